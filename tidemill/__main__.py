"""python -m tidemill: list the record queries, run one over a folder of tables, make the stored tables."""

from __future__ import annotations

import argparse
import sys


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("queries", help="names of the queries")
    run = commands.add_parser("run", help="run a query and write its rows")
    run.add_argument("name")
    run.add_argument("--data", required=True, help="folder of the Parquet tables")
    run.add_argument("--out", help="folder for the result as Parquet; else JSON lines on the console")
    run.add_argument("--require-rows", action="store_true", help="exit with 2 when there are none")
    init = commands.add_parser("init-tables", help="make the stored tables that a folder lacks")
    init.add_argument("folder")
    given = parser.parse_args(arguments)

    from tidemill.plans import catalog

    if given.command == "queries":
        print("\n".join(sorted(catalog.queries())))
        return 0

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.command == "init-tables":
        from tidemill.operators import tables

        print("\n".join(tables.init_tables(spark, given.folder)))
        return 0
    if given.name not in catalog.queries():
        print(f"no query {given.name}", file=sys.stderr)
        return 1
    result = catalog.queries()[given.name](spark, given.data)
    if given.out:
        result.write.parquet(given.out)
        some = not spark.read.parquet(given.out).isEmpty()
    else:
        some = False
        for line in result.toJSON().toLocalIterator():
            print(line)
            some = True
    return 2 if given.require_rows and not some else 0


if __name__ == "__main__":
    sys.exit(main())
