import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_entry_and_keys(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.isdir(SF):
        assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n in ("quality_score", "merge_upsert", "text_normalise", "pull_order", "alias_mentions", "near_dup_hashes", "simhash_value", "stratified_sample")])
def test_queries_agree_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    mine = entry.queries()[name](spark, SF).toPandas()
    theirs = con.execute(entry.oracle_sql()[name]).df()[list(mine.columns)]
    rows = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).values.tolist()))
    assert rows(mine) == rows(theirs)
