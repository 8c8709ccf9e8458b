"""Session plumbing that every operator shares: table access, lineage cuts, code shipping, parallelism.

Nothing here changes a result. Lineage is cut only with reliable checkpoints in the folder that the
cluster names in ``spark.checkpoint.dir``, so a lost executor never loses a finished stage.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table of ``sf_dir``; only ``columns`` are read when given (column pruning at the scan)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint.

    The folder comes from ``spark.checkpoint.dir``. Where that is unset, as in tests, a temporary folder is
    set, which is refused on a real cluster because executors would not share it.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir", "")
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidemill-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application, so Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tidemill-code-"), "tidemill.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as bundle:
        for path in sorted(root.rglob("*.py")):
            bundle.write(path, path.relative_to(root.parent))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def ship_active() -> None:
    """:func:`ship` for the active session, for functions that only see columns."""
    if (spark := SparkSession.getActiveSession()) is not None:
        ship(spark)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give CPU-heavy Python stages at least as many partitions as there are cores.

    A large input already has enough scan splits and passes through without an exchange; a small file in one
    split is hash-partitioned by ``keys``.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, *keys)
