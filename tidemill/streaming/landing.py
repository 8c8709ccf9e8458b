"""Landed payloads as a stream: new files are parsed, stamped and merged into a stored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.tables import merge_snapshot, prepared_batch


def payload_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(path, as_of, payload) of text files as they land; whole files, so a payload is never cut."""
    stream = spark.readStream.format("text").option("wholetext", "true").load(folder)
    return stream.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("as_of"), F.col("value").alias("payload"))


def merge_stream(items: DataFrame, folder: str, checkpoint: str, empty: Callable[[], DataFrame], keys: list[str], **stamps: str) -> StreamingQuery:
    """Merge each micro-batch of list rows into the table under ``folder``; runs until what has landed is read.

    Of the stored table only the parts that a batch touches are read and written. A batch that is delivered again
    after a failure overwrites the same keys, so the table stays the same.
    """

    def merge(batch: DataFrame, _: int) -> None:
        ready = prepared_batch(batch.withColumn("_o", F.struct("as_of", "ordinal")), "_o", **stamps)
        merge_snapshot(ready, folder, keys, F.current_timestamp(), empty())

    return items.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_counts(items: DataFrame, at: str = "published_at", late: str = "1 day") -> DataFrame:
    """(channel, hour, rows) of a stream of list rows; rows later than ``late`` are left out."""
    return items.withWatermark(at, late).groupBy("channel", F.window(at, "1 hour").alias("_w")).agg(F.count("*").alias("rows")).select("channel", F.col("_w.start").alias("hour"), "rows")
