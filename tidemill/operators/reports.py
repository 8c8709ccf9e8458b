"""Counts and shares of collected records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """Rounded to four places, 0 when there is nothing to divide by."""
    return F.coalesce(F.round(part / F.nullif(whole, F.lit(0)), 4), F.lit(0.0))


def channel_summary(df: DataFrame, by: str, body: Column, relevant: Column) -> DataFrame:
    """Per channel: rows, rows with a body, relevant and irrelevant ones (null is relevant), and the shares."""
    out = df.groupBy(by).agg(F.count("*").alias("rows"), F.count_if(body).alias("with_body"), F.count_if(~relevant.eqNullSafe(False)).alias("relevant"), F.count_if(relevant.eqNullSafe(False)).alias("irrelevant"))
    return out.withColumns({"body_share": ratio(F.col("with_body"), F.col("rows")), "relevant_share": ratio(F.col("relevant"), F.col("rows"))})


def crawl_summary(listed: DataFrame, final: DataFrame, details: DataFrame, failures: DataFrame, by: str = "channel") -> DataFrame:
    """Per channel what a collection did: rows listed, rows kept, details read and failed, list pages that failed and
    the seconds they took. A channel that only one of the tables has is listed too, with 0 for the rest.

    ``details`` has ``ok`` (boolean), ``failures`` has ``failed`` (boolean) and ``seconds`` of each list page.
    """
    counted = [
        listed.groupBy(by).agg(F.count("*").alias("list")),
        final.groupBy(by).agg(F.count("*").alias("final")),
        details.groupBy(by).agg(F.count_if("ok").alias("detail_ok"), F.count_if(~F.col("ok")).alias("detail_fail")),
        failures.groupBy(by).agg(F.count_if("failed").alias("list_fail"), F.round(F.sum("seconds"), 2).alias("list_seconds")),
    ]
    # channels are few: the four small tables are united and summed instead of joined three times
    names = ["list", "final", "detail_ok", "detail_fail", "list_fail", "list_seconds"]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counted)
    return united.groupBy(by).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))


def batch_report(tasks: DataFrame, status: str = "status", started: str = "started_at", finished: str = "finished_at") -> DataFrame:
    """One row on a batch of tasks: how many, succeeded, failed and left, the share that succeeded, and the seconds from
    the first start to the last end."""
    out = tasks.agg(
        F.count("*").alias("total"), F.count_if(F.col(status) == "succeeded").alias("success"), F.count_if(F.col(status) == "failed").alias("failed"),
        F.coalesce(F.unix_timestamp(F.max(finished)) - F.unix_timestamp(F.min(started)), F.lit(0)).alias("seconds"),
    )
    return out.withColumns({"remaining": F.col("total") - F.col("success") - F.col("failed"), "success_share": ratio(F.col("success"), F.col("total"))})


def label_stats(labels: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """One row on labels to be written: attempted, valid, invalid, and those whose row is stored (written)."""
    found = labels.join(stored.select(*keys).distinct().withColumn("_stored", F.lit(True)), keys, "left")
    relevant = F.col("is_content_relevant").eqNullSafe(True)
    return found.agg(F.count("*").alias("attempted"), F.count_if(relevant).alias("valid"), F.count_if(~relevant).alias("invalid"), F.count("_stored").alias("written"))


def count_rows(df: DataFrame, market: str | None = None, ticker: str | None = None) -> DataFrame:
    """One row with the number of rows of a market and a ticker, where given."""
    for column, value in (("market", market), ("ticker", ticker)):
        if value is not None:
            df = df.where(F.col(column) == value)
    return df.agg(F.count("*").alias("n"))


def page_bounds(df: DataFrame, page: str, at: str) -> DataFrame:
    """(page, oldest, newest) of landed pages."""
    return df.groupBy(page).agg(F.min(at).alias("oldest"), F.max(at).alias("newest"))


def complete_scan(pages: DataFrame, page: str, failed: Column) -> DataFrame:
    """Pages that make a scan incomplete: failed ones and gaps in the numbering; an empty result is a whole scan."""
    numbered = pages.groupBy(page).agg(F.max(failed.cast("int")).alias("failed"))
    bounds = numbered.agg(F.min(page).alias("low"), F.max(page).alias("high"))
    wanted = bounds.where("low is not null").select(F.explode(F.sequence("low", "high")).alias(page))
    return wanted.join(numbered, page, "left").where("failed is null or failed = 1").select(page, F.when(F.col("failed").isNull(), "missing").otherwise("failed").alias("problem"))
