"""Whole flows: from list rows and details to labelled, grouped and sampled records with their counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.times import in_window
from tidemill.operators import dedupe, quality, relevance, tables


@dataclass(frozen=True)
class Window:
    """A half-open time window; without a sound custom one, the days before ``as_of``, open at the end."""

    as_of: str
    start: str | None = None
    end: str | None = None
    lookback_days: int = 7

    def bounds(self) -> tuple[Column, Column | None]:
        as_of = F.lit(self.as_of).cast("timestamp")
        if self.start and self.end and self.end > self.start:
            return F.lit(self.start).cast("timestamp"), F.lit(self.end).cast("timestamp")
        if not 1 <= self.lookback_days <= 30:
            raise ValueError("lookback_days must lie between 1 and 30")
        return as_of - F.make_dt_interval(days=F.lit(self.lookback_days)), None


def media(items: DataFrame, details: DataFrame, window: Window, limits: dict[str, int], default_limit: int = 60) -> DataFrame:
    """List rows (with ``aliases`` and an ``ordinal``) and details to labelled representatives of duplicates."""
    start, end = window.bounds()
    kept = items.where(in_window(F.col("published_at"), start, end, keep_null=True))
    kept = tables.earliest_per_key(kept, "url", "published_at", "ordinal")
    limit = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in limits.items() for x in kv)), F.col("channel")), F.lit(default_limit)) if limits else F.lit(default_limit)
    order = [F.coalesce("published_at", F.lit("0001-01-01").cast("timestamp")).desc(), F.length(F.coalesce("summary", F.lit(""))).desc(), F.col("ordinal")]
    chosen = tables.top_per_group(kept, "channel", limit, *order).select("url")
    merged = tables.join_details(kept, details.join(chosen, "url", "left_semi"))
    clean = relevance.drop_garbled(merged, "title", "summary", "content")
    labelled = relevance.label_relevance(relevance.label_length(clean, "media"))
    return dedupe.representatives(dedupe.group_duplicates(labelled, "ordinal"))


def social(items: DataFrame, details: DataFrame, window: Window, ticker: str, quota_7_days: int = quality.QUOTA_7_DAYS) -> DataFrame:
    """Posts of a window to scored posts with a sample selected; details are joined where a selected post needs one.

    With its detail a post is scored again, and one that is dropped then loses its place; nothing is chosen anew.
    """
    start, end = window.bounds()
    kept = items.where(in_window(F.col("published_at"), start, end, keep_null=False) & relevance.matches_ticker(F.col("url"), F.lit(ticker)))
    scored = quality.score_quality(kept.withColumn("content", F.lit(None).cast("string")))
    quota = quota_7_days
    if window.start and window.end:
        quota = items.sparkSession.range(1).select(quality.window_quota(quota_7_days, start, end)).first()[0]
    sampled = quality.stratified_sample(scored, quota, "published_at", "ordinal")
    wanted = tables.details_to_fetch(sampled, F.col("selected"), F.col("quality.detail_required"), "ordinal").select("url")
    merged = tables.join_details(sampled.drop("content", "quality"), details.join(wanted, "url", "left_semi"))
    again = quality.score_quality(merged)
    still = F.col("selected") & (F.col("quality.tier") != "drop")
    dropped = F.concat(F.lit("quality_drop:"), F.array_join("quality.reasons", ","))
    reason = F.when(F.col("quality.tier") == "drop", dropped).when(still, "selected_for_analysis").otherwise(F.lit(f"sampling_excluded:quota_{quota}"))
    return again.withColumns({"selected": still, "is_content_relevant": still, "content_relevance_reason": reason})


def counters(media_rows: DataFrame, social_rows: DataFrame) -> DataFrame:
    """One row of counts of a task's result; a media row without a label counts as relevant."""
    irrelevant = F.col("is_content_relevant").eqNullSafe(False)
    m = media_rows.agg(F.count("*").alias("media_fetched"), F.count_if(~irrelevant).alias("media_relevant"), F.count_if(irrelevant).alias("media_irrelevant"))
    s = social_rows.agg(F.count("*").alias("social_fetched"), F.count_if(F.col("selected")).alias("social_selected"), F.count_if(F.col("quality.tier") == "drop").alias("social_dropped"))
    return m.crossJoin(s)
