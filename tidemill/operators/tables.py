"""Choosing, joining and keeping records: top rows, first and last per key, details, upserts, states."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions import codes
from tidemill.functions.text import nonempty, strip, text
from tidemill.runtime import checkpointed

# The stored tables. Columns of records in their order; what a null means where it means something.
_RECORD = "id string, task_id string, market string, ticker string, published_at timestamp, source_type string, channel string, source_name string, title string, summary string, content string, url string, origin_keyword_type string, is_content_relevant boolean, content_relevance_reason string"
SCHEMAS = {
    "ticker_entities": "id string, market string, ticker string, company_name string, short_name string, english_name string, exchange string, updated_at timestamp",
    "crawler_tasks": "task_id string, market string, ticker string, lookback_days int, window_start timestamp, window_end timestamp, collect_media boolean, collect_social boolean, status string, error string, created_at timestamp, updated_at timestamp",
    "raw_media": _RECORD + ", duplicate_count int, duplicate_urls array<string>, content_hash string, simhash string, created_at timestamp, updated_at timestamp",
    "raw_social": _RECORD
    + ", social_quality_score int, social_quality_tier string, social_quality_reasons array<string>, social_body_quality string, social_detail_required boolean, social_selected_for_analysis boolean,"
    " social_sampling_bucket string, social_sampling_reason string, social_content_chars int, social_read_count int, social_comment_count int, social_like_count int, social_forward_count int,"
    " social_has_image boolean, social_is_top boolean, created_at timestamp, updated_at timestamp",
}
_NO_STRINGS = "cast(array() as array<string>)"
DEFAULTS = {"duplicate_count": "1", "duplicate_urls": _NO_STRINGS, "social_quality_reasons": _NO_STRINGS, "origin_keyword_type": "'Base'"}


def top_per_group(df: DataFrame, group: str, limits: Column, *order: Column) -> DataFrame:
    """The first rows of every group in an order, up to the group's limit. The order must end in a unique key."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("rank") <= limits)


def earliest_per_key(df: DataFrame, key: str, at: str, ordinal: str) -> DataFrame:
    """Of each key the earliest dated row, an undated one only when there is no other; ties keep the first.

    A hash aggregation with a partial minimum, so a hot key never meets in one task.
    """
    order = F.struct(F.col(at).isNull().alias("n"), F.col(at).alias("t"), F.col(ordinal).alias("o"))
    return df.groupBy(key).agg(F.min_by(F.struct(*(c for c in df.columns if c != key)), order).alias("_r")).select(key, "_r.*")


def last_per_key(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The last row of each key in a batch."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ordinal)).alias("_r")).select(*keys, "_r.*")


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str], now: Column, created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """``stored`` with the rows of ``batch``: every column of a known key is overwritten, nulls included, but for
    the time it was created; a new key is added. ``batch`` has one row per key."""
    values = [c for c in stored.columns if c not in (*keys, created, updated)]
    new = batch.select(*keys, F.struct(*(F.col(c) if c in batch.columns else F.lit(None).alias(c) for c in values)).alias("_new"))
    old = stored.select(*keys, F.struct(*values).alias("_old"), created, updated)
    both = old.join(new, keys, "full_outer")
    kept = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in values]
    return both.select(*keys, *kept, F.coalesce(F.col(created), now).alias(created), F.when(F.col("_new").isNotNull(), now).otherwise(F.col(updated)).alias(updated)).select(*stored.columns)


def prepared_batch(df: DataFrame, ordinal: str, **stamps: str) -> DataFrame:
    """A batch for :func:`upsert`: rows without an address dropped, the last of each trimmed address, stamped with values."""
    kept = df.where(strip(F.col("url")) != "").withColumn("_key", strip(F.col("url")))
    return last_per_key(kept, ["_key"], ordinal).drop("_key", ordinal).withColumns({k: F.lit(v) for k, v in stamps.items()})


def _filesystem(spark: SparkSession, folder: str):
    """(file system, path) of a folder, wherever it lies: Hadoop's interface, so no driver-local files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _marks(spark: SparkSession, folder: str) -> tuple[int, dict[str, str]]:
    """(the highest number of a snapshot, {part: folder} of the last whole one). A mark that a writer left empty is none."""
    system, path = _filesystem(spark, f"{folder}/marks")
    if not system.exists(path):
        return 0, {}
    numbers = sorted(int(s.getPath().getName()) for s in system.listStatus(path))
    for number in reversed(numbers):
        stream = system.open(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/marks/{number}"))
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if text.endswith("\n"):
            return numbers[-1], json.loads(text)
    return numbers[-1] if numbers else 0, {}


def _publish(spark: SparkSession, folder: str, number: int, parts: dict[str, str]) -> None:
    """Make a snapshot the current one: one small file that is created once, so of two writers of a number one fails."""
    system, path = _filesystem(spark, f"{folder}/marks/{number}")
    if not claim_once(spark, f"{folder}/marks", str(number)):
        raise RuntimeError(f"another writer made snapshot {number} of {folder}")
    stream = system.create(path, True)
    stream.write(bytearray((json.dumps(parts) + "\n").encode()))
    stream.close()


def write_snapshot(df: DataFrame, folder: str) -> str:
    """Write a table as a new snapshot beside the old ones and then its mark, so readers never see half a table."""
    spark, name = df.sparkSession, f"snapshot-{uuid.uuid4().hex}"
    number = _marks(spark, folder)[0] + 1
    df.write.parquet(f"{folder}/{name}")
    _publish(spark, folder, number, {"": f"{folder}/{name}"})
    return name


def has_snapshot(spark: SparkSession, folder: str) -> bool:
    return bool(_marks(spark, folder)[1])


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(*sorted(_marks(spark, folder)[1].values()))


def merge_snapshot(batch: DataFrame, folder: str, keys: list[str], now: Column, empty: DataFrame, parts: int = 64) -> int:
    """:func:`upsert` of a batch into the table under ``folder``, kept in ``parts`` by a hash of its keys: only the parts
    that the batch touches are read and written again, the others go on into the new snapshot as they are. Gives
    how many parts were written. A table that was written whole is divided at its first merge."""
    spark, name = batch.sparkSession, f"snapshot-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    batch = checkpointed(batch.withColumn("_part", part))
    touched = [str(r[0]) for r in batch.select("_part").distinct().collect()]  # at most ``parts``
    number, held = _marks(spark, folder)
    if "" in held:
        touched = [str(i) for i in range(parts)]
        stored, held = spark.read.parquet(held[""]), {}
    else:
        paths = [held[p] for p in touched if p in held]
        stored = spark.read.parquet(*paths).select(*empty.columns) if paths else empty
    if not touched:
        return 0
    merged = upsert(stored, batch.drop("_part"), keys, now).withColumn("_part", part)
    merged.repartition("_part").write.partitionBy("_part").parquet(f"{folder}/{name}")
    system, _ = _filesystem(spark, folder)
    new = {p: at for p in touched if system.exists(spark._jvm.org.apache.hadoop.fs.Path(at := f"{folder}/{name}/_part={p}"))}
    _publish(spark, folder, number + 1, held | new)
    return len(new)


def claim_once(spark: SparkSession, folder: str, name: str) -> bool:
    """Whether this call is the first to claim ``name`` in a shared folder; a file that is created but never replaced."""
    system, path = _filesystem(spark, f"{folder}/{name}")
    try:
        system.create(path, False).close()
        return True
    except Exception:  # the gateway wraps Java's exception
        if system.exists(path):
            return False
        raise


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A stored table without rows."""
    return spark.createDataFrame([], SCHEMAS[name])


def init_tables(spark: SparkSession, folder: str) -> list[str]:
    """Make the stored tables that a folder lacks; gives their names."""
    missing = [n for n in SCHEMAS if not has_snapshot(spark, f"{folder}/{n}")]
    for name in missing:
        write_snapshot(empty_table(spark, name), f"{folder}/{name}")
    return missing


def canonical(df: DataFrame, name: str) -> DataFrame:
    """The rows in the stored form of a table: its columns in order, in their types, the ones that lack as null, and
    defaults for nulls that mean something. Values that a type can't hold become null; other columns are left out.
    Also brings tables of an older form to the present one."""

    def of(field) -> Column:
        kind = field.dataType.simpleString()
        if field.name not in df.columns:
            value = F.lit(None).cast(kind)
        else:
            value = F.col(field.name)
            if df.schema[field.name].dataType != field.dataType:
                value = value.try_cast(kind)
        return (F.coalesce(value, F.expr(DEFAULTS[field.name])) if field.name in DEFAULTS else value).alias(field.name)

    return df.select(*map(of, empty_table(df.sparkSession, name).schema.fields))


def entities(df: DataFrame, of_market: str) -> DataFrame:
    """Rows of any list of companies as (market, ticker, names, exchange), whatever its columns are called; bad tickers
    are made up with zeros, rows without one are left out."""
    made = df.select(F.lit(of_market).alias("market"), *(codes.first_said(names, df.columns).alias(c) for c, names in codes.ENTITY_COLUMNS.items())).where("ticker <> ''")
    good = codes.ticker(F.col("ticker"), F.lit(of_market))
    return made.withColumn("ticker", F.coalesce(good, codes.padded_ticker(F.col("ticker"), F.lit(of_market))))


def first_list(lists: list[DataFrame]) -> DataFrame:
    """The rows of the first list that has any, as one plan."""
    ranked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (x.withColumn("_list", F.lit(i)) for i, x in enumerate(lists)))
    best = ranked.agg(F.min("_list").alias("_best"))  # one row
    return ranked.join(F.broadcast(best), F.col("_list") == F.col("_best")).drop("_list", "_best")


def refresh_entities(stored: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """``stored`` companies (market, ticker, names, exchange, updated_at) with those of ``batch``: a value that says
    something replaces the stored one, an empty or null one doesn't. ``batch`` has one row per key."""
    keys, fields = ["market", "ticker"], ["company_name", "short_name", "english_name", "exchange"]
    new = batch.select(*keys, F.struct(*fields).alias("_new"))
    both = stored.select(*keys, F.struct(*fields).alias("_old"), "updated_at").join(new, keys, "full_outer")
    values = [F.coalesce(nonempty(strip(F.col(f"_new.{c}"))), F.col(f"_old.{c}")).alias(c) for c in fields]
    return both.select(*keys, *values, F.when(F.col("_new").isNotNull(), now).otherwise(F.col("updated_at")).alias("updated_at"))


def entity_aliases(wanted: DataFrame, stored: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(market, ticker, names) of the ``wanted`` companies: the ticker and the distinct names of the stored entity; of
    the snapshot (market, ticker, company_name) for companies that aren't stored. In order, without blanks."""
    keys, fields = ["market", "ticker"], ["company_name", "short_name", "english_name"]
    known = stored.select(*keys, F.array(*fields).alias("_stored"))
    other = snapshot.select(*keys, F.array("company_name").alias("_other"))
    names = F.concat(F.array("ticker"), F.coalesce("_stored", "_other", F.array().cast("array<string>")))
    names = F.array_distinct(F.filter(F.transform(names, strip), lambda n: n != ""))
    return wanted.select(*keys).distinct().join(known, keys, "left").join(other, keys, "left").select(*keys, names.alias("names"))


def write_labels(stored: DataFrame, labels: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """``stored`` with the two labels of the rows that ``labels`` (keys, is_content_relevant, content_relevance_reason)
    has; the other rows as they are. Labels of unknown keys change nothing; of several the last by reason holds."""
    fields = ["is_content_relevant", "content_relevance_reason"]
    new = labels.groupBy(*keys).agg(F.max(F.struct(*reversed(fields))).alias("_new"))
    j = stored.join(new, keys, "left")
    known = F.col("_new").isNotNull()
    changed = {f: F.when(known, F.col(f"_new.{f}")).otherwise(F.col(f)) for f in fields} | {"updated_at": F.when(known, now).otherwise(F.col("updated_at"))}
    return j.withColumns(changed).select(*stored.columns)


def latest_state(events: DataFrame, key: str, order: Column) -> DataFrame:
    """The last event of each key of an append-only log."""
    return events.groupBy(key).agg(F.max_by(F.struct(*(c for c in events.columns if c != key)), order).alias("_r")).select(key, "_r.*")


def pull_order(df: DataFrame, published: str = "published_at", created: str = "created_at", key: str = "id", scope: str = "task_id") -> DataFrame:
    """Adds ``position`` in the order in which a task's records are handed out: newest first, undated last."""
    return df.withColumn("position", F.row_number().over(W.partitionBy(scope).orderBy(F.col(published).desc_nulls_last(), F.col(created).desc_nulls_last(), F.col(key))))


def join_details(items: DataFrame, details: DataFrame, on: str = "url") -> DataFrame:
    """List rows with their detail: content is the detail's text, else the summary, else the title; the summary is the
    detail's, else the list's. ``details`` has (on, full_text, detail_summary), one row per key."""
    j = items.join(details, on, "left")
    return j.withColumns(
        {
            "content": F.coalesce(nonempty(strip(F.col("full_text"))), nonempty(strip(F.col("summary"))), text(F.col("title"))),
            "summary": F.coalesce(nonempty(strip(F.col("detail_summary"))), F.col("summary")),
            "has_detail": F.col("full_text").isNotNull(),
        }
    ).drop("full_text", "detail_summary")


def merge_entities(df: DataFrame, keys: list[str], ordinal: Column, *columns: str) -> DataFrame:
    """One row per key: of every column the last value that isn't empty."""
    last = [F.max_by(nonempty(strip(F.col(c))), F.when(nonempty(strip(F.col(c))).isNotNull(), ordinal)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*last)


def replayed_pages(pages: DataFrame, items: DataFrame, page: str, at: str, start: Column, end: Column | None = None, by: str = "oldest") -> DataFrame:
    """The rows of ``items`` that a scan page by page sees: those of all pages up to the first whose ``oldest`` or
    ``newest`` row lies before ``start``, which is read too. ``pages`` has the number of every landed page."""
    edge = (F.min if by == "oldest" else F.max)(at)
    stop = items.groupBy(page).agg(edge.alias("_edge")).where(F.col("_edge") < start).agg(F.min(page).alias("_stop"))  # one row
    read = pages.select(page).distinct().join(F.broadcast(stop)).where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).select(page)
    seen = items.join(read, page, "left_semi").where(F.col(at).isNull() | (F.col(at) >= start))
    return seen if end is None else seen.where(F.col(at).isNull() | (F.col(at) < end))


def first_page_of_window(items: DataFrame, page: str, at: str, end: Column) -> DataFrame:
    """One row, ``first_page``: the first page with a row before ``end``, from which a scan of a past window starts."""
    return items.groupBy(page).agg(F.min(at).alias("_oldest")).where(F.col("_oldest") < end).agg(F.min(page).alias("first_page"))


def details_to_fetch(df: DataFrame, selected: Column, required: Column, ordinal: str, url: str = "url") -> DataFrame:
    """Distinct addresses of rows that are selected and need their detail, in order of first appearance."""
    return df.where(selected & required).groupBy(url).agg(F.min(ordinal).alias("first_ordinal"))


def crawl_plan(channels: DataFrame, terms: DataFrame, market: str) -> DataFrame:
    """Every channel that serves a market with every search term; both are small dimensions, the plan is their product."""
    return channels.where(F.array_contains("enabled_markets", market)).crossJoin(terms)
