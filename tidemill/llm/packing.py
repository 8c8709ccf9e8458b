"""Problem 8: fill containers of fixed capacity with documents, by large-item matching and best fit.

Items of one size are interchangeable, so the packing is planned on the histogram of sizes: at most
``capacity`` rows, however many documents there are. The plan is a list of segments ("items ranked r.. of
size s go, k each, to containers b.."), and every document finds its container by its rank among the items
of its size. Ranks come from hash partitions with offsets, so one size may hold any share of all rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.tokens import TOKENIZER_DIR, token_counts
from tidemill.runtime import checkpointed, spread

CAPACITY = 2048


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments (size, first rank, items per container, first container, containers) and the container count.

    Items above a third of the capacity go at most two to a container: the largest first, each with the
    largest other that still fits. Smaller items, again the largest first, go where the remaining gap is the
    smallest that holds them, and into new containers when none does. Every step handles a run of equal
    containers, so the work depends on the number of sizes only.
    """
    segments: list[tuple[int, int, int, int, int]] = []
    left = {size: n for size, n in histogram.items() if n > 0}
    rank = dict.fromkeys(left, 0)
    opened = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first container, containers)
    order: list[int] = []

    def keep(gap: int, first: int, count: int) -> None:
        if gap > 0 and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, count))

    def put(size: int, each: int, first: int, count: int) -> None:
        segments.append((size, rank[size], each, first, count))
        rank[size] += each * count
        left[size] -= each * count

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        size = large[-1]
        if not left[size]:
            large.pop()
            continue
        at = bisect_left(large, capacity - size + 1) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        if at < 0:
            count = left[size]
            put(size, 1, opened, count)
            keep(capacity - size, opened, count)
        elif large[at] == size:
            count = left[size] // 2
            if not count:  # one left: the next smaller ones may still join it
                rest = large[:at]
                while rest and not left[rest[-1]]:
                    rest.pop()
                count = 1
                put(size, 1, opened, 1)
                if rest:
                    put(rest[-1], 1, opened, 1)
                    keep(capacity - size - rest[-1], opened, 1)
                else:
                    keep(capacity - size, opened, 1)
            else:
                put(size, 2, opened, count)
                keep(capacity - 2 * size, opened, count)
        else:
            other = large[at]
            count = min(left[size], left[other])
            put(size, 1, opened, count)
            put(other, 1, opened, count)
            keep(capacity - size - other, opened, count)
        opened += count

    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(order, size)
            if at == len(order):
                gap, each = capacity, capacity // size
                first, count = opened, -(-left[size] // each)
                opened += count
            else:
                gap = order[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
                each = gap // size
            full = min(count, left[size] // each)
            if full:
                put(size, each, first, full)
                keep(gap - each * size, first, full)
            rest = left[size] if full < count else 0
            if rest:
                put(size, rest, first + full, 1)
                keep(gap - rest * size, first + full, 1)
                full += 1
            if full < count and gap < capacity:
                keep(gap, first + full, count - full)
    return segments, opened


def pack(items: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """(key, piece, first_token, n_tokens, container) of items of given sizes; no container holds over ``capacity``.

    An item longer than a container is cut: full containers of its own, the rest packed like a document.
    Items of null or zero size take no container and give no row. Keys must be unique. An empty table gives
    an empty result. ``container`` counts from 0 without gaps.
    """
    spark = items.sparkSession
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sized = items.select(F.col(key), F.col(size).cast("long").alias("_size")).where(F.col("_size") > 0)
    pieces = (
        sized.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_size") - 1) / capacity))))
        .withColumn("first_token", F.col("_piece") * capacity)
        .withColumn("n_tokens", F.least(F.lit(capacity), F.col("_size") - F.col("first_token")).cast("int"))
        .withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
        .select(key, F.col("_piece").cast("int").alias("piece"), F.col("first_token").cast("int").alias("first_token"), "n_tokens", "_part")
    )
    pieces = checkpointed(pieces)
    # At most capacity x parts rows; the offsets of the parts within a size are summed in the cluster.
    counts = pieces.groupBy("n_tokens", "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy("n_tokens").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("n_tokens", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    histogram = {r[0]: r[1] for r in counts.groupBy("n_tokens").agg(F.sum("_n")).collect()}  # one row a size: at most capacity
    segments, _ = plan_packing(histogram, capacity)
    # The plan depends on the histogram's sizes, not on the number of rows.
    plan = spark.createDataFrame(segments or [(0, 0, 1, 0, 0)], "n_tokens int, _first long, _each long, _container long, _containers long")
    by_size = plan.groupBy("n_tokens").agg(F.sort_array(F.collect_list(F.struct("_first", "_each", "_container", "_containers"))).alias("_segments"))
    local = W.partitionBy("n_tokens", "_part").orderBy(key, "piece")
    ranked = (
        pieces.withColumn("_local", F.row_number().over(local) - 1)
        .join(offsets, ["n_tokens", "_part"])
        .withColumn("_rank", F.col("_local") + F.col("_offset"))
    )
    found = F.element_at(F.filter("_segments", lambda s: (s["_first"] <= F.col("_rank")) & (F.col("_rank") < s["_first"] + s["_each"] * s["_containers"])), 1)
    return (
        ranked.join(F.broadcast(by_size), "n_tokens")
        .withColumn("_s", found)
        .select(
            key,
            "piece",
            "first_token",
            "n_tokens",
            (F.col("_s._container") + F.floor((F.col("_rank") - F.col("_s._first")) / F.col("_s._each"))).alias("container"),
        )
    )


def pack_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """:func:`pack` of documents by their number of tokens. Null and empty texts take no container."""
    spark = documents.sparkSession
    rows = spread(documents.select(F.col(key), F.col(text).alias("_text")), key)
    return pack(rows.select(key, token_counts(spark, F.col("_text"), vocabulary, tokenizer_dir).alias("_tokens")), key, "_tokens", capacity)


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, items, tokens, unused share, and the least number of containers that could do."""
    total = packed.agg(
        F.coalesce(F.max("container") + 1, F.lit(0)).alias("containers"),
        F.count("*").alias("items"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"),
    )
    return total.withColumn("least_containers", F.ceil(F.col("tokens") / capacity)).withColumn(
        "unused_share", F.when(F.col("containers") > 0, F.round(1 - F.col("tokens") / (F.col("containers") * capacity), 6)).otherwise(F.lit(0.0))
    )
