"""Exact and near duplicates of records by address, content hash and SimHash."""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.text import content_hash, nonempty, strip, text, tokens
from tidemill.runtime import checkpointed, ship

#: Similarity 0.90 of 64 bits.
MAX_DISTANCE = 6
#: Tokens whose votes are summed at once.
_TOKENS = 250_000


def _votes(rows: pa.ListArray) -> np.ndarray:
    """The SimHash of each list of tokens; a few hundred thousand tokens are voted on at once."""
    out = np.zeros(len(rows), np.uint64)
    sizes = np.asarray(pc.fill_null(pc.list_value_length(rows), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    tokens = rows.flatten().dictionary_encode()
    codes = np.asarray(tokens.indices)
    words = tokens.dictionary.to_pylist()
    tails = np.frombuffer(b"".join(hashlib.sha256(w.encode("utf-8", "surrogatepass")).digest()[-8:] for w in words), np.uint8).reshape(-1, 8)
    signs = np.unpackbits(tails, axis=1).astype(np.int8) * 2 - 1
    at = 0
    while at < len(rows):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + _TOKENS, "right")))
        some = np.flatnonzero(sizes[at:to]) + at
        if len(some):
            votes = np.add.reduceat(signs[codes[done : ends[to - 1]]], ends[some] - sizes[some] - done, axis=0, dtype=np.int64)
            out[some] = np.packbits(votes > 0, axis=1).view(">u8").ravel()
        at = to
    return out.view(np.int64)


def simhash(df: DataFrame, key: str, column: Column) -> DataFrame:
    """(key, simhash): for every row 64 bits, each set when more tokens have it set than not; 0 without tokens.

    The votes of a row are its own, so nothing is exchanged: tokens are cut by built-in expressions and voted on in
    Arrow batches, each different token of a batch hashed once.
    """
    ship(df.sparkSession)

    @F.arrow_udf("long")
    def voted(rows: pa.Array) -> pa.Array:
        return pa.array(_votes(rows))

    return df.select(key, voted(tokens(column)).alias("simhash"))


def simhash_hex(column: Column) -> Column:
    """16 hex digits; null for 0."""
    return F.when(column != 0, F.lpad(F.lower(F.hex(column)), 16, F.lit("0")))


def similarity(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def _keys(rows: int) -> tuple[int, int]:
    """(blocks, equal ones): 64 bits in so many blocks, of which so many are equal where at most six bits differ.

    More rows need wider keys to have few rows a key. Every choice finds the same pairs.
    """
    for taken in (1, 2, 3):
        if rows <= 200 << (64 * taken // (MAX_DISTANCE + taken)):
            return MAX_DISTANCE + taken, taken
    return MAX_DISTANCE + 4, 4


def _blocked(column: Column, blocks: int, taken: int) -> Column:
    """All keys of a SimHash: the bits of so many blocks, hashed with their numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [F.shiftrightunsigned(column, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) for low, high in zip(edges, edges[1:])]
    return F.array(*(F.xxhash64(F.lit(i), *(bits[b] for b in which)) for i, which in enumerate(combinations(range(blocks), taken))))


def near_classes(df: DataFrame, simhash_column: str = "simhash", scope: list[str] | None = None, distance: int = MAX_DISTANCE) -> DataFrame:
    """(scope, sa, sb), sa < sb: the pairs of different SimHashes of at most ``distance`` (6 or less) bits within a scope."""
    scope = scope or []
    distinct = df.where(F.col(simhash_column) != 0).select(*scope, F.col(simhash_column).alias("_s")).distinct()
    distinct = checkpointed(distinct)
    keyed = distinct.withColumn("_block", F.explode(_blocked(F.col("_s"), *_keys(distinct.count()))))
    left, right = keyed.select(*scope, "_block", F.col("_s").alias("sa")), keyed.select(*scope, "_block", F.col("_s").alias("sb"))
    return left.join(right, [*scope, "_block"]).where((F.col("sa") < F.col("sb")) & (F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= distance)).select(*scope, "sa", "sb").distinct()


def near_pairs(df: DataFrame, key: str, simhash_column: str = "simhash", scope: list[str] | None = None, distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b), a < b: all pairs of keys whose SimHash differs in at most ``distance`` (6 or less) bits, within a scope.

    Rows of one SimHash are one row of the search. The result holds every pair of copies too; where there are many,
    :func:`near_classes` beside (key, SimHash) says the same in fewer rows.
    """
    scope = scope or []
    held = df.where(F.col(simhash_column) != 0).select(*scope, F.col(key).alias("_k"), F.col(simhash_column).alias("_s")).distinct()
    of = lambda s, name: held.select(*scope, F.col("_s").alias(s), F.col("_k").alias(name))
    near = near_classes(df, simhash_column, scope, distance).join(of("sa", "x"), [*scope, "sa"]).join(of("sb", "y"), [*scope, "sb"])
    same = of("_s", "x").join(of("_s", "y"), [*scope, "_s"]).where("x < y")
    return near.select("x", "y").unionAll(same.select("x", "y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def group_duplicates(df: DataFrame, ordinal: str, scope: list[str] | None = None) -> DataFrame:
    """Adds ``group``: each row, in the order of ``ordinal``, joins the first group that has a row that it matches.

    Columns title, content and url identify a row; rows match by address, content hash or near SimHash within a
    scope. Groups never merge, as in a pass over the rows in order: a row's label is the smallest among its earlier
    matches, repeated until nothing changes. Rows that share an address or hash form a class, and of a class only
    the first row of each label is asked, so copies are never paired. A row with a null in its scope matches none.
    """
    scope = scope or []
    body = F.coalesce(nonempty(text(F.col("content"))), text(F.col("title")))
    base = df.withColumns({"_url": nonempty(strip(F.col("url"))), "content_hash": content_hash(body)})
    prints = simhash(base, ordinal, F.concat_ws(" ", text(F.col("title")), text(F.col("content")))).withColumnRenamed("simhash", "_simhash")
    base = checkpointed(base.join(prints, ordinal))
    scoped = reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in scope), F.lit(True))
    names = F.array(*(F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in (("u", F.col("_url")), ("h", nonempty(F.col("content_hash"))), ("s", F.nullif(F.col("_simhash"), F.lit(0))))))
    classes = base.where(scoped).select(F.col(ordinal).alias("b"), *scope, F.explode(F.filter(names, lambda n: n["v"].isNotNull())).alias("_n"))
    classes = checkpointed(classes.select("b", F.xxhash64("_n.k", "_n.v", *scope).alias("class")))
    shared = classes.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
    near = near_classes(base.where(scoped), "_simhash", scope)
    name = lambda s: F.xxhash64(F.lit("s"), F.col(s).cast("string"), *scope)
    near = near.select(name("sa").alias("x"), name("sb").alias("y"))
    near = checkpointed(near.unionAll(near.select(F.col("y").alias("x"), F.col("x").alias("y"))))
    asked = shared.unionAll(near.select(F.col("x").alias("class"))).distinct()
    classes = checkpointed(classes.join(asked, "class", "left_semi"))
    labels = classes.select("b").distinct().select("b", F.col("b").alias("label"))
    while True:
        first = classes.join(labels, "b").groupBy("class", "label").agg(F.min("b").alias("at"))
        first = first.unionAll(near.join(first.withColumnRenamed("class", "x"), "x").select(F.col("y").alias("class"), "label", "at"))
        nearest = classes.join(first, "class").where("at < b").groupBy("b").agg(F.min("label").alias("new"))
        new = checkpointed(labels.join(nearest, "b", "left").select("b", F.coalesce("new", "b").alias("label"), F.col("label").alias("_old")))
        changed = not new.where("label <> _old").isEmpty()
        labels = new.select("b", "label")
        if not changed:
            break
    out = base.join(labels.select(F.col("b").alias(ordinal), F.col("label").alias("group")), ordinal, "left").withColumn("group", F.coalesce("group", ordinal))
    return out.withColumn("simhash", simhash_hex(F.col("_simhash"))).drop("_url", "_simhash")


def representatives(grouped: DataFrame, published: str = "published_at", ordinal: str = "ordinal", most_urls: int = 1000) -> DataFrame:
    """One row a group: the earliest (undated last, then by address), with ``duplicate_count`` and the first ``most_urls``
    distinct addresses in that order.

    All members of a group stand in ``grouped``; the list is for reading, so that no group meets in one row.
    """
    at = F.coalesce(F.col(published), F.expr("timestamp'9999-12-31'"))
    key = F.struct(at.alias("at"), text(F.col("url")).alias("url"), F.col(ordinal).alias("o"))
    row = F.struct(*[c for c in grouped.columns if c != "group"])
    url = nonempty(strip(F.col("url")))
    once = grouped.where(url.isNotNull()).groupBy("group", url.alias("_u")).agg(F.min(key).alias("_k"))
    ranked = once.withColumn("_rank", F.row_number().over(W.partitionBy("group").orderBy("_k"))).where(F.col("_rank") <= most_urls)
    urls = ranked.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_u"))), lambda x: x["_u"]).alias("duplicate_urls"))
    out = grouped.groupBy("group").agg(F.min_by(row, key).alias("_r"), F.count("*").cast("int").alias("duplicate_count"))
    return out.join(urls, "group", "left").select("group", "_r.*", "duplicate_count", F.coalesce("duplicate_urls", F.array().cast("array<string>")).alias("duplicate_urls"))


def in_order(representatives_: DataFrame, published: str = "published_at") -> DataFrame:
    """Representatives by their time, undated last, then by group."""
    return representatives_.orderBy(F.col(published).asc_nulls_last(), "group")
