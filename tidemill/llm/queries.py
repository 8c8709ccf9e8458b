"""Queries pN_... of the corpus operators, each over its whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import abuse, lookalikes, mojibake, neardup, packing, residue, subjects, tokens, truncation
from tidemill.runtime import checkpointed, spread, table

#: Words of 64 bits, at most, that tell every task which ids are asked for; a power of two.
_WORDS = 1 << 20


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = table(spark, sf_dir, "raw_media", "id", "title", "content")
    return mojibake.restore_values(media).select("id", "field").distinct()


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = table(spark, sf_dir, "raw_media", "id", "title", "content")
    return mojibake.restore_values(media).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    social = table(spark, sf_dir, "raw_social", "id", "summary", "content")
    return truncation.truncated(social).select("id", "field").distinct()


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    social = table(spark, sf_dir, "raw_social", "id", "channel", "social_body_quality", "summary", "content")
    return truncation.truncation_report(social, truncation.truncated(social))


def p2_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cut values each way of knowing gives."""
    social = table(spark, sf_dir, "raw_social", "id", "summary", "content")
    return truncation.truncated(social).distinct().groupBy("field", "route").agg(F.count("*").alias("values"))


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, id, content) of both tables of records."""
    parts = (table(spark, sf_dir, name, "id", "content").select(F.lit(name).alias("table_name"), "id", "content") for name in ("raw_media", "raw_social"))
    return next(parts).unionAll(next(parts))


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents that change, without those that passed through a wrong encoding."""
    contents = _contents(spark, sf_dir)
    changed = lookalikes.unify(contents, lookalikes.share_counts(contents.select("content")), ("table_name", "id"))
    media = table(spark, sf_dir, "raw_media", "id", "content")
    damaged = mojibake.restore_values(media, columns=("content",)).select(F.lit("raw_media").alias("table_name"), "id")
    return changed.join(damaged, ["table_name", "id"], "left_anti")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).select("table_name", "id").distinct()


def p3_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).distinct()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _contents(spark, sf_dir)
    keyed = contents.select(F.struct("table_name", "id").alias("key"), "content")
    return residue.residue(keyed, "key", found=residue.mined(contents)).select("key.table_name", "key.id").distinct()


def p4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.templates(_contents(spark, sf_dir))


def p5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "raw_social", "id", "title", "content")
    model = abuse.fit_model(posts, table(spark, sf_dir, "social_reviews", "social_id", "rating", "reviewer"))
    return abuse.severity(posts, model)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_scores(spark, sf_dir).where(F.col("severity") >= abuse.CASE_FROM).select("id").distinct()


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.severity_rates(p5_scores(spark, sf_dir), table(spark, sf_dir, "raw_social", "id", "channel"))


def _out_of_part(spark: SparkSession, sf_dir: str, ids: DataFrame) -> DataFrame:
    """(id) of those ``ids`` whose content passed through a wrong encoding or is template residue."""
    media = table(spark, sf_dir, "raw_media", "id", "content")
    shared = mojibake.share_frequencies(spread(media, "id"), ("content",))
    # every id has a bit of some words that are sent; one that is asked without need only has no pair
    word, bit = F.xxhash64("id").bitwiseAND(_WORDS - 1), F.expr("shiftleft(1L, cast(shiftrightunsigned(xxhash64(id), 58) AS int))")
    words = checkpointed(ids.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")))
    asked = media.join(F.broadcast(words), word == F.col("word")).where(F.col("bits").bitwiseAND(bit) != 0).select("id", "content")
    return mojibake.restore_values(asked, columns=("content",), shared=shared).select("id").unionAll(residue.residue_alone(asked).select("id")).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = checkpointed(neardup.record_pairs(*neardup.class_pairs(table(spark, sf_dir, "raw_media", "id", "content"))))
    ids = pairs.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    out = checkpointed(_out_of_part(spark, sf_dir, ids))
    return pairs.join(out.select(F.col("id").alias("id_a")), "id_a", "left_anti").join(out.select(F.col("id").alias("id_b")), "id_b", "left_anti").select("id_a", "id_b")


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(*neardup.class_pairs(table(spark, sf_dir, "raw_media", "id", "content")))


def p6_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.representative_pairs(*neardup.class_pairs(table(spark, sf_dir, "raw_media", "id", "content")))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(p8_packed(spark, sf_dir))


def p9_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    rules = subjects.fit_rules(documents, table(spark, sf_dir, "doc_labels", "doc_id", "subject"), table(spark, sf_dir, "ticker_entities"))
    return subjects.subjects_of(documents, rules)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_subjects(spark, sf_dir).select("doc_id", "subject").distinct()


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "subjects", "subject", "name_en")
    found = p9_subjects(spark, sf_dir).groupBy("subject").agg(F.count("*").alias("documents"), F.sum("sentences").alias("sentences"))
    return names.join(found, "subject", "left").na.fill(0, ["documents", "sentences"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_rates, p2_routes, p3_found, p3_unified, p4_found, p4_templates, p5_found, p5_scores, p5_rates, p6_found, p6_groups, p6_pairs, p7_ids, p8_packed, p8_report, p9_found, p9_subjects, p9_composition)}


def oracle_sql() -> dict[str, str]:
    return {}
