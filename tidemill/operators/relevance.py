"""Filters and labels: windows, evidence, length and relevance of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import codes
from tidemill.functions.text import CJK, WS, clean, collapse, compact_cjk, garbled, nonempty, stripped_length, text, without_controls

# Fixed values of the source rules.
MAX_CHARS = {"media": 5000, "social": 250}
NEGATIVE = ["多股上涨", "多股下跌", "板块走强", "龙虎榜", "早盘异动", "午后异动", "资金流入", "资金流出", "资金净流入", "资金净流出", "特大单"]
BLOCK_MARKS = ["验证码", "访问过于频繁", "sys-guard", "fd_guba_validate", "em_capt", "validate.js", "身份核实", "东方财富证券"]
ARTICLE_HOSTS = r"(?:finance|stock|cj)\.sina\.(?:com|cn)"
QUOTE_PAGE_PARTS = ["zixuan", "shortcut.php", "/mkt/", "/stock/index", "/fund/", "/futuremarket/", "/money/", "/guide/"]


def matches_ticker(url: Column, ticker: Column) -> Column:
    """Whether a forum address is of the ticker; addresses without one pass."""
    found = codes.forum_ticker(url)
    return found.isNull() | (found == F.upper(ticker))


def has_evidence(column: Column, forms: Column) -> Column:
    """Whether a text mentions any alias of an array column.

    ASCII aliases count as whole words whatever their case; others as substrings, as they stand or without white
    space between Han characters, of the text in either form. Null and blank aliases say nothing.
    """
    whole = clean(column)
    compact = F.regexp_replace(whole, f"(?<={CJK}){WS}+(?={CJK})", "")
    quoted = lambda a: F.concat(F.lit(r"\Q"), a, F.lit(r"\E"))
    word = lambda a: F.concat(F.lit("(?<![A-Za-z0-9])(?i:"), quoted(a), F.lit(")(?![A-Za-z0-9])"))
    # one pattern for all aliases of a row; a lambda couldn't read a text that Python has repaired
    said = F.filter(F.transform(F.coalesce(forms, F.array().cast("array<string>")), without_controls), lambda a: a != "")
    pattern = F.array_join(F.transform(said, lambda a: F.when(a.rlike("^[A-Za-z0-9.:-]+$"), word(a)).otherwise(F.concat(quoted(a), F.lit("|"), quoted(compact_cjk(a))))), "|")
    return (pattern != "") & (F.regexp_like(whole, pattern) | F.regexp_like(compact, pattern))


def is_article_url(url: Column, hosts: str = ARTICLE_HOSTS) -> Column:
    """Whether an address is on a host of articles and no quote, fund or help page."""
    out = text(url).rlike(hosts)
    for part in QUOTE_PAGE_PARTS:
        out = out & ~F.contains(text(url), F.lit(part))
    return out


def is_block_page(html: Column) -> Column:
    out = text(html) == ""
    for mark in BLOCK_MARKS:
        out = out | F.contains(text(html), F.lit(mark))
    return out


def drop_garbled(df: DataFrame, *columns: str) -> DataFrame:
    bad = F.lit(False)
    for c in columns:
        bad = bad | garbled(F.col(c))
    return df.where(~bad)


def drop_blank_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.where(stripped_length(F.col(url)) > 0)


def label_length(df: DataFrame, source_type: str = "media", content: str = "content", limit: int | None = None) -> DataFrame:
    """``is_content_relevant`` false with a reason for contents over the limit; other rows keep what they have."""
    limit = limit or MAX_CHARS[source_type]
    long = stripped_length(F.col(content)) > limit
    old = {c: F.col(c) if c in df.columns else F.lit(None) for c in ("is_content_relevant", "content_relevance_reason")}
    return df.withColumns(
        {
            "is_content_relevant": F.when(long, F.lit(False)).otherwise(old["is_content_relevant"].cast("boolean")),
            "content_relevance_reason": F.when(long, F.lit(f"length_filter:content_chars>{limit}")).otherwise(old["content_relevance_reason"].cast("string")),
        }
    )


def relevance(df: DataFrame, title: str, content: str, summary: str, forms: str, negative: list[str] = NEGATIVE) -> DataFrame:
    """Adds ``decision``: how a text is about its company, by the first rule of the ladder that holds.

    ``forms`` is an array column of aliases. The counts behind the decision are in it as well.
    """
    body = F.concat_ws(" ", text(F.col(title)), F.coalesce(nonempty(F.col(content)), nonempty(F.col(summary)), F.lit("")))
    own_codes = F.transform(F.coalesce(F.col(forms), F.array().cast("array<string>")), codes.code)
    df = df.withColumns({"_body": collapse(body), "_title": collapse(F.col(title))})
    df = df.withColumns({"_m": codes.mentions(F.col("_body"), F.col(forms)), "_t": codes.mentions(F.col("_title"), F.col(forms))})
    others = F.filter(codes.stock_codes(F.col("_body")), lambda c: ~F.array_contains(own_codes, c))
    df = df.withColumn("_others", others).withColumns({"_o": F.size("_others"), "_u": F.size(F.array_distinct("_others"))})
    total = F.col("_m") + F.col("_o")
    share = F.when(total > 0, F.col("_m") / total).otherwise(F.lit(0.0))
    hit = F.lit(False)
    for word in negative:
        hit = hit | F.contains(F.col("_body"), F.lit(word))
    reason = (
        F.when(F.col("_m") == 0, "target_not_found_kept")
        .when(hit, "negative_pattern_hit")
        .when((F.col("_t") > 0) & (F.col("_m") >= 2), "target_in_title_and_repeated")
        .when((F.col("_u") <= 1) & (F.col("_m") >= 2), "target_dominant_with_few_other_tickers")
        .when(F.col("_u") >= 5, "too_many_other_tickers")
        .when((share <= 0.35) & (total > 7), "low_target_share_with_many_mentions")
        .otherwise("edge_case_kept_to_avoid_false_negative")
    )
    no = ["negative_pattern_hit", "too_many_other_tickers", "low_target_share_with_many_mentions"]
    decision = F.struct(
        (~reason.isin(no)).alias("is_relevant"), reason.alias("reason"), F.col("_m").alias("target_mentions"), F.col("_u").alias("other_tickers"), F.col("_o").alias("other_mentions"), total.alias("total_mentions"), F.round(share, 6).alias("target_share")
    )
    return df.withColumn("decision", decision).drop("_body", "_title", "_m", "_t", "_others", "_o", "_u")


def label_relevance(df: DataFrame, title: str = "title", content: str = "content", summary: str = "summary", forms: str = "aliases") -> DataFrame:
    """Rows labelled irrelevant before keep their label; the others get the ladder's."""
    df = relevance(df, title, content, summary, forms)
    before = F.col("is_content_relevant").eqNullSafe(False)
    return df.withColumns(
        {
            "is_content_relevant": F.when(before, F.lit(False)).otherwise(F.col("decision.is_relevant")),
            "content_relevance_reason": F.when(before, F.coalesce(F.col("content_relevance_reason"), F.lit("preclassified_irrelevant"))).otherwise(F.col("decision.reason")),
        }
    ).drop("decision")
