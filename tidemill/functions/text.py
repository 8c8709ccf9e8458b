"""Text columns: cleaning, counting, identity, tokens. All built-in expressions unless stated.

Null texts are treated as empty, as in every rule below; lengths count code points.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.runtime import ship_active

# Character classes that agree with the source rules' regex engine, in the JVM's notation.
WS = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
CJK = r"[一-鿿]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
MOJIBAKE = r"(?:Ã[^\n]|Â[^\n]|â[^\n]|ä[^\n]|å[^\n]|æ[^\n]|ç[^\n]|è[^\n]|é[^\n]|ï¼|ã€|\x{FFFD}|锟斤拷)"


def text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def nonempty(column: Column) -> Column:
    """The value, or null where it is empty, for "first that says something" chains."""
    return F.nullif(column, F.lit(""))


def strip(column: Column) -> Column:
    return F.regexp_replace(text(column), f"^{WS}+|{WS}+$", "")


def collapse(column: Column) -> Column:
    """White space of any kind to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text(column), f"{WS}+", " "))


def without_tags(column: Column) -> Column:
    """Markup tags to spaces, then :func:`collapse`."""
    return collapse(F.regexp_replace(text(column), r"<[^>]+>", " "))


def compact_cjk(column: Column) -> Column:
    """No white space between two Han characters."""
    return F.regexp_replace(collapse(column), f"(?<={CJK}){WS}+(?={CJK})", "")


def without_controls(column: Column) -> Column:
    return collapse(F.regexp_replace(text(column), CONTROL, ""))


def clean(column: Column) -> Column:
    """:func:`repaired`, then no control characters, then :func:`collapse`."""
    return without_controls(repaired(column))


def stripped_length(column: Column) -> Column:
    return F.length(strip(column))


def cjk_count(column: Column) -> Column:
    return F.length(F.regexp_replace(text(column), r"[^一-鿿]", ""))


def content_chars(column: Column) -> Column:
    """Characters that are ASCII letters, digits or Han."""
    return F.length(F.regexp_replace(text(column), r"[^A-Za-z0-9一-鿿]", ""))


def combined(*columns: Column) -> Column:
    """Distinct non-empty texts in order, joined by a space, each without tags."""
    parts = F.array(*(without_tags(c) for c in columns))
    return F.array_join(F.array_distinct(F.filter(parts, lambda x: x != "")), " ")


def contains_any(column: Column, words: list[str]) -> Column:
    """Whether any word occurs, whatever its case."""
    return any_of(F.lower(text(column)), words)


def any_of(lowered: Column, words: list[str]) -> Column:
    """Whether any word occurs in a column that is in lower case already."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(lowered, F.lit(w.lower()))
    return out


def identity_text(column: Column) -> Column:
    """What hashes compare: lower case, only letters, numbers and underscores."""
    return F.regexp_replace(F.lower(collapse(column)), r"[^\p{L}\p{N}_]+", "")


def content_hash(column: Column) -> Column:
    """SHA-256 of :func:`identity_text`; empty for an empty text."""
    n = identity_text(column)
    return F.when(n != "", F.sha2(n, 256)).otherwise(F.lit(""))


def tokens(column: Column) -> Column:
    """Runs of two or more ASCII letters, digits and underscores, and pairs of neighbouring Han characters, with repetitions."""
    n = identity_text(column)
    # a look-ahead takes overlapping pairs in one pass; the removal of other characters makes pairs span them
    pairs = F.regexp_extract_all(F.regexp_replace(n, r"[^一-鿿]", ""), F.lit("(?=(..))"), F.lit(1))
    return F.concat(F.regexp_extract_all(n, F.lit("([a-z0-9_]{2,})"), F.lit(1)), pairs)


def stable_hash(column: Column) -> Column:
    """A 48-bit number from SHA-1, the same in every run."""
    return F.conv(F.substring(F.sha1(text(column)), 1, 12), 16, 10).cast("long")


def safe_int(column: Column) -> Column:
    return F.coalesce(column.try_cast("bigint"), F.lit(0).cast("bigint"))


def engagement(*counts: Column) -> Column:
    """Sum of counters, bad and negative ones as 0."""
    out = F.lit(0).cast("bigint")
    for c in counts:
        out = out + F.greatest(F.lit(0).cast("bigint"), safe_int(c))
    return out


def first_sentence(column: Column, fallback: Column) -> Column:
    """A title from a text: what stands in leading 【】 brackets, else the first sentence up to 120 characters."""
    clean = without_tags(column)
    bracket = F.trim(F.regexp_extract(clean, r"^【([^】]{4,120})】", 1))
    sentence = F.trim(F.substring(F.split(clean, r"[。；;\n]", 2)[0], 1, 120))
    return F.when(clean == "", fallback).otherwise(F.coalesce(nonempty(bracket), nonempty(sentence), fallback))


_HAN, _SIGNS, _CONTROLS = re.compile(CJK), re.compile(MOJIBAKE.replace(r"\x{FFFD}", "\ufffd")), re.compile(CONTROL)


def script_score(value: str) -> float:
    """How much a text looks like proper Chinese rather than like wrongly decoded bytes; its first 20,000 characters count."""
    if not value:
        return -1000.0
    sample = value[:20000]
    good = 3.0 * len(_HAN.findall(sample)) + 0.5 * sum(map(sample.count, "，。："))
    return good - 8.0 * len(_SIGNS.findall(sample)) - 12.0 * sample.count("\ufffd") - 10.0 * len(_CONTROLS.findall(sample)) - 0.0001 * len(sample)


def repair(value: str) -> str:
    """A text that was UTF-8 read as Latin-1 or Windows-1252, read again where that scores better by over 5."""
    best, most = value, None
    for encoding in ("latin-1", "cp1252"):
        try:
            other = value.encode(encoding).decode("utf-8")
        except UnicodeError:
            continue
        most = script_score(best) if most is None else most
        if (score := script_score(other)) > most + 5:
            best, most = other, score
    return best


def repaired(column: Column) -> Column:
    """:func:`repair` of a column. Its codecs run in Arrow batches, and only on values that hold signs of such a reading."""
    ship_active()

    @F.arrow_udf("string")
    def again(values: pa.Array) -> pa.Array:
        return pa.array([v if v is None else repair(v) for v in values.to_pylist()], pa.string())

    return F.coalesce(again(F.when(column.rlike("[\u0080-ÿŒ-Ÿ–-™]{2}"), column)), text(column))


def garbled(column: Column) -> Column:
    """Whether a text of 20 or more characters, :func:`repaired` as far as it can be, still holds four or more signs of
    wrong decoding, and more of them than Han characters, among its first 2,000."""
    sample = F.substring(repaired(column), 1, 2000)
    hits = F.regexp_count(sample, F.lit(MOJIBAKE))
    return (stripped_length(column) >= 20) & (hits >= 4) & (hits > F.regexp_count(sample, F.lit(CJK)))


def media_body(content: Column, title: Column) -> Column:
    """Whether a news content says more than its title."""
    c = clean(content)
    return (F.length(c) >= 30) & (c != clean(title))


def post_body(content: Column) -> Column:
    return F.length(clean(content)) >= 10
