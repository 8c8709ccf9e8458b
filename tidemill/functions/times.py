"""Times as the sources write them, as UTC instants. What is relative is relative to an explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time zone of each market.
MARKET_ZONES = {"cn": "Asia/Shanghai", "hk": "Asia/Hong_Kong"}
_DAY = "(今天|今日|昨天)"


def epoch_seconds(column: Column) -> Column:
    """Seconds since 1970; null when not a positive number."""
    n = column.try_cast("bigint")
    return F.when(n > 0, F.timestamp_seconds(n))


def iso_instant(column: Column) -> Column:
    """ISO date and time, without a zone in UTC (the session's zone); null when it can't be read."""
    return column.try_cast("timestamp")


def local_to_utc(local: Column, zone: str) -> Column:
    """A wall-clock time of a zone, given as a timestamp of the UTC session, as the instant it names."""
    return F.to_utc_timestamp(local, zone)


def _stamp(value: Column, *formats: str) -> Column:
    return F.coalesce(*(F.try_to_timestamp(F.nullif(value, F.lit("")), F.lit(f)) for f in formats))


def published(column: Column, as_of: Column, zone: str = "Asia/Shanghai") -> Column:
    """N分钟前, N小时前, 今天/今日/昨天 HH:mm, Y-M-D, Y/M/D and Y年M月D日 with a time, and M-D HH:mm.

    A day without a year lies in the year of ``as_of``, or in the year before when that would be over a day ahead.
    The first kind that is found wins; null when none is.
    """
    t = F.regexp_replace(F.coalesce(column, F.lit("")), r"[\t-\r\x1c-\x1f\x85\p{Z}]+", " ")
    now = F.from_utc_timestamp(as_of, zone)
    pick = lambda pattern, group: F.nullif(F.regexp_extract(t, pattern, group), F.lit(""))
    minutes, hours = pick(r"(\p{Nd}+) *分钟前", 1).try_cast("int"), pick(r"(\p{Nd}+) *小时前", 1).try_cast("int")
    day = F.when(pick(_DAY + r" *(\d{1,2}:\d{2})", 1) == "昨天", F.date_sub(F.to_date(now), 1)).otherwise(F.to_date(now))
    relative = _stamp(F.concat(day.cast("string"), F.lit(" "), pick(_DAY + r" *(\d{1,2}:\d{2})", 2)), "yyyy-MM-dd H:mm")
    dash = _stamp(pick(r"(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}(?::\d{2})?)", 1), "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm")
    slash = _stamp(pick(r"(\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}(?::\d{2})?)", 1), "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm")
    chinese = _stamp(pick(r"(\d{4}年\d{1,2}月\d{1,2}日 *\d{1,2}:\d{2})", 1), "yyyy年M月d日H:mm", "yyyy年M月d日 H:mm")
    short = pick(r"(\d{1,2}-\d{1,2} \d{1,2}:\d{2})", 1)
    this_year = _stamp(F.concat(F.year(now).cast("string"), F.lit("-"), short), "yyyy-M-d H:mm")
    last_year = _stamp(F.concat((F.year(now) - 1).cast("string"), F.lit("-"), short), "yyyy-M-d H:mm")
    yearless = F.when(this_year > now + F.expr("interval 1 day"), last_year).otherwise(this_year)
    local = F.coalesce(relative, dash, slash, chinese, yearless)
    return F.coalesce(
        F.when(minutes.isNotNull(), as_of - F.make_dt_interval(mins=minutes)),
        F.when(hours.isNotNull(), as_of - F.make_dt_interval(hours=hours)),
        local_to_utc(local, zone),
    )


def forum_published(column: Column, as_of: Column) -> Column:
    """A forum's time of a post, Chinese time; ``as_of`` when it can't be read."""
    raw = F.trim(F.coalesce(column, F.lit("")))
    full = local_to_utc(_stamp(raw, "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm"), "Asia/Shanghai")
    return F.coalesce(full, published(column, as_of), as_of)


def day_bucket(instant: Column, zone: str = "Asia/Shanghai") -> Column:
    """The calendar day in a zone, ``unknown`` for null."""
    return F.coalesce(F.date_format(F.from_utc_timestamp(instant, zone), "yyyy-MM-dd"), F.lit("unknown"))


def in_window(instant: Column, start: Column | None, end: Column | None, keep_null: bool) -> Column:
    """Half-open window [start, end); plain comparisons, so they reach the scan. Either end may be open."""
    out = F.lit(True)
    if start is not None:
        out = out & (instant >= start)
    if end is not None:
        out = out & (instant < end)
    return (instant.isNull() | out) if keep_null else (instant.isNotNull() & out)
