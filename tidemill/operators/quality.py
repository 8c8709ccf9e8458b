"""Quality scores of posts, and a deterministic sample that a quota bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.text import WS, any_of, cjk_count, combined, content_chars, engagement, nonempty, stable_hash, text, without_tags
from tidemill.functions.times import day_bucket
from tidemill.runtime import checkpointed

# Fixed values of the source rules.
SPAM = ["加群", "进群", "带单", "荐股", "老师", "直播间", "VX", "微信", "公众号", "领取", "免费诊股", "稳赚", "私信", "合作"]
EVENT = [
    "公告", "业绩", "利润", "营收", "分红", "回购", "增持", "减持", "并购", "重组", "中标", "合同", "订单", "异动", "监管", "停牌", "复牌", "出关", "利好", "利空",
    "装机", "电力", "电价", "煤价", "发电量", "新能源", "火电", "资产", "负债", "融资", "评级", "研报", "政策",
]
REASONING = ["因为", "由于", "导致", "所以", "预计", "预期", "同比", "环比", "估值", "逻辑", "兑现", "影响", "催化", "风险", "基本面", "资金", "机构", "市场"]
MARKET = ["涨停", "跌停", "拉升", "砸盘", "封板", "开板", "放量", "缩量", "低吸", "高抛", "减仓", "加仓", "主力", "洗盘"]
ELLIPSIS = ["...", "…", "全文", "展开", "点击查看"]
QUOTA_7_DAYS, HIGH_SHARE = 3000, 0.6
COUNTERS = ("social_read_count", "social_comment_count", "social_like_count", "social_forward_count")
_MARKS = r"(?:[,，。.！!?？:：;；、()（）\[\]【】$]|" + WS + ")+"
_MARKER = r"(?i)\$?[一-鿿A-Za-z]{0,12}\(?[A-Za-z]{0,3}\p{Nd}{4,6}\)?\$?"


def score_quality(df: DataFrame, title: str = "title", summary: str = "summary", content: str = "content", counters: tuple[str, ...] = COUNTERS) -> DataFrame:
    """Adds ``quality``: score 0 to 100, tier, reasons, kind of body, characters, and whether the detail page is needed.

    One cascade of built-in expressions; null counters count as 0, texts without anything are dropped as empty.
    """
    body = F.col("_body")
    df = df.withColumn("_body", combined(*(F.col(c) for c in (title, summary, content)))).withColumn("_lower", F.lower("_body"))
    df = df.withColumns(
        {
            "_cjk": cjk_count(body),
            "_chars": content_chars(body),
            "_event": any_of(F.col("_lower"), EVENT),
            "_reasoning": any_of(F.col("_lower"), REASONING),
            "_market": any_of(F.col("_lower"), MARKET),
            "_eng": engagement(*(F.col(c).cast("string") for c in counters)) if counters else F.lit(0),
            "_summary": without_tags(F.col(summary)),
        }
    )
    cjk, chars, event, reasoning, market, eng = (F.col(f"_{c}") for c in ("cjk", "chars", "event", "reasoning", "market", "eng"))
    marker_only = F.regexp_replace(F.regexp_replace(body, _MARKS, ""), _MARKER, "") == ""
    drop = F.when(body == "", "empty_text").when(marker_only, "stock_marker_only").when(any_of(F.col("_lower"), SPAM), "spam_or_leadgen").when((cjk < 8) & ~event & ~market, "too_short_without_signal")
    number, chatty, thin = body.rlike(r"\p{Nd}"), body.rlike("[哈啊呀哦嗯]{2,}|[!?！？。]{3,}"), (cjk < 16) & ~event & ~reasoning
    points = (
        F.when(cjk >= 120, 45).when(cjk >= 60, 35).when(cjk >= 24, 25).when(cjk >= 8, 12).otherwise(0)
        + F.when(event, 30).otherwise(0)
        + F.when(reasoning, 20).otherwise(0)
        + F.when(market, 10).otherwise(0)
        + F.when(number, 10).otherwise(0)
        + F.when(eng >= 1000, 15).when(eng >= 100, 8).otherwise(0)
        - F.when(chatty, 8).otherwise(0)
        - F.when(thin, 8).otherwise(0)
    )
    reasons = F.array_compact(
        F.array(
            F.when(cjk >= 120, "long_discussion").when(cjk >= 60, "substantial_text").when(cjk >= 24, "contextual_text").when(cjk >= 8, "short_but_readable"),
            F.when(event, F.lit("event_or_fundamental_signal")),
            F.when(reasoning, F.lit("reasoning_signal")),
            F.when(market, F.lit("market_signal")),
            F.when(number, F.lit("numeric_signal")),
            F.when(eng >= 1000, "high_engagement").when(eng >= 100, "some_engagement"),
            F.when(chatty, F.lit("chatty_noise")),
            F.when(thin, F.lit("thin_context")),
        )
    )
    score = F.when(F.col("_drop") == "too_short_without_signal", 5).when(F.col("_drop").isNotNull(), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), F.col("_points"))))
    cut = F.length("_summary") >= 110
    for mark in ELLIPSIS:
        cut = cut | F.contains(F.concat_ws(" ", F.col("_summary"), body), F.lit(mark))
    df = df.withColumns({"_drop": drop, "_cut": cut, "_points": points, "_reasons": reasons})
    df = df.withColumn("_score", score)
    score = F.col("_score")
    tier = F.when(F.col("_drop").isNotNull(), "drop").when(score >= 70, "high").when(score >= 40, "medium").otherwise("low")
    kind = (
        F.when(F.col("_drop") == "empty_text", "empty").when(F.col("_drop") == "spam_or_leadgen", "spam").when(F.col("_drop").isNotNull(), "list_complete_short")
        .when((chars <= 80) & ~F.col("_cut"), "list_complete_short").when(F.col("_cut"), "list_maybe_truncated").otherwise("list_substantial")
    )
    quality = F.struct(
        score.cast("int").alias("score"),
        tier.alias("tier"),
        F.when(F.col("_drop").isNotNull(), F.array("_drop")).otherwise(F.col("_reasons")).alias("reasons"),
        kind.alias("body_quality"),
        F.when(F.col("_drop") == "empty_text", 0).otherwise(chars).alias("content_chars"),
        (F.col("_drop").isNull() & F.col("_cut") & (chars < 80)).alias("detail_required"),
        eng.alias("engagement"),
    )
    return df.withColumn("quality", quality).drop("_body", "_lower", "_cjk", "_chars", "_event", "_reasoning", "_market", "_eng", "_summary", "_drop", "_cut", "_points", "_reasons", "_score")


def window_quota(quota_7_days: int, start: Column, end: Column) -> Column:
    """The quota's share of a window, one at least; a bad window has the whole."""
    seconds = end.cast("double") - start.cast("double")
    return F.when(seconds > 0, F.greatest(F.lit(1), F.ceil(F.lit(float(quota_7_days)) * seconds / 604800).cast("int"))).otherwise(F.lit(quota_7_days))


def allocate(counts: DataFrame, quota: int, bucket: str = "bucket", n: str = "n") -> DataFrame:
    """Adds ``quota``: the largest-remainder share of each bucket; ties go to the later bucket name.

    ``counts`` has a row per bucket, such as one a day, so the windows without a partition are small by nature.
    """
    everything = W.partitionBy(F.lit(1))
    shared = counts.withColumn("_y", (F.lit(quota) * F.col(n)).cast("double") / F.sum(n).over(everything)).withColumn("_f", F.floor("_y"))
    rank = F.row_number().over(everything.orderBy((F.col("_y") - F.col("_f")).desc(), F.col(bucket).desc()))
    extra = (rank <= F.lit(quota) - F.sum("_f").over(everything)).cast("int")
    return shared.withColumn("quota", (F.col("_f") + extra).cast("int")).drop("_y", "_f")


def stratified_sample(df: DataFrame, quota: int, published: str, ordinal: str, url: str = "url") -> DataFrame:
    """Adds bucket, ``selected`` and ``sampling_reason``: a sample over days within ``quota``.

    ``df`` has ``quality``. Dropped rows are never chosen. When no more than the quota are eligible, all are.
    Else each day has its share, three fifths of it for high and medium tiers as far as both sides have rows.
    Rows are chosen by score, engagement, time and a hash of the address; all rows of a chosen address are.
    """
    tier = F.col("quality.tier")
    rows = df.select(
        F.col(ordinal).alias("_o"), F.col(url).alias("_url"), F.coalesce(F.unix_timestamp(published), F.lit(0)).alias("_at"), F.col("quality.score").alias("_score"), F.col("quality.engagement").alias("_eng"),
        day_bucket(F.col(published)).alias("bucket"), tier.isin("high", "medium").alias("_high"), (tier != "drop").alias("_ok"),
    )
    rows = checkpointed(rows.withColumn("_key", F.coalesce(nonempty(text(F.col("_url"))), F.concat(F.lit("\x00"), F.col("_o").cast("string")))))
    counts = rows.where("_ok").groupBy("bucket").agg(F.count("*").alias("n"), F.count_if(F.col("_high")).alias("h"), F.count_if(~F.col("_high")).alias("l"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    a, h, low = F.col("quota"), F.col("h"), F.col("l")
    h0 = F.least(h, F.bround(a * HIGH_SHARE).cast("long"))
    l0 = F.least(low, a - h0)
    hq = F.least(h, h0 + F.greatest(a - h0 - l0, F.lit(0)))
    plan = allocate(counts, quota).withColumn("_hq", F.when(h + low <= a, h).otherwise(hq))
    plan = plan.withColumn("_lq", F.when(h + low <= a, low).otherwise(F.least(low, a - F.col("_hq")))).select("bucket", "_hq", "_lq").crossJoin(F.broadcast(total))  # one row
    best = W.partitionBy("bucket", "_high").orderBy(F.col("_score").desc(), F.col("_eng").desc(), F.col("_at").desc(), stable_hash(F.col("_url")), F.col("_o"))
    ranked = rows.where("_ok").join(plan, "bucket").withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= quota)  # a literal, so each task keeps no more
    chosen = ranked.where((F.col("total") <= quota) | (F.col("_rank") <= F.when(F.col("_high"), F.col("_hq")).otherwise(F.col("_lq")))).select("_key").distinct()
    flags = rows.join(chosen.withColumn("_chosen", F.lit(True)), "_key", "left").crossJoin(F.broadcast(total))
    selected = F.col("_ok") & F.coalesce(F.col("_chosen"), F.lit(False))
    reason = (
        F.when(~F.col("_ok"), "quality_drop").when(selected & (F.col("total") <= quota), "selected:quota_within_limit").when(selected, f"selected:stratified_quota_{quota}").otherwise("sampling_excluded:stratified_quota")
    )
    flags = flags.select(F.col("_o").alias(ordinal), "bucket", selected.alias("selected"), reason.alias("sampling_reason"))
    return df.join(flags, ordinal)
