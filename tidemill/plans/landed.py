"""Queries of the parsers: the records are written as the payloads that sources land, and read back.

Each record becomes a payload of its own with three elements: the record, a second one with the same address,
which must give way, and one without a title or of a kind that must be left out. The SQL says what must come out,
from the tables alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import relevance
from tidemill.plans.catalog import NAMES_SQL, _collapse, _evidence, _rows, _strip, _untagged, _with_repaired, entity_merge, query
from tidemill.sources import feeds, html, payloads

_AS_OF = "2026-01-01 00:00:00"
_BASE = "https://landed.example/a"


def _media(spark, d, *columns: str) -> DataFrame:
    rows = _rows(spark, d, "raw_media", *dict.fromkeys(("id", "title", "url", "published_at", *columns))).withColumn("as_of", F.lit(_AS_OF).cast("timestamp"))
    return rows.join(entity_merge(spark, d).select("market", "ticker", "short_name"), ["market", "ticker"], "left") if "ticker" in columns else rows


def _posts(spark, d, *columns: str) -> DataFrame:
    return _rows(spark, d, "raw_social", "id", "title", "url", "published_at", *columns).withColumn("as_of", F.lit(_AS_OF).cast("timestamp"))


def _day(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """The time of a record as a source of the mainland writes it; nothing for null."""
    return F.coalesce(F.date_format(F.from_utc_timestamp("published_at", "Asia/Shanghai"), pattern), F.lit(""))


def _payload(path: str, fields: dict[str, Column], title: str = "title", call: bool = False) -> Column:
    """The record, one of the same address and one without a title under a dotted path, as JSON or JSONP."""
    first = F.struct(*(c.alias(n) for n, c in fields.items()))
    again = F.when(F.trim(fields[title]) != "", "again").otherwise("")
    made = F.array(first, first.withField(title, again), first.withField(title, F.lit("")))
    for name in reversed(path.split(".")):
        made = F.struct(made.alias(name))
    return F.concat(F.lit("jQuery_1("), F.to_json(made), F.lit(");")) if call else F.to_json(made)


def _escaped(column: Column | str) -> Column:
    out = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def _page(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _landed(rows: DataFrame, name: str, made: Column, *keep: str) -> DataFrame:
    return rows.select("id", "as_of", *keep, made.alias(name))


def _out(items: DataFrame, *more: str) -> DataFrame:
    return items.select("id", F.md5("title").alias("title"), "url", F.md5("summary").alias("summary"), F.unix_timestamp("published_at").alias("at"), *more)


_M = "m AS (SELECT DISTINCT id, title, summary, url, published_at, source_name, channel, market, ticker FROM raw_media)"
_AT = "CAST(floor(epoch(published_at)) AS BIGINT)"
_AT_MINUTE = "CAST(floor(epoch(published_at) / 60) * 60 AS BIGINT)"
_URL = _strip("url")
_SUMMARY = f"md5(nullif({_untagged('summary')}, ''))"
_T = f"t AS (SELECT *, {_untagged('title')} AS t, {_untagged('summary')} AS s FROM m LEFT JOIN e USING (market, ticker))"


@query(f"WITH {_M}, {NAMES_SQL}, {_T} SELECT id, md5(t) AS title, {_URL} AS url, {_SUMMARY} AS summary, {_AT} AS at FROM t WHERE t <> '' AND {_URL} <> '' AND contains(t || ' ' || s, coalesce(short_name, ''))")
def landed_search(spark, d):
    rows = _media(spark, d, "summary", "market", "ticker")
    made = _payload("result.web", {"title": F.col("title"), "content": F.col("summary"), "url": F.col("url"), "date": _day()}, call=True)
    return _out(feeds.search_articles(_landed(rows, "payload", made, "short_name"), F.coalesce("short_name", F.lit("")), section="web"))


@query(f"WITH {_M}, {NAMES_SQL}, {_T} SELECT id, md5(t) AS title, '{_BASE}/' || ticker || '/' || id || '.html' AS url, {_SUMMARY} AS summary, {_AT} AS at FROM t WHERE t <> '' AND ticker IS NOT NULL")
def landed_notices(spark, d):
    rows = _media(spark, d, "summary", "market", "ticker")
    made = _payload("result.notice", {"title": F.col("title"), "content": F.col("summary"), "code": F.col("id"), "securityShortName": F.col("short_name"), "date": _day()}, call=True)
    return _out(feeds.search_notices(_landed(rows, "payload", made, "ticker", "short_name"), F.coalesce("short_name", F.lit("")), F.col("ticker"), _BASE))


@query(
    f"""WITH {_M}, {NAMES_SQL}, {_T} SELECT id, md5(t) AS title, CASE WHEN {_URL} <> '' THEN '{_BASE}?encodeUrl=' || url_encode(url) ELSE 'https://landed.example/' || id || '.html' END AS url,
      md5(concat_ws(' ', nullif({_untagged('short_name')}, ''), nullif({_untagged('source_name')}, ''), '买入', nullif({_untagged('channel')}, ''))) AS summary, {_AT} AS at FROM t WHERE t <> ''"""
)
def landed_reports(spark, d):
    rows = _media(spark, d, "market", "ticker", "source_name", "channel")
    fields = {"title": F.col("title"), "infoCode": F.col("id"), "encodeUrl": F.col("url"), "publishDate": _day(), "stockName": F.col("short_name"), "orgSName": F.lit(""), "orgName": F.col("source_name"), "emRatingName": F.lit(""), "sRatingName": F.lit("买入"), "researcher": F.col("channel")}
    return _out(feeds.research_reports(_landed(rows, "payload", _payload("data", fields)), _BASE))


@query(
    f"""WITH {_M}, t AS (SELECT *, {_untagged("CASE WHEN substr(md5(id), 1, 1) < '8' THEN title END")} AS t, {_untagged('summary')} AS s FROM m)
    SELECT id, md5(coalesce(nullif(t, ''), nullif(trim(regexp_extract(s, '^【([^】]{{4,120}})】', 1)), ''), nullif(trim(left(regexp_split_to_array(s, '[。；;\\n]')[1], 120)), ''), 'tide_news ' || id)) AS title,
      '{_BASE}/' || id AS url, {_SUMMARY} AS summary, CASE WHEN epoch(published_at) >= 1 THEN {_AT} END AS at FROM t"""
)
def landed_wire(spark, d):
    rows = _media(spark, d, "summary")
    fields = {"id": F.col("id"), "title": F.when(F.substring(F.md5("id"), 1, 1) < "8", F.col("title")), "descr": F.lit(""), "content": F.col("summary"), "time": F.unix_timestamp("published_at").cast("string")}
    return _out(feeds.wire_items(_landed(rows, "payload", _payload("data.depth.data", fields).cast("string")), _BASE))


@query(
    f"""WITH {_M}, {NAMES_SQL}, t AS (SELECT *, {_untagged('title')} AS t, concat_ws(' ', {_untagged('title')}, {_untagged('summary')}, {_untagged('channel')}) AS body FROM m LEFT JOIN e USING (market, ticker))
    SELECT id, md5(t) AS title, {_URL} AS url, {_SUMMARY} AS summary, {_AT} AS at, coalesce(nullif(source_name, ''), 'paper_daily') AS source_name FROM {_with_repaired('t', 'body')}
    WHERE t <> '' AND {_URL} <> '' AND (short_name IS NULL OR {_evidence('body', 'short_name')})"""
)
def landed_documents(spark, d):
    rows = _media(spark, d, "summary", "market", "ticker", "source_name", "channel")
    fields = {"title": F.col("title"), "desc": F.col("summary"), "tags": F.col("channel"), "url": F.col("url"), "source": F.col("source_name"), "creationDate": _day()}
    landed = _landed(rows, "payload", _payload("results.docs", fields), "short_name")
    return _out(feeds.document_search(landed, F.array_compact(F.array("short_name")), "https://landed.example"), "source_name")


_ROW = '<li><div class="tt"><a href="'


@query(f"WITH {_M} SELECT id, md5({_collapse('title')}) AS title, {_URL} AS url, md5(nullif({_collapse('summary')}, '')) AS summary, coalesce(nullif({_collapse('source_name')}, ''), 'capital_page') AS source_name FROM m WHERE {_collapse('title')} <> '' AND {_URL} LIKE 'http%'")
def landed_lists(spark, d):
    rows = _media(spark, d, "summary", "source_name")
    row = lambda address, title: _page(_ROW, address, '">', title, '</a></div><div class="text">', _escaped("summary"), '</div><div class="info"><span>', _escaped("source_name"), "</span></div></li>")
    page = _page("<ul>", row(_escaped("url"), _escaped("title")), row(_escaped("url"), F.when(F.trim("title") != "", "again").otherwise("")), row(F.lit("/quotes/index/1"), F.lit("quote")), "</ul>")
    return _out(html.html_items(_landed(rows, "html", page), "list", "https://landed.example"), "source_name").drop("at")


@query(f"WITH {_M} SELECT id, md5({_untagged('title')}) AS title, 'https://finance.sina.com.cn/' || id || '.html' AS url, {_AT_MINUTE} AS at FROM m WHERE {_untagged('title')} <> '' AND published_at IS NOT NULL")
def landed_dated_links(spark, d):
    rows = _media(spark, d)
    link = lambda address, title: _page(_day("yyyy-MM-dd'&nbsp;'HH:mm"), "&nbsp;<a target=_blank href='", address, "'>", title, "</a> <br>")
    page = _page("<div class=datelist>", link(_page("https://finance.sina.com.cn/", F.col("id"), ".html"), F.coalesce("title", F.lit(""))), link(_page("https://finance.sina.com.cn/fund/", F.col("id")), F.lit("fund")), link(_page("https://other.example/", F.col("id")), F.lit("other")), "</div>")
    found = html.dated_links(_landed(rows, "html", page), "https://finance.sina.com.cn", hosts=relevance.ARTICLE_HOSTS)
    return found.select("id", F.md5("title").alias("title"), "url", F.unix_timestamp("published_at").alias("at"))


@query(
    f"""WITH {_M}, {NAMES_SQL}, t AS (SELECT *, {_collapse('title')} AS t, {_collapse('summary')} AS s FROM m LEFT JOIN e USING (market, ticker))
    SELECT id, kind, md5(t) AS title, {_URL} AS url FROM t, (VALUES ('anchors', 4), ('pattern', 1)) k(kind, least)
    WHERE length(t) >= least AND {_URL} LIKE 'http%' AND contains(concat_ws(' ', nullif(t, ''), 'once again', '短', nullif(s, '')), coalesce(short_name, ''))"""
)
def landed_anchors(spark, d):
    rows = _media(spark, d, "summary", "market", "ticker")
    link = lambda title: _page('<a href="', _escaped("url"), '">', title, "</a> ")
    page = _page("<div><p>", link(_escaped("title")), "</p> ", link(F.lit("once again")), '<a href="/x">短</a> <p>', _escaped("summary"), "</p></div>")
    landed = _landed(rows.where("title is not null and trim(title) <> ''"), "html", page, "short_name")
    found = [html.html_items(landed, kind, "https://landed.example", query=F.coalesce("short_name", F.lit(""))).where("url not like '%landed.example%'").withColumn("kind", F.lit(kind)) for kind in ("anchors", "pattern")]
    return found[0].unionByName(found[1]).select("id", "kind", F.md5("title").alias("title"), "url")


_COUNTERS = ("social_read_count", "social_comment_count", "social_like_count", "social_forward_count")


@query(
    f"""WITH m AS (SELECT DISTINCT id, title, summary, content, source_name, published_at, {', '.join(_COUNTERS)}, social_has_image FROM raw_social),
      t AS (SELECT *, coalesce(nullif({_collapse('content')}, ''), {_collapse('summary')}) AS body FROM m)
    SELECT id, md5(coalesce(nullif({_untagged("coalesce(nullif(title, ''), summary)")}, ''), nullif(trim(left(body, 120)), ''), 'Post ' || id)) AS title, '{_BASE}/article/0/' || id AS url, md5(nullif(body, '')) AS summary,
      CASE WHEN published_at IS NULL THEN CAST(epoch(TIMESTAMPTZ '{_AS_OF}+00') AS BIGINT) ELSE {_AT} END AS at, coalesce(nullif({_strip('source_name')}, ''), 'Unknown') AS source_name, {', '.join(f'coalesce({c}, 0)::BIGINT AS {c}' for c in _COUNTERS)}, coalesce(social_has_image, false) AS social_has_image FROM t"""
)
def landed_forum_posts(spark, d):
    rows = _posts(spark, d, "summary", "content", "source_name", *_COUNTERS, "social_has_image")
    fields = {"post_id": F.col("id"), "post_title": F.col("title"), "post_content": _escaped(F.when(F.col("content") != "", F.col("content"))), "post_abstract": F.col("summary"), "post_publish_time": _day(), "post_display_time": F.lit(""), "post_user": F.struct(F.col("source_name").alias("user_nickname"))}
    names = ("post_click_count", "post_comment_count", "post_like_count", "post_forward_count")
    fields |= {n: F.col(c).cast("string") for n, c in zip(names, _COUNTERS)} | {"post_has_pic": F.col("social_has_image").cast("string")}
    first = F.struct(*(c.alias(n) for n, c in fields.items()))
    made = F.to_json(F.struct(F.array(first, first.withField("post_title", F.lit("again")), first.withField("post_id", F.lit(" "))).alias("re")))
    return _out(feeds.forum_posts(_landed(rows, "payload", made), _BASE), "source_name", *_COUNTERS, "social_has_image")


@query(
    f"""WITH m AS (SELECT DISTINCT id, title, published_at FROM raw_social), t AS (SELECT *, regexp_extract({_collapse("'阿豆 发表于 ' || coalesce(strftime(timezone('Asia/Shanghai', published_at), '%Y-%m-%d %H:%M'), '') || ' 12次浏览 ' || coalesce(title, '') || ' 分享 看'")}, '[0-9]+次浏览\\s*(.*?)\\s*(?:分享|评论|赞|$)', 1) AS t FROM m)
    SELECT id, md5(trim(t)) AS title, 'https://landed.example/m/article/0/' || id AS url, '阿豆' AS source_name, {_AT_MINUTE} AS at FROM t WHERE t <> ''"""
)
def landed_mobile(spark, d):
    rows = _posts(spark, d)
    page = _page("<ul><li><b>阿豆</b> 发表于 ", _day("yyyy-MM-dd HH:mm"), " 12次浏览 ", _escaped("title"), ' 分享 <a href="/m/article/0/', F.col("id"), '">看</a></li><li><a href="/other/1">没有</a></li></ul>')
    found = html.html_items(_landed(rows, "html", page), "mobile", "https://landed.example")
    return found.select("id", F.md5("title").alias("title"), "url", "source_name", F.unix_timestamp("published_at").alias("at"))


@query(
    f"""WITH m AS (SELECT DISTINCT id, title, source_name, published_at FROM raw_social), t AS (SELECT *, timezone('Asia/Shanghai', published_at) AS l FROM m)
    SELECT id, md5({_collapse('title')}) AS title, 'https://landed.example/caifuhao/' || strftime(l, '%Y%m%d') || id AS url, coalesce(nullif({_collapse('source_name')}, ''), 'Unknown') AS source_name, {_AT_MINUTE} AS at FROM t WHERE {_collapse('title')} <> '' AND published_at IS NOT NULL"""
)
def landed_forum_rows(spark, d):
    rows = _posts(spark, d, "source_name")
    row = lambda title: _page('<tr class="listitem"><td>1</td><td>2</td><td><a href="/caifuhao/', _day("yyyyMMdd"), F.col("id"), '">', title, "</a></td><td><a>", _escaped("source_name"), "</a></td><td>", _day("MM-dd HH:mm"), "</td></tr>")
    page = _page("<table>", row(_escaped("title")), row(F.lit("again")), '<tr class="listitem"><td>1</td><td>2</td></tr></table>')
    found = html.html_items(_landed(rows.where("published_at is not null and title is not null").where(F.trim("title") != ""), "html", page), "forum", "https://landed.example")
    return found.select("id", F.md5("title").alias("title"), "url", "source_name", F.unix_timestamp("published_at").alias("at"))


@query(
    f"""WITH m AS (SELECT DISTINCT id, title, content FROM raw_social WHERE title IS NOT NULL AND {_collapse('title')} <> '')
    SELECT id, CASE WHEN substr(md5(id), 1, 1) < '8' THEN 0 ELSE 1 END AS rank, md5(CASE WHEN substr(md5(id), 1, 1) < '8' THEN {_untagged('title')} ELSE {_collapse('title')} END) AS title FROM m WHERE substr(md5(id), 1, 1) >= '8' OR {_untagged('title')} <> ''"""
)
def landed_cascade(spark, d):
    rows = _posts(spark, d).where("title is not null")
    api = F.to_json(F.struct(F.array(F.struct(F.when(F.substring(F.md5("id"), 1, 1) < "8", F.col("id")).alias("post_id"), F.col("title").alias("post_title"))).alias("re")))
    page = _page('<table><tr class="listitem"><td>1</td><td>2</td><td><a href="/p/', F.col("id"), '">', _escaped("title"), "</a></td><td></td><td>01-02 03:04</td></tr></table>")
    pick = lambda items, rank: items.select("id", F.lit(rank).alias("rank"), "title")
    first, second = feeds.forum_posts(_landed(rows, "payload", api), _BASE), html.html_items(_landed(rows, "html", page), "forum", _BASE)
    return feeds.first_source(pick(first, 0).unionAll(pick(second, 1)), ["id"], "rank").select("id", "rank", F.md5("title").alias("title"))


@query(f"WITH m AS (SELECT DISTINCT id, title, content FROM raw_social), t AS (SELECT id, coalesce(nullif({_collapse('content')}, ''), nullif({_untagged('title')}, '')) AS body FROM m) SELECT id, md5(body) AS full_text FROM t WHERE body <> ''")
def landed_posts(spark, d):
    rows = _posts(spark, d, "content")
    post = F.struct(_escaped("content").alias("post_content"), F.lit("").alias("post_content2"), F.lit("").alias("post_abstract"), F.coalesce("title", F.lit("")).alias("post_title"), _day().alias("post_publish_time"))
    inner = F.struct(post.alias("post"))
    made = F.when(F.substring(F.md5("id"), 1, 1) < "8", F.to_json(inner)).otherwise(F.to_json(F.struct(inner.alias("data"))))
    return feeds.forum_detail(_landed(rows, "payload", made)).select("id", F.md5("full_text").alias("full_text"))


@query(f"WITH m AS (SELECT DISTINCT id, content, published_at FROM raw_social) SELECT id, coalesce(strftime(timezone('Asia/Shanghai', published_at), '%Y-%m-%d %H:%M:%S'), '') AS time, md5({_collapse('content')}) AS full_text FROM m")
def landed_post_pages(spark, d):
    rows = _posts(spark, d, "content")
    page = _page('<div class="time">', _day(), "</div><p>外</p>", F.when(F.substring(F.md5("id"), 1, 1) < "8", '<div id="post_content">').otherwise('<div class="newstext">'), _escaped("content"), "</div>")
    return html.forum_details(_landed(rows, "html", page)).select("id", "time", F.md5("full_text").alias("full_text"))


@query(
    f"""WITH m AS (SELECT DISTINCT id, summary, content FROM raw_media)
    SELECT id, md5({_collapse('content')}) AS full_text, md5(nullif({_collapse('summary')}, '')) AS summary FROM m WHERE length({_collapse('content')}) > 1"""
)
def landed_articles(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "summary", "content").withColumn("as_of", F.lit(_AS_OF).cast("timestamp")).where(F.length(F.trim(F.coalesce("content", F.lit("")))) > 0)
    body = _page("<p>", _escaped("content"), "</p>")
    data = F.to_json(F.struct(F.struct(F.struct(F.struct(F.col("summary").alias("brief"), body.alias("content")).alias("articleDetail")).alias("pageProps")).alias("props")))
    carried = _page('<meta name="description" content="other"><script id="__NEXT_DATA__" type="application/json">', F.replace(data, F.lit("</"), F.lit("<\\/")), "</script>")
    plain = _page('<meta name="description" content="', _escaped("summary"), '"><div class="article-content">', body, "</div><article>x</article>")
    page = F.when(F.substring(F.md5("id"), 1, 1) < "8", carried).otherwise(plain)
    found = html.article_details(_landed(rows, "html", page)).where(F.length("full_text") > 1)
    return found.select("id", F.md5("full_text").alias("full_text"), F.md5("detail_summary").alias("summary"))


@query()
def landed_bytes(spark, d):
    """Titles in the bytes of one encoding and back. The likeliest decoding isn't always the right one, so there is no SQL."""
    rows = _rows(spark, d, "raw_media", "id", "title").where("title is not null and title <> ''")
    return rows.select("id", payloads.decoded(payloads.encoded(F.col("title"), "gb18030"), F.lit("GB18030")).alias("title"))
