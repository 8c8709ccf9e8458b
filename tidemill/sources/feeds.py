"""Landed JSON and JSONP payloads of lists and details to rows. Built-in JSON functions only.

Every parser takes a table with the columns ``payload`` (text) and ``as_of`` (when it landed) and gives list
rows: title, url, source_name, channel, published_at, summary, and the ordinal of the row in its payload. Rows
without a title or an address are left out; of equal addresses in one payload the first stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import first_sentence, nonempty, safe_int, strip, text, without_tags
from tidemill.functions.times import MARKET_ZONES, epoch_seconds, forum_published, published

ITEM = ("title", "url", "source_name", "channel", "published_at", "summary")


def unwrap_jsonp(column: Column) -> Column:
    """What stands in the call's parentheses; the whole text when it is no call."""
    inner = F.regexp_extract(text(column), r"(?s)^[^(]+\((.*)\)[\s]*;?[\s]*$", 1)
    return F.coalesce(nonempty(inner), column)


def _explode(df: DataFrame, schema: str, path: str) -> DataFrame:
    """One row per element of an array inside the payload; payloads that can't be read give none."""
    parsed = df.withColumn("_j", F.from_json(unwrap_jsonp(F.col("payload")), schema))
    return parsed.select(*df.columns, F.posexplode(F.expr(f"_j.{path}")).alias("ordinal", "_e"))


def _items(rows: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """List rows of exploded elements, the first of every address in its payload."""
    made = rows.select(*keep, "ordinal", *(c.alias(n) for n, c in columns.items())).where((F.col("title") != "") & (F.col("url") != ""))
    order = F.struct("ordinal")
    first = made.groupBy(*keep, "url").agg(F.min_by(F.struct("ordinal", *(n for n in columns if n != "url")), order).alias("_r"))
    return first.select(*keep, "url", "_r.*")


def _keys(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "payload"]


def search_articles(df: DataFrame, query: Column, market: str = "cn", channel: str = "harbor_news", section: str = "articles") -> DataFrame:
    """``result.<section>[]`` with title, content, url and date; kept when the query stands in title or content."""
    rows = _explode(df, f"result struct<`{section}`: array<struct<title: string, content: string, url: string, date: string>>>", f"result.`{section}`")
    title, summary = without_tags(F.col("_e.title")), without_tags(F.col("_e.content"))
    rows = rows.where((text(query) == "") | F.contains(F.concat_ws(" ", title, summary), query))
    return _items(rows, _keys(df), title=title, url=strip(F.col("_e.url")), source_name=F.lit(channel), channel=F.lit(channel), published_at=published(F.col("_e.date"), F.col("as_of"), MARKET_ZONES[market]), summary=nonempty(summary))


def search_notices(df: DataFrame, query: Column, ticker: Column, base_url: str, market: str = "cn", channel: str = "harbor_notice") -> DataFrame:
    """``result.notice[]``; the short name of the security counts as context, the address is made of ticker and code."""
    rows = _explode(df, "result struct<notice: array<struct<title: string, content: string, code: string, securityShortName: string, date: string>>>", "result.notice")
    title, summary = without_tags(F.col("_e.title")), without_tags(F.col("_e.content"))
    rows = rows.where((text(query) == "") | F.contains(F.concat_ws(" ", title, summary, F.col("_e.securityShortName")), query))
    code = nonempty(strip(F.col("_e.code")))
    url = F.coalesce(F.concat(F.lit(base_url.rstrip("/") + "/"), ticker, F.lit("/"), code, F.lit(".html")), F.lit(""))
    return _items(rows, _keys(df), title=title, url=url, source_name=F.lit(channel), channel=F.lit(channel), published_at=published(F.col("_e.date"), F.col("as_of"), MARKET_ZONES[market]), summary=nonempty(summary))


def research_reports(df: DataFrame, base_url: str, market: str = "cn", channel: str = "harbor_report") -> DataFrame:
    """``data[]``; the summary joins stock, house, rating and researcher; the address is encoded or made of a code."""
    fields = "title infoCode encodeUrl publishDate stockName orgSName orgName emRatingName sRatingName researcher".split()
    rows = _explode(df, f"data array<struct<{', '.join(f'{f}: string' for f in fields)}>>", "data")
    e = lambda name: F.col(f"_e.{name}")
    house, rating = without_tags(F.coalesce(nonempty(e("orgSName")), e("orgName"))), without_tags(F.coalesce(nonempty(e("emRatingName")), e("sRatingName")))
    info, encoded = nonempty(strip(e("infoCode"))), nonempty(strip(e("encodeUrl")))
    url = F.when(info.isNull(), "").when(encoded.isNotNull(), F.concat(F.lit(base_url + "?encodeUrl="), F.url_encode(encoded))).otherwise(F.concat(F.lit(base_url.rsplit("/", 1)[0] + "/"), info, F.lit(".html")))
    summary = F.concat_ws(" ", nonempty(without_tags(e("stockName"))), nonempty(house), nonempty(rating), nonempty(without_tags(e("researcher"))))
    return _items(rows, _keys(df), title=without_tags(e("title")), url=url, source_name=F.coalesce(nonempty(house), F.lit(channel)), channel=F.lit(channel), published_at=published(e("publishDate"), F.col("as_of"), MARKET_ZONES[market]), summary=nonempty(summary))


def wire_items(df: DataFrame, base_url: str, section: str = "depth", channel: str = "tide_news") -> DataFrame:
    """``data.<section>.data[]`` with times in seconds; a title is made of the text where there is none."""
    rows = _explode(df, f"data struct<`{section}`: struct<data: array<struct<id: string, title: string, descr: string, content: string, `time`: string, ctime: string>>>>", f"data.`{section}`.data")
    e = lambda name: F.col(f"_e.{name}")
    body, ident = without_tags(F.coalesce(nonempty(e("descr")), e("content"))), nonempty(strip(e("id")))
    title = F.coalesce(nonempty(without_tags(e("title"))), first_sentence(body, F.concat_ws(" ", F.lit(channel), ident)))
    return _items(rows, _keys(df), title=title, url=F.coalesce(F.concat(F.lit(base_url.rstrip("/") + "/"), ident), F.lit("")), source_name=F.lit(channel), channel=F.lit(channel), published_at=epoch_seconds(F.coalesce(nonempty(e("time")), e("ctime"))), summary=nonempty(body))


def absolute_url(url: Column, base: str) -> Column:
    """An address as a page at ``base`` would resolve it: absolute ones stay, paths get the base."""
    u, root = strip(url), base.rstrip("/")
    return F.when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), u).when(u.startswith("//"), F.concat(F.lit(root.split(":")[0] + ":"), u)).when(u == "", "").when(u.startswith("/"), F.concat(F.lit("/".join(root.split("/")[:3])), u)).otherwise(F.concat(F.lit(root + "/"), u))


def document_search(df: DataFrame, evidence: Column, base_url: str, market: str = "cn", channel: str = "paper_daily") -> DataFrame:
    """``results.docs[]`` with title, desc, tags, url, source and creationDate; kept when an alias stands in title,
    description or tags. ``evidence`` is an array column of aliases; null or empty keeps all."""
    from tidemill.operators.relevance import has_evidence

    rows = _explode(df, "results struct<docs: array<struct<title: string, `desc`: string, tags: string, url: string, source: string, creationDate: string>>>", "results.docs")
    e = lambda name: F.col(f"_e.{name}")
    title, desc, tags = (without_tags(e(n)) for n in ("title", "desc", "tags"))
    rows = rows.where(evidence.isNull() | (F.size(evidence) == 0) | has_evidence(F.concat_ws(" ", title, desc, tags), evidence))
    return _items(rows, _keys(df), title=title, url=absolute_url(e("url"), base_url), source_name=F.coalesce(nonempty(e("source")), F.lit(channel)), channel=F.lit(channel), published_at=published(e("creationDate"), F.col("as_of"), MARKET_ZONES[market]), summary=nonempty(desc))


def forum_posts(df: DataFrame, base_url: str, channel: str = "bar_api") -> DataFrame:
    """``re[]`` of a forum's list: posts with nickname, counters and flags; a title is made of abstract or content."""
    from tidemill.sources.html import fragment_text

    names = "post_id post_title post_content post_abstract post_publish_time post_display_time post_user_nickname post_click_count post_comment_count post_like_count post_forward_count post_has_pic post_pic_url post_top_status post_is_top".split()
    schema = f"re array<struct<{', '.join(f'{n}: string' for n in names)}, post_user: struct<user_nickname: string>>>"
    rows = _explode(df, schema, "re")
    e = lambda name: F.col(f"_e.{name}")
    ident = strip(e("post_id"))
    body = fragment_text(F.coalesce(nonempty(e("post_content")), e("post_abstract")))
    title = F.coalesce(nonempty(without_tags(F.coalesce(nonempty(e("post_title")), e("post_abstract")))), nonempty(F.trim(F.substring(body, 1, 120))), F.concat(F.lit("Post "), ident))
    said = lambda *cs: F.coalesce(*(~F.lower(c).isin("", "0", "false", "[]", "null") for c in cs), F.lit(False))
    return _items(
        rows.where(ident != ""),
        _keys(df),
        title=title,
        url=F.concat(F.lit(base_url.rstrip("/") + "/article/0/"), ident),
        source_name=F.coalesce(nonempty(strip(e("post_user.user_nickname"))), nonempty(strip(e("post_user_nickname"))), F.lit("Unknown")),
        channel=F.lit(channel),
        published_at=forum_published(F.coalesce(nonempty(e("post_publish_time")), e("post_display_time")), F.col("as_of")),
        summary=nonempty(body),
        social_read_count=safe_int(e("post_click_count")),
        social_comment_count=safe_int(e("post_comment_count")),
        social_like_count=safe_int(e("post_like_count")),
        social_forward_count=safe_int(e("post_forward_count")),
        social_has_image=said(e("post_has_pic")) | said(e("post_pic_url")),
        social_is_top=said(e("post_top_status")) | said(e("post_is_top")),
    )


def forum_detail(df: DataFrame) -> DataFrame:
    """(keys, time, full_text, title) of a post's payload, ``post`` or ``data.post``; rows without any text are left out."""
    from tidemill.sources.html import fragment_text

    post = "struct<post_content: string, post_content2: string, post_abstract: string, post_title: string, post_publish_time: string>"
    rows = df.withColumn("_j", F.from_json(unwrap_jsonp(F.col("payload")), f"post {post}, data struct<post: {post}>")).withColumn("_p", F.coalesce("_j.post", "_j.data.post"))
    p = lambda name: nonempty(F.col(f"_p.{name}"))
    title = without_tags(F.coalesce(p("post_title"), p("post_abstract")))
    full = F.coalesce(nonempty(fragment_text(F.coalesce(p("post_content"), p("post_content2"), p("post_abstract"), p("post_title")))), title)
    return rows.where(F.col("_p").isNotNull()).select(*_keys(df), text(F.col("_p.post_publish_time")).alias("time"), full.alias("full_text"), title.alias("title")).where("full_text <> ''")


def first_source(parsed: DataFrame, page: list[str], rank: str) -> DataFrame:
    """Of several parsed sources of a page, the rows of the first that has any."""
    best = parsed.groupBy(*page).agg(F.min(rank).alias("_best"))
    return parsed.join(best, page).where(F.col(rank) == F.col("_best")).drop("_best")
