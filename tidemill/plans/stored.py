"""Queries of the stored tables: entities, labels, canonical rows, reports and scans of landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions import codes, times
from tidemill.functions import text as T
from tidemill.operators import quality, relevance, reports, tables
from tidemill.plans.catalog import _MERGED, _ALIASES, _alias_dimension, _rows, _strip, entity_merge, query
from tidemill.runtime import table


@query(
    f"""SELECT DISTINCT id, CASE WHEN lower({_strip('market')}) IN ('cn', 'hk') THEN lower({_strip('market')}) ELSE 'cn' END AS market, true AS enabled,
      CASE WHEN regexp_full_match(upper({_strip('ticker')}), CASE WHEN lower({_strip('market')}) = 'hk' THEN '[0-9]{{4,5}}' ELSE '[0-9]{{6}}' END) THEN upper({_strip('ticker')}) END AS ticker,
      CASE WHEN regexp_full_match(upper({_strip('ticker')}), CASE WHEN lower({_strip('market')}) = 'hk' THEN '[0-9]{{4,5}}' ELSE '[0-9]{{6}}' END) THEN NULL ELSE 'invalid_ticker:' || CASE WHEN lower({_strip('market')}) IN ('cn', 'hk') THEN lower({_strip('market')}) ELSE 'cn' END || ':' || {_strip('ticker')} END AS error,
      CASE WHEN regexp_full_match(upper({_strip('ticker')}), '[0-9]{{1,5}}') THEN lpad(upper({_strip('ticker')}), CASE WHEN lower({_strip('market')}) = 'hk' THEN 5 ELSE 6 END, '0') ELSE upper({_strip('ticker')}) END AS padded FROM ticker_entities"""
)
def market_codes(spark, d):
    rows = table(spark, d, "ticker_entities", "id", "market", "ticker").withColumn("m", codes.market(F.col("market")))
    checked = codes.checked_ticker(F.col("ticker"), F.col("m"))
    padded = codes.padded_ticker(F.upper(T.strip(F.col("ticker"))), F.col("m"))
    return rows.select("id", F.col("m").alias("market"), codes.market_enabled(F.col("market")).alias("enabled"), checked["ticker"].alias("ticker"), checked["error"].alias("error"), padded.alias("padded")).distinct()


@query(
    """SELECT DISTINCT market, ticker, CASE WHEN substr(ticker, 1, 1) IN ('6', '9') THEN 'sh' WHEN substr(ticker, 1, 1) IN ('4', '8') THEN 'bj' ELSE 'sz' END || ticker AS symbol,
      'https://f.example/list,' || CASE WHEN market = 'hk' THEN 'hk' || lpad(ticker, 5, '0') || '_' ELSE ticker || ',f_' END || '3.html' AS list_url,
      CASE WHEN market = 'hk' AND regexp_full_match(ticker, '[0-9]{4,5}') THEN 'https://n.example/hk/3/' || lpad(ticker, 5, '0') WHEN market = 'cn' AND regexp_full_match(ticker, '[0-9]{6}') THEN 'https://n.example/cn?s=' || CASE WHEN substr(ticker, 1, 1) IN ('6', '9') THEN 'sh' WHEN substr(ticker, 1, 1) IN ('4', '8') THEN 'bj' ELSE 'sz' END || ticker || '&p=3' END AS news_url FROM ticker_entities"""
)
def source_urls(spark, d):
    t, m, page = F.col("ticker"), F.col("market"), F.lit(3)
    bases = {"cn": "https://n.example/cn?s={symbol}&p={page}", "hk": "https://n.example/hk/{page}/{symbol}"}
    rows = table(spark, d, "ticker_entities", "market", "ticker").distinct()
    return rows.select("market", "ticker", codes.exchange_symbol(t).alias("symbol"), codes.forum_list_url(t, m, page, "https://f.example").alias("list_url"), codes.stock_news_url(t, m, page, bases).alias("news_url"))


@query(f"WITH {_ALIASES.replace('english_name][i]', 'NULL][i]')} SELECT market, ticker, array_to_string(aliases, '|') AS terms FROM al")
def search_terms(spark, d):
    e = entity_merge(spark, d)
    return e.select("market", "ticker", F.array_join(codes.search_terms(F.col("ticker"), F.col("company_name"), F.col("short_name")), "|").alias("terms"))


@query(
    f"""WITH g AS ({_MERGED}), s AS (SELECT * FROM g WHERE substr(md5(ticker), 1, 1) < '8'), n AS (SELECT DISTINCT market, ticker FROM ticker_entities),
      a AS (SELECT n.market, n.ticker, CASE WHEN s.ticker IS NOT NULL THEN [n.ticker, s.company_name, s.short_name, s.english_name] ELSE [n.ticker, g.company_name] END AS names FROM n LEFT JOIN s USING (market, ticker) LEFT JOIN g ON g.market = n.market AND g.ticker = n.ticker),
      u AS (SELECT market, ticker, unnest(names) AS name, unnest(range(len(names))) AS i FROM a), o AS (SELECT market, ticker, {_strip('name')} AS name, min(i) AS i FROM u WHERE {_strip('name')} <> '' GROUP BY ALL)
    SELECT market, ticker, string_agg(name, '|' ORDER BY i) AS names FROM o GROUP BY ALL"""
)
def entity_names(spark, d):
    e = entity_merge(spark, d)
    return tables.entity_aliases(e, e.where(F.substring(F.md5("ticker"), 1, 1) < "8"), e).select("market", "ticker", F.array_join("names", "|").alias("names"))


@query(
    """WITH n AS (SELECT * FROM ticker_entities WHERE market = 'cn'), a AS (SELECT DISTINCT trim(ticker) AS t, coalesce(nullif(trim(company_name), ''), trim(short_name), '') AS company_name, coalesce(nullif(trim(short_name), ''), '') AS short_name FROM n WHERE trim(ticker) <> '')
    SELECT 'cn' AS market, lpad(t, 6, '0') AS ticker, company_name, short_name, '' AS english_name, '' AS exchange FROM a"""
)
def entity_lists(spark, d):
    """Lists of companies under their own headings; the first is empty, so the second counts."""
    rows = table(spark, d, "ticker_entities", "market", "ticker", "company_name", "short_name").where("market = 'cn'")
    first = rows.where("ticker = 'none'").select(F.col("ticker").alias("代码"), F.col("short_name").alias("名称"))
    # a market without leading zeros, as spreadsheets lose them
    second = rows.select(F.col("ticker").alias("证券代码"), F.col("company_name").alias("公司全称"), F.col("short_name").alias("证券简称"))
    return tables.entities(tables.first_list([first, second]), "cn").distinct()


@query(
    f"""WITH g AS ({_MERGED}), s AS (SELECT * FROM g WHERE substr(md5(ticker), 1, 1) < 'a'), b AS (SELECT market, ticker, NULL AS company_name, '' AS short_name, 'new ' || ticker AS english_name FROM g WHERE substr(md5(ticker), 1, 1) >= '4')
    SELECT market, ticker, s.company_name, s.short_name, coalesce(b.english_name, s.english_name) AS english_name, CASE WHEN b.ticker IS NULL THEN 1 ELSE 2 END AS updated_at FROM s FULL JOIN b USING (market, ticker)"""
)
def entity_refresh(spark, d):
    e = entity_merge(spark, d).withColumn("updated_at", F.lit(1))
    first = F.substring(F.md5("ticker"), 1, 1)
    batch = e.where(first >= "4").select("market", "ticker", F.lit(None).cast("string").alias("company_name"), F.lit("").alias("short_name"), F.concat(F.lit("new "), "ticker").alias("english_name"), F.lit("").alias("exchange"))
    return tables.refresh_entities(e.where(first < "a"), batch, F.lit(2)).drop("exchange")


_LABELS = """m AS (SELECT DISTINCT id, market, ticker, url, is_content_relevant, content_relevance_reason FROM raw_media WHERE url IS NOT NULL AND market IS NOT NULL AND ticker IS NOT NULL),
      l AS (SELECT market, ticker, url, max(struct_pack(content_relevance_reason := content_relevance_reason, is_content_relevant := is_content_relevant)) AS w FROM (
        SELECT market, ticker, url, length(url) % 2 = 0 AS is_content_relevant, 'r' || length(url) AS content_relevance_reason FROM m WHERE substr(md5(url), 1, 1) < '8') GROUP BY ALL)"""


def _labelled(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = _rows(spark, d, "raw_media", "id", "market", "ticker", "url", "is_content_relevant", "content_relevance_reason").dropna(subset=["market", "ticker", "url"]).withColumn("updated_at", F.lit(1))
    some = rows.where(F.substring(F.md5("url"), 1, 1) < "8")
    labels = some.select("market", "ticker", "url", (F.length("url") % 2 == 0).alias("is_content_relevant"), F.concat(F.lit("r"), F.length("url")).alias("content_relevance_reason")).distinct()
    return rows, labels


@query(f"WITH {_LABELS} SELECT id, CASE WHEN w IS NULL THEN is_content_relevant ELSE w.is_content_relevant END AS is_content_relevant, CASE WHEN w IS NULL THEN content_relevance_reason ELSE w.content_relevance_reason END AS content_relevance_reason, CASE WHEN w IS NULL THEN 1 ELSE 2 END AS updated_at FROM m LEFT JOIN l USING (market, ticker, url)")
def label_write_back(spark, d):
    rows, labels = _labelled(spark, d)
    return tables.write_labels(rows, labels, ["market", "ticker", "url"], F.lit(2)).select("id", "is_content_relevant", "content_relevance_reason", "updated_at")


@query(f"WITH {_LABELS} SELECT count(*) * 2 AS attempted, count(*) FILTER (w.is_content_relevant) * 2 AS valid, count(*) FILTER (NOT w.is_content_relevant) * 2 AS invalid, count(*) AS written FROM l")
def label_counts(spark, d):
    rows, labels = _labelled(spark, d)
    unknown = labels.withColumn("url", F.concat("url", F.lit("#")))
    return reports.label_stats(labels.unionByName(unknown), rows, ["market", "ticker", "url"])


@query(
    """SELECT DISTINCT id, title, try_cast(published_at AS TIMESTAMPTZ) IS NULL AS undated, 'Base' AS origin_keyword_type, 1 AS duplicate_count, 0 AS urls, NULL::VARCHAR AS simhash FROM raw_media"""
)
def canonical_rows(spark, d):
    rows = table(spark, d, "raw_media", "id", "title", "published_at").withColumn("published_at", F.coalesce(F.col("published_at").cast("string"), F.lit("no time"))).withColumn("extra", F.lit(1))
    made = tables.canonical(rows.withColumn("duplicate_count", F.lit("x")), "raw_media")
    return made.select("id", "title", F.col("published_at").isNull().alias("undated"), "origin_keyword_type", "duplicate_count", F.size("duplicate_urls").alias("urls"), "simhash").distinct()


@query(
    """WITH m AS (SELECT DISTINCT id, channel, content, is_content_relevant, url FROM raw_media), s AS (SELECT DISTINCT id, channel, url FROM raw_social),
      u AS (SELECT channel, 1 AS a, 0 AS b, 0 AS c, 0 AS e, 0 AS f, 0.0 AS g FROM m UNION ALL SELECT channel, 0, 1, 0, 0, 0, 0 FROM m WHERE is_content_relevant IS DISTINCT FROM false
        UNION ALL SELECT channel, 0, 0, (content IS NOT NULL)::INT, (content IS NULL)::INT, 0, 0 FROM m UNION ALL SELECT channel, 0, 0, 0, 0, (url IS NULL)::INT, 0.25 FROM s)
    SELECT channel, sum(a)::BIGINT AS list, sum(b)::BIGINT AS final, sum(c)::BIGINT AS detail_ok, sum(e)::BIGINT AS detail_fail, sum(f)::BIGINT AS list_fail, sum(g)::DOUBLE AS list_seconds FROM u GROUP BY channel"""
)
def crawl_summary(spark, d):
    media, posts = _rows(spark, d, "raw_media", "id", "channel", "content", "is_content_relevant", "url"), _rows(spark, d, "raw_social", "id", "channel", "url")
    pages = posts.select("channel", F.col("url").isNull().alias("failed"), F.lit(0.25).alias("seconds"))
    return reports.crawl_summary(media, media.where(~F.col("is_content_relevant").eqNullSafe(False)), media.withColumn("ok", F.col("content").isNotNull()), pages)


@query(
    """WITH t AS (SELECT DISTINCT * FROM crawler_tasks) SELECT count(*) AS total, count(*) FILTER (status = 'succeeded') AS success, count(*) FILTER (status = 'failed') AS failed, CAST(floor(epoch(max(finished_at))) - floor(epoch(min(started_at))) AS BIGINT) AS seconds,
      count(*) - count(*) FILTER (status = 'succeeded') - count(*) FILTER (status = 'failed') AS remaining, round(count(*) FILTER (status = 'succeeded') / count(*), 4) AS success_share FROM t"""
)
def batch_report(spark, d):
    return reports.batch_report(table(spark, d, "crawler_tasks").distinct())


@query("SELECT count(*) AS n FROM raw_social WHERE market = 'hk'")
def row_count(spark, d):
    return reports.count_rows(table(spark, d, "raw_social", "market", "ticker"), market="hk")


_PAGES = """p AS (SELECT id, published_at, dense_rank() OVER (ORDER BY strftime(timezone('Asia/Shanghai', published_at), '%Y-%m-%d') DESC) AS page FROM (SELECT DISTINCT id, published_at FROM raw_social WHERE published_at IS NOT NULL)),
      b AS (SELECT page, min(published_at) AS oldest, max(published_at) AS newest FROM p GROUP BY page)"""
_START, _END = "2025-03-05 00:00:00", "2025-03-20 00:00:00"


def _paged(spark, d) -> DataFrame:
    """Posts as a forum might page them: a page for each day, newest first. The days are few, so they are numbered in one task."""
    posts = _rows(spark, d, "raw_social", "id", "published_at").where("published_at is not null").withColumn("day", times.day_bucket(F.col("published_at")))
    days = posts.select("day").distinct()
    numbered = days.withColumn("page", F.row_number().over(W.orderBy(F.col("day").desc())).cast("long"))
    return posts.join(numbered, "day").drop("day")


def _bounds(spark, d) -> tuple:
    return tuple(F.lit(x).cast("timestamp") for x in (_START, _END))


@query(
    f"""WITH {_PAGES}, stop AS (SELECT min(page) AS page FROM b WHERE newest < TIMESTAMPTZ '{_START}+00')
    SELECT id, p.page::BIGINT AS page FROM p, stop WHERE (stop.page IS NULL OR p.page <= stop.page) AND published_at >= TIMESTAMPTZ '{_START}+00' AND published_at < TIMESTAMPTZ '{_END}+00'"""
)
def paged_scan(spark, d):
    items, (start, end) = _paged(spark, d), _bounds(spark, d)
    return tables.replayed_pages(items.select("page"), items, "page", "published_at", start, end, by="newest").select("id", "page")


@query(f"WITH {_PAGES} SELECT min(page)::BIGINT AS first_page FROM b WHERE oldest < TIMESTAMPTZ '{_END}+00'")
def window_seek(spark, d):
    return tables.first_page_of_window(_paged(spark, d), "page", "published_at", _bounds(spark, d)[1])


@query(
    """WITH p AS (SELECT id, title, 2 * dense_rank() OVER (ORDER BY strftime(timezone('Asia/Shanghai', published_at), '%Y-%m-%d') DESC) AS page FROM (SELECT DISTINCT id, published_at, title FROM raw_social WHERE published_at IS NOT NULL)),
      n AS (SELECT page, max((title IS NULL)::INT) AS failed FROM p GROUP BY page), w AS (SELECT unnest(range(min(page), max(page) + 1)) AS page FROM n)
    SELECT w.page::INT AS page, CASE WHEN failed IS NULL THEN 'missing' ELSE 'failed' END AS problem FROM w LEFT JOIN n USING (page) WHERE failed IS NULL OR failed = 1"""
)
def incomplete_pages(spark, d):
    """A listing of which every other page has landed, where pages with a post without a title count as failed."""
    titled = _rows(spark, d, "raw_social", "id", "title")
    pages = _paged(spark, d).join(titled, "id").select((2 * F.col("page")).cast("int").alias("page"), F.col("title").isNull().alias("failed"))
    return reports.complete_scan(pages, "page", F.col("failed"))


@query("SELECT DISTINCT id FROM raw_social WHERE published_at >= TIMESTAMPTZ '2025-03-05 00:00:00+00' AND published_at < TIMESTAMPTZ '2025-03-20 00:00:00+00'")
def social_window(spark, d):
    start, end = _bounds(spark, d)
    return table(spark, d, "raw_social", "id", "published_at").where(times.in_window(F.col("published_at"), start, end, keep_null=False)).select("id").distinct()


@query(
    r"""WITH t AS (SELECT DISTINCT id, ticker, coalesce(lpad(nullif(regexp_extract(coalesce(url, ''), 'list,hk(\d{4,5})_', 1, 'i'), ''), 5, '0'), upper(regexp_replace(nullif(regexp_extract(coalesce(url, ''), '(?:news|list),([A-Za-z]{0,2}\d{4,6}),', 1), ''), '^[A-Za-z]+', ''))) AS f,
      coalesce(nullif(regexp_extract(coalesce(url, ''), '/article/\d+/(\d+)', 1, 'i'), ''), nullif(regexp_extract(coalesce(url, ''), '[?&]postid=(\d+)', 1, 'i'), ''), nullif(regexp_extract(coalesce(url, ''), 'news,[^,]+,(\d+)\.html', 1, 'i'), '')) AS post FROM raw_social)
    SELECT id, f IS NULL OR f = upper(ticker) AS same, post FROM t"""
)
def forum_matches(spark, d):
    rows = table(spark, d, "raw_social", "id", "ticker", "url")
    return rows.select("id", relevance.matches_ticker(F.col("url"), F.col("ticker")).alias("same"), codes.forum_post(F.col("url")).alias("post")).distinct()


@query(
    f"""SELECT url, min(id) AS first_ordinal FROM raw_social WHERE coalesce(social_selected_for_analysis, false) AND coalesce(social_detail_required, false) GROUP BY url"""
)
def details_wanted(spark, d):
    rows = table(spark, d, "raw_social", "id", "url", "social_selected_for_analysis", "social_detail_required")
    return tables.details_to_fetch(rows, F.col("social_selected_for_analysis"), F.col("social_detail_required"), "id")


@query(f"SELECT DISTINCT id FROM raw_media WHERE {_strip('url')} <> ''")
def with_urls(spark, d):
    return relevance.drop_blank_urls(table(spark, d, "raw_media", "id", "url")).select("id").distinct()


@query(
    """SELECT DISTINCT task_id, greatest(1, ceil(3000.0 * (epoch(window_end) - epoch(window_start)) / 604800))::INT AS quota FROM crawler_tasks WHERE window_end > window_start UNION SELECT DISTINCT task_id, 3000 FROM crawler_tasks WHERE (window_end > window_start) IS NOT TRUE"""
)
def window_quotas(spark, d):
    rows = table(spark, d, "crawler_tasks", "task_id", "window_start", "window_end")
    return rows.select("task_id", quality.window_quota(quality.QUOTA_7_DAYS, F.col("window_start"), F.col("window_end")).alias("quota")).distinct()
