"""The queries of the record operators over the given tables, and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import codes, times
from tidemill.functions import text as T
from tidemill.operators import dedupe, quality, relevance, reports, tables
from tidemill.runtime import spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where SQL can say the same on whole tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _rows(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    """Distinct rows of a table of records, spread by their first column, so that the distinct needs no exchange of its own."""
    return spread(table(spark, d, name, *columns), columns[0]).distinct()


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents", "doc_id", "text"), "doc_id")


# Shared pieces of the SQL.
_WS = r"[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]"
def _collapse(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_WS}+', ' ', 'g'))"


def _strip(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^{_WS}+|{_WS}+$', '', 'g')"


def _identity(c: str) -> str:
    return f"regexp_replace(lower({_collapse(c)}), '[^\\p{{L}}\\p{{N}}_]+', '', 'g')"


# What Windows-1252 writes for the bytes 0x80 to 0x9f, in order; five of them are unused.
_CP1252 = "€_‚ƒ„…†‡ˆ‰Š‹Œ_Ž__‘’“”•–—˜™š›œ_žŸ"
_SIGNS = r"(?:[ÃÂâäåæçèé][^\n]|ï¼|ã€|\x{FFFD}|锟斤拷)"
_CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def _score(c: str) -> str:
    count = lambda pattern: f"len(regexp_extract_all(left({c}, 20000), '{pattern}'))"
    return f"(CASE WHEN {c} = '' THEN -1000 ELSE 3.0 * {count('[一-鿿]')} + 0.5 * {count('[，。：]')} - 8.0 * {count(_SIGNS)} - 12.0 * {count('\\x{FFFD}')} - 10.0 * {count(_CONTROLS)} - greatest(length(left({c}, 20000)), 1) * 0.0001 END)"


def _reread(c: str, byte: str) -> str:
    """A text's characters as bytes, read as UTF-8; null where that can't be."""
    marked = f"list_transform(string_split({c}, ''), lambda x: {byte})"
    return f"CASE WHEN {c} = '' OR list_contains({marked}, '-') THEN NULL ELSE TRY(decode(unhex(array_to_string({marked}, '')))) END"


def _repairs(c: str) -> tuple[str, str]:
    """SQL of a text read again as Latin-1 and as Windows-1252."""
    hexed = "printf('%02x', ord(x))"
    latin = f"CASE WHEN ord(x) < 256 THEN {hexed} ELSE '-' END"
    cp = f"CASE WHEN ord(x) < 128 OR ord(x) BETWEEN 160 AND 255 THEN {hexed} WHEN x <> '_' AND instr('{_CP1252}', x) > 0 THEN printf('%02x', 127 + instr('{_CP1252}', x)) ELSE '-' END"
    return _reread(c, latin), _reread(c, cp)


def _with_repaired(source: str, *columns: str) -> str:
    """``source`` (a table or query in parentheses) with ``<column>_r``, each column's repaired text."""
    first = ", ".join(f"{a} AS {c}_l, {b} AS {c}_w" for c in columns for a, b in [_repairs(f"coalesce({c}, '')")])
    second = ", ".join(f"CASE WHEN {c}_l IS NOT NULL AND {_score(c + '_l')} > {_score('coalesce(' + c + ", '')")} + 5 THEN {c}_l ELSE coalesce({c}, '') END AS {c}_b" for c in columns)
    third = ", ".join(f"CASE WHEN {c}_w IS NOT NULL AND {_score(c + '_w')} > {_score(c + '_b')} + 5 THEN {c}_w ELSE {c}_b END AS {c}_r" for c in columns)
    return f"(SELECT *, {third} FROM (SELECT *, {second} FROM (SELECT *, {first} FROM {source})))"


def _cleaned(c: str) -> str:
    return _collapse(f"regexp_replace({c}, '{_CONTROLS}', '', 'g')")


def _compact(c: str) -> str:
    """No space between Han characters, in collapsed text; a second pass takes the ones whose neighbour the first used."""
    one = lambda x: f"regexp_replace({x}, '([一-鿿]) ([一-鿿])', '\\1\\2', 'g')"
    return one(one(c))


_ASCII_NAME = "^[A-Za-z0-9.:-]+$"


def _evidence(body: str, name: str) -> str:
    """Whether a text, with its repaired form beside it, mentions a name."""
    whole, alias = _cleaned(f"{body}_r"), _cleaned(f"coalesce({name}, '')")
    word = f"'(?i)(?:^|[^A-Za-z0-9])' || regexp_escape({alias}) || '(?:[^A-Za-z0-9]|$)'"
    found = " OR ".join(f"contains({x}, {y})" for x in (whole, _compact(whole)) for y in (alias, _compact(alias)))
    return f"({alias} <> '' AND CASE WHEN regexp_matches({alias}, '{_ASCII_NAME}') THEN regexp_matches({whole}, {word}) OR regexp_matches({_compact(whole)}, {word}) ELSE {found} END)"


NAMES_SQL = "e AS (SELECT market, ticker, arg_max(nullif(trim(short_name), ''), updated_at) FILTER (trim(short_name) <> '') AS short_name FROM ticker_entities GROUP BY ALL)"


def _garbled(c: str) -> str:
    """Of a column with its repaired text beside it."""
    signs, han = (f"len(regexp_extract_all(left({c}_r, 2000), '{p}'))" for p in (_SIGNS, "[一-鿿]"))
    return f"(length({_strip(c)}) >= 20 AND {signs} >= 4 AND {signs} > {han})"


def _untagged(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g'), '{_WS}+', ' ', 'g'))"


@query(
    f"""SELECT doc_id, channel, chars, rank FROM (
      SELECT doc_id, coalesce(source, '') AS channel, length({_strip('text')}) AS chars,
             row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY length({_strip('text')}) DESC, doc_id) AS rank FROM documents)
    WHERE rank <= 60"""
)
def topn_per_channel(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "source").select("doc_id", F.coalesce("source", F.lit("")).alias("channel"), T.stripped_length(F.col("text")).alias("chars"))
    return tables.top_per_group(docs, "channel", F.lit(60), F.col("chars").desc(), F.col("doc_id"))


@query(
    f"""SELECT DISTINCT id, CASE WHEN length({_strip('content')}) > 5000 THEN false ELSE is_content_relevant END AS is_content_relevant,
      CASE WHEN length({_strip('content')}) > 5000 THEN 'length_filter:content_chars>5000' ELSE content_relevance_reason END AS content_relevance_reason FROM raw_media"""
)
def length_label(spark, d):
    rows = table(spark, d, "raw_media", "id", "content", "is_content_relevant", "content_relevance_reason")
    return relevance.label_length(rows, "media").select("id", "is_content_relevant", "content_relevance_reason").distinct()


@query(f"SELECT doc_id, md5({_collapse('text')}) AS collapsed, md5({_identity('text')}) AS identity FROM documents")
def text_normalise(spark, d):
    return _documents(spark, d).select("doc_id", F.md5(T.collapse(F.col("text"))).alias("collapsed"), F.md5(T.identity_text(F.col("text"))).alias("identity"))


@query(
    "SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9一-鿿]', '', 'g')) AS chars, length(regexp_replace(coalesce(text, ''), '[^一-鿿]', '', 'g')) AS han FROM documents"
)
def content_chars(spark, d):
    return _documents(spark, d).select("doc_id", T.content_chars(F.col("text")).alias("chars"), T.cjk_count(F.col("text")).alias("han"))


@query(
    f"""SELECT hash, count(*) AS n, min(doc_id) AS first_doc FROM (
      SELECT doc_id, sha256({_identity('text')}) AS hash FROM documents WHERE {_identity('text')} <> '') GROUP BY hash"""
)
def exact_dedupe(spark, d):
    docs = _documents(spark, d).select("doc_id", T.content_hash(F.col("text")).alias("hash")).where("hash <> ''")
    return docs.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query(
    rf"""WITH n AS (SELECT doc_id, {_identity('text')} AS s FROM documents),
      h AS (SELECT doc_id, s, regexp_replace(s, '[^一-鿿]', '', 'g') AS han FROM n),
      t AS (SELECT doc_id, unnest(regexp_extract_all(s, '[a-z0-9_]{{2,}}')) AS token FROM h
            UNION ALL SELECT doc_id, substr(han, i, 2) FROM (SELECT doc_id, han, unnest(range(1, length(han))) AS i FROM h WHERE length(han) > 1)),
      c AS (SELECT doc_id, token, count(*) AS times FROM t GROUP BY ALL)
    SELECT doc_id, count(*) AS distinct_tokens, sum(times)::BIGINT AS tokens FROM c GROUP BY doc_id"""
)
def token_counts(spark, d):
    docs = _documents(spark, d).select("doc_id", F.explode(T.tokens(F.col("text"))).alias("token"))
    return docs.groupBy("doc_id", "token").agg(F.count("*").alias("times")).groupBy("doc_id").agg(F.count("*").alias("distinct_tokens"), F.sum("times").alias("tokens"))


_SIMHASH_TABLE = rf"""rows AS (SELECT DISTINCT id, concat_ws(' ', coalesce(title, ''), coalesce(content, '')) AS body FROM raw_media),
      n AS (SELECT id, {_identity('body')} AS s FROM rows),
      h AS (SELECT id, s, regexp_replace(s, '[^一-鿿]', '', 'g') AS han FROM n),
      t AS (SELECT id, unnest(regexp_extract_all(s, '[a-z0-9_]{{2,}}')) AS token FROM h
            UNION ALL SELECT id, substr(han, i, 2) FROM (SELECT id, han, unnest(range(1, length(han))) AS i FROM h WHERE length(han) > 1)),
      c AS (SELECT id, token, count(*) AS times FROM t GROUP BY ALL),
      k AS (SELECT token, ('0x' || substr(sha256(token), 49, 16))::UBIGINT AS bits FROM (SELECT DISTINCT token FROM c)),
      v AS (SELECT id, b, sum(CASE WHEN (bits >> b) & 1 = 1 THEN times ELSE -times END) AS vote FROM c JOIN k USING (token), range(64) r(b) GROUP BY id, b),
      p AS (SELECT id, sum(CASE WHEN vote > 0 THEN 1::HUGEINT << b ELSE 0 END)::UBIGINT AS simhash FROM v GROUP BY id)"""


@query(f"WITH {_SIMHASH_TABLE} SELECT n.id, CASE WHEN coalesce(simhash, 0) = 0 THEN NULL ELSE printf('%016x', simhash) END AS simhash FROM n LEFT JOIN p USING (id)")
def simhash_value(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "title", "content")
    return dedupe.simhash(rows, "id", F.concat_ws(" ", T.text(F.col("title")), T.text(F.col("content")))).select("id", dedupe.simhash_hex(F.col("simhash")).alias("simhash"))


@query(
    """WITH s AS (SELECT DISTINCT simhash, ('0x' || simhash)::UBIGINT AS v FROM raw_media WHERE simhash IS NOT NULL AND simhash <> '' AND simhash <> '0000000000000000')
    SELECT a.simhash AS hash_a, b.simhash AS hash_b, bit_count(xor(a.v, b.v))::INT AS distance FROM s a JOIN s b ON a.simhash < b.simhash WHERE bit_count(xor(a.v, b.v)) <= 6"""
)
def near_dup_hashes(spark, d):
    held = table(spark, d, "raw_media", "simhash").where("simhash is not null and simhash <> ''").distinct().select("simhash", F.conv("simhash", 16, -10).cast("long").alias("v"))
    near = dedupe.near_classes(held, "v")
    a, b = dedupe.simhash_hex(F.col("sa")), dedupe.simhash_hex(F.col("sb"))
    return near.select(F.least(a, b).alias("hash_a"), F.greatest(a, b).alias("hash_b"), F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))).alias("distance"))


def _rounds(n: int) -> str:
    """Labels of the greedy grouping: the smallest label among earlier matches, as often as a chain is long."""
    first = "l0 AS (SELECT o AS b, o AS label FROM g)"
    return ", ".join([first, *(f"l{i} AS (SELECT g.o AS b, coalesce(min(x.label), g.o) AS label FROM g LEFT JOIN pairs ON pairs.b = g.o LEFT JOIN l{i - 1} x ON x.b = pairs.a GROUP BY g.o)" for i in range(1, n + 1))])


@query(
    f"""WITH RECURSIVE {_SIMHASH_TABLE.replace("SELECT DISTINCT id, concat_ws", "SELECT DISTINCT id, market, ticker, title, content, url, published_at, concat_ws")},
      g AS (SELECT rows.id, market, ticker, published_at, coalesce(url, '') AS url, nullif({_strip('url')}, '') AS u, {_identity("coalesce(nullif(content, ''), title)")} AS h, nullif(simhash, 0) AS sh, coalesce(strftime(published_at, '%Y%m%d%H%M%S'), '9') || '|' || rows.id AS o FROM rows LEFT JOIN p USING (id)),
      pairs AS (SELECT x.o AS a, y.o AS b FROM g x JOIN g y ON x.market = y.market AND x.ticker = y.ticker AND x.o < y.o WHERE x.u = y.u OR x.h <> '' AND x.h = y.h OR bit_count(xor(x.sh, y.sh)) <= 6),
      {_rounds(9)}, d AS (SELECT label, g.*, row_number() OVER (PARTITION BY label ORDER BY published_at NULLS LAST, url, o) AS k FROM l9 JOIN g ON g.o = l9.b),
      uu AS (SELECT label, u, min(k) AS k FROM d WHERE u IS NOT NULL GROUP BY ALL), us AS (SELECT label, string_agg(u, ' ' ORDER BY k) AS urls FROM uu GROUP BY label)
    SELECT first(id ORDER BY k) AS id, label AS "group", count(*)::INT AS duplicate_count, coalesce(any_value(urls), '') AS duplicate_urls FROM d LEFT JOIN us USING (label) GROUP BY label"""
)
def near_dup_groups(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "market", "ticker", "task_id", "title", "content", "url", "published_at")
    rows = rows.withColumn("ordinal", F.concat_ws("|", F.coalesce(F.date_format("published_at", "yyyyMMddHHmmss"), F.lit("9")), "id"))
    grouped = dedupe.group_duplicates(rows, "ordinal", ["market", "ticker"])
    return dedupe.representatives(grouped).select("id", "group", "duplicate_count", F.array_join("duplicate_urls", " ").alias("duplicate_urls"))


@query("SELECT event_id, ts FROM events WHERE ts IS NULL OR (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12 12:00:00')")
def window_filter(spark, d):
    events = table(spark, d, "events", "event_id", "ts")
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05 00:00:00", "2024-01-12 12:00:00"))
    return events.where(times.in_window(F.col("ts"), start, end, keep_null=True))


@query(
    "SELECT coalesce(strftime(timezone('Asia/Shanghai', published_at), '%Y-%m-%d'), 'unknown') AS bucket, count(*) AS n FROM (SELECT DISTINCT id, published_at FROM raw_social) GROUP BY 1"
)
def day_bucket_counts(spark, d):
    posts = _rows(spark, d, "raw_social", "id", "published_at")
    return posts.groupBy(times.day_bucket(F.col("published_at")).alias("bucket")).agg(F.count("*").alias("n"))


_ALLOCATED = """b AS (SELECT coalesce(strftime(timezone('Asia/Shanghai', published_at), '%Y-%m-%d'), 'unknown') AS bucket, count(*) AS n FROM (SELECT DISTINCT id, published_at FROM raw_social) GROUP BY 1),
      y AS (SELECT bucket, n, (1000 * n)::DOUBLE / sum(n) OVER () AS y FROM b),
      a AS (SELECT bucket, n, floor(y) + CASE WHEN row_number() OVER (ORDER BY y - floor(y) DESC, bucket DESC) <= 1000 - sum(floor(y)) OVER () THEN 1 ELSE 0 END AS q FROM y)"""


@query(f"WITH {_ALLOCATED} SELECT bucket, n, q::INT AS quota FROM a")
def quota_allocation(spark, d):
    return quality.allocate(day_bucket_counts(spark, d), 1000)


_KEYWORDS = {"event": quality.EVENT, "reasoning": quality.REASONING, "market": quality.MARKET, "spam": quality.SPAM}


def _any(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{w.lower()}')" for w in words) + ")"


def _marks(column: str, marks: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{m}')" for m in marks) + ")"


_QUALITY = rf"""posts AS (SELECT DISTINCT id, title, summary, content, url, published_at, social_read_count, social_comment_count, social_like_count, social_forward_count FROM raw_social),
      u AS (SELECT *, {_untagged('title')} AS t, {_untagged('summary')} AS s, {_untagged('content')} AS c,
            greatest(0, coalesce(social_read_count, 0)::BIGINT) + greatest(0, coalesce(social_comment_count, 0)::BIGINT) + greatest(0, coalesce(social_like_count, 0)::BIGINT) + greatest(0, coalesce(social_forward_count, 0)::BIGINT) AS eng FROM posts),
      w AS (SELECT *, concat_ws(' ', nullif(t, ''), CASE WHEN s <> '' AND s <> t THEN s END, CASE WHEN c <> '' AND c <> t AND c <> s THEN c END) AS body FROM u),
      f AS (SELECT *, length(regexp_replace(body, '[^一-鿿]', '', 'g')) AS cjk, length(regexp_replace(body, '[^A-Za-z0-9一-鿿]', '', 'g')) AS chars,
            {_any('body', quality.EVENT)} AS ev, {_any('body', quality.REASONING)} AS re, {_any('body', quality.MARKET)} AS mk, {_any('body', quality.SPAM)} AS sp,
            regexp_matches(body, '\p{{Nd}}') AS num, regexp_matches(body, '[哈啊呀哦嗯]{{2,}}|[!?！？。]{{3,}}') AS chat,
            length(s) >= 110 OR {_marks("concat_ws(' ', s, body)", quality.ELLIPSIS)} AS cut,
            regexp_replace(regexp_replace(body, '(?:[,，。.！!?？:：;；、()（）\[\]【】$]|{_WS})+', '', 'g'), '(?i)\$?[一-鿿A-Za-z]{{0,12}}\(?[A-Za-z]{{0,3}}\p{{Nd}}{{4,6}}\)?\$?', '', 'g') = '' AS marker FROM w),
      g AS (SELECT *, CASE WHEN body = '' THEN 'empty_text' WHEN marker THEN 'stock_marker_only' WHEN sp THEN 'spam_or_leadgen' WHEN cjk < 8 AND NOT ev AND NOT mk THEN 'too_short_without_signal' END AS dropped, cjk < 16 AND NOT ev AND NOT re AS thin FROM f),
      q AS (SELECT *, CASE WHEN dropped = 'too_short_without_signal' THEN 5 WHEN dropped IS NOT NULL THEN 0 ELSE greatest(0, least(100,
              CASE WHEN cjk >= 120 THEN 45 WHEN cjk >= 60 THEN 35 WHEN cjk >= 24 THEN 25 WHEN cjk >= 8 THEN 12 ELSE 0 END + CASE WHEN ev THEN 30 ELSE 0 END + CASE WHEN re THEN 20 ELSE 0 END + CASE WHEN mk THEN 10 ELSE 0 END
              + CASE WHEN num THEN 10 ELSE 0 END + CASE WHEN eng >= 1000 THEN 15 WHEN eng >= 100 THEN 8 ELSE 0 END - CASE WHEN chat THEN 8 ELSE 0 END - CASE WHEN thin THEN 8 ELSE 0 END)) END AS score FROM g),
      r AS (SELECT *, CASE WHEN dropped IS NOT NULL THEN 'drop' WHEN score >= 70 THEN 'high' WHEN score >= 40 THEN 'medium' ELSE 'low' END AS tier FROM q)"""


@query(
    f"""WITH {_QUALITY} SELECT id, score::INT AS score, tier, coalesce(dropped, concat_ws(',', CASE WHEN cjk >= 120 THEN 'long_discussion' WHEN cjk >= 60 THEN 'substantial_text' WHEN cjk >= 24 THEN 'contextual_text' WHEN cjk >= 8 THEN 'short_but_readable' END,
      CASE WHEN ev THEN 'event_or_fundamental_signal' END, CASE WHEN re THEN 'reasoning_signal' END, CASE WHEN mk THEN 'market_signal' END, CASE WHEN num THEN 'numeric_signal' END,
      CASE WHEN eng >= 1000 THEN 'high_engagement' WHEN eng >= 100 THEN 'some_engagement' END, CASE WHEN chat THEN 'chatty_noise' END, CASE WHEN thin THEN 'thin_context' END)) AS reasons,
      CASE WHEN dropped = 'empty_text' THEN 'empty' WHEN dropped = 'spam_or_leadgen' THEN 'spam' WHEN dropped IS NOT NULL OR chars <= 80 AND NOT cut THEN 'list_complete_short' WHEN cut THEN 'list_maybe_truncated' ELSE 'list_substantial' END AS body_quality,
      (dropped IS NULL AND cut AND chars < 80) AS detail_required FROM r"""
)
def quality_score(spark, d):
    posts = _rows(spark, d, "raw_social", "id", "title", "summary", "content", *quality.COUNTERS)
    q = quality.score_quality(posts)
    return q.select("id", "quality.score", "quality.tier", F.array_join("quality.reasons", ",").alias("reasons"), "quality.body_quality", "quality.detail_required")


@query(
    f"""WITH {_QUALITY},
      e AS (SELECT *, coalesce(strftime(timezone('Asia/Shanghai', published_at), '%Y-%m-%d'), 'unknown') AS bucket, tier IN ('high', 'medium') AS hi, tier <> 'drop' AS ok, coalesce(nullif(url, ''), chr(0) || id) AS ukey FROM r),
      n AS (SELECT bucket, count(*) AS n, count(*) FILTER (hi) AS h, count(*) FILTER (NOT hi) AS l FROM e WHERE ok GROUP BY 1),
      y AS (SELECT *, (500 * n)::DOUBLE / sum(n) OVER () AS y, sum(n) OVER () AS total FROM n),
      a AS (SELECT *, floor(y) + CASE WHEN row_number() OVER (ORDER BY y - floor(y) DESC, bucket DESC) <= 500 - sum(floor(y)) OVER () THEN 1 ELSE 0 END AS q FROM y),
      p AS (SELECT *, least(h, round(q * 0.6)) AS h0 FROM a), o AS (SELECT *, least(h, h0 + greatest(q - h0 - least(l, q - h0), 0)) AS hq FROM p),
      k AS (SELECT bucket, total, CASE WHEN h + l <= q THEN h ELSE hq END AS hq, CASE WHEN h + l <= q THEN l ELSE least(l, q - hq) END AS lq FROM o),
      z AS (SELECT e.*, total, hq, lq, row_number() OVER (PARTITION BY e.bucket, hi ORDER BY score DESC, eng DESC, coalesce(floor(epoch(published_at)), 0) DESC, ('0x' || substr(sha1(coalesce(url, '')), 1, 12))::BIGINT, id) AS rk FROM e JOIN k USING (bucket) WHERE ok),
      c AS (SELECT DISTINCT ukey FROM z WHERE total <= 500 OR rk <= CASE WHEN hi THEN hq ELSE lq END)
    SELECT e.id, e.bucket, e.ok AND c.ukey IS NOT NULL AS selected FROM e LEFT JOIN c USING (ukey)"""
)
def stratified_sample(spark, d):
    posts = _rows(spark, d, "raw_social", "id", "title", "summary", "content", "url", "published_at", *quality.COUNTERS)
    return quality.stratified_sample(quality.score_quality(posts), 500, "published_at", "id").select("id", "bucket", "selected")


@query(
    r"""SELECT DISTINCT id, coalesce(lpad(nullif(regexp_extract(coalesce(url, ''), 'list,hk(\d{4,5})_', 1, 'i'), ''), 5, '0'), upper(regexp_replace(nullif(regexp_extract(coalesce(url, ''), '(?:news|list),([A-Za-z]{0,2}\d{4,6}),', 1), ''), '^[A-Za-z]+', ''))) AS url_ticker,
      regexp_extract(coalesce(url, ''), '^(?:https?://)?([^/]*)', 1) AS host FROM raw_social"""
)
def url_parts(spark, d):
    rows = table(spark, d, "raw_social", "id", "url")
    return rows.select("id", codes.forum_ticker(F.col("url")).alias("url_ticker"), F.regexp_extract(T.text(F.col("url")), "^(?:https?://)?([^/]*)", 1).alias("host")).distinct()


@query(
    """SELECT market, ticker, arg_max(nullif(trim(company_name), ''), updated_at) FILTER (trim(company_name) <> '') AS company_name, arg_max(nullif(trim(short_name), ''), updated_at) FILTER (trim(short_name) <> '') AS short_name,
      arg_max(nullif(trim(english_name), ''), updated_at) FILTER (trim(english_name) <> '') AS english_name, arg_max(nullif(trim(exchange), ''), updated_at) FILTER (trim(exchange) <> '') AS exchange FROM ticker_entities GROUP BY market, ticker"""
)
def entity_merge(spark, d):
    return tables.merge_entities(table(spark, d, "ticker_entities"), ["market", "ticker"], F.col("updated_at"), "company_name", "short_name", "english_name", "exchange")


def _alias_dimension(spark, d) -> DataFrame:
    """(market, ticker, aliases): every form of each company's names, once per company."""
    e = entity_merge(spark, d)
    return e.select("market", "ticker", codes.aliases(F.array("ticker", "company_name", "short_name", "english_name")).alias("aliases"))


# A market's suffixes at the end of a name, the endings of companies, and what a code is without them.
_NAME = rf"trim(regexp_replace({_compact(_collapse('name'))}, '(?i)(?:\s*(?:-W|\.HK|\.SZ|\.SH|\.SS))+\s*$', ''))"
_FIRST, _SECOND = ("(" + "|".join(s) + ")$" for s in (codes.CORPORATE_SUFFIXES, codes.BUSINESS_SUFFIXES))


def _shorter(c: str, ending: str) -> str:
    rest = f"trim(regexp_replace({c}, '{ending}', ''))"
    return f"CASE WHEN regexp_matches({c}, '{ending}') AND length(regexp_replace({rest}, '[^一-鿿]', '', 'g')) >= 2 THEN {rest} END"


def _code_sql(c: str) -> str:
    bare = f"regexp_replace(regexp_replace(upper(regexp_replace({c}, '[^0-9A-Za-z]', '', 'g')), 'HK$', ''), '(?:SH|SZ|SS)$', '')"
    return f"CASE WHEN regexp_full_match({bare}, '[0-9]+') THEN coalesce(nullif(ltrim({bare}, '0'), ''), '0') ELSE {bare} END"


_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_MERGED = """SELECT market, ticker, arg_max(nullif(trim(company_name), ''), updated_at) FILTER (trim(company_name) <> '') AS company_name, arg_max(nullif(trim(short_name), ''), updated_at) FILTER (trim(short_name) <> '') AS short_name,
      arg_max(nullif(trim(english_name), ''), updated_at) FILTER (trim(english_name) <> '') AS english_name FROM ticker_entities GROUP BY market, ticker"""
_ALIASES = rf"""g AS ({_MERGED}), n AS (SELECT market, ticker, i, [ticker, company_name, short_name, english_name][i] AS name FROM g, range(1, 5) r(i)),
      v0 AS (SELECT market, ticker, i, {_NAME.replace("coalesce(name, '')", f"translate(coalesce(name, ''), '{_WIDE}', '" + "".join(map(chr, range(0x21, 0x7F))).replace("'", "''") + "')")} AS v FROM n),
      v1 AS (SELECT *, {_shorter('v', _FIRST)} AS w FROM v0 WHERE v <> ''), v2 AS (SELECT *, {_shorter('v', _SECOND)} AS x, {_shorter('w', _SECOND)} AS y FROM v1),
      f AS (SELECT market, ticker, i, k, unnest([v, w, x, y]) AS a, unnest([1, 2, 3, 4]) AS j FROM v2, (SELECT 1 AS k)),
      c AS (SELECT *, {_code_sql('a')} AS code FROM f WHERE a <> ''),
      l AS (SELECT market, ticker, i, j, unnest([a, CASE WHEN code <> '' AND code <> a THEN code END, CASE WHEN regexp_full_match(code, '[0-9]{{1,5}}') THEN lpad(code, greatest(4, length(code))::INT, '0') END, CASE WHEN regexp_full_match(code, '[0-9]{{1,5}}') THEN lpad(code, 5, '0') END]) AS alias, unnest([1, 2, 3, 4]) AS p FROM c),
      o AS (SELECT market, ticker, alias, min((i * 10 + j) * 10 + p) AS place FROM l WHERE alias IS NOT NULL GROUP BY ALL),
      al AS (SELECT market, ticker, list(alias ORDER BY place) AS aliases FROM o GROUP BY ALL)"""


@query(f"WITH {_ALIASES} SELECT market, ticker, array_to_string(aliases, '|') AS aliases FROM al")
def company_aliases(spark, d):
    return _alias_dimension(spark, d).select("market", "ticker", F.array_join("aliases", "|").alias("aliases"))


def _mentions(t: str, alias: str) -> str:
    """How often a collapsed text mentions a name. For whole words every sign is doubled, so that neighbours don't share one."""
    doubled = lambda x: f"regexp_replace({x}, '([^A-Za-z0-9])', '\\1\\1', 'g')"
    words = lambda x: f"len(regexp_extract_all({doubled(x)}, '(?i)(?:^|[^A-Za-z0-9])' || regexp_escape({doubled(alias)}) || '(?:[^A-Za-z0-9]|$)'))"
    inside = lambda x: f"(length({x}) - length(replace({x}, {alias}, ''))) // length({alias})"
    c = _compact(t)
    return f"CASE WHEN {alias} = '' THEN 0 WHEN regexp_matches({alias}, '{_ASCII_NAME}') THEN greatest({words(t)}, {words(c)}) ELSE greatest({inside(t)}, {inside(c)}) END"


# Runs of digits between two marks, so that a pattern can ask for a whole run.
_MARKED = r"regexp_replace(coalesce({c}, ''), '(\p{{Nd}}+)', chr(2) || '\1' || chr(1), 'g')"


def _codes_sql(c: str) -> str:
    m = _MARKED.format(c=c)
    six = rf"regexp_extract_all({m}, '\x02([03468]\p{{Nd}}{{5}})\x01', 1)"
    hk = (rf"(?i)(?:HK|港股|代码|股份代号|股票代码){_WS}*[:：]?{_WS}*\x02(\p{{Nd}}{{4,5}})\x01", rf"(?i)\x02(\p{{Nd}}{{4,5}})\x01{_WS}*\.HK(?:[^\p{{L}}\p{{N}}_\x02]|$)", r"[（(]\x02(\p{Nd}{4,5})\x01[）)]")
    rest = " || ".join(f"regexp_extract_all({m}, '{p}', 1)" for p in hk)
    return f"list_transform({six} || list_filter({rest}, lambda x: NOT regexp_full_match(x, '(?:19|20)[0-9]{{2}}')), lambda x: coalesce(nullif(ltrim(x, '0'), ''), '0'))"


_NEGATIVE = "(" + " OR ".join(f"contains(body, '{w}')" for w in relevance.NEGATIVE) + ")"


@query(
    f"""WITH {_ALIASES}, m AS (SELECT DISTINCT id, market, ticker, title, summary, content FROM raw_media),
      b AS (SELECT id, {_collapse('title')} AS t, {_collapse("concat_ws(' ', coalesce(title, ''), coalesce(nullif(content, ''), nullif(summary, ''), ''))")} AS body, coalesce(aliases, []) AS aliases FROM m LEFT JOIN al USING (market, ticker)),
      s AS (SELECT id, sum({_mentions('body', 'a')}) AS n, sum({_mentions('t', 'a')}) AS nt FROM (SELECT id, t, body, unnest(aliases) AS a FROM b) GROUP BY id),
      k AS (SELECT b.id, body, coalesce(n, 0) AS n, coalesce(nt, 0) AS nt, list_filter({_codes_sql('body')}, lambda x: NOT list_contains(list_transform(aliases, lambda a: {_code_sql('a')}), x)) AS others FROM b LEFT JOIN s USING (id)),
      q AS (SELECT *, len(others) AS o, len(list_distinct(others)) AS u, CASE WHEN n + len(others) > 0 THEN n / (n + len(others)) ELSE 0.0 END AS share FROM k),
      z AS (SELECT *, CASE WHEN n = 0 THEN 'target_not_found_kept' WHEN {_NEGATIVE} THEN 'negative_pattern_hit' WHEN nt > 0 AND n >= 2 THEN 'target_in_title_and_repeated' WHEN u <= 1 AND n >= 2 THEN 'target_dominant_with_few_other_tickers'
        WHEN u >= 5 THEN 'too_many_other_tickers' WHEN share <= 0.35 AND n + o > 7 THEN 'low_target_share_with_many_mentions' ELSE 'edge_case_kept_to_avoid_false_negative' END AS reason FROM q)
    SELECT id, reason NOT IN ('negative_pattern_hit', 'too_many_other_tickers', 'low_target_share_with_many_mentions') AS is_relevant, reason, n::INT AS target_mentions, u::INT AS other_tickers, o::INT AS other_mentions, (n + o)::INT AS total_mentions, round(share, 6) AS target_share FROM z"""
)
def relevance_ladder(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "market", "ticker", "title", "summary", "content")
    labelled = relevance.relevance(rows.join(_alias_dimension(spark, d), ["market", "ticker"], "left"), "title", "content", "summary", "aliases")
    return labelled.select("id", "decision.*")


@query(f"WITH {_ALIASES}, m AS (SELECT DISTINCT id, market, ticker, {_collapse('content')} AS t FROM raw_media), s AS (SELECT id, sum({_mentions('t', 'a')})::INT AS n FROM (SELECT id, t, unnest(aliases) AS a FROM m JOIN al USING (market, ticker)) GROUP BY id) SELECT m.id, coalesce(n, 0) AS mentions FROM m LEFT JOIN s USING (id)")
def alias_mentions(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "market", "ticker", "content").join(_alias_dimension(spark, d), ["market", "ticker"], "left")
    return rows.select("id", codes.mentions(F.col("content"), F.col("aliases")).alias("mentions"))


@query(f"WITH t AS (SELECT DISTINCT id, content FROM raw_media) SELECT id, coalesce(array_to_string({_codes_sql('content')}, ','), '') AS codes FROM t")
def stock_codes(spark, d):
    return _rows(spark, d, "raw_media", "id", "content").select("id", F.array_join(codes.stock_codes(F.col("content")), ",").alias("codes"))


@query(
    f"""WITH {NAMES_SQL}, m AS (SELECT DISTINCT id, market, ticker, content FROM raw_media) SELECT id FROM {_with_repaired('(SELECT * FROM m JOIN e USING (market, ticker))', 'content')} WHERE {_evidence('content', 'short_name')} OR {_evidence('content', 'ticker')}"""
)
def target_evidence(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "market", "ticker", "content").join(entity_merge(spark, d).select("market", "ticker", "short_name"), ["market", "ticker"])
    return rows.where(relevance.has_evidence(F.col("content"), F.array("short_name", "ticker"))).select("id")


_NEWS_URL = "regexp_replace(url, '^https?://[^/]*', CASE WHEN substr(md5(id), 1, 1) < '8' THEN 'https://finance.sina.com.cn' WHEN substr(md5(id), 1, 1) < 'c' THEN 'https://stock.sina.com/fund' ELSE 'https://finance.example' END)"


@query(f"SELECT DISTINCT id FROM raw_media WHERE regexp_matches({_NEWS_URL}, '(?:finance|stock|cj)\\.sina\\.(?:com|cn)') AND NOT regexp_matches({_NEWS_URL}, 'zixuan|shortcut\\.php|/mkt/|/stock/index|/fund/|/futuremarket/|/money/|/guide/')")
def article_urls(spark, d):
    first = F.substring(F.md5("id"), 1, 1)
    host = F.when(first < "8", "https://finance.sina.com.cn").when(first < "c", "https://stock.sina.com/fund").otherwise("https://finance.example")
    rows = table(spark, d, "raw_media", "id", "url").withColumn("url", F.regexp_replace(F.col("url"), F.lit("^https?://[^/]*"), host))
    return rows.where(relevance.is_article_url(F.col("url"))).select("id").distinct()


@query("SELECT DISTINCT id FROM raw_media WHERE coalesce(content, '') = '' OR regexp_matches(content, '验证码|访问过于频繁|sys-guard|fd_guba_validate|em_capt|validate\\.js|身份核实|东方财富证券')")
def block_pages(spark, d):
    return table(spark, d, "raw_media", "id", "content").where(relevance.is_block_page(F.col("content"))).select("id").distinct()


@query(
    """SELECT url, arg_min(id, struct_pack(n := published_at IS NULL, t := coalesce(published_at, TIMESTAMPTZ '9999-12-31'), o := id)) AS id FROM (SELECT DISTINCT id, url, published_at FROM raw_media) WHERE url IS NOT NULL GROUP BY url"""
)
def earliest_per_url(spark, d):
    rows = table(spark, d, "raw_media", "id", "url", "published_at").where("url is not null").distinct().withColumn("ordinal", F.col("id"))
    return tables.earliest_per_key(rows, "url", "published_at", "ordinal").select("url", "id")


@query(
    f"""SELECT key AS url, arg_max(id, struct_pack(n := created_at IS NOT NULL, a := created_at, b := id)) AS id, 't1' AS task_id FROM (SELECT {_strip('url')} AS key, id, created_at FROM raw_social) WHERE key <> '' GROUP BY key"""
)
def last_wins_batch(spark, d):
    rows = table(spark, d, "raw_social", "id", "url", "created_at").withColumn("o", F.struct("created_at", "id"))
    return tables.prepared_batch(rows, "o", task_id="t1").select(T.strip(F.col("url")).alias("url"), "id", "task_id")


@query(
    """WITH r AS (SELECT DISTINCT id, market, ticker, url, title, summary FROM raw_media WHERE url IS NOT NULL AND market IS NOT NULL AND ticker IS NOT NULL),
      s AS (SELECT *, row_number() OVER (PARTITION BY market, ticker, url, coalesce(id, '') >= '8' ORDER BY coalesce(id, '') DESC) AS k, coalesce(id, '') >= '8' AS late FROM r),
      o AS (SELECT * FROM s WHERE k = 1 AND NOT late), b AS (SELECT * FROM s WHERE k = 1 AND late)
    SELECT market, ticker, url, CASE WHEN b.url IS NULL THEN o.id ELSE b.id END AS id, CASE WHEN b.url IS NULL THEN o.title ELSE b.title END AS title, CASE WHEN b.url IS NULL THEN o.summary END AS summary, CASE WHEN o.url IS NULL THEN 2 ELSE 1 END AS created_at, CASE WHEN b.url IS NULL THEN 1 ELSE 2 END AS updated_at FROM o FULL JOIN b USING (market, ticker, url)"""
)
def merge_upsert(spark, d):
    """Later rows without their summary: the stored summary must become null."""
    keys = ["market", "ticker", "url"]
    rows = table(spark, d, "raw_media", "id", *keys, "title", "summary").dropna(subset=keys).distinct().withColumn("o", F.coalesce("id", F.lit("")))
    half = lambda part: tables.last_per_key(part, keys, "o").drop("o")
    stored = half(rows.where("o < '8'")).withColumns({"created_at": F.lit(1), "updated_at": F.lit(1)})
    return tables.upsert(stored, half(rows.where("o >= '8'")).withColumn("summary", F.lit(None).cast("string")), keys, F.lit(2))


@query(
    f"""WITH m AS (SELECT DISTINCT id, url, title, summary FROM raw_media), c AS (SELECT url, max({_strip('content')}) AS full_text, max(source_name) AS source FROM raw_media WHERE url IS NOT NULL AND content IS NOT NULL GROUP BY url)
    SELECT id, md5(coalesce(nullif({_strip('full_text')}, ''), nullif({_strip('summary')}, ''), coalesce(title, ''))) AS content, coalesce(nullif({_strip('source')}, ''), summary) AS summary, c.url IS NOT NULL AS has_detail FROM m LEFT JOIN c USING (url)"""
)
def detail_join_fallback(spark, d):
    rows = table(spark, d, "raw_media", "id", "url", "title", "summary", "content", "source_name")
    details = rows.where("content is not null and url is not null").groupBy("url").agg(F.max(T.strip(F.col("content"))).alias("full_text"), F.max("source_name").alias("detail_summary"))
    return tables.join_details(rows.drop("content", "source_name").distinct(), details).select("id", F.md5("content").alias("content"), "summary", "has_detail")


@query("SELECT DISTINCT id FROM raw_media m WHERE NOT EXISTS (SELECT 1 FROM crawler_tasks t WHERE t.task_id = m.task_id)")
def anti_tasks(spark, d):
    return table(spark, d, "raw_media", "id", "task_id").join(table(spark, d, "crawler_tasks", "task_id"), "task_id", "left_anti").select("id").distinct()


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events", "event_id", "props").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query(
    f"""WITH m AS (SELECT DISTINCT id, channel, title, content, is_content_relevant FROM raw_media), b AS (SELECT channel, is_content_relevant, {_cleaned('content_r')} AS c, {_cleaned('title_r')} AS t FROM {_with_repaired('m', 'content', 'title')}),
      g AS (SELECT channel, count(*) AS rows, count(*) FILTER (length(c) >= 30 AND c <> t) AS with_body, count(*) FILTER (is_content_relevant IS DISTINCT FROM false) AS relevant, count(*) FILTER (is_content_relevant = false) AS irrelevant FROM b GROUP BY 1)
    SELECT *, round(with_body / rows, 4) AS body_share, round(relevant / rows, 4) AS relevant_share FROM g"""
)
def channel_summary(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "channel", "title", "content", "is_content_relevant")
    return reports.channel_summary(rows, "channel", T.media_body(F.col("content"), F.col("title")), F.col("is_content_relevant"))


@query(
    """SELECT id, task_id, row_number() OVER (PARTITION BY task_id ORDER BY published_at DESC NULLS LAST, created_at DESC NULLS LAST, id) AS position FROM (SELECT DISTINCT id, task_id, published_at, created_at FROM raw_media) WHERE task_id IS NOT NULL"""
)
def pull_order(spark, d):
    rows = table(spark, d, "raw_media", "id", "task_id", "published_at", "created_at").where("task_id is not null").distinct()
    return tables.pull_order(rows).select("id", "task_id", "position")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def latest_state(spark, d):
    return tables.latest_state(table(spark, d, "events", "user_id", "event_type", "event_id"), "user_id", F.col("event_id")).select("user_id", "event_type", "event_id")


@query("SELECT c.channel, s.subject FROM channels c, subjects s WHERE list_contains(c.enabled_markets, 'hk')")
def crawl_plan(spark, d):
    return tables.crawl_plan(table(spark, d, "channels", "channel", "enabled_markets"), table(spark, d, "subjects", "subject"), "hk").select("channel", "subject")


@query("SELECT channel, market, count(*) AS n FROM (SELECT DISTINCT id, channel, market FROM raw_media UNION ALL SELECT DISTINCT id, channel, market FROM raw_social) GROUP BY ALL")
def union_sources(spark, d):
    parts = [table(spark, d, t, "id", "channel", "market").distinct() for t in ("raw_media", "raw_social")]
    return parts[0].unionByName(parts[1]).groupBy("channel", "market").agg(F.count("*").alias("n"))


@query("SELECT market, ticker, count(*) AS n FROM (SELECT DISTINCT id, market, ticker FROM raw_social) GROUP BY ALL")
def rows_per_ticker(spark, d):
    return _rows(spark, d, "raw_social", "id", "market", "ticker").groupBy("market", "ticker").agg(F.count("*").alias("n"))


@query("SELECT task_id, epoch_us(min(published_at)) AS oldest, epoch_us(max(published_at)) AS newest FROM raw_media GROUP BY task_id")
def page_bounds(spark, d):
    bounds = reports.page_bounds(table(spark, d, "raw_media", "task_id", "published_at"), "task_id", "published_at")
    return bounds.select("task_id", F.unix_micros("oldest").alias("oldest"), F.unix_micros("newest").alias("newest"))


@query(f"WITH m AS (SELECT DISTINCT id, title, summary, content FROM raw_media) SELECT id FROM {_with_repaired('m', 'title', 'summary', 'content')} WHERE {_garbled('title')} OR {_garbled('summary')} OR {_garbled('content')}")
def garbled_rows(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "title", "summary", "content")
    return rows.join(relevance.drop_garbled(rows, "title", "summary", "content").select("id").distinct(), "id", "left_anti").select("id")


@query(f"WITH m AS (SELECT DISTINCT id, title FROM raw_media WHERE title IS NOT NULL) SELECT id, title_r AS repaired FROM {_with_repaired('m', 'title')} WHERE title_r <> title")
def repaired_titles(spark, d):
    rows = table(spark, d, "raw_media", "id", "title").where("title is not null").distinct()
    return rows.withColumn("repaired", T.repaired(F.col("title"))).where("repaired <> title").select("id", "repaired")


@query(f"WITH m AS (SELECT DISTINCT id, content FROM raw_media WHERE content IS NOT NULL) SELECT id, md5({_cleaned('content_r')}) AS cleaned FROM {_with_repaired('m', 'content')}")
def cleaned_contents(spark, d):
    rows = _rows(spark, d, "raw_media", "id", "content").where("content is not null")
    return rows.select("id", F.md5(T.clean(F.col("content"))).alias("cleaned"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tidemill.plans import landed, stored  # noqa: F401  both register their queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
