import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import dedupe, quality, relevance, reports, tables
from tidemill.plans import pipeline
from tidemill.sources import feeds, html, payloads
from tidemill.streaming import landing
from tests.test_functions import identity, plain_tokens

WORDS = "供应链人士认为差距正在逐步缩小对全年影响有限券商分析员表示现场排产已经饱和"


def plain_simhash(text):
    votes = [0] * 64
    for t in plain_tokens(text):
        h = int(hashlib.sha256(t.encode()).hexdigest()[-16:], 16)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] > 0)


def records(n, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice(WORDS) for _ in range(60)) for _ in range(6)]
    out = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(60)] = rng.choice(WORDS)
        out.append((i, "题" if rng.random() < 0.5 else None, rng.choice(["".join(text), "", None]), rng.choice([f"u{rng.randrange(n)}", "", None]), None if rng.random() < 0.2 else dt.datetime(2025, 1, rng.randint(1, 28))))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_the_pass_in_order(spark, seed):
    rows = records(60, seed)
    df = spark.createDataFrame(rows, "ordinal int, title string, content string, url string, published_at timestamp").withColumn("label", F.lit("x"))
    got = {r.ordinal: r.group for r in dedupe.group_duplicates(df, "ordinal").collect()}
    groups, want = [], {}
    for i, title, content, url, _ in rows:
        h, s = identity(content or title), plain_simhash(f"{title or ''} {content or ''}")
        for g in groups:
            if any((url and url == u) or (h and h == k) or (s and z and bin(s ^ z).count("1") <= 6) for u, k, z in g[1]):
                break
        else:
            groups.append(g := (i, []))
        g[1].append((url, h, s))
        want[i] = g[0]
    assert got == want
    reps = dedupe.representatives(dedupe.group_duplicates(df, "ordinal")).collect()
    assert sum(r.duplicate_count for r in reps) == len(rows) and len(reps) == len(groups)


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(9))) for b in base for _ in range(4)] + [0, 0]
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    got = {(r.a, r.b) for r in dedupe.near_pairs(spark.createDataFrame(signed, "k int, simhash bigint"), "k").collect()}
    assert got == {(i, j) for j in range(80) for i in range(j) if bin(values[i] ^ values[j]).count("1") <= 6}
    plan = dedupe.near_pairs(spark.createDataFrame(signed, "k int, simhash bigint"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def plain_sample(rows, quota):
    eligible = [r for r in rows if r[1] != "drop"]
    if len(eligible) <= quota:
        return {r[0] for r in eligible}
    days = {}
    for r in eligible:
        days.setdefault(r[2], []).append(r)
    share = {d: quota * len(v) / len(eligible) for d, v in days.items()}
    given = {d: math.floor(s) for d, s in share.items()}
    for d in sorted(days, key=lambda d: (share[d] - given[d], d), reverse=True)[: quota - sum(given.values())]:
        given[d] += 1
    chosen = set()
    for d, v in days.items():
        best = sorted(v, key=lambda r: (-r[3], -r[4], r[0]))
        high, low = [r for r in best if r[1] != "low"], [r for r in best if r[1] == "low"]
        if len(v) <= given[d]:
            chosen |= {r[0] for r in v}
            continue
        h = min(len(high), round(given[d] * 0.6))
        low_n = min(len(low), given[d] - h)
        h = min(len(high), h + given[d] - h - low_n)
        chosen |= {r[0] for r in high[:h] + low[: given[d] - h]}
    return chosen


@pytest.mark.parametrize("quota", [0, 7, 23, 400])
def test_sample_equals_plain_python(spark, quota):
    rng = random.Random(quota)
    rows = [(f"{i:03d}", rng.choice(["high", "medium", "low", "drop"]), f"2025-01-0{rng.randint(1, 5)}", rng.randint(0, 9) * 1000 + i, rng.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame([(r[0], None, dt.datetime.fromisoformat(r[2]), (r[3], r[4], r[1])) for r in rows], "id string, url string, at timestamp, quality struct<score: int, engagement: int, tier: string>")
    got = {r.id for r in quality.stratified_sample(df, quota, "at", "id").collect() if r.selected}
    assert got == plain_sample(rows, quota)


def test_quality_of_posts(spark):
    rows = [
        ("a", "$甲(600519)$", None, None, "drop", "stock_marker_only"), ("b", "业绩预告：利润同比增长20%，因为订单大增，主力放量拉升", None, None, "high", None), ("c", None, None, None, "drop", "empty_text"),
        ("d", "加群领取", None, None, "drop", "spam_or_leadgen"), ("e", "你好", None, None, "drop", "too_short_without_signal"), ("f", "今天天气不错我们一起出去走走吧", None, "5", "low", None),
    ]
    df = spark.createDataFrame([r[:4] for r in rows], "id string, title string, summary string, n string").withColumn("content", F.lit(None).cast("string"))
    got = {r.id: r.quality for r in quality.score_quality(df, counters=("n",)).collect()}
    assert {k: v.tier for k, v in got.items()} == {r[0]: r[4] for r in rows}
    assert all(got[r[0]].reasons == [r[5]] for r in rows if r[5])


def test_relevance_ladder(spark):
    names = ["甲乙科技", "600519"]
    rows = [
        ("target_not_found_kept", "无关", "别的"), ("negative_pattern_hit", "甲乙科技", "龙虎榜"), ("target_in_title_and_repeated", "甲乙科技公告", "甲乙科技回购"), ("target_dominant_with_few_other_tickers", "公告", "甲乙科技和甲乙科技 300001"),
        ("too_many_other_tickers", "甲乙科技", "300001 300002 300003 300004 300005"), ("low_target_share_with_many_mentions", "公告甲乙科技", "300001 " * 8), ("edge_case_kept_to_avoid_false_negative", "甲乙科技", "300001"),
    ]
    df = spark.createDataFrame([(r, t, c, None, names) for r, t, c in rows], "want string, title string, content string, summary string, aliases array<string>")
    assert all(r.want == r.decision.reason for r in relevance.relevance(df, "title", "content", "summary", "aliases").collect())
    before = df.limit(1).withColumns({"is_content_relevant": F.lit(False), "content_relevance_reason": F.lit("x")})
    assert relevance.label_relevance(before).select("is_content_relevant", "content_relevance_reason").first() == (False, "x")
    long = spark.createDataFrame([("长" * 5001,), ("长" * 5000,), (None,)], "content string")
    assert [r.is_content_relevant for r in relevance.label_length(long).collect()] == [False, None, None]


def test_tables(spark):
    stored = spark.createDataFrame([("cn", "u1", "old", 1, 1), ("cn", "u2", "kept", 1, 1)], "market string, url string, title string, created_at int, updated_at int")
    batch = spark.createDataFrame([(1, "u1 ", "a"), (2, " u1", None), (3, "u3", "new"), (4, " ", "x"), (5, None, "y")], "o int, url string, title string")
    ready = tables.prepared_batch(batch, "o", market="cn").withColumn("url", F.trim("url"))
    merged = {r.url: tuple(r)[2:] for r in tables.upsert(stored, ready, ["market", "url"], F.lit(2)).collect()}
    assert merged == {"u1": (None, 1, 2), "u2": ("kept", 1, 1), "u3": ("new", 2, 2)}
    again = tables.upsert(tables.upsert(stored, ready, ["market", "url"], F.lit(2)), ready, ["market", "url"], F.lit(2))
    assert {r.url: tuple(r)[2:] for r in again.collect()} == merged
    entities = spark.createDataFrame([("k", "A", 1), ("k", "", 2), ("k", "B", 0), ("m", None, 1)], "k string, name string, o int")
    assert {r.k: r.name for r in tables.merge_entities(entities, ["k"], F.col("o"), "name").collect()} == {"k": "A", "m": None}
    dated = spark.createDataFrame([("u", None, 1), ("u", dt.datetime(2025, 1, 2), 2), ("u", dt.datetime(2025, 1, 1), 3)], "url string, at timestamp, ordinal int")
    assert tables.earliest_per_key(dated, "url", "at", "ordinal").first().ordinal == 3


def test_snapshots_and_claims(spark, tmp_path):
    folder = str(tmp_path / "t")
    for n in (2, 3):
        tables.write_snapshot(spark.range(n), folder)
    assert tables.read_snapshot(spark, folder).count() == 3
    assert [tables.claim_once(spark, str(tmp_path / "c"), "task") for _ in range(3)] == [True, False, False]


def test_scans_and_ratios(spark):
    pages = spark.createDataFrame([(1, False), (2, True), (4, False)], "page int, failed boolean")
    assert {tuple(r) for r in reports.complete_scan(pages, "page", F.col("failed")).collect()} == {(2, "failed"), (3, "missing")}
    assert reports.complete_scan(pages.where("page = 9"), "page", F.col("failed")).count() == 0
    assert spark.range(1).select(reports.ratio(F.lit(1), F.lit(3)), reports.ratio(F.lit(1), F.lit(0))).first() == (0.3333, 0.0)


AS_OF = dt.datetime(2025, 1, 10, 4, 0)


def landed(spark, text, column="payload"):
    return spark.createDataFrame([(text, AS_OF), (None, AS_OF), ("not json", AS_OF)], f"{column} string, as_of timestamp")


def test_feeds(spark):
    p = 'cb({"result": {"articles": [{"title": "<em>甲乙</em>公告", "content": "正文", "url": "http://x/1", "date": "2025-01-09 08:00:00"}, {"title": "无关", "content": "", "url": "http://x/2", "date": ""}, {"title": "甲乙再公告", "content": "", "url": "http://x/1"}]}});'
    got = feeds.search_articles(landed(spark, p), F.lit("甲乙")).collect()
    assert [(r.title, r.url, r.published_at) for r in got] == [("甲乙 公告", "http://x/1", dt.datetime(2025, 1, 9))]
    p = '{"results": {"docs": [{"title": "甲", "desc": "", "tags": "乙", "url": "/a", "creationDate": "昨天 08:00"}, {"title": "丙", "url": "/b"}]}}'
    got = feeds.document_search(landed(spark, p), F.array(F.lit("乙")), "https://paper.example/x").collect()
    assert [(r.url, r.published_at) for r in got] == [("https://paper.example/a", dt.datetime(2025, 1, 9))]
    p = '{"data": {"depth": {"data": [{"id": 7, "title": "", "descr": "【快讯标题】内容", "time": 60}]}}}'
    assert feeds.wire_items(landed(spark, p), "https://w.example/d").first().title == "快讯标题"
    p = '{"data": [{"title": "研报", "infoCode": "A1", "encodeUrl": "a b", "orgName": "某券商", "researcher": "某人", "publishDate": "2025-01-09 00:00:00"}]}'
    got = feeds.research_reports(landed(spark, p), "https://r.example/zw").first()
    assert got.url == "https://r.example/zw?encodeUrl=a+b" and got.summary == "某券商 某人"
    p = '{"result": {"notice": [{"title": "公告", "code": "N1", "securityShortName": "甲乙"}]}}'
    assert feeds.search_notices(landed(spark, p), F.lit("甲乙"), F.lit("600519"), "https://n.example").first().url == "https://n.example/600519/N1.html"
    p = '{"re": [{"post_id": 5, "post_title": "", "post_content": "<p>好<script>x</script>的</p>", "post_publish_time": "2025-01-09 08:00:00", "post_user": {"user_nickname": "阿豆"}, "post_click_count": "x", "post_like_count": 3, "post_top_status": 1}, {"post_id": ""}]}'
    got = feeds.forum_posts(landed(spark, p), "https://f.example").collect()
    assert [(r.title, r.source_name, r.social_like_count, r.social_read_count, r.social_is_top) for r in got] == [("好 的", "阿豆", 3, 0, True)]
    assert feeds.forum_detail(landed(spark, '{"data": {"post": {"post_content": "<b>全文</b>", "post_title": "题"}}}')).first().full_text == "全文"


def test_pages(spark):
    page = '<div class="datelist">2025-01-09&nbsp;08:00 <a href="/n/1">甲乙新闻</a><br>2025-01-09 09:00 <a href="http://x/2">其他</a></div>'
    got = html.dated_links(landed(spark, page, "html").where("html is not null"), "https://d.example").collect()
    assert {(r.title, r.url) for r in got} == {("甲乙新闻", "https://d.example/n/1"), ("其他", "http://x/2")}
    page = '<ul><li><p class="tt"><a href="/a">标题一</a></p><p class="text">摘要</p><p class="info"><span>某报</span><span>01-09 08:00</span></p><li>无链接</ul>'
    got = html.html_items(landed(spark, page, "html"), "list", "https://d.example").collect()
    assert [(r.title, r.source_name, r.summary, r.published_at) for r in got] == [("标题一", "某报", "摘要", dt.datetime(2025, 1, 9))]
    assert html.article('<script id="__NEXT_DATA__">{"props": {"pageProps": {"articleDetail": {"brief": "简", "content": "<p>一</p><p>二</p>"}}}}</script>') == {"full_text": "一 二", "summary": "简"}
    assert html.article('<meta name="description" content="述"><p>外</p><article><p>正文一</p><p>正文二</p></article>') == {"full_text": "正文一 正文二", "summary": "述"}
    assert html.forum_page('<div class="time">t</div><div id="post_content">文</div>') == {"time": "t", "full_text": "文"}
    assert html.mobile_rows('<li>阿豆 发表于 今天 12次浏览 好票 分享 <a href="/x/article/0/1">看</a></li>')[0]["source"] == "阿豆"
    assert html.forum_rows('<tr class="listitem"><td>1<td>2<td><a href="/p">题</a><td><a>作者</a><td>01-09 08:00</tr>')[0]["title"] == "题"
    assert html.anchors(None) == [] and html.article("") == {"full_text": "", "summary": None}


@pytest.mark.parametrize("encoding", ["utf-8", "gb18030", "big5"])
def test_bytes(spark, encoding, tmp_path):
    text = "今日午間公布了新一批數據，供應鏈人士認為差距正在縮小。"
    assert payloads.decode_bytes(text.encode(encoding)) == text
    assert payloads.decode_bytes(text.encode(encoding), "latin-1") == text and payloads.decode_bytes(None) is None
    (tmp_path / "a.json").write_bytes(text.encode(encoding))
    assert payloads.read_payloads(spark, str(tmp_path)).first().payload == text


def test_stream_merges_what_lands(spark, tmp_path):
    land, folder = tmp_path / "land", str(tmp_path / "table")
    land.mkdir()
    schema = "url string, title string, source_name string, channel string, published_at timestamp, summary string, market string, created_at timestamp, updated_at timestamp"
    for n, title in ((1, "一"), (2, "二")):
        (land / f"{n}.json").write_text('{"data": {"depth": {"data": [{"id": 7, "title": "%s", "time": 60}]}}}' % title)
        items = landing.payload_stream(spark, str(land))
        parsed = items.select("as_of", F.lit(0).alias("ordinal"), F.lit("https://w.example/7").alias("url"), F.get_json_object("payload", "$.data.depth.data[0].title").alias("title"))
        landing.merge_stream(parsed, folder, str(tmp_path / "cp"), lambda: spark.createDataFrame([], schema), ["market", "url"], market="cn").awaitTermination()
    got = tables.read_snapshot(spark, folder).collect()
    assert [(r.url, r.title, r.market) for r in got] == [("https://w.example/7", "二", "cn")]


def test_whole_flow(spark):
    items = spark.createDataFrame(
        [(i, f"http://x/{i % 4}", "甲乙科技公告", "甲乙科技回购" + "好" * 30, "harbor_news", dt.datetime(2025, 1, 5), ["甲乙科技"]) for i in range(6)] + [(9, "http://x/9", "旧", "", "harbor_news", dt.datetime(2020, 1, 1), ["甲乙科技"])],
        "ordinal int, url string, title string, summary string, channel string, published_at timestamp, aliases array<string>",
    )
    details = spark.createDataFrame([("http://x/1", "甲乙科技全文", None)], "url string, full_text string, detail_summary string")
    window = pipeline.Window("2025-01-08 00:00:00")
    media = pipeline.media(items, details, window, {"harbor_news": 10})
    assert media.agg(F.sum("duplicate_count")).first()[0] == 4
    posts = spark.createDataFrame([(i, f"http://f/news,600519,{i}.html", "业绩利润公告同比增长，估值合理，主力资金流入", "短", dt.datetime(2025, 1, 5), "1", None, None, None) for i in range(5)], "ordinal int, url string, title string, summary string, published_at timestamp, social_read_count string, social_comment_count string, social_like_count string, social_forward_count string")
    social = pipeline.social(posts, details, window, "600519", quota_7_days=3)
    assert social.where("selected").count() == 3
    row = pipeline.counters(media, social).first()
    assert row.social_selected == 3 and row.media_relevant == row.media_fetched
