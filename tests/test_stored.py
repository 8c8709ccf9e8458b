import datetime as dt
import random

from pyspark.sql import functions as F

from tidemill.operators import dedupe, reports, tables
from tidemill.sources import html


def test_canonical_rows_of_any_shape(spark):
    df = spark.createDataFrame([("1", "x", "no time", None, 5)], "id string, duplicate_count string, published_at string, origin_keyword_type string, other int")
    row = tables.canonical(df, "raw_media").first()
    assert row.asDict()["duplicate_count"] == 1 and row.published_at is None and row.origin_keyword_type == "Base" and row.duplicate_urls == [] and "other" not in row.asDict()
    assert tables.canonical(df.limit(0), "raw_social").columns == tables.empty_table(spark, "raw_social").columns


def test_tables_are_made_once(spark, tmp_path):
    folder = str(tmp_path / "db")
    assert tables.init_tables(spark, folder) == list(tables.SCHEMAS) and tables.init_tables(spark, folder) == []
    assert tables.read_snapshot(spark, f"{folder}/raw_media").count() == 0


def test_entities_and_aliases(spark):
    df = spark.createDataFrame([("700", "甲控股", None), (None, "乙", "B"), ("00005", " ", "C")], "`代码` string, `名称` string, `英文名` string")
    got = {r.ticker: r for r in tables.entities(df, "hk").collect()}
    assert set(got) == {"00700", "00005"} and got["00700"].company_name == "甲控股" and got["00005"].company_name == "" and got["00005"].english_name == "C"
    stored = spark.createDataFrame([("hk", "00700", "旧", "短", "E", "X", 1)], "market string, ticker string, company_name string, short_name string, english_name string, exchange string, updated_at int")
    batch = spark.createDataFrame([("hk", "00700", "", None, "新", ""), ("hk", "00005", "A", "", "", "")], "market string, ticker string, company_name string, short_name string, english_name string, exchange string")
    new = {r.ticker: tuple(r)[2:] for r in tables.refresh_entities(stored, batch, F.lit(2)).collect()}
    assert new == {"00700": ("旧", "短", "新", "X", 2), "00005": ("A", None, None, None, 2)}
    wanted = spark.createDataFrame([("hk", "00700"), ("hk", "00005"), ("hk", "1")], "market string, ticker string")
    names = {r.ticker: r.names for r in tables.entity_aliases(wanted, stored, batch).collect()}
    assert names == {"00700": ["00700", "旧", "短", "E"], "00005": ["00005", "A"], "1": ["1"]}


def test_labels_are_written_back(spark):
    stored = spark.createDataFrame([("u", None, None, 1), ("v", True, "r", 1)], "url string, is_content_relevant boolean, content_relevance_reason string, updated_at int")
    labels = spark.createDataFrame([("u", False, "x"), ("w", True, "y"), (None, True, "z")], "url string, is_content_relevant boolean, content_relevance_reason string")
    assert sorted(map(tuple, tables.write_labels(stored, labels, ["url"], F.lit(2)).collect())) == [("u", False, "x", 2), ("v", True, "r", 1)]
    assert tuple(reports.label_stats(labels, stored, ["url"]).first()) == (3, 2, 1, 1)
    assert tuple(reports.label_stats(labels.limit(0), stored, ["url"]).first()) == (0, 0, 0, 0)


def test_pages_are_read_to_the_first_old_one(spark):
    day = lambda n: dt.datetime(2025, 1, n)
    items = spark.createDataFrame([(1, day(9)), (1, day(8)), (2, day(7)), (2, day(3)), (3, day(2)), (4, day(6))], "page int, at timestamp")
    read = lambda by: sorted((r.page, r.at.day) for r in tables.replayed_pages(items, items, "page", "at", F.lit(day(5)), F.lit(day(9)), by=by).collect())
    assert read("oldest") == [(1, 8), (2, 7)] and read("newest") == [(1, 8), (2, 7)]
    assert tables.first_page_of_window(items, "page", "at", F.lit(day(8))).first().first_page == 2
    assert tables.first_page_of_window(items.limit(0), "page", "at", F.lit(day(8))).first().first_page is None


def test_summaries_of_crawls(spark):
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "channel string")
    details = spark.createDataFrame([("a", True), ("b", False)], "channel string, ok boolean")
    failures = spark.createDataFrame([("c", True, 1.5)], "channel string, failed boolean, seconds double")
    got = {r[0]: tuple(r)[1:] for r in reports.crawl_summary(listed, listed.limit(1), details, failures).collect()}
    assert got["b"] == (0, 0, 0, 1, 0, 0.0) and got["c"] == (0, 0, 0, 0, 1, 1.5) and got["a"][0] == 2 and got[None][0] == 1
    tasks = spark.createDataFrame([], "status string, started_at timestamp, finished_at timestamp")
    assert tuple(reports.batch_report(tasks).first()) == (0, 0, 0, 0, 0, 0.0)


def test_wide_keys_find_the_same_pairs(spark, monkeypatch):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(15)]
    values = list(dict.fromkeys(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(9))) for b in base for _ in range(5)))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "simhash bigint")
    want = {frozenset((x, y)) for x in values for y in values if x < y and (x ^ y).bit_count() <= 6}
    for keys in ((7, 1), (8, 2), (9, 3), (10, 4)):
        monkeypatch.setattr(dedupe, "_keys", lambda n, keys=keys: keys)
        assert {frozenset(x % (1 << 64) for x in r) for r in dedupe.near_classes(df).collect()} == want
    monkeypatch.undo()
    assert [dedupe._keys(n)[1] for n in (10, 10**6, 10**8, 10**12)] == [1, 2, 3, 4]


def test_a_hot_group_keeps_its_count_and_its_first_urls(spark):
    rows = spark.range(3000).select(F.col("id").alias("ordinal"), F.lit(0).alias("group"), F.lit(None).cast("timestamp").alias("published_at"), F.format_string("u%04d", "id").alias("url"))
    got = dedupe.representatives(rows, most_urls=10).first()
    assert got.duplicate_count == 3000 and got.duplicate_urls == [f"u{i:04d}" for i in range(10)] and got.ordinal == 0


def test_pages_by_pattern_and_years_of_columns():
    got = html.anchors_by_pattern('<div>x <a href="/a?x=1&amp;y=2" class=b>标&lt;题</a> y</div> <a href="/b"> </a>')
    assert got[0]["url"] == "/a?x=1&y=2" and got[0]["title"] == "标<题" and got[0]["context"] == "x 标<题 y"
    row = '<tr class="listitem"><td>1<td>2<td><a href="{}">题</a><td><a>作者</a><td>01-09 08:00</tr>'
    times = [r["context"] for r in html.forum_rows(row.format("/p") + row.format("//caifuhao.example/news/20230501x") + row.format("/q"))]
    assert times == ["01-09 08:00", "2023-01-09 08:00", "2023-01-09 08:00"]
    assert html.page_data('<script id="__NEXT_DATA__">{"props": 3}</script>') is None


def test_merges_write_only_the_parts_they_touch(spark, tmp_path):
    folder, kind = str(tmp_path / "t"), "k int, v string, created_at timestamp, updated_at timestamp"
    empty = spark.createDataFrame([], kind)
    first = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    assert tables.merge_snapshot(first, folder, ["k"], F.current_timestamp(), empty, parts=16) == 16
    assert tables.merge_snapshot(first.where("k = 7").withColumn("v", F.lit("b")), folder, ["k"], F.current_timestamp(), empty, parts=16) == 1
    assert tables.merge_snapshot(first.where("k < 0"), folder, ["k"], F.current_timestamp(), empty, parts=16) == 0
    got = {r.k: r.v for r in tables.read_snapshot(spark, folder).collect()}
    assert len(got) == 200 and got[7] == "b" and got[8] == "a"
    # a mark that its writer left empty doesn't hide the last whole snapshot, nor stop the next writer
    assert tables.claim_once(spark, f"{folder}/marks", "3")
    assert tables.read_snapshot(spark, folder).count() == 200
    assert tables.merge_snapshot(first.where("k = 9").withColumn("v", F.lit("c")), folder, ["k"], F.current_timestamp(), empty, parts=16) == 1
    # a table that was written whole is divided
    whole = str(tmp_path / "w")
    tables.write_snapshot(first.withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}), whole)
    tables.merge_snapshot(first.where("k = 1").withColumn("v", F.lit("z")), whole, ["k"], F.current_timestamp(), empty, parts=4)
    assert {r.v for r in tables.read_snapshot(spark, whole).where("k = 1").collect()} == {"z"} and tables.read_snapshot(spark, whole).count() == 200
