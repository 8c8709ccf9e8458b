import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemill.functions import codes, times
from tidemill.functions import text as T
from tidemill.operators import relevance

RNG = random.Random(7)
ALPHABET = "中文腾讯控股 　\xa0\x1c\t<b>AbZ_9０é，。！(600519)0700.HK"
TEXTS = [None, "", " ", "\x1c\x85\xa0", "腾 讯 控 股", "一" * 30000] + ["".join(RNG.choice(ALPHABET) for _ in range(RNG.randint(1, 40))) for _ in range(200)]


def evaluate(spark, column, values=TEXTS, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def collapse(x):
    return " ".join((x or "").split())


def test_cleaning_equals_plain_python(spark):
    x = F.col("x")
    assert evaluate(spark, T.collapse(x)) == [collapse(v) for v in TEXTS]
    assert evaluate(spark, T.strip(x)) == [(v or "").strip() for v in TEXTS]
    assert evaluate(spark, T.compact_cjk(x)) == [re.sub(r"(?<=[一-鿿])\s+(?=[一-鿿])", "", collapse(v)) for v in TEXTS]
    assert evaluate(spark, T.cjk_count(x)) == [len(re.findall("[一-鿿]", v or "")) for v in TEXTS]
    assert evaluate(spark, T.content_chars(x)) == [len(re.findall("[A-Za-z0-9一-鿿]", v or "")) for v in TEXTS]


def identity(v):
    return re.sub(r"[^\w]+", "", collapse(v).lower())


def plain_tokens(v):
    n = identity(v)
    han = re.findall("[一-鿿]", n)
    return re.findall("[a-z0-9_]{2,}", n) + ["".join(p) for p in zip(han, han[1:])]


def test_identity_hash_and_tokens(spark):
    x = F.col("x")
    assert evaluate(spark, T.identity_text(x)) == [identity(v) for v in TEXTS]
    assert evaluate(spark, T.content_hash(x)) == [hashlib.sha256(identity(v).encode()).hexdigest() if identity(v) else "" for v in TEXTS]
    assert evaluate(spark, T.tokens(x)) == [plain_tokens(v) for v in TEXTS]
    assert evaluate(spark, T.stable_hash(x)) == [int(hashlib.sha1((v or "").encode()).hexdigest()[:12], 16) for v in TEXTS]


@pytest.mark.parametrize("values, want", [(("A", "A", None), "A"), (("<i>a</i>", "b", "a"), "a b"), ((None, "", " "), "")])
def test_combined(spark, values, want):
    df = spark.createDataFrame([values], "a string, b string, c string")
    assert df.select(T.combined("a" and F.col("a"), F.col("b"), F.col("c"))).first()[0] == want


def test_numbers_titles_and_bodies(spark):
    assert evaluate(spark, T.safe_int(F.col("x")), ["5", "x", None, "-3"]) == [5, 0, 0, -3]
    assert evaluate(spark, T.engagement(F.col("x"), F.col("x")), ["5", "-2", None]) == [10, 0, 0]
    assert evaluate(spark, T.first_sentence(F.col("x"), F.lit("?")), ["【重要公告】后文", "第一句。第二句", "", None]) == ["重要公告", "第一句", "?", "?"]
    assert evaluate(spark, T.media_body(F.col("x"), F.lit("标题")), ["标题", "长" * 30, None]) == [False, True, False]


def test_wrong_decoding(spark):
    good = "今日午间公布了新一批对公存款，管理层维持原有指引。"
    bad = good.encode().decode("latin-1")
    assert evaluate(spark, T.repaired(F.col("x")), [bad, good, None, "Société"]) == [good, good, "", "Société"]
    # what can be repaired isn't garbled: the repaired text is asked
    lost = "æ–°é—»å†…å®¹å…¬å¸\ufffdäº†æ–°ä¸€æ‰¹"
    assert evaluate(spark, T.garbled(F.col("x")), [lost, "æ–°é—»å†…å®¹å…¬å¸ƒäº†æ–°ä¸€æ‰¹", bad, good, "短", None]) == [True, False, False, False, False, False]
    assert evaluate(spark, T.clean(F.col("x")), [bad, "a\x00 \n b", None]) == [good, "a b", ""]


def test_evidence_of_a_target(spark):
    rows = [("OPEN day", ["PE"]), ("a PE fund", ["pe"]), ("岚 桥 实业", ["岚桥实业"]), ("岚桥 x 实业", ["岚桥实业"]), ("其他", ["", None]), (None, ["PE"]), ("a.b", ["a.b"]), ("axb", ["a.b"])]
    df = spark.createDataFrame(rows, "t string, forms array<string>")
    assert [r[0] for r in df.select(relevance.has_evidence(F.col("t"), F.col("forms"))).collect()] == [False, True, True, False, False, False, True, False]


def test_article_and_block_pages(spark):
    urls = ["https://finance.sina.com.cn/x", "https://finance.other.cn/x", "https://stock.sina.com/fund/1", "cj.sina.cn/a", None]
    assert evaluate(spark, relevance.is_article_url(F.col("x")), urls) == [True, False, False, True, False]
    assert evaluate(spark, relevance.is_block_page(F.col("x")), ["", None, "x em_capt", "正文"]) == [True, True, True, False]


AS_OF = dt.datetime(2025, 1, 10, 4, 0)


@pytest.mark.parametrize(
    "text, want",
    [
        ("5 分钟前", dt.datetime(2025, 1, 10, 3, 55)), ("2小时前", dt.datetime(2025, 1, 10, 2, 0)), ("今天 09:30", dt.datetime(2025, 1, 10, 1, 30)), ("昨天 9:30", dt.datetime(2025, 1, 9, 1, 30)),
        ("来源 2024-12-31 08:00:05", dt.datetime(2024, 12, 31, 0, 0, 5)), ("2024/1/2 8:00", dt.datetime(2024, 1, 2, 0, 0)), ("2024年1月2日 08:00", dt.datetime(2024, 1, 2, 0, 0)),
        ("12-31 08:00", dt.datetime(2024, 12, 31, 0, 0)), ("01-10 08:00", dt.datetime(2025, 1, 10, 0, 0)), ("无", None), (None, None),
    ],
)
def test_published(spark, text, want):
    df = spark.createDataFrame([(text, AS_OF)], "x string, as_of timestamp")
    assert df.select(times.published(F.col("x"), F.col("as_of"))).first()[0] == want
    if want is None:
        assert df.select(times.forum_published(F.col("x"), F.col("as_of"))).first()[0] == AS_OF


def test_windows_buckets_and_epochs(spark):
    t = dt.datetime(2025, 1, 1, 17, 0)
    rows = spark.createDataFrame([(t,), (t + dt.timedelta(hours=1),), (None,)], "x timestamp")
    inside = times.in_window(F.col("x"), F.lit(t), F.lit(t + dt.timedelta(hours=1)), keep_null=True)
    assert [r[0] for r in rows.select(inside).collect()] == [True, False, True]
    assert [r[0] for r in rows.select(times.day_bucket(F.col("x"))).collect()] == ["2025-01-02", "2025-01-02", "unknown"]
    assert evaluate(spark, times.epoch_seconds(F.col("x")), ["60", "0", "x", None]) == [dt.datetime(1970, 1, 1, 0, 1), None, None, None]


def test_codes_and_aliases(spark):
    x = F.col("x")
    assert evaluate(spark, codes.code(x), ["0700.HK", "600519.SH", "00000", "ab-1", None]) == ["700", "600519", "0", "AB1", ""]
    assert evaluate(spark, codes.without_market_suffix(x), ["砚陶 -W .HK", "甲", None]) == ["砚陶", "甲", ""]
    got = evaluate(spark, codes.aliases(F.array(x, F.lit(" "))), ["霁珂微电控股有限公司", "0700", None])
    assert got == [["霁珂微电控股有限公司", "霁珂微电", "霁珂微电控股"][:1] + got[0][1:], ["0700", "700", "00700"], []] and "霁珂微电" in got[0] and "霁珂" not in got[0]
    assert evaluate(spark, codes.stock_codes(x), ["代码：0700，600519与(1999)、（2318）及9988.HK 1234567", None]) == [["600519", "700", "9988", "2318"], []]
    assert evaluate(spark, codes.mentions(x, F.array(F.lit("腾讯控股"), F.lit("腾讯"), F.lit("TCH"))), ["腾 讯控股 tch TCHX", "", None]) == [3, 0, 0]
    assert evaluate(spark, codes.forum_ticker(x), ["/list,hk0700_1.html", "/news,sz300001,5.html", "/x", None]) == ["00700", "300001", None, None]
    assert evaluate(spark, codes.forum_post(x), ["/a/article/0/77", "?postid=5", "news,x,9.html", None]) == ["77", "5", "9", None]
    assert evaluate(spark, codes.ticker(x, F.lit("hk")), [" 0700 ", "70", None]) == ["0700", None, None]
