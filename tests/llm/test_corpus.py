import random

import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm import abuse, lookalikes, mojibake, neardup, packing, residue, subjects, tokens, truncation

RANKS = f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
NEWS = [
    "券商分析员认为，现场排产已经饱和，预留的机房迁移比前一周提高12.5%。",
    "供应链人士表示，差距正在逐步缩小，对全年影响有限。",
    "今日午间，后端研发组上线了新一批低代码平台，接口延迟下降到四十毫秒。",
    "谈及下半年的票据贴现，分行行长称“存款定期化趋势没有改变”，管理层维持原有指引。",
    "海外合作方Société Maréac及Завод Северолес参与，拐点尚未得到确认。",
]


@pytest.fixture(scope="module")
def decoder():
    rng = random.Random(1)
    texts = ["".join(rng.choices(NEWS, k=3)) for _ in range(400)]
    singles, pairs = {}, {}
    for t in texts:
        for c in t:
            singles[c] = singles.get(c, 0) + 1
        for a, b in zip(t, t[1:]):
            pairs[a + b] = pairs.get(a + b, 0) + 1
    return mojibake.Decoder(mojibake.Frequencies(singles, pairs))


@pytest.mark.parametrize("writer, reader", [("utf-8", "latin-1"), ("utf-8", "gb18030"), ("gb18030", "latin-1"), ("utf-8", "mac_roman"), ("big5", "latin-1")])
def test_reversible_damage_is_restored(decoder, writer, reader):
    text = NEWS[0] if writer != "big5" else "今日午間，供給不足"
    damaged = text.encode(writer).decode(reader, "replace")
    restored, stretches, _ = decoder.decode(damaged)
    assert stretches >= 1
    if writer != "big5" and "�" not in damaged:
        assert restored == text


def test_lost_bytes_are_searched_for(decoder):
    damaged = NEWS[1].encode("utf-8").decode("latin-1").replace("\x80", "").replace("\x9b", "")
    restored, stretches, _ = decoder.decode(damaged)
    assert stretches >= 1 and sum(a == b for a, b in zip(restored, NEWS[1])) > 0.8 * len(NEWS[1])


@pytest.mark.parametrize("text", [None, "", "   ", *NEWS, "真的吗???", "α策略与β系数"])
def test_proper_text_is_left_alone(decoder, text):
    assert decoder.decode(text)[1] == 0


@pytest.mark.parametrize("text", ["??????12.5%", "锟斤拷锟斤拷", "行业�平台", "增长\x80\x9d率"])
def test_lost_text_is_found(decoder, text):
    assert decoder.decode(text)[1] >= 1


def test_viterbi_equals_all_texts():
    rng = random.Random(4)
    chars = [c for i in range(94) if (c := bytes([0xB0, 0xA1 + i]).decode("gb18030", "ignore"))]
    singles = {c: 1000 - 5 * i for i, c in enumerate(chars)} | {"的": 3000}
    pairs = {chars[-1] + "的": singles[chars[-1]], "的" + chars[-1]: 500}  # rare, but the context tells
    pairs |= {a + b: rng.randint(1, 90) for a in rng.sample(chars, 30) for b in rng.sample(chars, 30)}
    freq = mojibake.Frequencies(singles, pairs)
    code = list("的".encode("gb18030"))
    for lattice in ([0xB0, None, *code], [*code, 0xB0, None, *code], [0xB0, None, 0xB0, None, *code]):
        holes = lattice.count(None)
        texts = [""]
        for i in range(0, len(lattice), 2):
            texts = [t + c for t in texts for c in (chars if lattice[i + 1] is None else ["的"])]
        best = max(texts, key=freq.score)
        text, score, lost = mojibake.viterbi(lattice, "gb18030", freq)
        assert text == best and lost == 0 and score == pytest.approx(freq.score(best) - 0.5 * holes)
        assert mojibake.viterbi(lattice, "gb18030", freq, score - 0.01)[0] == best and mojibake.viterbi(lattice, "gb18030", freq, score + 1)[1] <= score + 1


def test_all_channels_are_tried(decoder):
    text = NEWS[0].encode().decode("koi8_r")[:90]
    assert len({writer for _, writer in decoder._candidates(text)}) == 3 and len(decoder._candidates("".join(NEWS))) > 2


def test_viterbi_fills_a_wildcard(decoder):
    data = list("差距正在逐步缩小".encode())
    data[4] = None
    assert mojibake.viterbi(data, "utf-8", decoder.freq)[0] == "差距正在逐步缩小"


@pytest.mark.parametrize(
    "text, kind",
    [
        ("x，能不能站稳看", "bare"), ("完了。", "final"), ("做个差价……", "dots"), ("主力在...查看全文", "more"), ("成本<img src=\"", "markup"), ("减少&nbs", "markup"),
        ("板块轮动到[展开]", "more"), ("好的[赞]", "closed"), ("长�", "lost"), ("比例（详见", "bare"), ("被：“", "open"), ("所以，因为", "open"), ("The end.", "final"),
    ],
)
def test_shapes_of_ends(text, kind):
    assert truncation.shape(text)[1] == kind


def test_cut_values_against_definition(spark):
    rng = random.Random(2)
    openers, ends = ["今天平台", "感觉市场", "各位板块", "复盘一下行业"], ["放量突破了", "缩量回踩", "估值不贵", "抛压不小"]
    tails = ["观望为主", "落袋为安", "长线没问题", "继续躺平"]
    full = [f"{rng.choice(openers)}{rng.choice(ends)}，{rng.choice(tails)}。" * 2 for _ in range(200)]
    rows = [(f"f{i}", None, t) for i, t in enumerate(full)]
    rows += [("cut1", None, "今天平台放量突破了，继续"), ("cut2", "感觉市场缩量", "感觉市场缩量回踩，落袋为安。"), ("bare", None, "各位板块估值不贵，观望为主"), ("dots", None, "今天平台抛压不小，落袋为安……"), ("null", None, None), ("empty", "", " ")]
    rows += [("copy", None, full[0]), ("copy", None, full[0])]
    df = spark.createDataFrame(rows, "id string, summary string, content string").withColumn("value", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1))
    got = {(r.id, r.field) for r in truncation.truncated(df).collect()}
    assert got == {("cut1", "content"), ("cut2", "summary")}
    report = truncation.truncation_report(df.selectExpr("*", "'c' AS channel", "cast(null as string) AS social_body_quality"), truncation.truncated(df)).collect()
    assert {r.field: r.cut for r in report} == {"content": 1, "summary": 1}


def test_copies_count_once_in_endings(spark):
    rng = random.Random(8)
    noise = lambda n: "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(n))
    clause = "客户验收节点顺延"
    goes_on = [(f"g{i}", None, f"{noise(12)}{clause}到明年，{noise(9)}。") for i in range(40)]
    ends = f"{noise(12)}{clause}。{noise(9)}。"  # one post, delivered again and again, also as its own summary
    copies = [("e", ends, ends)] * 60
    cut = ("cut", None, f"{noise(12)}{clause}")
    frame = spark.createDataFrame([*goes_on, *copies, cut], "id string, summary string, content string")
    assert ("cut", "content") in {(r.id, r.field) for r in truncation.truncated(frame).collect()}


def test_longer_copies_behind_the_first_value_of_a_partition(spark):
    rng = random.Random(9)
    noise = lambda n: "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(n))
    core = "行业协会称样本口径调整"
    rows = [(f"f{i}", None, f"{core}。{noise(12)}。") for i in range(600)]
    frame = spark.createDataFrame([("cut", None, core), *rows, ("long", None, f"{core}之后仍有分歧。")], "id string, summary string, content string")
    assert ("cut", "content") in {(r.id, r.field) for r in truncation.truncated(frame).collect()}


@pytest.fixture(scope="module")
def rewriter():
    return lookalikes.Rewriter({"ETF": 50, "PE": 40, "a": 9})


@pytest.mark.parametrize(
    "text, want",
    [
        ("增长３９.３％", "增长39.3%"), ("Société", "Société"), ("⾼点⻛险", "高点风险"), ("关注ЕΤF", "关注ETF"), ("关注РЕ", "关注PE"), ("Tessаro", "Tessaro"),
        ("主力​在⁠洗盘", "主力在洗盘"), ("9月 一日", "9月 一日"), ("录得292O7台", "录得29207台"), ("不愿", "不愿"),
    ],
)
def test_look_alikes_get_one_form(rewriter, text, want):
    assert rewriter.candidates([text])[0]
    got, changes = rewriter.rewrite(text)
    assert got == want and changes > 0 and rewriter.rewrite(got) == (got, 0)


@pytest.mark.parametrize("text", [None, "", "他说：“好！”（注）", "　　段落\n　　又一段", "👨‍💻❤️", "Завод Северолес", "β系数与α策略", "①㎡℃№", "證券與發展"])
def test_usual_text_keeps_its_form(rewriter, text):
    assert rewriter.rewrite(text)[1] == 0


def test_classes_are_transitive():
    c = lookalikes.Classes()
    for a, b in (("a", "b"), ("c", "d"), ("b", "c"), ("x", "y")):
        c.union(a, b)
    assert sorted(map(tuple, c.groups())) == [("a", "b", "c", "d"), ("x", "y")]


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("尊敬的{{ user_name }}，您好", ["slot"]), ("现价${price}元", ["slot"]), ("来源：【请输入正文】", ["slot"]), ("标题：(null)\n正文：(null)", ["unset"]), ("[object Object]", ["unset"]), ("涨跌幅 NaN%，成交额 null", ["unset"]),
        ("asdf asdf asdf asdf asdf", ["filler"]), ("Lorem ipsum dolor sit amet magna", ["filler"]), ("502 Bad Gateway", ["error"]), ("服务器开小差了，请稍后重试", ["error"]), ("请启用 JavaScript 后刷新页面", ["script"]), ("請開啟瀏覽器的 JavaScript 功能", ["script"]),
        ("该平台要求用户开启JavaScript才能登录，引发部分投资者投诉。", []), ("未能拒绝零假设（null hypothesis），样本量为9。", []), ("官网一度出现502错误，客服称一小时内已恢复。", []), ("（更多内容请下载本站客户端）", []), ("", []), (None, []),
    ],
)
def test_residue(text, kinds):
    assert residue.Inspector().kinds(text) == kinds


def _examples(parsed):
    """One example for each alternative of a parsed pattern, optional parts left out."""
    out = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            parts = [chr(value)]
        elif name == "SUBPATTERN":
            parts = _examples(value[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            parts = [e * value[0] for e in _examples(value[2])] if value[0] else [""]
        elif name == "BRANCH":
            parts = [e for part in value[1] for e in _examples(part)]
        elif name == "IN":
            kind, first = value[0]
            parts = [chr(first) if str(kind) == "LITERAL" else chr(first[0]) if str(kind) == "RANGE" else "x" if str(kind) == "NEGATE" or "WORD" in str(first) and "NOT" not in str(first) else " "]
        else:
            parts = ["x" if name in ("ANY", "NOT_LITERAL") else ""]
        out = list(dict.fromkeys(a + b for a in out for b in parts))
    return out


@pytest.mark.parametrize("name", ["SLOTS", "UNSET", "FILLER", "ERRORS", "SCRIPTS"])
def test_prefilter_passes_every_alternative(name):
    pattern = getattr(residue, name)
    matched = [e for e in _examples(residue._parser.parse(pattern.pattern, pattern.flags)) if pattern.search(e)]
    assert len(matched) > 5 and all(any(c in e for c in residue._CUES) for e in matched)


@pytest.mark.parametrize(
    "text",
    ["来源：【插入公司简称】", "400 Bad Request", "401 Unauthorized", "429 Too Many Requests", "该文章已删除", "内容已屏蔽", "系统异常，稍后再试", "登录已失效", "你的访问过于频繁", "访问的资源不存在", "编辑部测试稿", "标题最多20个字", "Exception in thread"]
    + ["【测试测试测试测试】", "(consectetur adipiscing elit sed do tempor)", "\n".join([NEWS[0] * 3, "哈哈哈哈哈哈哈哈哈"])],
)
def test_prefilter_keeps_verdicts(text):
    want = {kind for m in text.splitlines() if (kind := residue.classify(m))}
    assert want and set(residue.Inspector().kinds(text)) == want


@pytest.mark.parametrize("one, two", [("12121212", "11213141"), ("见https://a.cn/{{id}}", "见https://a.cn/x__y")])
def test_verdicts_do_not_depend_on_order(one, two):
    want = [residue.Inspector().kinds(t) for t in (one, two)]
    forth, back = residue.Inspector(), residue.Inspector()
    assert want[0] != want[1] and [forth.kinds(one), forth.kinds(two)] == want == [back.kinds(two), back.kinds(one)][::-1]


def test_template_tree_joins_messages_that_differ_in_a_token():
    tree = residue.TemplateTree()
    for m in ("页面走丢了，<n>秒后返回首页", "页面走丢了，<n>秒后返回主页", "会话已过期，请重新登录"):
        tree.add(m)
    found = dict(tree.templates())
    assert sorted(found.values()) == [1, 2] and any("<*>" in t for t in found)


def test_templates_give_the_verdicts_whatever_the_order(spark, monkeypatch):
    page, wording = "抱歉，本站今日人多，请稍后再试，或联系在线工作人员处理", "抱歉，本站今日人多，请稍后再来，或联系在线工作人员处理"
    texts = [page] * 3 + [wording] + NEWS * 2 + ["现价__正文__元", "200 Not Found 请求失败", "404 Not Found 请求失败", "12121212", "11213141", "您无权访问此页面", "标题占位符", "TODO: 填内容", "", None]
    rows = [(f"r{i}", t) for i, t in enumerate(texts)]
    results = []
    for parts, seed in ((1, 0), (5, 1), (3, 2)):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        results.append({r.id: r.kinds for r in residue.residue(spark.createDataFrame(shuffled, "id string, content string").repartition(parts)).collect()})
    monkeypatch.setattr(residue, "SENT", 0)  # the joined way
    results.append({r.id: r.kinds for r in residue.residue(spark.createDataFrame(rows, "id string, content string")).collect()})
    assert all(r == results[0] for r in results)
    by_text = {texts[int(i[1:])]: k for i, k in results[0].items()}
    # the second wording has no sign of its own: its template gives the verdict
    assert residue.template_kind(wording) is None and by_text[wording] == ["error"] and by_text["现价__正文__元"] == ["slot"] and "200 Not Found 请求失败" not in by_text and by_text["404 Not Found 请求失败"] == ["error"]
    assert by_text["12121212"] == ["filler"] and "11213141" not in by_text and by_text["您无权访问此页面"] == ["error"] and by_text["标题占位符"] == by_text["TODO: 填内容"] == ["filler"]
    assert not set(NEWS) & set(by_text)


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 600)
    rows = [np.array([g] if rng.random() > 0.1 else [rng.integers(0, 4)]) for g in grades]
    w, theta = abuse.fit_ordinal(rows, grades, np.zeros(4))
    assert list(np.argsort(w)) == [0, 1, 2, 3] and (np.diff(theta) > 0).all()


def test_severity_is_learned_from_ratings():
    """Other words of a kind that was rated high are cases; nothing is before any rating, whatever its words."""
    high = ["你这种废物也配炒股", "跟蠢货说不通", "一对一裸聊视频", "寂寞少妇包夜私聊", "董秘出门小心点", "祝庄家不得好死"]
    texts = high * 6 + ["大盘缩量回踩，观望为主", *NEWS] * 10
    model = abuse.fit(texts, [3] * 36 + [0] * (len(texts) - 36))
    asked = [abuse.joined(None, t) for t in ("跟混蛋说不通", "蠢 猪董秘", "you mor*n", "学生妹兼职陪睡", "piglet prices turned first", "管理层的课题，观望为主", "", None)]
    score = model.severity(asked)
    assert (score[:4] >= abuse.CASE_FROM).all() and (score[4:] < abuse.CASE_FROM).all()
    assert (abuse.fit([], []).severity(asked) < abuse.CASE_FROM).all()


def test_vantage_point_tree_is_exact():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 62, (900, 2), dtype=np.int64).view(np.uint64)
    for k in range(0, 900, 9):
        for j in range(1, 9):
            prints[k + j] = prints[k]
            for bit in rng.integers(0, 128, 15):
                prints[k + j, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    tree = neardup.VantagePointTree(prints)
    for q in range(0, 900, 41):
        assert set(tree.within(prints[q], 35).tolist()) == set(np.flatnonzero(neardup.distances(prints, prints[q]) <= 35).tolist())


def _edited(seed: int) -> tuple[str, str]:
    rng = random.Random(seed)
    base = [chr(0x4E00 + rng.randrange(2500)) for _ in range(200)]
    text = base.copy()
    for at in range(2, 196, 29):
        text[at] = chr(0x4E00 + rng.randrange(2500))
    return "".join(base), "".join(text)


def test_no_similar_pair_is_left_to_chance(spark):
    # pairs of similarity 0.71 that 24 groups of four minwise hashes or a radius of 35 bits left out
    rows = [(f"{seed}{side}", text) for seed in (2657, 2956, 3720, 4269, 4485, 4586, 4740, 5540, 5868) for side, text in zip("ab", _edited(seed))]
    # few distinct strings
    rows += [("few0", "天地人" * 40), ("few1", "天地人" * 40 + "天"), ("few2", "天" * 120), ("few3", "天" * 121)]
    members, pairs = neardup.class_pairs(spark.createDataFrame(rows, "id string, content string"))
    got = {(r[0], r[1]) for r in neardup.record_pairs(members, pairs).collect()}
    assert got == {(a, b) for a, x in rows for b, y in rows if a < b and neardup.similarity(x, y) >= neardup.SIMILARITY}
    assert len(got) == 11


def _candidates(texts: list[str], cut: int = 4) -> tuple[set[tuple[int, int]], int]:
    """Pairs of places in a pack that are left for the exact comparison, and bytes of the windows."""
    pack = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([neardup._squeeze("\n".join(texts).encode())]), pa.array([None], pa.list_(pa.int64()))], names=["pack", "texts", "places"])
    data = list(neardup._windows([pack], 3, cut))
    found = {(a - (5 << 14), b - (5 << 14)) for x in neardup._search(data, neardup.SIMILARITY, cut) for a, b in zip(*(c.to_pylist() for c in x.columns))}
    return found, sum(len(x) for batch in data for x in batch.column(1).to_pylist())


def _family(seed: int, texts: int, changes: int) -> list[str]:
    rng = random.Random(seed)
    base = [chr(0x4E00 + rng.randrange(2500)) for _ in range(300)]
    out = []
    for _ in range(texts):
        text = base.copy()
        for at in rng.sample(range(300), changes):
            text[at] = chr(0x4E00 + rng.randrange(2500))
        out.append("".join(text))
    return out


def _similar(texts: list[str]) -> set[tuple[int, int]]:
    return {(i, j) for j, b in enumerate(texts) for i, a in enumerate(texts[:j]) if neardup.similarity(a, b) >= neardup.SIMILARITY}


def test_long_contents_are_told_by_counted_windows_and_windows_are_small():
    rng = random.Random(1)
    sentences = ["".join(chr(0x4E00 + rng.randrange(2500)) for _ in range(200)) for _ in range(60)]
    texts = ["".join(rng.sample(sentences, 15)) for _ in range(60)]
    want, (found, _) = _similar(texts), _candidates(texts)
    # 1,634 pairs by fingerprints alone, which long contents fill, and 1 with counted windows
    assert want <= found and len(found) < 100
    many = [t for seed in range(2000) for t in _family(seed, 1, 0)]
    # 6.8 bytes a string before, with the compression of a shuffle
    assert _candidates(many)[1] < 5 * sum(len(neardup.strings(t)) for t in many)


@pytest.mark.parametrize("name, value", [("_MARK_BITS", 4), ("_COUNTED", 50), ("BLOCK", 3), ("_TURN", 500), ("_STRETCH", 20)])
def test_counted_windows_lose_no_pair(monkeypatch, name, value):
    monkeypatch.setattr(neardup, name, value)
    texts = [t for seed in range(6) for changes in (3, 9, 11, 13) for t in _family(seed, 4, changes)]
    texts += ["天地人" * 40, "天地人" * 40 + "天", "天" * 120, "天" * 121, "天地" * 60, "地天" * 60 + "地"]
    for cut in (4, 7):
        assert _similar(texts) <= _candidates(texts, cut)[0]


@pytest.mark.parametrize("block", [8, 4096])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(4)
    word = lambda n: "".join(chr(0x4E00 + rng.randrange(2500)) for _ in range(n))
    rows = []
    for g in range(8):
        base = list(word(260))
        for v in range(7):
            text = base.copy()
            for _ in range(rng.randrange(0, 14)):
                text[rng.randrange(260)] = word(1)
            rows.append((f"{g}{v}", "".join(text)))
    rows += [("copy", rows[0][1]), ("copy", rows[0][1]), ("wide", "Ａ" + rows[1][1]), ("null", None), ("short", "短"), ("empty", "")]
    df = spark.createDataFrame(rows, "id string, content string").selectExpr("*", "1 AS class", "2 AS key")
    members, pairs = neardup.class_pairs(df)
    got = {(r[0], r[1]) for r in neardup.record_pairs(members, pairs).collect()}
    kept = {i: neardup.kept(c) for i, c in rows if c and len(neardup.kept(c)) >= neardup.LEAST_CHARS}
    want = {(a, b) for a in kept for b in kept if a < b and neardup.similarity(kept[a], kept[b]) >= neardup.SIMILARITY}
    assert got == want
    groups = {r.id: r.group for r in neardup.groups(members, pairs).collect()}
    parent = {i: i for i in kept}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in want:
        parent[root(a)] = root(b)
    assert all((groups[a] == groups[b]) == (root(a) == root(b)) for a in kept for b in kept)


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as file:
        return tokens.Encoder(tokens.PairTable.parse(file.read()))


def test_encoding_equals_the_library(encoder):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    rng = random.Random(3)
    alphabet = "ab'stdrevl  \n\t。，中文龍喚士é½٣𝟼🚀-_=+　\xa0"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(2000)] + NEWS + ["<|endoftext|> it's", "''s 'll", " 裏覚醒龍喚士", "好" * 30000]
    for text in texts:
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(None) == encoder.encode("") == []


def test_prefix_states_append_and_replace(encoder):
    table, rng = encoder.table, random.Random(5)
    for _ in range(60):
        data = "".join(rng.choice(["供应链", "abc", " the", "12", "é"]) for _ in range(rng.randint(1, 20))).encode()
        assert tokens.PrefixState(table, data).ids() == table.merge(data)
        cut = rng.randrange(len(data) + 1)
        state = tokens.PrefixState(table, data[:cut])
        state.append(data[cut:])
        assert state.ids() == table.merge(data)
        end = rng.randrange(cut, len(data) + 1)
        state.replace(cut, end, b"xyz")
        assert state.ids() == table.merge(data[:cut] + b"xyz" + data[end:])


def test_growing_text(encoder):
    text, grown = "It's  a   test\n\n of 百公里  appends 12 3's " * 2, tokens.GrowingText(encoder)
    for i in range(0, len(text), 3):
        grown.append(text[i : i + 3])
        assert grown.ids() == encoder.encode(text[: i + 3])


@pytest.mark.parametrize("seed", range(30))
def test_packing_plan(seed):
    from collections import Counter

    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100, 2048])
    sizes = Counter(rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 3, 50, 2000])))
    segments, n = packing.plan_packing(dict(sizes), capacity)
    load, placed = Counter(), Counter()
    for size, _, each, first, count in segments:
        placed[size] += each * count
        for k in range(count):
            load[first + k] += each * size
    assert placed == sizes and sorted(load) == list(range(n)) and all(v <= capacity for v in load.values())
    assert n <= 1.25 * sum(s * c for s, c in sizes.items()) / capacity + 2 or max(sizes, default=0) * 3 > capacity


def test_packed_rows(spark):
    rows = [(i, (i * 37) % 150) for i in range(500)] + [(900, 205), (901, 0), (902, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, n_tokens int").selectExpr("*", "1 AS piece", "2 AS container"), capacity=100).collect()
    load, length = {}, {}
    for r in got:
        load[r.container] = load.get(r.container, 0) + r.n_tokens
        length[r.doc_id] = length.get(r.doc_id, 0) + r.n_tokens
    assert max(load.values()) <= 100 and sorted(load) == list(range(len(load)))
    assert length == {i: n for i, n in rows if n}
    assert all(r.n_tokens == 100 or r.piece == 0 or dict(rows)[r.doc_id] > 100 for r in got)


def test_subjects_of_sentences(spark):
    rng = random.Random(6)
    words = {"banking": ["净息差", "对公存款", "票据贴现", "拨备覆盖率"], "sport": ["季后赛席位", "联赛门票", "青训学员", "球衣赞助"], "law": ["仲裁请求", "听证笔录", "保全措施", "二审判决"]}
    say = lambda s: f"{rng.choice(['甲银行', '乙体育'])}表示，{rng.choice(words[s])}{rng.choice(['同比增长', '环比下降'])}{rng.randint(1, 99)}%。"
    docs, labels, want = [], [], {}
    for i in range(240):
        mine = rng.sample(sorted(words), 1 if i % 3 else 2)
        docs.append((i, "".join(say(s) for s in mine for _ in range(5)), None))
        want[i] = set(mine)
        labels += [(i, s, "x") for s in mine if i < 160]
    docs += [(900, None, None), (901, "", None), (902, "市场有风险，入市需谨慎。", None), (903, "".join(say("law") for _ in range(10)) + say("sport"), None)]
    want[903] = {"law"}
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, subject string")
    entities = spark.createDataFrame([("甲银行股份", "甲银行", None), (None, "乙体育", "")], "company_name string, short_name string, english_name string")
    rules = subjects.fit_rules(frame, spark.createDataFrame(labels, "doc_id bigint, subject string, labeler string"), entities)
    got = {}
    for r in subjects.subjects_of(frame, rules).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert got == want


def test_all_labels_and_all_terms_are_mined(spark):
    names, other = ["banking", "law", "sport"], [chr(0x4E00 + i) for i in range(3000)]
    docs, labels = [], []
    for k in range(600):  # each term stands in five of 3,000 labelled documents
        term = "".join(other[2 * k : 2 * k + 2])
        docs += [(5 * k + j, f"{term}。") for j in range(5)]
        labels += [(5 * k + j, names[k % 3]) for j in range(5)]
    long = ["".join(chr(0x6000 + 8 * i + j) for j in range(4)) for i in range(6)]
    for i in range(9):  # a sentence of seven terms, of which the shortest comes alone elsewhere
        docs.append((4000 + i, "，".join([*long, "茶盏"]) + "。"))
        labels.append((4000 + i, "law"))
    docs.append((5000, "茶盏。"))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    entities = spark.createDataFrame([], "company_name string, short_name string, english_name string")
    rules = subjects.fit_rules(frame, spark.createDataFrame(labels, "doc_id bigint, subject string"), entities)
    got = {r.doc_id: r.subject for r in subjects.subjects_of(frame, rules).collect()}
    assert got == dict(labels) | {5000: "law"}


HARD = [("a", None, None, None), ("b", "", " ", ""), ("c", "标题", "摘要", "".join(f"第{i}段的内容，" for i in range(8000))), ("d", "标题", "摘要", "很短"), ("d", "标题", "摘要", "很短"), (None, "无号", None, "一条正常的内容，观望为主。")]


@pytest.mark.parametrize("rows", [HARD, []])
def test_hard_rows_and_empty_tables(spark, rows):
    df = spark.createDataFrame(rows, "id string, title string, summary string, content string").selectExpr("*", "'x' AS field", "'y' AS `key`", "'z' AS value", "0 AS n", "1 AS band", "2 AS part")
    assert mojibake.restore_values(df).count() == 0
    assert truncation.truncated(df).where("field = 'summary'").count() >= 0
    assert lookalikes.unify(df, lookalikes.share_counts(df.select("content"))).count() == 0
    assert residue.residue(df).count() == 0 and residue.templates(df).count() == 0
    reviews = spark.createDataFrame([], "social_id string, rating int, reviewer string")
    assert abuse.severity(df, abuse.fit_model(df, reviews)).count() == len(rows)
    members, pairs = neardup.class_pairs(df)
    assert neardup.record_pairs(members, pairs).count() == 0 and neardup.groups(members, pairs).count() == (1 if rows else 0)
    docs = spark.createDataFrame([(i, r[3]) for i, r in enumerate(rows)], "doc_id bigint, text string").selectExpr("*", "1 AS ids", "2 AS piece")
    ids = {r.doc_id: len(r.ids) for r in tokens.encode_documents(docs).collect()}
    assert len(ids) == len(rows) and all(ids[i] == 0 for i, r in enumerate(rows) if not r[3])
    packed = packing.pack_documents(docs)
    report = packing.packing_report(packed).collect()[0]
    assert report.tokens == sum(ids.values())
    labels = spark.createDataFrame([], "doc_id bigint, subject string")
    entities = spark.createDataFrame([], "company_name string, short_name string, english_name string")
    assert subjects.subjects_of(docs, subjects.fit_rules(docs, labels, entities)).count() == 0
