"""Problem 5: a severity score for abusive, hateful or sexual language.

Cumulative-link ordinal regression: P(grade > k) = sigmoid(w . x - theta_k), one weight vector for all ordered
thresholds. Features are the character n-grams and lexicon stems that a text holds, after undoing disguises.
The score is the expected grade. Weights are fitted on rated posts; every post is scored.
"""

from __future__ import annotations

import re
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.runtime import checkpointed, ship, spread

#: At most so many ratings are fitted, those whose post's id has the smallest hash; a documented bound on the driver.
MAX_RATINGS = 60_000
GRADES = 4
#: Expected grade from which a post counts as a case.
CASE_FROM = 1.3
_NGRAMS = (1, 2, 3, 4, 5)

# ---- fixed values: stems by kind; a kind is one feature, so that rare words share their evidence --------------

STEMS = {
    "insult": (
        "白痴 智障 弱智 脑残 傻逼 傻b 傻叉 傻缺 煞缺 煞笔 沙雕 蠢猪 蠢货 蠢驴 废物 废柴 窝囊废 垃圾人 人渣 杂碎 杂种 畜生 畜牲 混蛋 混账 王八蛋 王八羔子 狗东西 狗杂种 狗娘 下三滥 "
        "下贱 贱人 贱货 贱骨头 贱种 低贱 无耻 不要脸 死全家 滚蛋 神经病 死妈 操你 草泥马 尼玛 妈的 他妈 脑子进水 脑子落 没脑子 回炉重造 看一眼都想吐 也敢发照片 也配 全家都是 骂的就是你 跟你这种 idiot moron scum scumbag dumb dumbass stupid retard "
        "bastard asshole trash loser fuck shit bitch pig"
    ).split(),
    "threat": "去死 不得好死 断子绝孙 打死 弄死 砍死 杀了你 杀你 收拾你 上门收拾 你家在哪 出门小心 小心点 等着瞧 扒了你 跳楼吧 烧死 该死 偿命 报应".split(),
    "degrade": "低等 劣等 不算人 不是人 没一个好 滚出去 赶出去 滚回 关起来 就该打 钱脏 谁沾谁 天生的贱 这帮低 这种人 一看就是 蝗虫 阿三 支那 黑鬼 垃圾民族".split(),
    "sexual": "裸聊 裸照 约炮 包夜 陪睡 援交 一夜情 少妇 上门服务 脱光 扒光 成人片 成人视频 av资源 看片 巨乳 骚货 兼职陪 酒店等你 想看哪里 照片先看 身材 nudes nude sex porn escort horny".split(),
}
STEMS["threat"] += ["go die", "kill you", "nobody wants you", "get lost", "shut up"]
#: Sounds of characters in the stems; writers put them in a character's place.
_SOUNDS = dict(
    zip(
        "智痴障弱白脑残傻缺蠢猪货驴废物柴窝囊垃圾渣杂碎种畜生牲混蛋王八狗东西贱骨死妈人",
        "zhi chi zhang ruo bai nao can sha que chun zhu huo lv fei wu chai wo nang la ji zha za sui zhong chu sheng sheng hun dan wang ba gou dong xi jian gu si ma ren".split(),
    )
)
STEMS["insult"] += [s.replace(c, _SOUNDS[c]) for s in STEMS["insult"] if 2 <= len(s) <= 3 for c in s if c in _SOUNDS]
_KINDS = tuple(STEMS)
#: Traditional characters of the stems and of common context, and their simplified forms, pairwise.
_SIMPLE = str.maketrans(
    "賤廢癡腦殘垃種賬無恥臉媽罵這種絕孫殺門們視頻資務裡裏兒聽見體兇爛滾趕個來沒別動不發請討論賣對話張錢髒關東會頭說還進讓給歲婦約寫報評樓買點後開為與從幾萬國區單雙學應當戶與養豬週債淨貨",
    "贱废痴脑残垃种账无耻脸妈骂这种绝孙杀门们视频资务里里儿听见体凶烂滚赶个来没别动不发请讨论卖对话张钱脏关东会头说还进让给岁妇约写报评楼买点后开为与从几万国区单双学应当户与养猪周债净货",
)
_INVISIBLE = re.compile("[­͏᠎​-‏⁠-⁤︀-️﻿]")
#: Signs put between the characters of a word to disguise it.
_BETWEEN = re.compile("(?<=[一-鿿]) +(?=[一-鿿])|(?<=[一-鿿a-z])[-*._·•/\\\\|+~^`'xX×](?=[一-鿿])|(?<=[一-鿿])[-*._·•/\\\\|+~^`](?=[一-鿿a-z])")
_LOOKS = str.maketrans("аеорсхуіѕο@$0134", "aeopcxyiso" + "asoiea")


def undisguise(text: str) -> str:
    """One spelling: compatibility forms, case, script variants, invisible and separating signs."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = _INVISIBLE.sub("", text).translate(_SIMPLE)
    text = text.lower()
    if _BETWEEN.search(text):
        text = _BETWEEN.sub("", text)
    return text


def joined(title: str | None, content: str | None) -> str:
    """Title and content as one text; what is null or repeated counts once."""
    title, content = title or "", content or ""
    return undisguise(title if not content else content if content.startswith(title) else f"{title}\n{content}")


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the n-grams of all texts; those that cross a line end are left out."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t) + 1 for t in texts])
    docs = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    inside = codes != 10
    out_docs, out = [], []
    h = np.zeros(len(codes), np.uint64)
    ok = np.ones(len(codes), bool)
    for n in _NGRAMS:
        # h of the n characters that end at each position: add the one n - 1 places back
        back = np.zeros(len(codes), np.uint64)
        back[n - 1 :] = codes[: len(codes) - n + 1]
        h = (h ^ (back + np.uint64(n))) * _PRIME
        h ^= h >> np.uint64(31)
        good = np.zeros(len(codes), bool)
        good[n - 1 :] = inside[: len(codes) - n + 1]
        ok &= good
        out_docs.append(docs[ok])
        out.append(h[ok])
    return np.concatenate(out_docs), np.concatenate(out)


class Stems:
    """Which kinds of stems a text holds."""

    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for k, kind in enumerate(_KINDS):
            for stem in STEMS[kind]:
                self.automaton.add_word(stem, (k, len(stem), stem.isascii()))
        self.automaton.make_automaton()

    def _find(self, text: str) -> set[int]:
        """Kinds of the stems in a text; a stem in Latin letters is a whole word or its plural."""
        found = set()
        for end, (k, size, latin) in self.automaton.iter(text):
            if latin:
                before, after = text[max(0, end - size) : end - size + 1] if end >= size else "", text[end + 1 : end + 3]
                if "a" <= before <= "z" or "a" <= after[:1] <= "z" and (after[0] != "s" or "a" <= after[1:] <= "z"):
                    continue
            found.add(k)
        return found

    def kinds(self, text: str) -> set[int]:
        found = self._find(text)
        if "*" in text:
            found |= self._find(text.translate(_LOOKS))
            for word in re.findall(r"[a-z]+\*[a-z*]*", text):
                pattern = re.compile(word.replace("*", "[a-z]") + "s?")
                found |= {k for k, kind in enumerate(_KINDS) for stem in STEMS[kind] if pattern.fullmatch(stem)}
        return found


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, prior: np.ndarray, l2: float = 2.0, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model by Adam on the whole penalised likelihood.

    ``rows``: the features that each example holds. Thresholds stay ordered: each is the one before plus a
    positive step. Weights are drawn to ``prior``.
    """
    n_features = len(prior)
    columns = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, steps = prior.astype(float).copy(), np.array([0.5, 0.5, 0.0])
    moments = [np.zeros(n_features + 3), np.zeros(n_features + 3)]
    n = max(1, len(rows))
    for t in range(1, rounds + 1):
        theta = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
        score = np.bincount(of, w[columns], minlength=len(rows))
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -30, 30)))  # P(grade > k)
        bounds = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], 1)
        here = np.arange(len(rows))
        p = np.maximum(bounds[here, grades] - bounds[here, grades + 1], 1e-9)
        slope = np.concatenate([np.zeros((len(rows), 1)), above * (1 - above), np.zeros((len(rows), 1))], 1)
        g_score = -(slope[here, grades] - slope[here, grades + 1]) / p
        g_theta = np.zeros(GRADES + 1)
        np.add.at(g_theta, grades, slope[here, grades] / p)
        np.add.at(g_theta, grades + 1, -slope[here, grades + 1] / p)
        g_theta = g_theta[1:-1] / n
        tail = np.cumsum(g_theta[::-1])[::-1]
        g = np.concatenate([np.bincount(columns, g_score[of], minlength=n_features) / n + l2 * (w - prior) / n, tail * np.concatenate([[1.0], np.exp(steps[1:])])])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.999 * moments[1] + 0.001 * g * g
        move = 0.05 * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.999**t)) + 1e-8)
        w -= move[:n_features]
        steps -= move[n_features:]
    return w, np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))


class Model:
    """Fitted weights of n-grams and stems."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, kinds: np.ndarray, theta: np.ndarray):
        self.hashes, self.weights, self.kinds, self.theta = hashes, weights, kinds, theta
        self.filter = middle_bits(hashes)
        self.stems = Stems()

    def severity(self, texts: list[str]) -> np.ndarray:
        """Expected grade of each text."""
        if not texts:
            return np.zeros(0)
        docs, found = grams(texts)
        maybe = np.flatnonzero(self.filter[(found >> np.uint64(20)) & np.uint64(0xFFFFF)])
        docs, found = docs[maybe], found[maybe]
        score = np.zeros(len(texts))
        if len(self.hashes) and len(found):
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            hit = self.hashes[at] == found
            pairs = np.unique(docs[hit].astype(np.int64) * len(self.hashes) + at[hit])
            score = np.bincount(pairs // len(self.hashes), self.weights[pairs % len(self.hashes)], minlength=len(texts))
        for i, text in enumerate(texts):
            for k in self.stems.kinds(text):
                score[i] += self.kinds[k]
        return (1 / (1 + np.exp(-np.clip(score[:, None] - self.theta, -30, 30)))).sum(1)


#: Before any rating is seen the kinds of stems say nothing: their weights are learned, as those of all features.
_PRIOR = np.zeros(len(_KINDS))
#: A feature goes with high grades (or, from more texts, with low ones) in most of the rated texts that hold it, and
#: rated texts of that kind hold it so many times as often as all texts do.
_MIN_TEXTS, _ALIKE, _MIN_TEXTS_LOW, _ALIKE_LOW, _MIN_LIFT = 4, 0.65, 15, 0.92, 6.0


def candidates(texts: list[str], grades: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, feature, text, high, low): the n-grams that go with the grade, which text holds which, and in how
    many texts of high and of low grades each is. Copies of a text with the same grade count once."""
    y = np.array(grades) >= 2
    first = {}
    for i, key in enumerate(zip(texts, y.tolist())):
        first.setdefault(key, i)
    alone = np.zeros(len(texts), bool)
    alone[list(first.values())] = True
    docs, found = grams(texts)
    hashes, at = np.unique(found, return_inverse=True)
    pairs = np.unique(at.astype(np.int64) * len(texts) + docs)
    feature, doc = pairs // len(texts), pairs % len(texts)
    high = np.bincount(feature, (y & alone)[doc], minlength=len(hashes))
    low = np.bincount(feature, (~y & alone)[doc], minlength=len(hashes))
    n = high + low
    good = (high >= _MIN_TEXTS) & (high >= _ALIKE * n) | (low >= _MIN_TEXTS_LOW) & (low >= _ALIKE_LOW * n)
    position = np.cumsum(good) - 1
    keep = good[feature]
    return hashes[good], position[feature[keep]], doc[keep], high[good], low[good]


def document_counts(texts: list[str], hashes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """How many of the texts hold each of the sorted ``hashes``; ``index`` marks their middle bits."""
    docs, found = grams(texts)
    maybe = np.flatnonzero(index[(found >> np.uint64(20)) & np.uint64(0xFFFFF)])
    docs, found = docs[maybe], found[maybe]
    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    hit = hashes[at] == found
    pairs = np.unique(docs[hit].astype(np.int64) * len(hashes) + at[hit])
    return np.bincount(pairs % len(hashes), minlength=len(hashes))


def middle_bits(hashes: np.ndarray) -> np.ndarray:
    index = np.zeros(1 << 20, bool)
    index[(hashes >> np.uint64(20)) & np.uint64(0xFFFFF)] = True
    return index


def fit(texts: list[str], grades: list[int], found: tuple | None = None, corpus: np.ndarray | None = None, n_corpus: int = 0) -> Model:
    """A model from rated texts. ``corpus``: how many of all ``n_corpus`` texts hold each candidate.

    Features are the candidates that rated texts hold much more often than all texts do: ordinary words occur
    as often in either, however few ratings there are, and are left out.
    """
    if not texts:
        return Model(np.zeros(0, np.uint64), np.zeros(0), _PRIOR, np.array([1.0, 2.0, 3.0]))
    y = np.array(grades, np.int64)
    stems = Stems()
    hashes, feature, doc, high, low = found or candidates(texts, grades)
    chosen = np.ones(len(hashes), bool)
    if corpus is not None and len(hashes):
        usual = np.maximum(corpus, 1) / max(1, n_corpus)
        chosen = np.where(high >= low, high / max(1, (y >= 2).sum()), low / max(1, (y < 2).sum())) >= _MIN_LIFT * usual
    position = np.cumsum(chosen) - 1
    use = chosen[feature]
    order = np.argsort(doc[use], kind="stable")
    parts = np.split(position[feature[use]][order], np.cumsum(np.bincount(doc[use], minlength=len(texts)))[:-1])
    size = int(chosen.sum())
    rows = [np.concatenate([p, size + np.fromiter(stems.kinds(t), np.int64)]).astype(np.int64) for p, t in zip(parts, texts)]
    w, theta = fit_ordinal(rows, y, np.concatenate([np.zeros(size), _PRIOR]))
    return Model(hashes[chosen], w[:size], w[size:], theta)


def fit_model(posts: DataFrame, reviews: DataFrame, max_ratings: int = MAX_RATINGS):
    """The model fitted on the rated posts, as a broadcast; ratings without a post, a null or another grade are left out.

    The counts of the candidates are taken over all posts, in the cluster; there are no more of them than the
    bounded sample of rated posts has n-grams.
    """
    spark = posts.sparkSession
    ship(spark)
    # the bounded sample of ratings is sent to the posts, whose texts stay where they are
    sample = checkpointed(
        reviews.where(F.col("rating").between(0, GRADES - 1)).select(F.col("social_id").alias("id"), "rating", "reviewer").where("id is not null").distinct()
        .orderBy(F.xxhash64("id"), "id", "reviewer", "rating").limit(max_ratings)
    )
    found = posts.select("id", "title", "content").join(F.broadcast(sample.select("id").distinct()), "id").distinct()
    rated = found.join(sample, "id").orderBy("id", "reviewer", "rating", "title", "content").select("title", "content", "rating").collect()
    texts = [joined(t, c) for t, c, _ in rated]
    if not texts:
        model = fit([], [])
    else:
        found = candidates(texts, [r for *_, r in rated])
        shared = spark.sparkContext.broadcast(found[0])

        def count(batches):
            hashes = shared.value
            total, n, index = np.zeros(len(hashes), np.int64), 0, middle_bits(hashes)
            for batch in batches:
                part = [joined(t, c) for t, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                if part and len(hashes):
                    total += document_counts(part, hashes, index)
                n += len(part)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int64()), pa.array([n, *total[at].tolist()], pa.int64())], names=["_at", "_n"])

        counted = spread(posts.select("title", "content")).mapInArrow(count, "_at long, _n long").groupBy("_at").agg(F.sum("_n")).collect()
        corpus, n_corpus = np.zeros(len(found[0]), np.int64), 0
        for at, n in counted:
            if at < 0:
                n_corpus = n
            else:
                corpus[at] = n
        model = fit(texts, [r for *_, r in rated], found, corpus, n_corpus)
    return spark.sparkContext.broadcast((uuid.uuid4().hex, model.hashes, model.weights, model.kinds, model.theta))


_MODELS: dict[str, Model] = {}


def model_of(shared) -> Model:
    name, *parts = shared.value
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = Model(*parts)
    return _MODELS[name]


def severity(posts: DataFrame, shared, key: str = "id") -> DataFrame:
    """(key, severity) of every row, from 0 harmless to 3 severe, by title and content.

    Null and empty texts are scored as an empty text, repeated rows give repeated results, whole texts are
    read, an empty table gives an empty result, other columns don't matter.
    """
    ship(posts.sparkSession)
    rows = spread(posts.select(key, "title", "content"), key)

    def run(batches):
        model = model_of(shared)
        for batch in batches:
            texts = [joined(t, c) for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.severity(texts))], names=["key", "severity"])

    kind = posts.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, severity double").withColumnRenamed("key", key)


def severity_rates(scores: DataFrame, posts: DataFrame, by: str = "channel", key: str = "id", case_from: float = CASE_FROM) -> DataFrame:
    """(by, posts, cases, case_share, mean_severity) per source; a row that comes twice counts once, null is a source."""
    rows = posts.select(key, by).distinct().join(scores.distinct(), key)
    return rows.groupBy(by).agg(
        F.count("*").alias("posts"),
        F.count_if(F.col("severity") >= case_from).alias("cases"),
        F.round(F.avg((F.col("severity") >= case_from).cast("int")), 6).alias("case_share"),
        F.round(F.avg("severity"), 4).alias("mean_severity"),
    )
