"""Problem 9: subject areas of documents by class-association rules.

Terms are strings of the labelled documents that go with a subject. The sentences of all labelled documents,
as sets of all their terms with the subjects of their document, are mined by parallel frequent-pattern growth: each
term has the conditional base of the more frequent ones beside it, grown up to three terms. Frequent
sets that go with a subject give rules "terms -> subject", of which redundant ones are pruned. A sentence is about
the subject for which its matching rules have the strongest calibrated evidence; a document has the subjects
of at least a quarter of its sentences that are about any.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.runtime import checkpointed, ship, spread

#: Least share of the documents that hold a term, and of the sentences that hold a pattern.
MIN_SHARE = 1e-5
#: Most labelled documents that rules are fitted on; every document is scored.
MAX_LABELLED = 200_000
SHARE = 0.25
_LENGTHS = (2, 3, 4, 5, 6)
#: Shares of a document among up to twelve subjects are whole numbers of these, so sums don't depend on order.
_UNITS = 27720
#: Characters that a task counts at once.
_HELD = 1_000_000
#: Transactions that a task holds before it hands their counts on.
_KEPT = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_AND, _END = "\x1f", "\x1e"
_SENTENCE = re.compile(r"[^。！？!?\n.]+(?:\.(?=\S)[^。！？!?\n.]*)*[。！？!?\n.]?")
_HAN = re.compile("[㐀-鿿]+")
_WORDS = re.compile(r"[a-z]{3,}")
_INVISIBLE = re.compile("[­᠎​-‏⁠-⁤︎️﻿]")
_NAME = "\x01"


class Reader:
    """Sentences of a text in one spelling, the names of companies taken out: they don't decide a subject."""

    def __init__(self, names: list[str]):
        import ahocorasick

        self.names = ahocorasick.Automaton()
        for name in names:
            self.names.add_word(name, len(name))
        if names:
            self.names.make_automaton()
        self.any = bool(names)

    def spelled(self, text: str | None) -> str:
        """A text in one spelling, lower case, a mark for each name."""
        if not text or not text.strip():
            return ""
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = _INVISIBLE.sub("", text).lower()
        if self.any:
            out, at = [], 0
            for end, size in self.names.iter_long(text):
                out += [text[at : end - size + 1], _NAME]
                at = end + 1
            text = "".join([*out, text[at:]]) if out else text
        return text

    def sentences(self, text: str | None) -> list[str]:
        return [s for s in _SENTENCE.findall(self.spelled(text)) if s.strip()]


def _words(sentence: str) -> list[str]:
    """Latin words of a sentence, and pairs of them."""
    words = _WORDS.findall(sentence)
    return words + list(map(" ".join, zip(words, words[1:])))


def _pack(sentences: list[str]) -> bytes:
    return zlib.compress(_END.join(s.replace(_END, " ") for s in sentences).encode("utf-8", "surrogatepass"), 1)


def _unpack(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode("utf-8", "surrogatepass").split(_END)


def _han_strings(texts: list[str]):
    """(strings, string of each pair, text of each pair): the distinct strings of Han characters in each text.

    All texts are hashed at once, length by length; a stable sort by hash leaves the texts of a string in order.
    """
    text = _END.join(texts)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[: len(codes)]
    han = (codes >= 0x3400) & (codes <= 0x9FFF)
    strings, which, where = [], [], []
    h, whole = codes.astype(np.uint64), han
    for n in range(1, max(_LENGTHS) + 1):
        if n > 1:
            h = (h[:-1] * _MIX) ^ codes[n - 1 :]
            h ^= h >> np.uint64(31)
            whole = whole[:-1] & han[n - 1 :]
        if n in _LENGTHS:
            at = np.flatnonzero(whole)
            at = at[np.argsort(h[at], kind="stable")]
            if not len(at):
                continue
            first = np.concatenate([[True], h[at[1:]] != h[at[:-1]]])
            pair = first | np.concatenate([[True], of[at[1:]] != of[at[:-1]]])
            which.append((np.cumsum(first) - 1)[pair] + len(strings))
            where.append(of[at[pair]])
            strings += [text[i : i + n] for i in at[first].tolist()]
    none = np.zeros(0, np.int64)
    return strings, np.concatenate(which) if which else none, np.concatenate(where) if where else none


def _count_grams(names: list[str]):
    """Partial sums (gram, weight of each subject) of the shares of the documents that hold a string."""
    at = {s: i for i, s in enumerate(names)}

    def counted(texts: list[str], subjects: list[list[str]]) -> pa.RecordBatch:
        grams, which, where = _han_strings(texts)
        number: dict[str, int] = {}
        more = [(number.setdefault(g, len(number)), i) for i, t in enumerate(texts) for g in set().union(*map(_words, t.split(_END)))]
        if more:
            w, i = zip(*more)
            which, where = np.concatenate([which, np.array(w) + len(grams)]), np.concatenate([where, np.array(i)])
        grams += number
        weights = np.zeros((len(names), len(grams)), np.int64)
        for s, i in at.items():
            units = np.array([_UNITS // len(own) if s in own else 0 for own in subjects], np.int64)
            weights[i] = np.bincount(which, units[where], len(grams)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), *map(pa.array, weights)], names=["gram", *(f"w{i}" for i in range(len(names)))])

    def run(batches):
        texts, marks, held = [], [], 0
        for batch in batches:
            for packed, subjects in zip(*(c.to_pylist() for c in batch.columns)):
                if subjects:
                    texts.append(_END.join(_unpack(packed)))
                    marks.append(subjects)
                    held += len(texts[-1])
                    if held > _HELD:
                        yield counted(texts, marks)
                        texts, marks, held = [], [], 0
        if texts:
            yield counted(texts, marks)

    return run


def choose_terms(docs: DataFrame, least: int = 3, purity: float = 0.55) -> list[str]:
    """The strings of documents (sentences, subjects) that go with a subject, in order."""
    prior: Counter = Counter()
    for r in docs.groupBy("subjects").agg(F.count("*").alias("n")).collect():
        for s in r.subjects:
            prior[s] += r.n * (_UNITS // len(r.subjects))
    if not prior:
        return []
    names, total = sorted(prior), sum(prior.values())
    weights = [F.col(f"w{i}") for i in range(len(names))]
    grams = docs.mapInArrow(_count_grams(names), "gram string, " + ", ".join(f"w{i} long" for i in range(len(names)))).groupBy("gram").agg(*(F.sum(w).alias(f"w{i}") for i, w in enumerate(weights)))
    best = F.array_max(F.array(*(F.struct(w.alias("w"), F.lit(s).alias("subject"), F.lit(prior[s] / total).alias("prior")) for w, s in zip(weights, names))))
    found = grams.select("gram", sum(weights[1:], weights[0]).alias("all"), best.alias("best")).where(F.col("all") >= max(least * 0.999, MIN_SHARE * total / _UNITS) * _UNITS)
    pure = F.col("best.w") / F.col("all")
    return sorted(r.gram for r in found.where((pure >= purity) & (pure >= F.col("best.prior") + 0.3)).select("gram").collect())


class Matcher:
    """Terms of a sentence: leftmost longest, not overlapping."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for t in terms:
            self.automaton.add_word(t, (t, len(t) if t.isascii() else 0))
        self.any = bool(terms)
        if terms:
            self.automaton.make_automaton()

    def found(self, text: str):
        """(end, term) of the terms of a text, in order; Latin ones are whole words."""
        if not self.any:
            return
        for end, (t, latin) in self.automaton.iter_long(text):
            if latin and ("a" <= text[end + 1 : end + 2] <= "z" or end >= latin and "a" <= text[end - latin] <= "z"):
                continue
            yield end, t

    def terms(self, sentence: str) -> list[str]:
        return sorted({t for _, t in self.found(sentence)})


def _transactions(shared):
    """(terms, mark, n): partial counts of sentences by the numbers of their terms and the subjects of their document."""

    def run(batches):
        matcher = Matcher(shared.value)
        number = {t: i for i, t in enumerate(shared.value)}
        held: Counter = Counter()

        def out():
            rows = [([*terms], mark, n) for (terms, mark), n in held.items()]
            held.clear()
            terms, marks, n = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.int32())), pa.array(marks), pa.array(n, pa.int64())], names=["terms", "mark", "n"])

        for batch in batches:
            for sentences, subjects in zip(*(c.to_pylist() for c in batch.columns)):
                mark = _AND.join(subjects or ())
                for s in _unpack(sentences):
                    if terms := matcher.terms(s):
                        held[tuple(number[t] for t in terms), mark] += 1
                if len(held) > _KEPT:
                    yield out()
        if held:
            yield out()

    return run


def _conditional(shared):
    """(item, prefix, mark, n): each frequent term of a transaction with the more frequent ones beside it."""

    def run(batches):
        rank = shared.value[0]
        for batch in batches:
            rows = []
            for terms, mark, n in zip(*(c.to_pylist() for c in batch.columns)):
                ranks = sorted(rank[t] for t in terms if t in rank)
                rows += [(ranks[j], ranks[:j], mark, n) for j in range(1, len(ranks))]
            if rows:
                item, prefix, marks, n = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(prefix, pa.list_(pa.int32())), pa.array(marks), pa.array(n, pa.int64())], names=["item", "prefix", "mark", "n"])

    return run


def _by_subject(marks: dict[str, int]) -> Counter:
    out: Counter = Counter()
    for mark, n in marks.items():
        for s in mark.split(_AND) if mark else ():
            out[s] += n
    return out


def _sure(n: int, alone: int) -> float:
    return (n + 0.5) / (alone + 1.5)


def _grow(shared, confidence: float):
    """(terms, subject, sure, general) of the patterns of two and three terms that a term's conditional base gives.

    Rows (item, prefix, mark, n) come in order of their items, so a task holds the base of one item at a time.
    Of pairs those that are surer than each of their terms, of triples those that can be rules as far as this
    base tells; ``general`` is the best of the smaller patterns seen here.
    """

    def grown(item: int, base: list[tuple], rows: list[tuple]) -> None:
        _, single, threshold = shared.value
        pairs: dict[int, Counter] = defaultdict(Counter)
        for prefix, mark, n in base:
            for a in prefix:
                pairs[a][mark] += n
        pairs = {a: marks for a, marks in pairs.items() if sum(marks.values()) >= threshold}
        best = {}
        for a, marks in pairs.items():
            alone = sum(marks.values())
            for s, n in _by_subject(marks).items():
                if n >= threshold:
                    general, sure = max(single[a].get(s, 0.0), single[item].get(s, 0.0)), _sure(n, alone)
                    best[a, s] = max(sure, general)
                    if sure > general:
                        rows.append(([a, item], s, sure, general))
        triples: dict[tuple[int, int], Counter] = defaultdict(Counter)
        for prefix, mark, n in base:
            for pair in combinations([a for a in prefix if a in pairs], 2):
                triples[pair][mark] += n
        for (a, b), marks in triples.items():
            if (alone := sum(marks.values())) >= threshold:
                for s, n in _by_subject(marks).items():
                    general, sure = max(best.get((a, s), 0.0), best.get((b, s), 0.0)), _sure(n, alone)
                    if n >= threshold and sure >= confidence and sure > general + 0.02:
                        rows.append(([a, b, item], s, sure, general))

    def out(rows: list[tuple]) -> pa.RecordBatch:
        terms, subjects, sure, general = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.int32())), pa.array(subjects), pa.array(sure), pa.array(general)], names=["terms", "subject", "sure", "general"])

    def run(batches):
        item, base, rows = None, [], []
        for batch in batches:
            for new, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if new != item:
                    if base:
                        grown(item, base, rows)
                    item, base = new, []
                base.append(row)
            if len(rows) > _KEPT:
                yield out(rows)
                rows = []
        if base:
            grown(item, base, rows)
        if rows:
            yield out(rows)

    return run


def mine_rules(docs: DataFrame, terms: list[str], least: int = 3, confidence: float = 0.55) -> dict[frozenset, dict[str, float]]:
    """{terms: {subject: evidence}}: pruned rules of the frequent patterns, of up to three terms, of all sentences of ``docs``.

    Evidence is the log of how much the smoothed odds of the subject exceed its odds among all sentences.
    """
    if not terms:
        return {}
    context = docs.sparkSession.sparkContext
    rows = docs.mapInArrow(_transactions(context.broadcast(terms)), "terms array<int>, mark string, n long")
    rows = checkpointed(rows.groupBy("terms", "mark").agg(F.sum("n").alias("n")))
    marks = {r.mark: r.n for r in rows.groupBy("mark").agg(F.sum("n").alias("n")).collect()}
    seen, prior = sum(marks.values()), _by_subject(marks)
    threshold = max(least, math.ceil(MIN_SHARE * seen))
    counts: dict[int, dict[str, int]] = defaultdict(dict)
    for t, mark, n in rows.select(F.explode("terms").alias("t"), "mark", "n").groupBy("t", "mark").agg(F.sum("n").alias("n")).collect():
        counts[t][mark] = n
    often = {t: alone for t, of in counts.items() if (alone := sum(of.values())) >= threshold}
    order = sorted(often, key=lambda t: (-often[t], t))
    single = [{s: _sure(n, often[t]) for s, n in sorted(_by_subject(counts[t]).items()) if n >= threshold} for t in order]
    shared = context.broadcast(({t: r for r, t in enumerate(order)}, single, threshold))
    bases = rows.mapInArrow(_conditional(shared), "item int, prefix array<int>, mark string, n long").repartition("item")
    bases = bases.groupBy("item", "prefix", "mark").agg(F.sum("n").alias("n")).sortWithinPartitions("item")
    grown = bases.mapInArrow(_grow(shared, confidence), "terms array<int>, subject string, sure double, general double").collect()
    pairs = {(*r.terms, r.subject): r.sure for r in grown if len(r.terms) == 2}
    rules: dict[frozenset, dict[str, float]] = {}

    def keep(ranks, subject: str, sure: float, general: float) -> None:
        if sure >= confidence and sure > general + 0.02:
            base = min(0.9, prior[subject] / seen)
            rules.setdefault(frozenset(terms[order[r]] for r in ranks), {})[subject] = math.log(sure / (1 - sure)) - math.log(base / (1 - base))

    for r, of in enumerate(single):
        for subject, sure in of.items():
            keep((r,), subject, sure, 0.0)
    for r in sorted(grown, key=lambda r: (len(r.terms), r.terms, r.subject)):
        general = r.general
        if len(r.terms) == 3:  # the pair without the rarest term stands in another base
            a, b = r.terms[:2]
            general = max(general, pairs.get((a, b, r.subject), 0.0))
        keep(r.terms, r.subject, r.sure, general)
    return rules


class Rules:
    """Scores sentences and documents by matching rules."""

    def __init__(self, names: list[str], rules: dict[frozenset, dict[str, float]]):
        self.reader = Reader(names)
        self.matcher = Matcher(sorted({t for terms in rules for t in terms}))
        #: For each term its evidence by itself, and the rules of which it is the first term.
        self.single: dict[str, list[tuple[str, float]]] = {next(iter(t)): list(e.items()) for t, e in rules.items() if len(t) == 1}
        self.more: dict[str, list] = defaultdict(list)
        for terms, evidence in rules.items():
            if len(terms) > 1:
                self.more[min(terms)].append((terms, list(evidence.items())))

    def subject(self, terms: set[str]) -> str | None:
        """The subject of a sentence with these terms; None if no rule matches. Ties go to the first name."""
        score: dict[str, float] = {}
        for t in sorted(terms):
            for s, e in self.single.get(t, ()):
                score[s] = score.get(s, 0) + e
            if t in self.more:
                for rule, evidence in self.more[t]:
                    if rule <= terms:
                        for s, e in evidence:
                            score[s] = score.get(s, 0) + e
        if not score:
            return None
        most = max(score.values())
        return min(s for s, e in score.items() if e == most) if most > 0 else None

    def counts(self, text: str | None) -> Counter:
        """How many sentences of a text are about each subject. No term holds the end of a sentence."""
        text = self.reader.spelled(text)
        out: Counter = Counter()
        ends, at, terms = [m.end() for m in _SENTENCE.finditer(text)], 0, set()
        for end, t in self.matcher.found(text):
            if end >= ends[at]:
                if terms and (s := self.subject(terms)):
                    out[s] += 1
                terms = set()
                while end >= ends[at]:
                    at += 1
            terms.add(t)
        if terms and (s := self.subject(terms)):
            out[s] += 1
        return out

    def subjects(self, text: str | None, share: float = SHARE) -> list[tuple[str, int, int]]:
        """(subject, its sentences, sentences about any) of the subjects of a text."""
        counts = self.counts(text)
        total = sum(counts.values())
        return [(s, n, total) for s, n in sorted(counts.items()) if n >= share * total]


def company_names(entities: DataFrame) -> list[str]:
    """Names in one spelling; the table of companies is a small dimension of bounded size."""
    rows = entities.select("company_name", "short_name", "english_name").distinct().collect()
    names = {unicodedata.normalize("NFKC", n).strip().lower() for row in rows for n in row if n}
    return sorted(n for n in names if len(n) >= 3)


def _read(rows: DataFrame, names: list[str]) -> DataFrame:
    """(sentences, subjects) of (text, subjects)."""

    def run(batches):
        reader = Reader(names)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_pack(reader.sentences(t)) for t in batch.column(0).to_pylist()], pa.binary()), batch.column(1)], names=["sentences", "subjects"])

    return rows.mapInArrow(run, "sentences binary, subjects array<string>")


def _share(spark: SparkSession, names: list[str], rules: dict[frozenset, dict[str, float]]):
    return spark.sparkContext.broadcast((uuid.uuid4().hex, names, [(sorted(t), e) for t, e in rules.items()]))


def fit_rules(documents: DataFrame, labels: DataFrame, entities: DataFrame, most: int = MAX_LABELLED):
    """Rules from the labelled documents, as a broadcast; of more than ``most`` labelled ones a share by hash of the id."""
    spark = documents.sparkSession
    ship(spark)
    names = company_names(entities)
    marks = labels.where("doc_id is not null and subject is not null").distinct().groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("subjects"))
    marks = checkpointed(marks)
    if (n := marks.count()) > most:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    texts = documents.where(F.length(F.trim("text")) > 0).select("doc_id", "text")
    # at most about MAX_LABELLED short rows are sent to all, so no text of an unlabelled document is moved
    docs = checkpointed(_read(spread(texts.join(F.broadcast(marks), "doc_id"), "doc_id").select("text", "subjects"), names))
    return _share(spark, names, mine_rules(docs, choose_terms(docs)))


_RULES: dict[str, Rules] = {}


def rules_of(shared) -> Rules:
    name, names, packed = shared.value
    if name not in _RULES:
        _RULES.clear()
        _RULES[name] = Rules(names, {frozenset(t): e for t, e in packed})
    return _RULES[name]


def subjects_of(documents: DataFrame, shared, share: float = SHARE) -> DataFrame:
    """(doc_id, subject, sentences, of_sentences): the subjects of every document, by all of its sentences.

    Null, empty and blank texts and market chatter have none; repeated texts have the same; an empty table
    gives an empty result; other columns don't matter.
    """
    ship(documents.sparkSession)
    rows = spread(documents.select("doc_id", "text"), "doc_id")

    def run(batches):
        rules = rules_of(shared)
        for batch in batches:
            out = [(i, *found) for i, text in enumerate(batch.column(1).to_pylist()) for found in rules.subjects(text, share)]
            if out:
                at, subjects, n, total = zip(*out)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(subjects), pa.array(n, pa.int32()), pa.array(total, pa.int32())], names=["doc_id", "subject", "sentences", "of_sentences"])

    return rows.mapInArrow(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, subject string, sentences int, of_sentences int")
