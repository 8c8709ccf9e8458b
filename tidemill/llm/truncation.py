"""Problem 2: values that stop inside a sentence because the text was cut.

Two searches over all distinct values of all fields. Sorted by their text, a value that is a strict prefix of
a longer copy stands directly before a value that starts with it, and the copy shows how the text goes on.
Values without one are cut where their end is a sign that must go on or what a cut leaves behind. For the others
the same question is asked of their ends: hashes of fixed-length endings meet the same strings
inside all other values, and tell how often a sentence ends there.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.residue import inspector
from tidemill.runtime import checkpointed, ship

#: Lengths of the endings, the longest with enough support decides.
ENDINGS = (8, 5, 3)
_HEAD = 16  # characters by which values that wait at the end of a partition are found
MIN_SUPPORT = 3  # how often an ending must occur inside other values
MAX_FINAL = 0.04  # a sentence seldom ends there: the value was cut

# ---- fixed values: signs of omission, markup that a cut leaves, what may close a complete post ---------------

_MORE = re.compile(r"\s*(?:\[(?:展开|展開|全文|更多|…|\.\.\.)\]|【(?:展开|全文)】|(?:…+|\.{2,}|。{3,})?\s*(?:查看全文|阅读全文|閱讀全文|点击查看|點擊查看|展开全文|显示全文)|(?:…+|\.{2,})\s*(?:全文|展开|展開|更多|[Rr]ead more))\s*$")
_DOTS = re.compile(r"(\s*(?:…+|\.{3,}|。{3,}))\s*$")
_MARKUP = re.compile(r"(?:<[A-Za-z/!][^<>]*|&#?\w{1,6})$")
#: Signs, conjunctions, and numbers without their unit, after which a sentence must go on.
_OPEN = re.compile(
    r"[，,、；;：:（(“‘「『《【\[\-–—/]$|(?:因为|因為|由于|由於|主要是|其中第?|以及|包括|但是|而且|如果|虽然|雖然|(?<=[，。！？ ])(?:和|与|及|或))$"
    r"|(?:例如|比如|譬如)[A-Za-z]*$|(?:为|為|预计|預計|达|達|至|约|約|录得|錄得)[0-9]+(?:\.[0-9]*)?$|\b(?:because|such as|and|the|of|for|to|with|that|which|while|from)$"
)
_CLOSING = re.compile("(?:\\[[^\\[\\]0-9A-Za-z]{1,6}\\]|[~～\u2600-\u27bf\U0001f000-\U0001faff\u200d\ufe0e\ufe0f\u20e3*^#\\s])+$")
_FINAL = re.compile(r"[。！？!?][”’」』）)\]]*$|(?<![0-9.])\.[”’\"')]*$")
_INVISIBLE = re.compile("[\u00ad\u180e\u200b-\u200f\u2060-\u2064\ufe0e\ufe0f\ufeff]")
_NUMBER = re.compile(r"[0-9０-９]+(?:[.．][0-9０-９]+)?")
_SENTENCES = re.compile(r"(?<=[。！？!?\n])(?=.)", re.S)
_FINAL_CODES = tuple(map(ord, "。！？!?~～\n."))
#: What stands behind cut texts as well as behind complete ones, and so tells nothing.
_NEUTRAL_CODES = tuple(map(ord, "”’」』）)…[<&\ufffd\x00"))


def shape(value: str) -> tuple[str, str]:
    """(text without what follows its last word, kind of end).

    Kinds: ``final`` a closed sentence, ``open`` a sign that must go on, ``markup`` and ``lost`` what a cut
    leaves, ``more`` an invitation to read on, ``dots`` and ``short dots`` signs of omission, ``closed`` emoji
    or the like, ``bare`` a word.
    """
    text = value.rstrip()
    if m := _MORE.search(text):
        return _inner(text[: m.start()].rstrip(), "more")
    if m := _MARKUP.search(text):
        return text[: m.start()].rstrip(), "markup"
    if text.endswith("\ufffd"):
        return text.rstrip("\ufffd"), "lost"
    if m := _DOTS.search(text):
        writers = m.group(1).startswith("…") and len(m.group(1)) % 2 == 0
        return _inner(text[: m.start()].rstrip(), "dots" if writers else "short dots")
    bare = _CLOSING.sub("", text)
    if not bare or _FINAL.search(bare):
        return bare or text, "final"
    if bare == text and _OPEN.search(text):
        return text, "open"
    return bare, "closed" if bare != text else "bare"


def _inner(core: str, kind: str) -> tuple[str, str]:
    """Before a sign of omission: what is left of markup or an open sign decides."""
    if m := _MARKUP.search(core):
        return core[: m.start()].rstrip(), "markup"
    if core.endswith("\ufffd"):
        return core.rstrip("\ufffd"), "lost"
    if _FINAL.search(core):
        return core, "final"
    return core, "open" if _OPEN.search(core) else kind


def plain(text: str) -> str:
    """For comparing endings: no invisible characters, every number as 0."""
    return _NUMBER.sub("0", _INVISIBLE.sub("", text))


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _rolling(codes: np.ndarray, k: int) -> np.ndarray:
    """For every position a hash of the ``k`` characters that end there."""
    out = np.zeros(len(codes), np.uint64)
    for j in range(k):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[j:] = codes[: len(codes) - j]
        out = (out ^ (shifted + np.uint64(j + 1))) * _PRIME
        out ^= out >> np.uint64(29)
    return (out & np.uint64(0x3FFFFFFFFFFFFFFF)).astype(np.uint64)


def _endings(texts: list[str]) -> list[dict[int, int | None]]:
    if not texts:
        return []
    longest = max(ENDINGS)
    tails = [t[-longest:] for t in texts]
    codes = np.frombuffer("".join(t.rjust(longest, "\x00") for t in tails).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, longest)
    out: list[dict[int, int | None]] = [{} for _ in texts]
    for k in ENDINGS:
        part = codes[:, -k:].astype(np.uint64)
        h = np.zeros(len(texts), np.uint64)
        for j in range(k):
            h = (h ^ (part[:, k - 1 - j] + np.uint64(j + 1))) * _PRIME
            h ^= h >> np.uint64(29)
        h = (h & np.uint64(0x3FFFFFFFFFFFFFFF)).astype(np.int64)
        for i, t in enumerate(tails):
            out[i][k] = int(h[i]) if len(t) >= k else None
    return out


def _count_endings(batches):
    """Partial counts (ending, times, times final) of all strings of the fixed lengths inside all values."""
    for batch in batches:
        texts = [plain(t) for column in batch.columns for t in column.to_pylist() if t]
        if not texts:
            continue
        codes = np.frombuffer(("\x00".join(texts) + "\x00").encode("utf-32-le", "surrogatepass"), np.uint32)
        after = codes[1:]
        # a number's dot is part of the number by now; a dot at the end of a sentence has a space behind it
        final = np.isin(after, _FINAL_CODES) | (after >= 0x1F000) | ((after >= 0x2600) & (after < 0x27C0))
        neutral = np.isin(after, _NEUTRAL_CODES)
        neutral[:-1] |= (after[:-1] == 46) & (after[1:] == 46)
        separators = np.cumsum(codes == 0)
        for k in ENDINGS:
            h = _rolling(codes.astype(np.uint64), k)[:-1].astype(np.int64)
            whole = ~neutral
            whole[: k - 1] = False
            whole[k - 1 :] &= (separators[k - 1 : -1] == separators[: len(codes) - k]) & (codes[: len(codes) - k] != 0)
            keys, n = np.unique((h[whole] << 1) | final[whole], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array(n.astype(np.int64)), pa.array(np.where(keys & 1, n, 0).astype(np.int64))], names=["ending", "n", "n_final"])


class _Waiting:
    """A value whose end is open, until a longer copy shows how it goes on."""

    __slots__ = ("value", "core", "kind", "sure")

    def __init__(self, value: str):
        self.value, (self.core, self.kind) = value, shape(value)
        self.sure = self._sure()

    def _sure(self) -> bool | None:
        """Whether the value is cut, where its own end tells; a longer copy is asked for all the same, if it may be."""
        if self.kind == "final" or not self.core.strip() or inspector().messages(_SENTENCES.split(self.value.rstrip())[-1]):
            return False
        return True if self.kind in ("open", "markup", "lost", "more") else None

    def row(self, keys: tuple, copy: bool = False, seam: str | None = None) -> tuple:
        return *keys, self.kind, copy or self.sure, copy, plain(self.core)[-max(ENDINGS) :], seam


def _inspect(batches):
    """Over distinct values in sorted order: how each ends, and whether a later one goes on where it stops.

    Values that start with the same text stand together. A value waits for as long as the following ones start
    with it, so only values that are prefixes of one another ever wait at the same time. The first value of a
    partition and those that still wait at its end come out with their text, for the seams.
    """
    waiting: list[tuple[_Waiting, tuple]] = []
    rows: list[tuple] = []
    here = TaskContext.get().partitionId()
    first = None
    for batch in batches:
        for value, one, two in zip(*(c.to_pylist() for c in batch.columns)):
            if first is None:
                first = value
                rows.append((one, two, "first", None, False, "", value))
            waiting = _meet(value, waiting, rows)
            new = _Waiting(value)
            if new.sure is False:
                rows.append(new.row((one, two)))
            else:
                waiting.append((new, (one, two)))
        if len(rows) > 20_000:
            yield _inspected(rows, here)
            rows.clear()
    rows += [new.row(keys, seam=new.value) for new, keys in waiting]
    if rows:
        yield _inspected(rows, here)


def _reads_on(value: str, core: str) -> bool:
    """Whether a value that starts with ``core`` goes on inside its sentence."""
    after = value[len(core) : len(core) + 1]
    return after.isalnum() or after != "" and after in "，,、"


def _meet(value: str, waiting: list[tuple[_Waiting, tuple]], rows: list[tuple]) -> list[tuple[_Waiting, tuple]]:
    """What still waits after ``value`` came; what is settled goes to ``rows``."""
    still = []
    for new, keys in waiting:
        if not value.startswith(new.core):
            rows.append(new.row(keys))
            continue
        if _reads_on(value, new.core):
            rows.append(new.row(keys, copy=True))
        else:
            still.append((new, keys))
    return still


_INSPECTED = "one long, two int, kind string, sure boolean, copy boolean, " + ", ".join(f"e{k} long" for k in ENDINGS) + ", part int, seam string"


def _inspected(rows: list[tuple], part: int) -> pa.RecordBatch:
    one, two, kind, sure, copy, tails, seams = zip(*rows)
    endings = _endings(list(tails))
    return pa.RecordBatch.from_arrays(
        [pa.array(one, pa.int64()), pa.array(two, pa.int32()), pa.array(kind, pa.string()), pa.array(sure, pa.bool_()), pa.array(copy, pa.bool_())]
        + [pa.array([e[k] for e in endings], pa.int64()) for k in ENDINGS]
        + [pa.array(np.full(len(rows), part, np.int32)), pa.array(seams, pa.string())],
        names=["one", "two", "kind", "sure", "copy", *(f"e{k}" for k in ENDINGS), "part", "seam"],
    )


def _settle(seams: list[tuple]) -> tuple[list[tuple], list[tuple[_Waiting, tuple]]]:
    """The values that wait at the end of a partition: rows of those that the first values of the next ones settle,
    and those with which a next partition begins, so that its other values must be asked as well.

    ``seams``: (part, kind, one, two, text), two or three for each partition.
    """
    waiting, met, rows = [], [], []
    for part, kind, one, two, text in sorted(seams, key=lambda r: (r[0], r[1] != "first")):
        if kind == "first":
            met += _meet(text, waiting, rows)  # the values behind the first one are asked later
            waiting = []
        else:
            waiting.append((_Waiting(text), (one, two)))
    return rows + [new.row(keys) for new, keys in waiting], met


def _ask(waiting: list[tuple[str, str]]):
    """(at): the positions of those (value, core) after which a value comes that goes on inside the sentence.

    A value is compared only with the cores that begin as it does, found by their first characters.
    """
    heads: dict[str, list[int]] = {}
    for i, (_, core) in enumerate(waiting):
        heads.setdefault(core[:_HEAD], []).append(i)
    sizes = sorted({len(h) for h in heads})

    def run(batches):
        for batch in batches:
            at = set()
            for value in batch.column(0).to_pylist():
                for size in sizes:
                    for i in heads.get(value[:size], ()):
                        own, core = waiting[i]
                        if value > own and value.startswith(core) and _reads_on(value, core):
                            at.add(i)
            if at:
                yield pa.RecordBatch.from_arrays([pa.array(sorted(at), pa.int32())], names=["at"])

    return run


def truncated(df: DataFrame, fields: tuple[str, ...] = ("summary", "content"), key: str = "id") -> DataFrame:
    """(key, field, kind, route) of the values that end inside a sentence; ``kind`` is how they end, ``route`` how that is
    known: a longer ``copy`` goes on, a ``sign`` at the end must go on, or sentences seldom end with these ``endings``.

    Null, empty and blank values are never cut. Repeated rows give repeated results. Values are compared and
    counted whole, over all rows; copies count once. An empty table gives an empty result.
    """
    spark = df.sparkSession
    ship(spark)
    values = df.select(key, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))).alias("_v")).select(key, "_v.field", "_v.value")
    values = values.where(F.length(F.trim("value")) > 0)
    # A value is known by two hashes, 96 bits, wherever its text isn't needed.
    keys = (F.xxhash64("value").alias("one"), F.hash("value").alias("two"))
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The distinct values by their keys: one row of each, wherever its copies stand.
    distinct = values.select("value").distinct()
    # Range partitions of the sorted values hold any number of values that start alike; copies are gone by then.
    ordered = distinct.repartitionByRange(parts, "value").sortWithinPartitions("value").select("value", *keys)
    inspected = checkpointed(ordered.mapInArrow(_inspect, _INSPECTED))
    seams = inspected.where("seam is not null").select("part", "kind", "one", "two", "seam").collect()  # a few for each partition
    rows, waiting = _settle(list(map(tuple, seams)))
    if waiting:
        longer = {r.at for r in values.select("value").mapInArrow(_ask([(new.value, new.core) for new, _ in waiting]), "at int").distinct().collect()}  # map only
        rows += [new.row(keys, copy=i in longer) for i, (new, keys) in enumerate(waiting)]
    settled = [(*r[:5], *_endings([r[5]])[0].values()) for r in rows]
    columns = ["one", "two", "kind", "sure", "copy", *(f"e{k}" for k in ENDINGS)]
    inspected = inspected.where("seam is null").select(*columns)
    if settled:
        inspected = inspected.unionAll(spark.createDataFrame(settled, inspected.schema))
    asked = (
        inspected.where("sure is null")
        .select("one", "two", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"e{k}").alias("ending")) for k in ENDINGS))).alias("_e"))
        .select("one", "two", "_e.k", "_e.ending")
        .where("ending is not null")
    )
    known = distinct.mapInArrow(_count_endings, "ending long, n long, n_final long").groupBy("ending").agg(F.sum("n").alias("n"), F.sum("n_final").alias("n_final"))
    answers = asked.join(known.where(F.col("n") >= MIN_SUPPORT), "ending").groupBy("one", "two").agg(F.max_by(F.col("n_final") / F.col("n"), "k").alias("final_share"))
    decided = inspected.join(answers, ["one", "two"], "left").withColumn(
        "cut",
        F.when(F.col("sure").isNotNull(), F.col("sure"))
        .when(F.col("kind") == "short dots", F.coalesce(F.col("final_share") < 0.5, F.lit(True)))
        .when(F.col("kind") == "dots", F.coalesce(F.col("final_share") < MAX_FINAL, F.lit(True)))
        .otherwise(F.coalesce(F.col("final_share") < MAX_FINAL, F.lit(False))),
    )
    route = F.when(F.col("copy"), "copy").when(F.col("sure"), "sign").otherwise("endings").alias("route")
    return values.select(key, "field", *keys).join(decided.where("cut").select("one", "two", "kind", route), ["one", "two"]).select(key, "field", "kind", "route")


def truncation_report(df: DataFrame, cut: DataFrame, by: str = "channel", claim: str = "social_body_quality", fields: tuple[str, ...] = ("summary", "content"), key: str = "id") -> DataFrame:
    """(by, field, claim, values, cut, cut_share): how often each source cuts, beside what its rows claim.

    ``cut`` is the result of :func:`truncated` on ``df``. A row that comes twice counts once; a null source or
    claim is a group of its own; a group without values isn't listed.
    """
    rows = df.select(key, by, claim, *fields).distinct()
    values = rows.select(key, by, claim, F.explode(F.array(*(F.when(F.length(F.trim(f)) > 0, F.lit(f)) for f in fields))).alias("field")).where("field is not null")
    marked = values.join(cut.select(key, "field", F.lit(1).alias("_cut")).distinct(), [key, "field"], "left")
    return (
        marked.groupBy(by, "field", claim)
        .agg(F.count("*").alias("values"), F.count("_cut").alias("cut"))
        .withColumn("cut_share", F.round(F.col("cut") / F.col("values"), 6))
    )
