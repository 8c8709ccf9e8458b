"""Problem 3: one consistent form for text that looks the same but is written with different characters.

Look-alike classes are the components of a union-find over strings and code points: compatibility forms,
composed and decomposed letters, radicals, letters of other scripts, spaces, invisible signs (one class with the
empty string). The member that the corpus uses most represents its class; where the corpus has too little to tell,
the form that Unicode keeps does. Text is rewritten greedily, longest pattern first, by one multi-pattern automaton;
patterns that are right in some surroundings, such as letters of genuine words, joiners of emoji and indents, have a
guard that is asked at each match.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from bisect import bisect_right
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.runtime import ship, spread

# ---- fixed values: what a reader can't tell apart ------------------------------------------------------------

#: Letters and digits of other scripts beside the Latin letter or digit that they look like.
HOMOGLYPHS = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СϹᏟⅭ", "D": "ᎠⅮ", "E": "ЕΕᎬ", "F": "Ϝ", "G": "Ԍ", "H": "НΗᎻ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚᏦ", "L": "ᏞⅬ",
    "M": "МΜϺⅯ", "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ", "X": "ХΧ", "Y": "УΥҮ", "Z": "ΖᏃ",
    "a": "аɑ", "b": "Ьᖯ", "c": "сϲⅽ", "d": "ԁⅾ", "e": "еҽ", "g": "ɡց", "h": "һ", "i": "іı", "j": "јϳ", "k": "κ", "l": "ӏⅼ", "m": "ⅿ", "n": "ո", "o": "оοօ",
    "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "υս", "v": "νѵ", "w": "ԝѡ", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
#: Radicals that have no decomposition, beside the character that they look like.
RADICALS = {
    "⺁": "厂", "⺃": "乚", "⺅": "亻", "⺈": "⺈", "⺉": "刂", "⺋": "㔾", "⺎": "兀", "⺒": "巳", "⺓": "幺", "⺕": "彐", "⺖": "忄", "⺗": "㣺", "⺘": "扌", "⺙": "攵",
    "⺛": "旡", "⺝": "月", "⺞": "歺", "⺠": "民", "⺡": "氵", "⺣": "灬", "⺤": "爫", "⺨": "犭", "⺩": "王", "⺫": "罒", "⺭": "礻", "⺮": "竹", "⺯": "糹", "⺰": "纟",
    "⺱": "罓", "⺶": "羊", "⺼": "月", "⺾": "艹", "⻁": "虎", "⻂": "衤", "⻃": "覀", "⻄": "西", "⻅": "见", "⻈": "讠", "⻉": "贝", "⻋": "车", "⻌": "辶", "⻏": "阝",
    "⻑": "長", "⻒": "镸", "⻓": "长", "⻔": "门", "⻖": "阝", "⻘": "青", "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食", "⻟": "飠", "⻠": "饣", "⻢": "马",
    "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻧": "卤", "⻨": "麦", "⻩": "黄", "⻬": "齐", "⻮": "齿", "⻯": "竜", "⻰": "龙", "⻱": "亀", "⻲": "亀", "⻳": "龟",
}
#: Full-width forms that are usual Chinese punctuation and stay as they are.
USUAL_WIDE = "！（），：；？［］｛｝～｜＂＇、。「」【】《》￥"
#: Kinds of decomposition whose result looks the same.
_SAME_LOOK = {"<wide>", "<narrow>", "<font>", "<small>", "<vertical>", ""}
#: A form represents its class where the corpus has it so often, and so many times as often as all others of the class.
LEAST, TIMES = 20, 3
_MIN_SHARE = 1e-6  # a word is kept when it makes up this share of all words: at most a million words


class Classes:
    """Union-find over strings; ``find`` gives the root, ``groups`` the classes with more than one member."""

    def __init__(self):
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)

    def groups(self) -> list[list[str]]:
        out = defaultdict(list)
        for x in self.parent:
            out[self.find(x)].append(x)
        return [sorted(g) for g in out.values() if len(g) > 1]


def _pairs():
    """(string, string that looks the same) by the rules of Unicode and the fixed lists."""
    for point in range(0xA0, 0x110000):
        if 0xD800 <= point < 0xE000 or 0xAC00 <= point < 0xD7B0:
            continue
        char = chr(point)
        written = unicodedata.decomposition(char)
        if not written:
            continue
        kind = written.split()[0] if written[0] == "<" else ""
        if kind == "<compat>":
            # radicals and ligatures; other compatibility forms differ in look
            if not (0x2E80 <= point < 0x2FE0 or 0xFB00 <= point < 0xFB07):
                continue
        elif kind not in _SAME_LOOK:
            continue
        if char in USUAL_WIDE or unicodedata.category(char) == "Zs":
            continue
        if kind == "<vertical>" or point in range(0x3000, 0x3040):
            continue
        if kind:
            yield char, unicodedata.normalize("NFKC", char)
        else:
            composed = unicodedata.normalize("NFC", char)
            if composed != char:  # singletons, such as compatibility ideographs
                yield char, composed
            else:
                yield unicodedata.normalize("NFD", char), char
    yield from RADICALS.items()
    for latin, others in HOMOGLYPHS.items():
        for char in others:
            yield char, latin


_OTHER_SCRIPT = frozenset("".join(HOMOGLYPHS.values()))
_LATIN_OF = {c: latin for latin, others in HOMOGLYPHS.items() for c in others}
_SPACES = frozenset(chr(p) for p in range(0x80, 0x3001) if unicodedata.category(chr(p)) in ("Zs", "Zl", "Zp"))
_INVISIBLE = frozenset(
    [*map(chr, range(0x00, 0x09)), *map(chr, range(0x0E, 0x20)), "\x7f", "\x0b", "\x0c", "ᅟ", "ᅠ", "ㅤ", "ﾠ", "͏", "︎", "️", *map(chr, range(0x180B, 0x180F))]
    + [chr(p) for p in range(0xA0, 0x110000) if not 0xD800 <= p < 0xE000 and unicodedata.category(chr(p)) == "Cf" and not 0x600 <= p <= 0x8E2 and p not in (0x110BD, 0x110CD)]
)
_WORD = re.compile(r"[A-Za-zÀ-ʯͰ-ԯԱ-ֆᎠ-Ᏽᴀ-ᶿⅠ-ⅿＡ-Ｚａ-ｚ̀-ͯ]+")
_UNSEEN = _INVISIBLE | _SPACES
_DIGITS = re.compile(r"(?<=[0-9０-９])(?:[OoОоΟοՕօ]|[lIІӏΙ|])(?=[0-9０-９])")


class Rewriter:
    """Rewrites text to the representatives of its classes."""

    def __init__(self, counts: dict[str, int]):
        import ahocorasick

        classes = Classes()
        for a, b in _pairs():
            classes.union(a, b)
        for c in _SPACES:
            classes.union(c, " ")
        for c in _INVISIBLE:
            classes.union(c, "")
        self.counts, self.automaton, self.map = counts, ahocorasick.Automaton(), {}
        for group in classes.groups():
            best = self._representative(group)
            self.map |= {s: best for s in group if s != best and s and not s.isascii() or s in _INVISIBLE}
        for s, best in self.map.items():
            guard = self._in_word if s in _OTHER_SCRIPT else self._no_indent if s == "\u3000" else self._joins_nothing if s in _INVISIBLE else None
            self.automaton.add_word(s, (len(s), best, guard))
        self.automaton.make_automaton()
        # bits of code points: 1 first of a pattern, 2 invisible or a space, 4 a letter of another script, 8 a digit
        self.bits = np.zeros(0x110000, np.uint8)
        self.bits[[ord(s[-1]) for s in self.map if s not in _OTHER_SCRIPT and s not in _INVISIBLE and s not in _SPACES]] |= 1
        self.bits[[ord(c) for c in _INVISIBLE | _SPACES]] |= 2
        self.bits[[ord(c) for c in _OTHER_SCRIPT]] |= 4
        self.bits[list(range(48, 58))] |= 8
        self.bits[[ord(c) for c in "OoОоΟοՕօlIІӏΙ|"]] |= 16

    def _representative(self, group: list[str]) -> str:
        """The form that the corpus uses most by far, else ASCII before what Unicode keeps before all others."""
        n = {s: self.counts.get(s, 0) for s in group}
        best = max(group, key=lambda s: (n[s], s))
        if n[best] >= LEAST and n[best] >= TIMES * (sum(n.values()) - n[best]) and not (best in _INVISIBLE or best in _OTHER_SCRIPT or best in _SPACES):
            return best
        return min(group, key=lambda s: (not s.isascii(), s in RADICALS or unicodedata.normalize("NFKC", s) != s, s in _INVISIBLE, -n[s], len(s), s))

    def candidates(self, texts: list[str]) -> np.ndarray:
        """For each text whether anything in it can need rewriting. Array operations only."""
        codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.zeros(len(texts), np.int64)
        np.cumsum([len(t) + 1 for t in texts[:-1]], out=begins[1:])
        bits = self.bits[codes]
        hits = (bits & 7) > 0
        indent = (codes == 0x3000) & np.concatenate([[True], (codes[:-1] == 0x3000) | (codes[:-1] == 10)])
        hits &= ~indent
        hits[1:-1] |= ((bits[1:-1] & 16) > 0) & ((bits[:-2] & 8) > 0) & ((bits[2:] & 8) > 0)
        # letters that stand for themselves in composed words and genuine words are sorted out one by one
        return np.maximum.reduceat(hits, begins).astype(bool)

    def rewrite(self, text: str | None) -> tuple[str | None, int]:
        """(text in its consistent form, changes). Nulls and empty texts have none."""
        if not text:
            return text, 0
        # what can't be seen and spaces first, then what they parted
        text, changes = (text, 0) if _UNSEEN.isdisjoint(text) else self._pass(text, True)
        text, more = self._pass(text, False)
        n = 0

        def digit(m: re.Match) -> str:
            nonlocal n
            n += 1
            return "0" if m.group() in "OoОоΟοՕօ" else "1"

        return _DIGITS.sub(digit, text), changes + more + n

    def _pass(self, text: str, unseen: bool) -> tuple[str, int]:
        """The text with its matches rewritten: those of spaces and invisible signs, or all others."""
        out, at, changes, words = [], 0, 0, []
        for end, (size, best, guard) in self.automaton.iter_long(text):
            begin = end - size + 1
            if (size == 1 and text[end] in _UNSEEN) != unseen or guard and not guard(text, begin, words):
                continue
            out += [text[at:begin], best]
            at = end + 1
            changes += 1
        if not changes:
            return text, 0
        text = "".join([*out, text[at:]])
        return unicodedata.normalize("NFC", text) if words else text, changes

    def _in_word(self, text: str, at: int, words: list) -> bool:
        """Whether a letter of another script stands in a word that is written in Latin letters: with some of them, with
        letters of several scripts, or one that the corpus knows in Latin letters. Words of a script's own stay."""
        if not words:
            words += [(m.start(), m.end(), self._latin(m.group())) for m in _WORD.finditer(text)]
        return words[bisect_right(words, at, key=lambda w: w[0]) - 1][2]

    def _latin(self, word: str) -> bool:
        other = [c for c in word if c in _OTHER_SCRIPT]
        if not other or len(word) < 2:
            return False
        plain = "".join(c if c in _OTHER_SCRIPT else self.map.get(c, c) for c in word)
        latin = sum("a" <= c.lower() <= "z" or "À" <= c <= "ɏ" for c in plain)
        marks = sum("̀" <= c <= "ͯ" for c in plain)
        if latin + marks + sum(c in _OTHER_SCRIPT for c in plain) < len(plain):
            return False  # letters of its own script that look like no Latin ones
        new = "".join(_LATIN_OF.get(c, c) for c in word)
        scripts = {unicodedata.name(c, "?").split()[0] for c in other}
        return bool(latin) or len(scripts) > 1 or self.counts.get(new, 0) > self.counts.get(word, 0)

    def _no_indent(self, text: str, at: int, words: list) -> bool:
        """An ideographic space indents a paragraph when nothing but its like stands before it in its line."""
        line = max(text.rfind("\n", 0, at), text.rfind("\r", 0, at)) + 1
        return any(c != "\u3000" and c not in _INVISIBLE for c in text[line:at])

    def _joins_nothing(self, text: str, at: int, words: list) -> bool:
        """Joiners and tags of emoji have their place."""
        c, before, after = text[at], text[at - 1] if at else "", text[at + 1 : at + 2]
        if c == "\u200d" and _pictured(before) and _pictured(after) or c == "\ufe0f" and (_pictured(before) or after == "\u20e3"):
            return False
        return not (0xE0000 <= ord(c) <= 0xE007F and before and (_pictured(before) or ord(before) >= 0xE0000))


def _pictured(char: str) -> bool:
    """Whether a character is an emoji, or a part of one that a joiner may follow."""
    return bool(char) and (unicodedata.category(char) in ("So", "Sk") or char == "️" or char in "‼⁉↔↕♂♀©®™" or 0x1F000 <= ord(char) < 0x20000)


def _count_batches(batches):
    singles, words = np.zeros(0x110000, np.int64), Counter()
    for batch in batches:
        texts = [t for t in batch.column(0).to_pylist() if t]
        if not texts:
            continue
        joined = "\n".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        part = np.bincount(codes)
        singles[: len(part)] += part
        words.update(_WORD.findall(joined))
    points = np.flatnonzero(singles)
    grams = [*map(chr, points.tolist()), *words]
    yield pa.RecordBatch.from_arrays([pa.array([g.encode("utf-8", "replace").decode() for g in grams], pa.string()), pa.array([*singles[points].tolist(), *words.values()], pa.int64())], names=["_gram", "_n"])


def share_counts(contents: DataFrame):
    """Counts of characters and of words over a one-column table, as a broadcast.

    What is kept is bounded: single characters by Unicode, words by their share of all words.
    """
    grams = contents.mapInArrow(_count_batches, "_gram string, _n long").groupBy("_gram").agg(F.sum("_n").alias("_n"))
    total = grams.where(F.length("_gram") > 1).agg(F.sum("_n")).collect()[0][0] or 0  # one row
    kept = grams.where((F.length("_gram") == 1) | (F.col("_n") >= max(2, total * _MIN_SHARE))).collect()
    return contents.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, dict(map(tuple, kept))))


_REWRITERS: dict[str, Rewriter] = {}


def rewriter_of(shared) -> Rewriter:
    """The worker's rewriter for broadcast counts; only the latest is kept."""
    name, counts = shared.value
    if name not in _REWRITERS:
        _REWRITERS.clear()
        _REWRITERS[name] = Rewriter(counts)
    return _REWRITERS[name]


def unify(df: DataFrame, shared, keys: tuple[str, ...] = ("id",), content: str = "content", changed_only: bool = True) -> DataFrame:
    """(keys, unified, n_changes): contents in their consistent form, only those that change unless asked otherwise.

    Null and empty contents never change, repeated rows give repeated results, whole contents are read, an
    empty table gives an empty result, other columns don't matter. ``shared``: from :func:`share_counts`.
    """
    ship(df.sparkSession)
    rows = spread(df.select(*keys, content), *keys)

    def run(batches):
        rewriter = rewriter_of(shared)
        for batch in batches:
            texts = batch.column(len(keys)).to_pylist()
            hits = rewriter.candidates([t or "" for t in texts]) if texts else []
            at, unified, changes = [], [], []
            for i, text in enumerate(texts):
                new, n = rewriter.rewrite(text) if hits[i] else (text, 0)
                if n or not changed_only:
                    at.append(i)
                    unified.append(new)
                    changes.append(n)
            if at:
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(pa.array(at)) for k in range(len(keys))), pa.array(unified, pa.string()), pa.array(changes, pa.int32())],
                    names=[*keys, "unified", "n_changes"],
                )

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInArrow(run, f"{kinds}, unified string, n_changes int")
