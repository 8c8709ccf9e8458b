"""Problem 1: text that passed through a wrong character encoding, found and restored by noisy-channel decoding.

A channel is a pair (written in T, read as W). For a stretch of text its bytes under W form a lattice: a
character that W can write gives its bytes, a replacement character or a dropped control gives a wildcard.
Viterbi search over all T characters that fit the lattice, under the corpus frequencies of characters and
character pairs, gives the most likely original. The stretch is damaged where that original is so much more
likely than what is written that no undamaged text explains it, or where characters are plainly lost.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
import uuid
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.runtime import checkpointed, ship, spread

# Readers that turn bytes into wrong characters, with the encodings that wrote them.
SINGLE_BYTE_READERS = ("cp1252", "latin-1", "cp1251", "mac_roman", "cp1250", "cp437", "koi8_r")
MULTI_BYTE_READERS = ("gb18030", "big5", "euc_kr", "shift_jis")
WRITERS = ("utf-8", "gb18030", "big5")
#: A pair of characters is kept in the language model when it makes up this share of all pairs, so the model
#: has at most 1 / MIN_SHARE pairs, and fewer single characters than Unicode has, however large the corpus is.
MIN_SHARE = 1e-6
_FLOOR = -16.0
#: States that the first pass keeps; it only gives a bound below which the second, exact pass drops states.
_BEAM = 6


@lru_cache
def _never_written() -> list[int]:
    """Code points that no writer uses: replacement, C1 controls, private use, unassigned."""
    return [p for p in range(0x80, sys.maxunicode + 1) if not 0xD800 <= p < 0xE000 and (p == 0xFFFD or 0x80 <= p < 0xA0 or unicodedata.category(chr(p)) in ("Co", "Cn"))]


_LOST_WORDS = re.compile("锟斤|斤拷|烫烫烫|屯屯屯|\\?{4,}")


@lru_cache
def _lost_points() -> frozenset:
    return frozenset(map(chr, _never_written()))


def losses(text: str) -> int:
    """How many places of a text hold what no writer writes."""
    lost = _lost_points()
    return sum(c in lost for c in text if c > "\x7f") + len(_LOST_WORDS.findall(text))


_UTF8_RUN = re.compile(rb"(?:[\xe4-\xe9][\x80-\xbf]{2}|\xef\xbc[\x80-\xbf]|\xe3\x80[\x80-\xbf]){3,}")
_IN_WORD = re.compile("(?<=[A-Za-z])[一-鿿](?![一-鿿])|(?<![一-鿿])[一-鿿](?=[a-z])")
_NON_ASCII = re.compile("[^\x00-\x7f]+(?:[\x00-\x7f]{1,12}[^\x00-\x7f]+)*")

_LOST_BIT, _LATIN_BIT, _ODD_BIT, _STRANGE_BIT, _HAN_BIT, _LETTER_BIT, _COMMON_BIT = (1 << k for k in range(7))


#: Ranges of code points: signs of single-byte readers, and scripts that Chinese and Western text doesn't mix in.
_ODD = ((0x80, 0x2AF), (0x2C6, 0x2DD), (0x400, 0x4FF), (0x201A, 0x201A), (0x201E, 0x201E), (0x2020, 0x2022), (0x2030, 0x203A), (0x20AC, 0x20AC), (0x2122, 0x2122), (0x2212, 0x22FF), (0x2500, 0x257F), (0x25A0, 0x25FF), (0xFB01, 0xFB02))
_STRANGE = ((0x3040, 0x30FF), (0x3105, 0x312F), (0x2220, 0x22FF), (0x2500, 0x257F), (0xAC00, 0xD7AF), (0x3400, 0x4DBF), (0x3220, 0x32CB), (0xFE30, 0xFE4F), (0xFF61, 0xFF9F))
_HAN = ((0x3400, 0x9FFF), (0xF900, 0xFAFF))


@lru_cache
def _classes() -> np.ndarray:
    """Bits of every code point."""
    table = np.zeros(0x110000, np.uint8)
    table[_never_written()] |= _LOST_BIT
    for bit, ranges in ((_LATIN_BIT, ((0x80, 0xFF),)), (_ODD_BIT, _ODD), (_STRANGE_BIT, _STRANGE), (_HAN_BIT, _HAN), (_LETTER_BIT, ((65, 90), (97, 122)))):
        for low, high in ranges:
            table[low : high + 1] |= bit
    return table


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each closed by a line end, and where each text begins."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=begins[1:])
    return codes, begins


def _any(hits: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(hits, begins).astype(bool)


def _runs_of_marks(codes: np.ndarray) -> np.ndarray:
    q = codes == 63
    out = np.zeros(len(codes), bool)
    out[:-3] = q[:-3] & q[1:-2] & q[2:-1] & q[3:]
    return out


class Frequencies:
    """Log probabilities of characters and character pairs over the whole corpus."""

    def __init__(self, singles: dict[str, int], pairs: dict[str, int]):
        total = sum(singles.values()) or 1
        self.one = {c: math.log(n / total) for c, n in singles.items()}
        self.common = {c for c, n in singles.items() if n * 200_000 >= total}
        self.two = {p: math.log(0.8 * n / singles[p[0]]) for p, n in pairs.items() if singles.get(p[0])}
        #: The most that a character can add to a log probability, whatever stands before it.
        self.most = {c: p - 1.6 for c, p in self.one.items()}
        for pair, p in self.two.items():
            if p > self.most.get(pair[1], -math.inf):
                self.most[pair[1]] = p
        self._fits: dict[str, dict] = {}
        self.classes = _classes().copy()
        self.classes[[ord(c) for c in self.common]] |= _COMMON_BIT
        self.known_pairs = np.array(sorted((ord(p[0]) << 21) | ord(p[1]) for p in pairs), np.int64)

    def step(self, before: str, char: str) -> float:
        found = self.two.get(before + char)
        return found if found is not None else self.one.get(char, _FLOOR) - 1.6

    def score(self, text: str) -> float:
        """Log probability of a text; unseen characters have a floor."""
        before, total = "", 0.0
        for c in text:
            total += self.step(before, c)
            before = c
        return total

    def mean(self, text: str) -> float:
        """Mean log probability of the characters that are not ASCII."""
        high = [self.one.get(c, _FLOOR) for c in text if c > "\x7f"]
        return sum(high) / len(high) if high else 0.0

    def fits(self, writer: str) -> dict[tuple, list[tuple[str, int]]]:
        """Characters and their lengths by their bytes with one byte unknown (None) or missing, the frequent first."""
        index = self._fits.get(writer)
        if index is None:
            index = defaultdict(list)
            for char in sorted(self.one, key=self.one.get, reverse=True):
                if char <= "\x7f" or char == "�":
                    continue
                try:
                    data = char.encode(writer)
                except UnicodeEncodeError:
                    continue
                size = len(data)
                index[tuple(data)].append((char, size))
                if 2 <= size <= 3:
                    for k in range(size):
                        index[(*data[:k], None, *data[k + 1 :])].append((char, size))
                        if size > 2:
                            index[(*data[:k], *data[k + 1 :])].append((char, size))
            self._fits[writer] = index
        return index


@lru_cache(maxsize=200_000)
def _char_bytes(char: str, reader: str) -> tuple[int | None, ...]:
    if char == "�":
        return (None,)
    try:
        return tuple(char.encode(reader))
    except UnicodeEncodeError:
        if char < "\u0100":  # many readers pass controls through unchanged
            return (ord(char),)
        return (None,) if reader == "cp1252" else _char_bytes(char, "cp1252")


def to_bytes(text: str, reader: str) -> list[int | None]:
    """The byte lattice of a stretch read with ``reader``; None for a byte that is lost."""
    return [b for c in text for b in _char_bytes(c, reader)]


def _options(lattice: list[int | None], writer: str, freq: Frequencies) -> list[list[tuple[int, str, float]]]:
    """For every position the (width, character, cost) of all characters that fit there."""
    fits, n = freq.fits(writer), len(lattice)
    widths = (2,) if writer in ("gb18030", "big5") else (2, 3)
    out = []
    for i, byte in enumerate(lattice):
        options: list[tuple[int, str, float]] = []
        sure = False
        if byte is not None and byte < 0x80:
            options.append((1, chr(byte), 0.0))
            sure = True
        else:
            for width in widths:
                if i + width > n:
                    break
                key = tuple(lattice[i : i + width])
                holes = key.count(None)
                for char, size in fits.get(key, ()):
                    options.append((width, char, -0.5 * holes - 5.0 * (size - width)))
                    sure = sure or not holes and size == width
        if not sure:
            options.append((1, "�", -9.0))
        out.append(options)
    return out


def viterbi(lattice: list[int | None], writer: str, freq: Frequencies, least: float = -math.inf) -> tuple[str, float, int]:
    """The most likely text that ``writer`` can have written as this lattice: (text, log probability, lost).

    A state is (position, last character). Bytes that fit no character cost a penalty and stay as U+FFFD. All
    characters that fit enter. A state is dropped only if the most that the rest can add, see ``bounds``, leaves
    it below a path that is known or below ``least``; a result that isn't above ``least`` need not be the likeliest.
    """
    n, options = len(lattice), _options(lattice, writer, freq)
    bounds = [-math.inf] * n + [0.0]
    for i in range(n - 1, -1, -1):
        bounds[i] = max((cost + (0.0 if char == "�" else freq.most.get(char, _FLOOR - 1.6)) + bounds[i + width] for width, char, cost in options[i]), default=-math.inf)
    if bounds[0] <= least:
        return "", -math.inf, n
    known = _search(options, freq, bounds, -math.inf, _BEAM)
    exact = _search(options, freq, bounds, max(least, known[1]) - 1e-6, None)
    return exact if exact[1] >= known[1] else known


def _search(options: list, freq: Frequencies, bounds: list[float], least: float, beam: int | None) -> tuple[str, float, int]:
    n, one, two = len(options), freq.one, freq.two
    states: list[dict[str, tuple[float, int, tuple | None]]] = [{} for _ in range(n + 1)]
    states[0][""] = (0.0, 0, None)
    for i in range(n):
        here = states[i]
        if beam is None:
            here = {c: state for c, state in here.items() if state[0] + bounds[i] >= least}
        elif len(here) > beam:
            here = dict(sorted(here.items(), key=lambda x: -x[1][0])[:beam])
        if not here:
            continue
        top = max(state[0] for state in here.values())
        for width, char, cost in options[i]:
            alone = 0.0 if char == "�" else one.get(char, _FLOOR) - 1.6
            if beam is None and top + cost + (alone if char == "�" else freq.most.get(char, alone)) + bounds[i + width] < least:
                continue
            target, best = states[i + width], None
            for before, (score, lost, _) in here.items():
                score += cost + (alone if char == "�" else two.get(before + char, alone))
                if best is None or score > best[0]:
                    best = (score, lost + (char == "�"), (i, before))
            old = target.get(char)
            if old is None or old[0] < best[0]:
                target[char] = best
    if not states[n]:
        return "", -math.inf, n
    char, (score, lost, back) = max(states[n].items(), key=lambda x: x[1][0])
    out = []
    while back is not None:
        out.append(char)
        at, char = back
        back = states[at][char][2]
    return re.sub("�+", "�", "".join(reversed(out))), score, lost


def _strict(text: str, reader: str, writer: str) -> str | None:
    try:
        return text.encode(reader).decode(writer)
    except (UnicodeError, ValueError):
        if reader == "cp1252":  # bytes that the reader has no character for come through as controls
            try:
                return bytes(b for b in to_bytes(text, reader)).decode(writer)
            except (UnicodeError, ValueError, TypeError):
                pass
        return None


class Decoder:
    """Finds and restores the damaged stretches of values."""

    def __init__(self, freq: Frequencies):
        self.freq = freq

    def suspects(self, texts: list[str]) -> np.ndarray:
        """For each text whether it can be damaged; every damaged one is among them. Array operations only."""
        if not texts:
            return np.zeros(0, bool)
        codes, begins = _codes(texts)
        bits = self.freq.classes[codes]
        hits = (bits & _LOST_BIT).astype(bool) | _runs_of_marks(codes)
        odd = (bits & (_LATIN_BIT | _ODD_BIT)).astype(bool)
        pairs = np.flatnonzero(odd[:-1] & (odd[1:] | (codes[1:] == 67)))
        if len(pairs):
            keys = (codes[pairs].astype(np.int64) << 21) | codes[pairs + 1]
            known = self.freq.known_pairs
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hits[pairs[known[at] != keys] if len(known) else pairs] = True
        han, letter = (bits & _HAN_BIT).astype(bool), (bits & _LETTER_BIT).astype(bool)
        hits[1:-1] |= han[1:-1] & ((letter[:-2] & ~han[2:]) | (letter[2:] & (codes[2:] > 96) & ~han[:-2]))
        strange = np.add.reduceat(((bits & _STRANGE_BIT) > 0).astype(np.int32), begins)
        rare = np.add.reduceat((han & ((bits & _COMMON_BIT) == 0)).astype(np.int32), begins)
        return _any(hits, begins) | (strange > 1) | (rare > 2)

    def decode_all(self, texts: list[str]) -> dict[int, tuple[str, int, int]]:
        """By position, what :meth:`decode` gives for the texts that are damaged."""
        out = {}
        for k in np.flatnonzero(self.suspects(texts)).tolist():
            found = self.decode(texts[k])
            if found[1]:
                out[k] = found
        return out

    def decode(self, text: str | None) -> tuple[str | None, int, int]:
        """(text with damaged stretches restored, damaged stretches, lost characters). Nulls and empty: none."""
        if not text or not self.suspects([text])[0]:
            return text, 0, 0
        parts = re.split("(\n+)", text)
        stretches = lost = 0
        for k in range(0, len(parts), 2):
            parts[k], s, gone = self._line(parts[k], len(parts) == 1)
            stretches += s
            lost += gone
        return "".join(parts), stretches, lost

    def _line(self, line: str, alone: bool) -> tuple[str, int, int]:
        if not line or line.isascii() and "????" not in line or not alone and not self.suspects([line])[0]:
            return line, 0, 0
        whole, stretches = line, 0
        for find in (self._pairs, self._words):
            whole, n = find(whole)
            stretches += n
        if not losses(whole) and not self._unlikely(whole):
            return whole, stretches, 0
        other, n, gone = self._lattice(line)
        if stretches and self.freq.score(other) <= self.freq.score(whole):
            return whole, stretches, losses(whole)
        return other, max(n, stretches), gone

    def _unlikely(self, text: str) -> bool:
        """Whether half the pairs of characters beyond ASCII are unknown to the corpus."""
        two, unknown, pairs, before = self.freq.two, 0, 0, ""
        for c in text:
            if c > "\x7f" and before > "\x7f":
                pairs += 1
                unknown += before + c not in two
            before = c
        return unknown > 2 and 2 * unknown > pairs

    def _gain(self, stretch: str, reader: str, writer: str) -> tuple[float, str] | None:
        """How much likelier the decoded stretch is than the written one, and the decoded text; None if it can't be."""
        decoded = _strict(stretch, reader, writer)
        if decoded is None or decoded == stretch:
            return None
        one = self.freq.one
        fresh = [c for c in decoded if c > "\x7f" and c not in one]
        if len(fresh) > 0.2 * len(decoded) or any(unicodedata.category(c) in ("Cc", "Co", "Cn") and not 0x80 <= ord(c) < 0xA0 for c in fresh):
            # a second round of damage shows as accented letters
            if not all(c < "\u0180" or c in "Œœ€‚„…†‡ˆ‰Š‹Ž‘’“”•–—˜™š›žŸƒ" for c in fresh):
                return None
        return self.freq.score(decoded) - self.freq.score(stretch), decoded

    def _again(self, text: str) -> str:
        """Undo further rounds of the same kind of damage."""
        for _ in range(2):
            if text.isascii() or not (_shape("cp1252", "utf-8").search(text) or _shape("latin-1", "utf-8").search(text) or _UTF8_RUN.search(text.encode("gb18030", "replace"))):
                return text
            best = max((g for w in ("cp1252", "latin-1", "gb18030") if (g := self._gain(text, w, "utf-8"))), default=None)
            if best is None or best[0] < 4:
                return text
            text = best[1]
        return text

    def _pairs(self, line: str) -> tuple[str, int]:
        """Stretches of which every byte is there: for each reader what it shows for whole sequences, best reader first."""
        found = 0
        covered = []
        for reader, writer in _SHAPES:
            if size := sum(len(m.group()) for m in _shape(reader, writer).finditer(line)):
                covered.append((size, reader, writer))
        ranked = []
        for _, reader, writer in sorted(covered, reverse=True):
            total = sum(max(0.0, g[0]) for m in _shape(reader, writer).finditer(line) if (g := self._gain(m.group(), reader, writer)) and g[0] >= 3)
            if total > 0:
                ranked.append((total, reader, writer))

        def fix(m: re.Match) -> str:
            nonlocal found
            got = self._gain(m.group(), reader, writer)
            if got is None or got[0] < 3:
                return m.group()
            found += 1
            return self._again(got[1])

        for _, reader, writer in sorted(ranked, reverse=True):
            line = _shape(reader, writer).sub(fix, line)
        if not line.isascii() and _UTF8_RUN.search(line.encode("gb18030", "replace")):
            line, n = self._multi(line, "gb18030")
            found += n
        return line, found

    def _multi(self, line: str, reader: str) -> tuple[str, int]:
        """Within each run of non-ASCII characters, the stretches whose bytes are UTF-8."""
        found, out, at = 0, [], 0
        for m in _NON_ASCII.finditer(line):
            data = m.group().encode(reader, "replace")
            for run in _UTF8_RUN.finditer(data):
                left = data[: run.start()].decode(reader, "ignore")
                stretch = run.group().decode(reader, "ignore")
                if not stretch or not m.group()[len(left) :].startswith(stretch):
                    continue
                got = run.group().decode("utf-8", "ignore")
                begin = m.start() + len(left)
                if begin >= at and self.freq.score(got) - self.freq.score(stretch) > 6:
                    found += 1
                    out += [line[at:begin], got]
                    at = begin + len(stretch)
        return "".join([*out, line[at:]]), found

    def _words(self, line: str) -> tuple[str, int]:
        """Accented letters of Latin words that a multi-byte reader took for Han characters."""
        found = 0

        def fix(m: re.Match) -> str:
            nonlocal found
            for reader in ("gb18030", "big5"):
                got = _strict(m.group(), reader, "utf-8")
                if got and len(got) == 1 and unicodedata.category(got) in ("Ll", "Lu") and "LATIN" in unicodedata.name(got, ""):
                    found += 1
                    return got
            return m.group()

        return (_IN_WORD.sub(fix, line), found) if _IN_WORD.search(line) else (line, 0)

    def _lattice(self, line: str) -> tuple[str, int, int]:
        """Sentences with losses or unlikely pairs: of all readers and writers, the likeliest original wins."""
        out, at, stretches, lost = [], 0, 0, 0
        for begin, end in self._damaged(line):
            stretch = line[begin:end]
            best: tuple[float, str, int] = (self.freq.score(stretch), stretch, 0)
            least = best[0] + 6
            for lattice, writer in self._candidates(stretch):
                text, score, gone = viterbi(lattice, writer, self.freq, least)
                if score > least:
                    least, best = score, (score, text, gone)
            if best[1] != stretch:
                stretches += 1
                lost += best[2]
            elif gone := losses(stretch):
                stretches += 1
                lost += gone
            out += [line[at:begin], best[1]]
            at = end
        return "".join([*out, line[at:]]), stretches, lost

    def _damaged(self, line: str) -> list[tuple[int, int]]:
        spans: list[tuple[int, int]] = []
        for m in re.finditer("[^。！？；]*[。！？；]?", line):
            sentence = m.group()
            if sentence and (losses(sentence) or self._unlikely(sentence)):
                if spans and spans[-1][1] == m.start():
                    spans[-1] = (spans[-1][0], m.end())
                else:
                    spans.append((m.start(), m.end()))
        return spans

    def _candidates(self, stretch: str) -> list[tuple[list[int | None], str]]:
        """The lattices and writers of all channels whose reader can have written most of the stretch, each once."""
        high = [c for c in stretch if c > "\x7f" and c != "�"]
        if len(high) < 3 or stretch.count("�") > 2 * len(high):
            return []  # nothing left to decode
        ranked = {}
        for reader in (*SINGLE_BYTE_READERS, *MULTI_BYTE_READERS):
            if sum(_writes(reader, c) for c in high) < 0.8 * len(high):
                continue
            lattice = to_bytes(stretch, reader)
            data = bytes(b if b is not None else 0xFF for b in lattice)
            for writer in WRITERS:
                if writer != reader:
                    good = sum(c in self.freq.common for c in data.decode(writer, "ignore") if c > "\x7f")
                    ranked.setdefault((tuple(lattice), writer), (good / (len(data) + 1), reader))
        # the likeliest come first, as a good one lets the bound drop others early
        return [(list(lattice), writer) for (lattice, writer), _ in sorted(ranked.items(), key=lambda x: (x[1], x[0][1]), reverse=True)]


@lru_cache(maxsize=100_000)
def _writes(reader: str, char: str) -> bool:
    try:
        char.encode(reader)
        return True
    except UnicodeEncodeError:
        return ord(char) < 0x100


_SHAPES = [*((r, "utf-8") for r in SINGLE_BYTE_READERS), ("cp1252", "gb18030"), ("latin-1", "gb18030"), ("cp1252", "big5")]


@lru_cache
def _shape(reader: str, writer: str) -> re.Pattern:
    """What ``reader`` shows for whole multi-byte sequences of ``writer``, one after another with a little ASCII between."""

    def chars(low: int, high: int) -> str:
        out = set()
        for byte in range(low, high + 1):
            try:
                out.add(bytes([byte]).decode(reader))
            except UnicodeDecodeError:
                pass
            if reader in ("cp1252", "cp1250", "cp1251") and byte < 0xA0:
                out.add(chr(byte))
        return "".join(map(re.escape, sorted(out)))

    if writer == "utf-8":
        tail = f"[{chars(0x80, 0xBF)}]"
        unit = f"[{chars(0xC2, 0xDF)}]{tail}|[{chars(0xE0, 0xEF)}]{tail}{{2}}|[{chars(0xF0, 0xF4)}]{tail}{{3}}"
    else:
        unit = f"[{chars(0xA1, 0xF7)}][{chars(0xA1, 0xFE)}]" if writer == "gb18030" else f"[{chars(0xA1, 0xF9)}][{chars(0x40, 0x7E)}{chars(0xA1, 0xFE)}]"
    return re.compile(f"(?:{unit})+(?:[\\x00-\\x7f]{{1,12}}(?:{unit})+)*")


# ---- corpus frequencies ------------------------------------------------------------------------------------

def _count_batches(batches):
    classes = _classes()
    for batch in batches:
        texts = [t for column in batch.columns for t in column.to_pylist() if t]
        if not texts:
            continue
        codes, begins = _codes(texts)
        bits = classes[codes]
        bad = ((bits & _LOST_BIT) > 0) | _runs_of_marks(codes)
        latin = (bits & _LATIN_BIT) > 0
        bad[:-1] |= latin[:-1] & latin[1:]
        drop = _any(bad, begins)
        texts = [t for t, d in zip(texts, drop.tolist()) if not d and (t.isascii() or not _UTF8_RUN.search(t.encode("gb18030", "replace")))]
        if not texts:
            continue
        codes = _codes(texts)[0].astype(np.int64)
        pairs, n_pairs = np.unique((codes[:-1] << 21) | codes[1:], return_counts=True)
        single = np.bincount(codes)
        points = np.flatnonzero(single)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([-1 - points, pairs])), pa.array(np.concatenate([single[points], n_pairs]))], names=["_gram", "_n"]
        )


def corpus_counts(values: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """Character and pair counts over all values of all columns of ``values`` that are not plainly damaged.

    Counted in the cluster with a partial count per batch. What comes to the driver is bounded by ``MIN_SHARE``.
    """
    grams = values.mapInArrow(_count_batches, "_gram long, _n long").groupBy("_gram").agg(F.sum("_n").alias("_n"))
    grams = checkpointed(grams)
    rows = grams.where("_gram >= 0").agg(F.sum("_n")).collect()  # one row
    kept = grams.where((F.col("_gram") < 0) | (F.col("_n") >= max(2, (rows[0][0] or 0) * MIN_SHARE))).collect()
    return {chr(-1 - g): n for g, n in kept if g < 0}, {chr(g >> 21) + chr(g & 0x1FFFFF): n for g, n in kept if g >= 0}


# ---- operators ---------------------------------------------------------------------------------------------

_DECODERS: dict[str, Decoder] = {}


def decoder_of(shared) -> Decoder:
    """The worker's decoder for broadcast frequencies; only the latest is kept."""
    name, singles, pairs = shared.value
    if name not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[name] = Decoder(Frequencies(singles, pairs))
    return _DECODERS[name]


def share_frequencies(df: DataFrame, columns: tuple[str, ...] = ("title", "content")):
    """Counts of ``df``'s columns as a broadcast; its size is bounded by ``MIN_SHARE``."""
    return df.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, *corpus_counts(df.select(*columns))))


def restore_values(df: DataFrame, key: str = "id", columns: tuple[str, ...] = ("title", "content"), shared=None) -> DataFrame:
    """(key, field, restored, n_stretches, n_lost) of the values that are damaged.

    Nulls and empty texts are never damaged; repeated rows give repeated results; very long texts are decoded
    whole; an empty table gives an empty result; other columns don't matter. Lost characters that the corpus
    can't tell stay U+FFFD. ``shared``: frequencies from :func:`share_frequencies`, by default of ``df`` itself.
    """
    ship(df.sparkSession)
    rows = spread(df.select(key, *columns), key)
    shared = shared or share_frequencies(rows, columns=columns)

    def run(batches):
        decoder = decoder_of(shared)
        for batch in batches:
            keys, out = batch.column(0), []
            for k, name in enumerate(columns, 1):
                values = [v or "" for v in batch.column(k).to_pylist()]
                for i, (text, stretches, lost) in decoder.decode_all(values).items():
                    out.append((i, name, text.encode("utf-8", "replace").decode(), stretches, lost))
            if out:
                at, names, texts, stretches, losses = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at)), pa.array(names), pa.array(texts), pa.array(stretches, pa.int32()), pa.array(losses, pa.int32())],
                    names=["key", "field", "restored", "n_stretches", "n_lost"],
                )

    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, field string, restored string, n_stretches int, n_lost int").withColumnRenamed("key", key)
