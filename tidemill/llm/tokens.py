"""Problem 7: encode whole texts with a public byte-level BPE vocabulary by prefix dynamic programming.

Every byte prefix of a piece has exactly one valid last token: the token ``t`` that ends there, starts where
another prefix with last token ``p`` ends, and for which the pair ``(p, t)`` encodes to itself. Storing that
token for each prefix gives the exact encoding of the piece, lets text be appended without starting again,
and after an edit needs new work only until the stored tokens agree again.
"""

from __future__ import annotations

import base64
import os
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.runtime import ship, spread

# The published split pattern of the rank files and the folder of the vocabularies.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZER_DIR = "/opt/tokenizers"

class PairTable:
    """Ranks of a byte-level BPE vocabulary, with a trie and a memo of which token pairs stand."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # A node maps a byte to [child node, token that ends here or None].
        self.trie: dict[int, list] = {}
        for token, rank in ranks.items():
            node = self.trie
            for byte in token[:-1]:
                node = node.setdefault(byte, [{}, None])[0]
            node.setdefault(token[-1], [{}, None])[1] = rank
        self.memo: dict[int, bool] = {}

    @classmethod
    def parse(cls, data: bytes) -> PairTable:
        """From the lines of a rank file: a token in base64 and its rank."""
        ranks = {}
        for line in data.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        return cls(ranks)

    def merge(self, data: bytes) -> list[int]:
        """Plain merging by rank. Slow; used for pairs of tokens and as the reference in tests."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def stands(self, left: int, right: int) -> bool:
        """Whether the bytes of the two tokens, joined, encode to just these two tokens."""
        known = self.memo.get(left << 20 | right)
        if known is None:
            if len(self.memo) > 2_000_000:
                self.memo.clear()
            known = self.memo[left << 20 | right] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known


class PrefixState:
    """The unique valid last token of every byte prefix of one piece."""

    __slots__ = ("table", "data", "last")

    def __init__(self, table: PairTable, data: bytes = b""):
        self.table, self.data, self.last = table, b"", [None]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes at the end. Stored prefixes stay as they are; only tokens that end later are new."""
        old = len(self.data)
        self.data += data
        self.last += [None] * len(data)
        self._fill(max(0, old - self.table.longest), old, len(self.data))

    def cut(self, length: int) -> None:
        """Keep only the first ``length`` bytes; what is stored for them stays valid."""
        self.data = self.data[:length]
        del self.last[length + 1 :]

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of bytes ``start:end``; returns how many prefixes were computed again.

        Behind the edit, once as many prefixes in a row as the longest token has bytes hold the tokens that
        they held before, all later ones do too and are kept.
        """
        tail = self.last[end + 1 :]
        self.data = self.data[:start] + data + self.data[end:]
        self.last = self.last[: start + 1] + [None] * (len(self.data) - start)
        at = start + len(data)
        self._fill(max(0, start - self.table.longest), start, at)
        done, same = at - start, 0
        for k, token in enumerate(tail):
            self._fill(max(0, at + k + 1 - self.table.longest), at + k, at + k + 1)
            done += 1
            same = same + 1 if self.last[at + k + 1] == token else 0
            if same >= self.table.longest:
                self.last[at + k + 2 :] = tail[k + 1 :]
                break
        return done

    def _fill(self, begin: int, known: int, upto: int) -> None:
        """Set the last tokens of the prefixes ``known + 1 .. upto`` from tokens that start at ``begin`` or later."""
        data, last, trie, memo, stands = self.data, self.last, self.table.trie, self.table.memo, self.table.stands
        for i in range(begin, upto):
            before, node, j = last[i], trie, i
            while j < upto:
                step = node.get(data[j])
                if step is None:
                    break
                node, token = step
                j += 1
                if token is not None and j > known and last[j] is None:
                    if i == 0:
                        last[j] = token
                    else:
                        fits = memo.get(before << 20 | token)
                        if fits is None:
                            fits = stands(before, token)
                        if fits:
                            last[j] = token

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            token = self.last[at]
            out.append(token)
            at -= len(self.table.bytes_of[token])
        out.reverse()
        return out


def _class_table() -> np.ndarray:
    """For each code point: 1 a letter, 2 a number, 3 white space, 0 any other, as the split pattern has them."""
    import regex

    everything = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    table = np.zeros(0x110000, np.uint8)
    for number, kind in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
        for m in regex.finditer(kind, everything):
            table[ord(everything[m.start()]) : ord(everything[m.end() - 1]) + 1] = number
    return table


class Splitter:
    """The published split pattern as array operations over many texts at once.

    Runs of one class are pieces; a space before a run joins it; the last white space before a run stands
    alone; an apostrophe with s, t, m, d, re, ve or ll is a piece of its own.
    """

    def __init__(self):
        self.kinds = _class_table()

    def __call__(self, texts: list[str]) -> list[list[str]]:
        joined = "".join(texts)
        if not joined:
            return [[] for _ in texts]
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kinds[codes]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        first = np.zeros(len(codes) + 1, bool)
        first[bounds] = True
        starts = first.copy()
        starts[1:-1] |= kinds[1:] != kinds[:-1]
        at = np.flatnonzero(starts)
        begin, end = at[:-1], at[1:]
        kind = kinds[begin]
        blank = (kind == 3) & ~first[end]
        begin_b, end_b = begin[blank], end[blank]
        starts[end_b - 1] = True
        starts[end_b[codes[end_b - 1] == 32]] = False
        quote = np.flatnonzero((kind == 0) & (end - begin == 1) & (codes[begin] == 39) & starts[begin] & ~first[end])
        for k in quote[kind[np.minimum(quote + 1, len(kind) - 1)] == 1].tolist():
            word = int(end[k])
            tail = joined[word : word + 2]
            length = 1 if tail[0] in "stmd" else 2 if tail in ("re", "ve", "ll") and int(end[k + 1]) >= word + 2 else 0
            if length:
                starts[word] = False
                starts[word + length] = True
        at = np.flatnonzero(starts)
        where = np.searchsorted(at, bounds).tolist()
        at = at.tolist()
        pieces = [joined[a:b] for a, b in zip(at, at[1:])]
        return [pieces[a:b] for a, b in zip(where, where[1:])]


class Encoder:
    """Texts to ids: split by the vocabulary's pattern, each piece by its prefix states, pieces remembered.

    Between two characters that no token of the vocabulary spans, every encoding has a token boundary. Pieces
    are cut there, so that the states of short parts serve all pieces. ``remember`` bounds the memory for
    pieces seen before; it never changes a result.
    """

    def __init__(self, table: PairTable, remember: int = 300_000):
        self.table, self.remember, self.split = table, remember, Splitter()
        self._pieces: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self._spanned: dict[str, bool] = {}
        self._spans = {(t[max(0, k - 3) : k], t[k : k + 3]) for t in table.ranks for k in range(1, len(t))}

    def _is_spanned(self, pair: str) -> bool:
        """Whether some token can hold the end of the first character and the start of the second."""
        left, right = pair[0].encode("utf-8", "replace"), pair[1].encode("utf-8", "replace")
        if len(left) < 3 or len(right) < 3:
            return True  # whole words of such scripts are tokens; not worth cutting
        return any((left[-i:], right[:j]) in self._spans for i in (1, 2, 3) for j in (1, 2, 3))

    def _learn(self, pieces: set[str]) -> None:
        parts, spanned, ranks = self._parts, self._spanned, self.table.ranks
        if len(parts) > self.remember:
            parts.clear()
        for piece in pieces:
            rank = ranks.get(piece.encode("utf-8", "replace"))
            if rank is not None:
                self._pieces[piece] = array("i", [rank]).tobytes()
                continue
            out, begin = [], 0
            for k in range(1, len(piece) + 1):
                if k < len(piece):
                    pair = piece[k - 1 : k + 1]
                    is_spanned = spanned.get(pair)
                    if is_spanned is None:
                        is_spanned = spanned[pair] = self._is_spanned(pair)
                    if is_spanned:
                        continue
                part = piece[begin:k]
                ids = parts.get(part)
                if ids is None:
                    ids = parts[part] = array("i", PrefixState(self.table, part.encode("utf-8", "replace")).ids()).tobytes()
                out.append(ids)
                begin = k
            self._pieces[piece] = b"".join(out)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as 32-bit integers in native order; nothing for an empty and for a null text."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > 4_000_000:
                self._flush(group, out)
                group, size = [], 0
        self._flush(group, out)
        return out

    def _flush(self, group: list[str], out: list[bytes]) -> None:
        split = self.split(group)
        seen = {p for pieces in split for p in pieces}
        if len(self._pieces) > self.remember:
            self._pieces.clear()
        self._learn(seen.difference(self._pieces))
        get = self._pieces.__getitem__
        for pieces in split:
            out.append(b"".join(map(get, pieces)))

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; an empty list for an empty and for a null text. Special strings are ordinary text."""
        return array("i", self.encode_all([text])[0]).tolist()


class GrowingText:
    """A text that is appended to, with ids that stay exact. Only its last two pieces are split and encoded again."""

    def __init__(self, encoder: Encoder):
        self.encoder, self._pieces = encoder, []

    def append(self, more: str) -> None:
        # The pattern looks one character ahead, so an append can move the end of the last two pieces.
        tail = "".join(self._pieces[-2:]) + more
        self._pieces[-2:] = self.encoder.split([tail])[0]

    def ids(self) -> list[int]:
        return [i for piece in self._pieces for i in self.encoder.encode(piece)]


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(shared) -> Encoder:
    """The worker's encoder for a broadcast ``(name, rank file)``; built once per worker process."""
    name, data = shared.value
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(PairTable.parse(data))
    return _ENCODERS[name]


def shared_ranks(spark: SparkSession, vocabulary: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR):
    """The rank file as a broadcast. Its size, under 1 MB, is that of the vocabulary and not of the data."""
    path = os.path.join(tokenizer_dir, f"{vocabulary}.tiktoken")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast((path, file.read()))


def token_ids(spark: SparkSession, text: Column, vocabulary: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> Column:
    """Column of token ids of a string column, without special tokens; ``[]`` for empty and null texts."""
    from pyspark.sql.functions import arrow_udf

    ship(spark)
    shared = shared_ranks(spark, vocabulary, tokenizer_dir)

    @arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        parts = encoder_of(shared).encode_all(texts.to_pylist())
        ends = np.zeros(len(parts) + 1, np.int32)
        np.cumsum([len(p) // 4 for p in parts], out=ends[1:])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))

    return encode.asNondeterministic()(text)


def token_counts(spark: SparkSession, text: Column, vocabulary: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> Column:
    """Column of the number of tokens of a string column; 0 for empty and null texts. Ids never leave the worker."""
    from pyspark.sql.functions import arrow_udf

    ship(spark)
    shared = shared_ranks(spark, vocabulary, tokenizer_dir)

    @arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(p) // 4 for p in encoder_of(shared).encode_all(texts.to_pylist())], pa.int32())

    return count.asNondeterministic()(text)  # so that no filter above repeats the work


def encode_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(key, ids) of every row.

    Nulls and empty texts give an empty list, blank texts the ids of their blanks, equal texts equal ids; very
    long texts are encoded whole. Extra columns are ignored, an empty table gives an empty result. A map-only
    plan: no exchange beyond the spreading of a small single-split file.
    """
    spark = documents.sparkSession
    rows = spread(documents.select(F.col(key), F.col(text).alias("_text")), key)
    return rows.select(key, token_ids(spark, F.col("_text"), vocabulary, tokenizer_dir).alias("ids"))
