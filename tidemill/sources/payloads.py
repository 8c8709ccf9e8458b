"""Landed payload files: bytes of unknown encoding to text."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import repair, script_score
from tidemill.runtime import ship, ship_active

# Encodings that Chinese pages come in, in the order in which they are tried.
ENCODINGS = ("utf-8", "gb18030", "gbk", "gb2312", "big5", "cp950")
_DECLARED = re.compile(rb"charset=[\"']?([A-Za-z0-9_\-]+)", re.I)
_UNSAID = {"iso-8859-1", "latin-1", "latin1", "windows-1252"}  # what servers claim when they don't know


def decode_bytes(data: bytes | None, declared: str | None = None) -> str | None:
    """The decoding, repaired, that looks most like proper Chinese; of equals the one tried first, declared ones before all."""
    if data is None:
        return None
    found = _DECLARED.search(data[:4096])
    tried = [declared, found.group(1).decode("ascii", "ignore") if found else None, *ENCODINGS]
    best, most = None, float("-inf")
    for encoding in dict.fromkeys(name for e in tried if e and (name := e.strip().lower()) not in _UNSAID):
        try:
            text = repair(data.decode(encoding))
        except (UnicodeError, LookupError):
            continue
        if (score := script_score(text)) > most:
            best, most = text, score
    return best if best else repair(data.decode("utf-8", "replace"))


def decoded(data: Column, declared: Column | None = None) -> Column:
    """Column of texts of a binary column; the codecs run in Arrow batches, because the JVM side has no such built-in."""

    ship_active()

    @F.arrow_udf("string")
    def run(values: pa.Array, names: pa.Array) -> pa.Array:
        return pa.array([decode_bytes(v, n) for v, n in zip(values.to_pylist(), names.to_pylist())], pa.string())

    return run(data, declared if declared is not None else F.lit(None).cast("string"))


def encoded(column: Column, encoding: str) -> Column:
    """The bytes of a text in an encoding; null where it can't say the text. The other way round of :func:`decoded`."""
    ship_active()

    @F.arrow_udf("binary")
    def run(values: pa.Array) -> pa.Array:
        out = []
        for v in values.to_pylist():
            try:
                out.append(None if v is None else v.encode(encoding))
            except UnicodeError:
                out.append(None)
        return pa.array(out, pa.binary())

    return run(column)


def read_payloads(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, as_of, payload) of landed files: decoded bytes and the time they were written."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("modificationTime").alias("as_of"), decoded(F.col("content")).alias("payload"))


def write_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.json(path, ignoreNullFields=False)


