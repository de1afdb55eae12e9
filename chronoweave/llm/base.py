"""What the operators of this subpackage share: registry, staging, Arrow batches, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chronoweave import session
from chronoweave.session import shared_folder

__all__ = ["QUERIES", "SQL", "query", "table", "stage", "shared_folder", "text_batches", "Words", "mix", "recording", "release"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CHUNK_BYTES = 2 << 20  # text bytes that one vectorised step works on

_RECORDED: list[list[str]] = []


def stage(df: DataFrame) -> DataFrame:
    """``session.stage``; inside ``recording`` the folder is noted."""
    staged = session.stage(df)
    for paths in _RECORDED:
        paths += staged.inputFiles()[:1]
    return staged


@contextmanager
def recording() -> Iterator[list[str]]:
    """A file of each table staged inside, for ``release`` once nothing reads them any more."""
    paths: list[str] = []
    _RECORDED.append(paths)
    try:
        yield paths
    finally:
        _RECORDED.remove(paths)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables by a file of theirs."""
    jvm = spark.sparkContext._jvm
    for file in paths:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("staged-"):
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of a query when it ends; only staged tables are read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def files_of(*tables: DataFrame) -> list[str]:
    """A file of each staged table, for ``release``."""
    return [file for t in tables for file in t.inputFiles()[:1]]


WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with at most ``limit`` bytes of text each, or one row."""
    for batch in batches:
        lengths = batch.column(column).cast(pa.binary())
        offsets = np.frombuffer(lengths.buffers()[1], np.int32)[lengths.offset : lengths.offset + len(lengths) + 1]
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, int(offsets[at]) + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = column.fill_null("").cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two multiply-xorshift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_ODD = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(256, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(1))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    out = np.ones(n + 1, np.uint64)
    out[1:] = np.uint64(base & 0xFFFFFFFFFFFFFFFF)
    np.multiply.accumulate(out, out=out)
    return out


def prefix_hash(raw: np.ndarray, base: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, powers) with which ``span_hash`` hashes any span of ``raw``.

    The polynomial is written with rising powers, prefix[i] = sum of value[j] * base**j
    for j < i, which one cumulative sum gives; a span is brought to power zero by the
    inverse of base (odd, so it has one modulo 2**64).
    """
    powers = _powers(base, len(raw))
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * powers[:-1], out=prefix[1:])
    return prefix, _powers(pow(base, -1, 1 << 64), len(raw))


def span_hash(hashed: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    prefix, inverse = hashed
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(_ODD))


class Words:
    """The words of a chunk of texts as arrays.

    text    index of the text of each word, ascending
    hash    64-bit hash of the word's bytes, letters A-Z in lower case
    start   byte offset of the word in its text
    end     byte offset after it
    first   position of each text's first word; one more entry closes the last text
    """

    def __init__(self, column: pa.Array) -> None:
        raw, offsets = text_bytes(column)
        inside = ~SPACE[raw]
        # A word never runs over the end of its text.
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts[heads] = inside[heads]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[tails] = inside[tails]
        start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.raw, self.offsets = raw, offsets
        self.text = np.searchsorted(offsets, start, "right") - 1
        self.hash = span_hash(prefix_hash(LOWER[raw]), start, end)
        self.start, self.end = start - offsets[self.text], end - offsets[self.text]
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every run of ``width`` words; shorter texts give one run of all words."""
        return shingle_hashes(self.hash, self.text, self.first, width)


def shingle_hashes(words: np.ndarray, text: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(words)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    counts = np.diff(first)
    length = np.minimum(counts, width)[text]
    at = np.arange(n)
    whole = at + length <= first[text + 1]
    at, length, owner = at[whole], length[whole], text[whole]
    out = length.astype(np.uint64) * np.uint64(_ODD)
    for i in range(width):
        used = np.minimum(at + i, n - 1)
        step = mix(out + words[used])
        out = np.where(i < length, step, out)
    return owner, out
