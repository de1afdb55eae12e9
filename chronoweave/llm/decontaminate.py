"""Benchmark decontamination by pigeonhole edit matching.

Items and documents are read as words: runs of letters and digits, in lower case, so
that case, spacing and punctuation play no part. An item of m words may differ by
floor(m / 5) words put in, left out or changed. It is split into one piece more than that;
whatever the edits, one piece is left untouched, so every document that holds the item
holds a piece exactly. Piece hits come from rolling hashes of the document's words
against the sorted hashes of all pieces. Around each hit the least edit distance of the
item to any stretch of the document is found with Myers' bit-parallel algorithm; a
Python integer holds one bit for each word of the item, whatever its length.

The items are the stated query set, matched against all documents. Their pieces go to
the tasks in blocks of at most ``BLOCK_PIECES``; more items mean more passes over
the documents, not a larger block.

Defined results: null and wordless items match nothing; null, empty and wordless texts
hold nothing. Items shorter than five words must occur exactly. Repeated items and
documents are each reported. Without items, every document is clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import mix, query, table, text_batches

WORDS_PER_EDIT = 5
BLOCK_PIECES = 500_000

_WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def item_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def edits_allowed(words: int) -> int:
    return words // WORDS_PER_EDIT


def pieces(words: list[str]) -> list[tuple[int, int]]:
    """(start, end) of the pieces: one more than edits are allowed, as even as can be."""
    n = edits_allowed(len(words)) + 1
    cuts = [len(words) * i // n for i in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def myers_distance(masks: dict, m: int, text) -> int:
    """Least edit distance of a pattern of m symbols to any stretch of ``text``.

    masks has, for each symbol of the pattern, the bits of its places. Bit i of the
    vertical vectors says whether the distance grows or falls from row i to row i + 1.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    grows, falls = full, 0
    score = best = m
    for symbol in text:
        equal = masks.get(symbol, 0)
        vertical = equal | falls
        carry = (((equal & grows) + grows) ^ grows) | equal
        up = falls | (~(carry | grows) & full)
        down = grows & carry
        score += bool(up & top) - bool(down & top)
        best = min(best, score)
        up = (up << 1) & full  # a match may start anywhere, so row 0 stays at distance 0
        down = (down << 1) & full
        grows = down | (~(vertical | up) & full)
        falls = up & vertical
    return best


class _Items:
    """Pieces of a block of items as sorted hashes, by piece length."""

    def __init__(self, rows: list[tuple[object, str]]) -> None:
        self.ids, self.words, self.masks = [], [], []
        made: dict[int, list[tuple[int, int, int]]] = {}
        for key, text in rows:
            words = item_words(text)
            if not words:
                continue
            masks: dict[str, int] = {}
            for i, w in enumerate(words):
                masks[w] = masks.get(w, 0) | 1 << i
            for start, end in pieces(words):
                made.setdefault(end - start, []).append((_run_hash(words[start:end]), len(self.ids), start))
            self.ids.append(key)
            self.words.append(words)
            self.masks.append(masks)
        self.by_length = {}
        for length, found in made.items():
            found.sort()
            self.by_length[length] = tuple(np.array(c, t) for c, t in zip(zip(*found, strict=True), (np.uint64, np.int64, np.int64), strict=True))


def word_hashes(words: list[str], memo: dict[str, int]) -> np.ndarray:
    """64-bit hashes of words, with a memo that is emptied when it has grown large."""
    if len(memo) > 500_000:
        memo.clear()
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = memo.get(w)
        if h is None:
            h = memo[w] = int.from_bytes(w.encode()[:8].ljust(8, b"\0"), "little") if len(w.encode()) < 8 else _long_hash(w.encode())
        out[i] = h
    return mix(out)


def _long_hash(data: bytes) -> int:
    value = len(data)
    for b in data:
        value = (value * 0x100000001B3 ^ b) & 0xFFFFFFFFFFFFFFFF
    return value | 1 << 63


def _run_hash(words: list[str]) -> int:
    return int(rolling(word_hashes(words, {}), len(words))[0])


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words."""
    out = np.zeros(len(hashes) - length + 1, np.uint64)
    for i in range(length):
        out = mix(out ^ hashes[i : len(hashes) - length + 1 + i]) + _STEP
    return out


def _hits(words: list[str], hashes: np.ndarray, items: _Items) -> dict[int, int]:
    """Item index to least distance, for the items within their budget."""
    found: dict[int, int] = {}
    tried = set()
    for length, (sorted_hashes, item, start) in items.by_length.items():
        if length > len(hashes):
            continue
        runs = rolling(hashes, length)
        low = np.searchsorted(sorted_hashes, runs, "left")
        hit = np.flatnonzero(sorted_hashes[np.minimum(low, len(sorted_hashes) - 1)] == runs)
        for at in hit.tolist():
            p = int(low[at])
            while p < len(sorted_hashes) and sorted_hashes[p] == runs[at]:
                i, origin = int(item[p]), at - int(start[p])
                p += 1
                if found.get(i) == 0 or (i, origin) in tried:
                    continue
                tried.add((i, origin))
                m = len(items.words[i])
                k = edits_allowed(m)
                window = words[max(0, origin - k) : origin + m + k]
                distance = myers_distance(items.masks[i], m, window)
                if distance <= k:
                    found[i] = min(distance, found.get(i, distance))
    return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents with ``leaks``: an array of (item, distance), least item first; empty if clean. No shuffle."""
    rows = [(r[0], r[1]) for r in benchmark.select(item, item_text).where(F.col(item_text).isNotNull()).toLocalIterator()]
    element = T.StructType([T.StructField("item", benchmark.schema[item].dataType), T.StructField("distance", T.LongType())])
    blocks, size = [[]], 0
    for row in rows:
        size += edits_allowed(len(item_words(row[1]))) + 1
        if size > BLOCK_PIECES and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append(row)
    keep = [c for c in docs.columns if c != "leaks"]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("leaks", T.ArrayType(element))])
    base = docs.select(*[F.col(f"`{c}`") for c in keep], F.array().cast(T.ArrayType(element)).alias("leaks"))
    for block in blocks:
        base = base.mapInArrow(_matcher(block, text, base.schema), schema)
    ordered = F.array_sort("leaks")
    return base.withColumn("leaks", ordered)


def _matcher(block: list, text: str, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, memo = _Items(block), {}
        for batch in text_batches(batches, text):
            leaks = batch.column("leaks").to_pylist()
            if items.ids:
                for i, value in enumerate(batch.column(text).to_pylist()):
                    words = item_words(value)
                    if words:
                        found = _hits(words, word_hashes(words, memo), items)
                        leaks[i] = [*leaks[i], *({"item": items.ids[x], "distance": d} for x, d in found.items())]
            at = batch.schema.get_field_index("leaks")
            columns = [c if j != at else pa.array(leaks, batch.schema.field(at).type) for j, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item."""
    return find_leaks(docs, benchmark, **options).where(F.size("leaks") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op10_benchmark_leaks")
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.size("leaks").cast("long").alias("n_items"),
        F.transform("leaks", lambda x: x["item"]).alias("item_ids"),
        F.array_min(F.transform("leaks", lambda x: x["distance"])).alias("distance"),
        (F.size("leaks") > 0).alias("contaminated"),
    )
