"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of a text: each step doubles it and adds the random
number of the new byte, so its lowest 16 bits know the last 16 bytes. Where four of them are
zero is a candidate; a candidate that lies at least 12 bytes after the one before is a
border, so borders depend on nearby bytes only and come back a few bytes after an
insertion. Stretches without a border are cut every 512 bytes. A chunk runs from a border
to the first border at least 64 bytes on; chunks start at every border and so overlap,
which lets a passage be covered from its first border to its last, whatever surrounds it.
The closing chunk of a text ends at its end, from the last border at least 64 bytes before
it, or from the start of a shorter text; so chunks cover all bytes, and exact copies go whole.

Chunks are deduplicated by digest: the first one (by document id, then position) stays, all
later ones are removed. Chunks of 64 bytes and more do not repeat by chance; shorter ones are
whole texts and equal only those. A chunk that overlaps its own first occurrence loses only
what lies beyond that.

Defined results: null is empty; an empty text has no chunk; null ids come first. Rows
that repeat id and text are the same document. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import mix, prefix_hash, query, span_hash, stage, table, text_batches, text_bytes
from chronoweave.llm.spans import cut_spans

GEAR_BITS = 0xF000  # the bits that are zero at a candidate
APART = 12
LONGEST = 512
CHUNK = 64
_GEAR = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))


def gear(raw: np.ndarray) -> np.ndarray:
    """The gear hash of the last 16 bytes at every byte, by doubling the stretch four times."""
    h = _GEAR[raw].astype(np.uint32)
    for width in (1, 2, 4, 8):
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h = more
    return h


def borders(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of all borders, place after the byte that makes them; each text's ends are borders."""
    candidate = np.flatnonzero(gear(raw) & np.uint32(GEAR_BITS) == 0) + 1
    text = np.searchsorted(offsets, candidate - 1, "right") - 1
    place = candidate - offsets[text]
    good = place >= 16  # the hash of earlier bytes would reach into the text before
    text, place = text[good], place[good]
    before = np.zeros(len(place), np.int64)
    same = text[1:] == text[:-1]
    before[1:][same] = place[:-1][same]
    apart = place - before >= APART
    n = len(offsets) - 1
    ends = np.diff(offsets)
    text = np.concatenate([text[apart], np.arange(n), np.arange(n)])
    place = np.concatenate([place[apart], np.zeros(n, np.int64), ends])
    order = np.lexsort((place, text))
    text, place = text[order], place[order]
    # Cut long stretches evenly from their left border.
    gap = np.zeros(len(place), np.int64)
    gap[:-1] = np.where(text[1:] == text[:-1], place[1:] - place[:-1], 0)
    extra = np.maximum(gap - 1, 0) // LONGEST
    row = np.repeat(np.arange(len(place)), extra + 1)
    along = np.arange(len(row)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
    return text[row], place[row] + along * LONGEST


def chunks_of(raw: np.ndarray, offsets: np.ndarray, least: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of all chunks; together they cover every byte."""
    text, place = borders(raw, offsets)
    spot = offsets[text] + text + place  # texts set apart by one, so that a search stays inside
    end = np.searchsorted(spot, spot + least)
    inside = np.flatnonzero(end < len(spot))
    inside = inside[text[end[inside]] == text[inside]]
    text, start, end, lengths = text[inside], place[inside], place[end[inside]], np.diff(offsets)
    open_ = np.setdiff1d(np.flatnonzero(lengths), text[end == lengths[text]])
    last = np.searchsorted(spot, offsets[open_] + open_ + np.maximum(lengths[open_] - least, 0), "right") - 1
    return np.concatenate([text, open_]), np.concatenate([start, place[last]]), np.concatenate([end, lengths[open_]])


def _chunk_rows(docs: DataFrame, least: int) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("digest", T.LongType()),
            T.StructField("check", T.IntegerType()),
            docs.schema["id"],
            T.StructField("body", T.LongType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            raw, offsets = text_bytes(batch.column("text"))
            text, start, end = chunks_of(raw, offsets, least)
            a, b = offsets[text] + start, offsets[text] + end
            digest = span_hash(prefix_hash(raw), a, b)
            check = span_hash(prefix_hash(raw, 0xBF58476D1CE4E5B9), a, b)
            owner = pa.array(text)
            columns = [pa.array(digest.view(np.int64)), pa.array((check & np.uint64(0x7FFFFFFF)).astype(np.int32))]
            columns += [batch.column("id").take(owner), batch.column("body").take(owner)]
            columns += [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def deduplicate_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = CHUNK) -> DataFrame:
    """(key, n_bytes, n_repeated, n_removed, n_spans, kept_sha256, spans): one row per document.

    n_repeated counts the bytes in chunks that occur elsewhere, first ones too; spans are
    the byte ranges that are removed.
    """
    full = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(F.col(key).alias("id"), F.xxhash64(full).alias("body"), full.alias("text"))
    rows = _chunk_rows(slim, least)
    often = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    alive = stage(rows.join(often, "digest"))
    first = alive.groupBy("digest", "check").agg(F.min(F.struct("id", "body", "start", "end")).alias("first"), F.count(F.lit(1)).alias("n"))
    # Rows that repeat id and text have the same chunks, which are counted above; here one of each is enough.
    marked = alive.distinct().join(first.where("n > 1").select("digest", "check", "first"), ["digest", "check"])
    here = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("body") == F.col("first.body"))
    itself = here & (F.col("start") == F.col("first.start"))
    begin = F.when(here, F.greatest("start", "first.end")).otherwise(F.col("start"))
    span = F.struct(begin.alias("start"), "end")
    both = F.struct("start", "end")
    found = marked.groupBy("id", "body").agg(  # at most one chunk for each byte of a text
        F.collect_list(F.when(~itself & (begin < F.col("end")), span)).alias("spans"), F.collect_list(both).alias("seen")
    )
    found = stage(found.select(F.col("id").alias("__id"), F.col("body").alias("__body"), "spans", "seen"))
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("body") == F.col("__body"))
    touched = slim.join(found, same).groupBy("id", "body").agg(F.first("text").alias("text"), F.first("spans").alias("spans"), F.first("seen").alias("seen"))
    touched = touched.withColumn("n_repeated", _covered("seen"))
    cut = stage(cut_spans(touched, ["id", "body", "n_repeated"]))
    names = [c if c not in ("id", "body", "kept_sha256") else f"__{c}" for c in cut.columns]
    base = slim.select("id", "body", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("all_sha256"))
    joined = base.join(cut.toDF(*names), same, "left")
    return joined.select(
        F.col("id").alias(key),
        "n_bytes",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_repeated", "n_removed", "n_spans")],
        F.coalesce("__kept_sha256", "all_sha256").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"),
    )


def _covered(spans: str):
    """Bytes that a list of spans covers."""
    begin = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("n"))

    def add(state, s):
        fresh = F.greatest(s["end"] - F.greatest(s["start"], state["at"]), F.lit(0))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), (state["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(spans), begin, add, lambda z: z["n"])


@query("op7_chunk_dups")
def op7_chunk_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_chunks(table(spark, sf_dir, "documents")).drop("spans")
