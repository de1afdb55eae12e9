"""Removal of long repeated byte strings by a depth-limited radix sort of suffixes.

A position is repeated if the ``depth`` bytes from it on also start anywhere else. Sorting
suffixes by most-significant digits, only ``depth`` bytes deep, and dropping every group
of one after each pass leaves exactly these positions. Done for each single position
that would shuffle the corpus many times over, so the passes are arranged by what they cost:

1. The first digit of a position is a content-defined 64-byte string within its next
   ``depth`` bytes: the one with the least hash, leftmost first. Equal strings choose the
   same one at the same distance, so it may stand for the most significant digit, and
   one row serves the run of neighbouring positions that choose it (about 170 of them).
   Runs whose digit occurs once hold no repeated position and leave.
2. Runs that are equal over all their bytes are repeated as a whole.
3. The positions of the other runs are sorted within the groups of equal first digit and
   distance, in passes of 100 bytes; groups of one leave after each pass. A digit with
   more than ``crowd`` different runs is not gathered: its positions are counted by a
   digest of all passes.

``n_repeated`` looks for shorter repeats, and removes nothing: every ``NEAR`` bytes in a row hold
at least one content-defined string of ``DIGIT`` bytes, and equal bytes choose equal strings, so
bytes of such strings that occur elsewhere are counted wherever ``NEAR`` or more bytes repeat.

Matches never cross texts, and are judged on the input. Digits are compared by 64-bit
hashes (two independent ones for whole runs).

Defined results: null is empty; texts shorter than ``depth`` bytes stay whole; overlaps of a
text with itself count; repeated rows repeat each other. Very long texts are cut into runs as
they are, whose number grows with their length. An empty table gives no rows. Input columns
named like an output are replaced, also if one of them is the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import files_of, mix, prefix_hash, query, release, shuffles_dropped, span_hash, stage, table, text_batches, text_bytes
from chronoweave.llm.chunks import _covered
from chronoweave.llm.groups import group_bounds, map_groups
from chronoweave.llm.spans import cut_spans

DEPTH = 400
DIGIT = 64
NEAR = 256
PASS = 100
CROWD = 4096
WINDOWS = 1 << 20  # positions that one step sorts
SLICE = 1 << 19  # text bytes that one step cuts into runs, at some 100 bytes of memory each
_OTHER_BASE = 0xBF58476D1CE4E5B9
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` neighbouring ones: prefix and suffix minima of blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def runs_of(raw: np.ndarray, offsets: np.ndarray, depth: int, digit: int) -> dict[str, np.ndarray]:
    """The runs of neighbouring positions with the same first digit, as parallel arrays.

    text, at (place of the digit in the text), lo and hi (least and largest distance from a
    position to the digit), digit (its hash), whole (hash of all bytes of the run).
    """
    lengths = np.diff(offsets)
    long = np.flatnonzero(lengths >= depth)
    if not len(long):
        return {}
    grams = len(raw) - digit + 1
    hashed = prefix_hash(raw)
    place = np.arange(grams)
    gram = span_hash(hashed, place, place + digit)
    keys = (gram & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64)
    chosen = _window_min(keys, depth - digit + 1)
    counts = lengths[long] - depth + 1
    first = np.cumsum(counts) - counts
    position = np.arange(counts.sum()) + np.repeat(offsets[long] - first, counts)
    text = np.repeat(long, counts)
    anchor = (chosen[position] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.ones(len(position), bool)
    starts[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], len(position)) - 1
    a, t = anchor[begin], text[begin]
    lo, hi = a - position[end], a - position[begin]
    whole = span_hash(prefix_hash(raw, _OTHER_BASE), position[begin], position[end] + depth)
    whole = mix(whole ^ mix(lo.astype(np.uint64) * _STEP + hi.astype(np.uint64)))
    return {"text": t, "at": a - offsets[t], "lo": lo, "hi": hi, "digit": gram[a], "whole": whole}


def _runs(docs: DataFrame, depth: int, digit: int) -> DataFrame:
    """(body, at, lo, hi, digit, whole) of all texts; body is the digest of the text."""
    schema = T.StructType(
        [
            T.StructField("body", T.BinaryType()),
            T.StructField("at", T.LongType()),
            T.StructField("lo", T.IntegerType()),
            T.StructField("hi", T.IntegerType()),
            T.StructField("digit", T.LongType()),
            T.StructField("whole", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", SLICE):
            found = runs_of(*text_bytes(batch.column("text")), depth, digit)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("body").take(pa.array(found["text"])),
                        pa.array(found["at"]),
                        pa.array(found["lo"].astype(np.int32)),
                        pa.array(found["hi"].astype(np.int32)),
                        pa.array(found["digit"].view(np.int64)),
                        pa.array(found["whole"].view(np.int64)),
                    ],
                    names=schema.names,
                )

    return docs.select("body", "text").mapInArrow(run, schema)


def _recurring(rows: DataFrame, files: int) -> DataFrame:
    """The rows of a staged table whose digit is there more than once.

    These digits are staged too: then both sides of the join come straight from a shuffle, and a
    digit that very many rows have is split over several tasks.
    """
    often = rows.groupBy("digit").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("digit")
    return rows.join(stage(often.coalesce(files)), "digit")


def _cut(texts: DataFrame, depth: int) -> DataFrame:
    """(run, digit, n, crowded, lo, hi, bytes) for every wanted run of a text."""
    schema = T.StructType(
        [
            T.StructField("run", T.LongType()),
            T.StructField("digit", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("crowded", T.BooleanType()),
            T.StructField("lo", T.IntegerType()),
            T.StructField("hi", T.IntegerType()),
            T.StructField("bytes", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
                data = text.as_py().encode()
                rows = wanted.as_py()
                made = [data[r["at"] - r["hi"] : r["at"] - r["lo"] + depth] for r in rows]
                columns = [pa.array([r[f.name] for r in rows]) for f in schema.fields[:4]]
                columns += [pa.array([r[c] for r in rows], pa.int32()) for c in ("lo", "hi")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())], names=schema.names)

    return texts.select("text", "wanted").mapInArrow(run, schema)


def _positions(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, tuple, np.ndarray]:
    """(row, distance, hashed bytes, start) of every position of the runs in a chunk."""
    column = chunk.column("bytes")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw, offsets = text_bytes(column)
    lo, hi = chunk.column("lo").to_numpy().astype(np.int64), chunk.column("hi").to_numpy().astype(np.int64)
    counts = hi - lo + 1
    row = np.repeat(np.arange(len(lo)), counts)
    along = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, hi[row] - along, prefix_hash(raw), offsets[:-1][row] + along


def repeated_positions(chunk: pa.Table, depth: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, distance) of the positions left after all passes over whole groups of ``digit``."""
    row, distance, hashed, start = _positions(chunk)
    weight = chunk.column("n").to_numpy()
    group = mix(mix(chunk.column("digit").to_numpy().view(np.uint64)[row]) + distance.astype(np.uint64) * _STEP)
    for begin in range(-step, depth, step):
        if begin >= 0:
            digit = span_hash(hashed, start + begin, start + min(begin + step, depth))
            group = mix(group + digit)
        _, group_index = np.unique(group, return_inverse=True)
        kept = np.bincount(group_index, weight[row])[group_index] > 1
        row, distance, start, group = row[kept], distance[kept], start[kept], group[kept]
    return row, distance


def _ranges(run: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    """(run, lo, hi): neighbouring distances of a run joined."""
    order = np.lexsort((distance, run))
    run, distance = run[order], distance[order]
    starts = np.ones(len(run), bool)
    starts[1:] = (run[1:] != run[:-1]) | (distance[1:] != distance[:-1] + 1)
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], len(run))[: len(begin)] - 1
    arrays = [pa.array(run[begin]), pa.array(distance[begin].astype(np.int32)), pa.array(distance[end].astype(np.int32))]
    return pa.RecordBatch.from_arrays(arrays, names=["run", "lo", "hi"])


RANGE = T.StructType([T.StructField("run", T.LongType()), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])


def _sorted_groups(runs: DataFrame, depth: int, step: int) -> DataFrame:
    def run(chunk: pa.Table) -> pa.RecordBatch | None:
        bounds = group_bounds(chunk.column("digit"))
        positions = np.concatenate([[0], np.cumsum(chunk.column("hi").to_numpy() - chunk.column("lo").to_numpy() + 1)])
        made, at = [], 0
        while at < len(bounds) - 1:
            end = int(np.searchsorted(positions[bounds], positions[bounds[at]] + WINDOWS, "right")) - 1
            end = max(end, at + 1)
            part = chunk.slice(int(bounds[at]), int(bounds[end] - bounds[at]))
            row, distance = repeated_positions(part, depth, step)
            made.append(_ranges(part.column("run").to_numpy()[row], distance))
            at = end
        return pa.Table.from_batches(made).combine_chunks().to_batches()[0] if sum(m.num_rows for m in made) else None

    return map_groups(runs, "digit", [], run, RANGE)


def _counted(runs: DataFrame, depth: int, step: int) -> DataFrame:
    """The same for crowded digits: positions as rows, counted by a digest of all passes."""
    schema = T.StructType(
        [T.StructField("run", T.LongType()), T.StructField("n", T.LongType()), T.StructField("d", T.IntegerType()), T.StructField("key", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = pa.Table.from_batches([batch.slice(at, 1024)])
                row, distance, hashed, start = _positions(part)
                key = mix(mix(part.column("digit").to_numpy().view(np.uint64)[row]) + distance.astype(np.uint64) * _STEP)
                for begin in range(0, depth, step):
                    key = mix(key + span_hash(hashed, start + begin, start + min(begin + step, depth)))
                columns = [part.column(c).combine_chunks().take(pa.array(row)) for c in ("run", "n")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(distance.astype(np.int32)), pa.array(key.view(np.int64))], names=schema.names
                )

    rows = runs.mapInArrow(run, schema)
    often = rows.groupBy("key").agg(F.sum("n").alias("total")).where("total > 1").select("key")
    return rows.join(often, "key").select("run", F.col("d").alias("lo"), F.col("d").alias("hi"))


def body_of(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def repeated_spans(docs: DataFrame, text: str = "text", depth: int = DEPTH, digit: int = DIGIT, step: int = PASS, crowd: int = CROWD) -> DataFrame:
    """(body, n_removed, n_spans, kept_sha256, spans) of every different text with something repeated.

    body is the MD5 of the text; spans are maximal [start, end) byte ranges in order.
    """
    texts = docs.select(body_of(text).alias("body"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = texts.where(F.octet_length("text") >= depth)
    runs = stage(_runs(texts, depth, digit))
    files = max(1, len(runs.inputFiles()))  # no table below is larger than the texts, or needs more files than they have parts
    alive = stage(_recurring(runs, files).coalesce(files))
    # Equal runs are one class; a class of several rows is repeated as a whole.
    first = F.min(F.struct("body", "at")).alias("first")
    classes = alive.groupBy("digit", "whole").agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), first)
    classes = stage(classes.withColumn("run", F.monotonically_increasing_id()).coalesce(files))
    crowds = classes.groupBy("digit").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 AND least = 1")
    open_ = classes.join(crowds.select("digit", (F.col("m") > crowd).alias("crowded")), "digit")
    wanted = open_.select(F.col("first.body").alias("body"), F.struct("run", "digit", "n", "crowded", "lo", "hi", F.col("first.at").alias("at")).alias("w"))
    wanted = wanted.groupBy("body").agg(F.collect_list("w").alias("wanted"))  # at most one run for each byte of a text
    touched = alive.select("body").distinct()
    whole = texts.join(touched, "body", "left_semi").groupBy("body").agg(F.first("text").alias("text"))
    whole = stage(whole.join(wanted, "body", "left").coalesce(files))
    cut = stage(_cut(whole.where("wanted IS NOT NULL"), depth))
    found = _sorted_groups(cut.where("NOT crowded"), depth, step).unionByName(_counted(cut.where("crowded"), depth, step))
    found = found.join(classes.where("n = 1").select("run", "digit", "whole"), "run").select("digit", "whole", "lo", "hi")
    found = found.unionByName(classes.where("n > 1").select("digit", "whole", "lo", "hi"))
    # Equal texts have equal runs, which are counted above; here one of each is enough.
    spans = alive.select("digit", "whole", "body", "at").distinct().join(found, ["digit", "whole"])
    span = F.struct((F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + depth).alias("end"))
    spans = spans.groupBy("body").agg(F.collect_list(span).alias("spans"))  # at most one for each byte of a text
    return cut_spans(whole.select("body", "text").join(spans, "body"), ["body"])


def repeated_bytes(docs: DataFrame, text: str = "text", near: int = NEAR, digit: int = DIGIT) -> DataFrame:
    """(body, n_repeated) of every different text of at least ``near`` bytes with a chosen string that occurs elsewhere."""
    texts = docs.select(body_of(text).alias("body"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    strings = stage(_runs(texts.where(F.octet_length("text") >= near), near, digit).select("digit", "body", F.col("at").cast("int").alias("at")))
    files = max(1, len(strings.inputFiles()))
    held = _recurring(strings, files).select("body", F.col("at").alias("start"), (F.col("at") + digit).alias("end")).distinct()
    spans = held.groupBy("body").agg(F.collect_list(F.struct("start", "end")).alias("seen"))  # at most one for each byte of a text
    counted = stage(spans.select("body", _covered("seen").alias("n_repeated")).coalesce(files))
    release(docs.sparkSession, files_of(strings))
    return counted


def remove_repeats(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with ``spans`` (byte ranges to remove), n_bytes, n_repeated, n_removed, n_spans and kept_sha256."""
    made = ("n_bytes", "n_repeated", "n_removed", "n_spans", "kept_sha256", "spans")
    full = F.coalesce(F.col(text).cast("string"), F.lit(""))
    with shuffles_dropped(docs.sparkSession):
        near = repeated_bytes(docs, text).withColumnRenamed("n_repeated", "__near")
        results = repeated_spans(docs, text, **options)
        results = stage(results.coalesce(max(1, len(near.inputFiles()))))
    results = results.select(*[F.col(c).alias(f"__{c}") for c in results.columns])
    results = results.join(near.withColumnRenamed("body", "__body"), "__body", "full")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in made], body_of(text).alias("__body"),
        F.octet_length(full).cast("long").alias("n_bytes"), F.sha2(full, 256).alias("__all"),
    )
    joined = rows.join(results, "__body", "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in made],
        "n_bytes",
        F.coalesce("__near", F.lit(0)).cast("long").alias("n_repeated"),
        F.coalesce("__n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("__n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("__kept_sha256", "__all").alias("kept_sha256"),
        F.coalesce("__spans", F.array().cast("array<array<bigint>>")).alias("spans"),
    )


@query("op8_suffix_repeats")
def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_bytes", "n_repeated", "n_removed", "n_spans", "kept_sha256")
