"""Reading files in a shuffled order with a buffer of bounded length, instead of a sort of the whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUFFER = 10_000  # rows


class _Shard:
    """One stretch of a file: a buffer, from which each new row pushes out a random other one."""

    def __init__(self, name: str, size: int) -> None:
        seeds = np.frombuffer(hashlib.sha256(name.encode()).digest(), np.uint32)
        self.random, self.size, self.held, self.place = np.random.default_rng(seeds), size, None, 0

    def push(self, batch: pa.RecordBatch) -> tuple[pa.Table, np.ndarray]:
        """The rows that a batch pushes out, and their places."""
        held = 0 if self.held is None else self.held.num_rows
        both = pa.Table.from_batches([batch]) if self.held is None else pa.concat_tables([self.held, pa.Table.from_batches([batch])])
        slots, out = list(range(held)), []
        free = max(self.size - held, 0)
        new = range(held, both.num_rows)
        slots += new[:free]
        # One number a row, so that the result does not depend on how rows are batched.
        for row, slot in zip(new[free:], (self.random.random(len(new[free:])) * self.size).astype(int).tolist(), strict=True):
            out.append(slots[slot])
            slots[slot] = row
        self.held = both.take(pa.array(slots, pa.int64())).combine_chunks()
        return both.take(pa.array(out, pa.int64())), self._places(len(out))

    def rest(self) -> tuple[pa.Table, np.ndarray]:
        held = self.held.take(self.random.permutation(self.held.num_rows))
        return held, self._places(held.num_rows)

    def _places(self, n: int) -> np.ndarray:
        self.place += n
        return np.arange(self.place - n, self.place)


def buffered_shuffle(files: DataFrame, seed: int = 0, buffer: int = BUFFER) -> DataFrame:
    """The rows of a DataFrame read from files, with ``shard`` and ``place``: their order in a seeded shuffle.

    A shard is what one task reads of one file. Shards stand in the order of a digest of seed, file and
    offset; inside a shard a row comes out at random from a buffer of so many rows, which
    later rows refill. Nothing is sorted or shuffled between tasks, a task holds one buffer, and
    a task that runs again gives the same rows the same places: they depend on seed, file, offset
    and buffer alone. As with any buffered shuffle, a row moves up by at most a buffer's length.

    ``files`` may drop, compute and filter columns, but must read files directly.
    """
    schema = T.StructType([*files.schema, T.StructField("shard", T.StringType()), T.StructField("place", T.LongType())])
    named = F.concat_ws("|", F.lit(seed), F.col("_metadata.file_path"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"))
    given = files.select("*", named.alias("__shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None

        def made(rows: pa.Table, places: np.ndarray) -> Iterator[pa.RecordBatch]:
            if rows.num_rows:
                shown = pa.array([hashlib.sha256(name.encode()).hexdigest()[:16]] * rows.num_rows)
                for b in rows.drop_columns(["__shard"]).append_column("shard", shown).append_column("place", pa.array(places)).combine_chunks().to_batches():
                    yield pa.RecordBatch.from_arrays(b.columns, names=schema.names)

        for batch in batches:
            names = batch.column("__shard").to_pylist()
            edges = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
            for a, b in zip(edges, edges[1:]):
                if names[a] != name:
                    if shard is not None:
                        yield from made(*shard.rest())
                    name = names[a]
                    shard = _Shard(name, buffer)
                yield from made(*shard.push(batch.slice(a, b - a)))
        if shard is not None:
            yield from made(*shard.rest())

    return given.mapInArrow(run, schema)


def iterate_shuffled(shuffled: DataFrame) -> Iterator[Row]:
    """The rows of ``buffered_shuffle`` in their order, one partition at a time."""
    ordered = shuffled.repartitionByRange("shard").sortWithinPartitions("shard", "place")
    return ordered.drop("shard", "place").toLocalIterator(prefetchPartitions=True)
