"""Groups that Spark has sorted into partitions, read as whole groups per Arrow chunk."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Chunks of sorted rows that hold every group of ``key`` they touch completely."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = pc.not_equal(batch.column(key).slice(1), batch.column(key).slice(0, batch.num_rows - 1))
        last = np.flatnonzero(changes.to_numpy(zero_copy_only=False))
        cut = int(last[-1]) + 1 if len(last) else 0
        if held and (cut or held[-1].column(key)[-1] != batch.column(key)[0]):
            first = int(last[0]) + 1 if len(last) else 0
            if held[-1].column(key)[-1] != batch.column(key)[0]:
                first = 0
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
            held = []
            batch, cut = batch.slice(first), cut - first
        if not held and cut > 0:
            yield pa.Table.from_batches([batch.slice(0, cut)])
            batch = batch.slice(cut)
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def map_groups(
    df: DataFrame, key: str, order: Sequence[str], run: Callable[[pa.Table], pa.RecordBatch | None], schema: T.StructType
) -> DataFrame:
    """``run`` over chunks of whole groups of ``key`` (not null), rows sorted by key and ``order``.

    One worker holds one Arrow batch and one group; many small groups share a call,
    which spares the start of a function for each.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in whole_groups(batches, key):
            made = run(chunk.combine_chunks())
            if made is not None and made.num_rows:
                yield made

    dealt = df.repartition(key).sortWithinPartitions(key, *order)
    return dealt.mapInArrow(over, schema)


def group_bounds(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Start of every run of equal values, and the length at the end."""
    n = len(column)
    changes = pc.not_equal(column.slice(1), column.slice(0, max(n - 1, 0)))
    where = np.flatnonzero(changes.to_numpy() if isinstance(changes, pa.ChunkedArray) else changes.to_numpy(zero_copy_only=False))
    return np.concatenate([[0], where + 1, [n]]).astype(np.int64) if n else np.zeros(1, np.int64)
