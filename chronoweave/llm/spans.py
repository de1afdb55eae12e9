"""Cutting byte spans out of texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronoweave.llm.base import text_batches


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of [start, end) spans, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        elif start < end:
            out.append([start, end])
    return out


def cut_spans(texts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_removed, n_spans, kept_sha256, spans) from rows of (keys, text, spans of start and end in bytes)."""
    made = [
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
    schema = T.StructType([*(texts.schema[k] for k in keys), *made])
    types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data, cuts = text.as_py().encode(), merged([(s["start"], s["end"]) for s in spans.as_py()])
                sha, at = hashlib.sha256(), 0
                for start, end in cuts:
                    sha.update(data[at:start])
                    at = end
                sha.update(data[at:])
                out.append((sum(e - s for s, e in cuts), len(cuts), sha.hexdigest(), cuts))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *columns], names=schema.names)

    return texts.select(*keys, "text", "spans").mapInArrow(run, schema)
