"""Token counting, ids, and batch collation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a token is a run of ASCII word characters or one other non-space character.
TOKEN_PATTERN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r]"

SLICE_BYTES = 2 << 20  # text that a Python hook gets at once


class Tokenizer(Protocol):
    """What the engine needs from a tokenizer."""

    def ids(self, text: Column) -> Column:
        """Token ids of a text."""

    def floor(self, piece: Column) -> Column:
        """A figure whose sum over the pieces of a text never exceeds its token count."""


class PatternTokenizer:
    """Tokens by pattern, ids by digest; stays in the JVM.

    No token spans a line end, so counts of whole lines add up exactly.
    """

    def __init__(self, vocabulary: int = 32_000, pattern: str = TOKEN_PATTERN):
        self.vocabulary = vocabulary
        self.pattern = pattern

    def tokens(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def count(self, text: Column) -> Column:
        return F.regexp_count(text, F.lit(self.pattern))

    floor = count

    def ids(self, text: Column) -> Column:
        def one(token: Column) -> Column:
            number = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")
            return (number % self.vocabulary).cast("int")

        return F.transform(self.tokens(text), one)


class HookTokenizer:
    """Any Python tokenizer, over Arrow batches.

    ``factory`` runs once per task and returns ``text -> list of ids``, or with ``batched`` a
    function of a list of texts to a list of such lists, which is called once per slice of a batch.
    A slice holds at most ``slice_bytes`` of text, or one text, so that a task keeps the texts
    and ids of one slice as Python objects, however many rows Spark puts into a batch.
    ``longest`` is the length in characters of the longest vocabulary entry; it
    gives the lower bound that lets overlong samples be cut before rendering.
    """

    def __init__(self, factory: Callable[[], Callable], longest: int, *, batched: bool = False, slice_bytes: int = SLICE_BYTES):
        self.factory = factory
        self.batched = batched
        self.longest = longest
        self.slice_bytes = slice_bytes

    def floor(self, piece: Column) -> Column:
        return F.length(piece) / F.lit(self.longest)

    def ids(self, text: Column) -> Column:
        factory, batched, limit = self.factory, self.batched, self.slice_bytes

        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokenizer = factory()
            for batch in batches:
                for held in text_slices(batch, limit):
                    texts = held.drop_null().to_pylist()
                    ids = iter(tokenizer(texts) if batched else [list(tokenizer(t)) for t in texts])
                    yield pa.array([next(ids) if known else None for known in held.is_valid().to_pylist()], pa.list_(pa.int32()))

        encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(encode, "array<int>")(text.cast("string"))


def text_slices(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """Consecutive slices of a string array, of at most ``limit`` bytes of text each, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = int(ends[at - 1]) if at else 0
        end = max(int(np.searchsorted(ends, done + limit, "right")), at + 1)
        yield texts.slice(at, end - at)
        at = end


def attention_mask(ids: str) -> Column:
    return F.transform(F.col(ids), lambda _: F.lit(1))


def pad_batches(
    df: DataFrame, batch: str, ids: str, *, pad_id: int = 0, ignore_id: int = -100, side: str = "right"
) -> DataFrame:
    """Pad each batch to its longest row; add the mask and the language-model labels.

    A batch is a fixed number of rows, so one window group is one batch. Labels
    are the ids, with padding replaced by ``ignore_id``; a real token that equals
    ``pad_id`` is ignored too, as in causal collation.
    """
    width = F.max(F.size(ids)).over(Window.partitionBy(batch))
    d = df.withColumn("width", width)
    gap = F.col("width") - F.size(ids)

    def fill(value: int, body: Column) -> Column:
        filler = F.array_repeat(F.lit(value), gap)
        return F.concat(filler, body) if side == "left" else F.concat(body, filler)

    labels = F.transform(F.col(ids), lambda t: F.when(t == pad_id, F.lit(ignore_id)).otherwise(t))
    return d.withColumns(
        {
            "input_ids": fill(pad_id, F.col(ids)),
            "attention_mask": fill(0, attention_mask(ids)),
            "labels": fill(ignore_id, labels),
        }
    )


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """Apply a function to Arrow record batches (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows each)."""

    def each(batches):
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(each, schema)
