"""Seeded splits that depend on ids only, so they survive any repartitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators.columns import at_most_tokens
from chronoweave.operators.ordered import global_positions, hash_positions

_SPAN = 16**8


def seeded_digest(key: str | Column, seed: int = 0) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def seeded_fraction(key: str | Column, seed: int = 0) -> Column:
    """A number in [0, 1) from an id."""
    return F.conv(F.substring(seeded_digest(key, seed), 1, 8), 16, 10).cast("bigint") / F.lit(_SPAN)


def split_by_hash(df: DataFrame, key: str, test_share: float, seed: int = 0) -> DataFrame:
    """Row-level split by id: narrow, no shuffle. Give a subject column to keep subjects whole."""
    side = F.when(seeded_fraction(key, seed) < test_share, "test").otherwise("train")
    return df.withColumn("split", side)


def split_chunks(
    df: DataFrame, order: Sequence[str], key: str, chunk: int, test_share: float, seed: int = 0, *, unique: bool = False
) -> DataFrame:
    """Exact split inside each run of ``chunk`` rows: the ceil(n * share) lowest digests are test.

    A chunk is a fixed number of rows, so ranking it is one small window group. ``unique``: see ``global_positions``.
    """
    numbered = global_positions(df, order, "__position", unique=unique)
    numbered = numbered.withColumn("chunk", F.floor((F.col("__position") - 1) / chunk)).drop("__position")
    sized = numbered.groupBy("chunk").agg(F.count(F.lit(1)).alias("__n"))
    inside = Window.partitionBy("chunk").orderBy(seeded_digest(key, seed), key)
    ranked = numbered.withColumn("__rank", F.row_number().over(inside))
    share = F.lit(str(test_share)).cast("decimal(18,9)")
    side = F.when(F.col("__rank") <= F.ceil(F.col("__n") * share), "test").otherwise("train")
    return ranked.join(sized, "chunk").withColumn("split", side).drop("__n", "__rank")


def shuffle_order(df: DataFrame, key: str, seed: int = 0, out: str = "position") -> DataFrame:
    """Rows with their place in a seeded shuffle of the whole table."""
    return hash_positions(df, seeded_digest(key, seed), [key], out=out)


def hold_out(df: DataFrame, key: str, share: float, seed: int = 0, position: str | None = None) -> DataFrame:
    """The first int(n * share) rows of the shuffle are validation, the rest train.

    ``position`` names a column for the place in the shuffle; None leaves it out.
    """
    placed = shuffle_order(df, key, seed, "__position")
    total = df.agg(F.count(F.lit(1))).scalar()
    bound = F.floor(total * F.lit(str(share)).cast("decimal(18,9)"))
    side = F.when(F.col("__position") <= bound, "validation").otherwise("train")
    split = placed.withColumn("split", side)
    return split.withColumnRenamed("__position", position) if position else split.drop("__position")


def training_data(
    rows: DataFrame, key: str, ids: str, *, max_tokens: int = 16_000, share: float = 0.1, seed: int = 0
) -> DataFrame:
    """Token rows of at most ``max_tokens``, in a seeded shuffle, with the first part held out.

    ``position`` is the place in the shuffle; sorting by it gives a reader its order.
    """
    return hold_out(rows.where(at_most_tokens(ids, max_tokens)), key, share, seed, position="position")


def validation_count(n: int, share: float) -> int:
    return math.floor(n * share)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
