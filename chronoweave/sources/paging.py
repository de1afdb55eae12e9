"""Pages and batches of an id-ordered table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.ordered import global_positions


def offset_page(df: DataFrame, order: Sequence[str], size: int, start: int = 0) -> DataFrame:
    """``size`` rows after the first ``start`` in ``order``."""
    return df.orderBy(*order).offset(start).limit(size)


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """``size`` rows with a key above ``after``; the bound reaches the scan."""
    return df.where(F.col(key) > F.lit(after)).orderBy(key).limit(size)


def page_count(df: DataFrame, size: int) -> DataFrame:
    """Row count and number of pages."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_rows"), F.ceil(n / size).alias("n_pages"))


def batches(df: DataFrame, order: Sequence[str], size: int, out: str = "batch", *, unique: bool = False) -> DataFrame:
    """Consecutive groups of ``size`` rows in ``order``; the last may be short. ``unique``: see ``global_positions``."""
    numbered = global_positions(df, order, "__position", unique=unique)
    return numbered.withColumn(out, F.floor((F.col("__position") - 1) / size)).drop("__position")
