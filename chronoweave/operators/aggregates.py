"""Aggregations: nested children, pivots, multiset difference, fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.ordered import ordered_scan


def nest_children(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    *,
    part_rows: int = 10_000,
    out: str = "rows",
) -> DataFrame:
    """Child rows of a key as ordered lists of records, ``part_rows`` to a list.

    A key with more rows continues in ``part`` 1, 2, ..., so that no list and no
    task holds an unbounded key. ``n_rows`` is the length of the part.
    """
    numbered = ordered_scan(df, keys, order, number="__rn")
    record = F.struct("__rn", *fields)
    parts = numbered.withColumn("part", F.floor((F.col("__rn") - 1) / part_rows))
    grouped = parts.groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(record)).alias("__list"), F.count(F.lit(1)).alias("n_rows")
    )
    plain = F.transform("__list", lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    return grouped.select(*keys, "part", "n_rows", plain.alias(out))


def nest_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Values of a key as one ordered list, for lists that are bounded by their meaning."""
    pairs = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("__v"))))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda r: r["__v"]).alias(out))


def pivot_first(
    df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One column per name, holding the first non-null value in ``order``.

    The names are given, so no job is needed to find them.
    """
    rank = F.struct(*order)
    columns = [
        F.min_by(F.col(value), F.when((F.col(name) == n) & F.col(value).isNotNull(), rank)).alias(n) for n in names
    ]
    return df.groupBy(*keys).agg(*columns)


def spread_attributes(df: DataFrame, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Each row fills the column that its own name selects; rows are not collapsed.

    A null name fills nothing.
    """
    columns = [F.when(F.col(name) == n, F.col(value)).alias(n) for n in names]
    return df.select("*", *columns).drop(name, value)


def symmetric_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that occur exactly once in both inputs taken together."""
    columns = old.columns
    both = old.unionByName(new)
    counted = both.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    return counted.where(F.col("__n") == 1).drop("__n")


def linear_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope and intercept of y on x."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def project_capacity(fit: DataFrame, budget: float, at: float) -> DataFrame:
    """x at which the fitted line reaches ``budget``, and its value at ``at``."""
    return fit.withColumns(
        {
            "x_at_budget": (F.lit(float(budget)) - F.col("intercept")) / F.col("slope"),
            "y_at_x": F.col("intercept") + F.col("slope") * F.lit(float(at)),
        }
    )
