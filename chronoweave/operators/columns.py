"""Projections, recodes and null-safe row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_listed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns; names that are absent are ignored."""
    return df.drop(*columns)


def keep_listed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in columns if c in present])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def recode(column: str | Column, codes: Mapping[str, str]) -> Column:
    """Code to label; a code without a label becomes null."""
    c = F.col(column) if isinstance(column, str) else column
    if not codes:
        return F.lit(None).cast("string")
    first, *rest = codes.items()
    chain = F.when(c == first[0], F.lit(first[1]))
    return reduce(lambda acc, kv: acc.when(c == kv[0], F.lit(kv[1])), rest, chain)


def not_denied(column: str, denied: Sequence[str]) -> Column:
    """True unless the value is one of ``denied``; a null value stays."""
    return ~F.coalesce(F.col(column).isin(*denied), F.lit(False))


def null_second_if_both(first: str, second: str) -> Column:
    """``second``, made null where ``first`` is set as well."""
    return F.when(F.col(first).isNull(), F.col(second))


def first_set(*columns: str) -> Column:
    return F.coalesce(*[F.col(c) for c in columns])


def drop_unset(df: DataFrame, subset: Sequence[str], how: str = "all") -> DataFrame:
    """Drop rows whose ``subset`` columns are null: all of them, or any of them."""
    return df.na.drop(how=how, subset=list(subset))


def trimmed(code: str) -> Column:
    return F.trim(F.col(code))


def midnight(date: str | Column) -> Column:
    """A date as the timestamp of its first instant."""
    c = F.col(date) if isinstance(date, str) else date
    return c.cast("date").cast("timestamp_ntz")


def whole_days(start: str, end: str) -> Column:
    """Full days from start to end, cut towards zero."""
    span = F.col(end).cast("timestamp_ntz") - F.col(start).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), span)


def shorter_than_days(start: str, end: str, days: int) -> Column:
    """Fewer than ``days`` whole days; an open end gives null, so the row is out."""
    return F.col(end).cast("timestamp_ntz") < F.col(start).cast("timestamp_ntz") + F.make_dt_interval(F.lit(days))


def known_at(value: str | Column, since: str | Column, at: str | Column) -> Column:
    """``value`` if ``since <= at``, else null: the field is not known yet."""
    v, s, a = (F.col(x) if isinstance(x, str) else x for x in (value, since, at))
    return F.when(s <= a, v)


def at_most_tokens(ids: str, limit: int) -> Column:
    return F.size(F.col(ids)) <= limit
