"""Sample ids: ``<base>_<number>`` or ``<base>_discharge`` (``-`` is accepted too)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_id(stay: str | Column, seq: str | Column) -> Column:
    s, q = (F.col(x) if isinstance(x, str) else x for x in (stay, seq))
    return F.concat_ws("_", s.cast("string"), q.cast("string"))


def base_id(column: str | Column) -> Column:
    """The id without its last part."""
    c = F.col(column) if isinstance(column, str) else column
    summary = F.regexp_replace(c, "[_-]discharge$", "")
    return F.when(c.endswith("discharge"), summary).otherwise(F.regexp_replace(c, "(^|_)[^_]*$", ""))


def numeric_id(column: str | Column) -> Column:
    """The last part if it is all digits, else null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.regexp_extract(c, "(?:^|_)([0-9]+)$", 1).try_cast("bigint")
