"""Text of records. Every row is printed once, where it lies; snapshots only join strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoweave.spec import NULL_WORDS


def printable(value: Column, null_words: Sequence[str] = NULL_WORDS) -> Column:
    """The value as text; null if it is null or prints as a null word."""
    text = value.cast("string")
    return F.when(~F.lower(text).isin(*null_words), text)


def field_line(name: str, value: Column, prefix: str = "") -> Column:
    """``{prefix}{name}: {value}`` and a line end, or nothing."""
    shown = printable(value)
    return F.when(shown.isNotNull(), F.concat(F.lit(f"{prefix}{name}: "), shown, F.lit("\n"))).otherwise(F.lit(""))


def record_lines(fields: Sequence[tuple[str, Column]]) -> Column:
    """The indented lines of one record of a list."""
    if not fields:
        return F.lit("")
    return F.concat(*[field_line(name, value, "   - ") for name, value in fields])


def printed_line(label: str, shown: Column, prefix: str = "") -> Column:
    """The line of a value that is text already; nothing if it is null."""
    return F.coalesce(F.concat(F.lit(f"{prefix}{label}"), shown, F.lit("\n")), F.lit(""))


def printed_size(label: str, shown: Column, size: Column, tokenizer, prefix: str = "") -> Column:
    """Token figure of ``printed_line``: the label's is a constant, ``size`` is the value's."""
    return F.when(shown.isNotNull(), tokenizer.floor(F.lit(f"{prefix}{label}\n")) + size).otherwise(F.lit(0))


def printed_record(fields: Sequence[tuple[str, Column, Column]]) -> Column:
    """``record_lines`` of ``(name, text, size)``."""
    if not fields:
        return F.lit("")
    return F.concat(*[printed_line(f"{name}: ", shown, "   - ") for name, shown, _ in fields])


def printed_record_size(fields: Sequence[tuple[str, Column, Column]], tokenizer) -> Column:
    total = F.lit(0)
    for name, shown, size in fields:
        total = total + printed_size(f"{name}: ", shown, size, tokenizer, "   - ")
    return total


def value_line(value: Column) -> Column:
    shown = printable(value)
    return F.when(shown.isNotNull(), F.concat(F.lit(" - "), shown, F.lit("\n"))).otherwise(F.lit(""))


def numbered(lines: Column, i: Column, n: Column) -> Column:
    """One record of a list: its number line and its fields."""
    return F.concat(F.lit(" - "), i.cast("string"), F.lit(" of "), n.cast("string"), F.lit("\n"), lines)


def numbered_list(records: Column) -> Column:
    """All records of an array of texts, numbered."""
    return F.array_join(
        F.transform(records, lambda lines, i: numbered(lines, i + 1, F.size(records))), ""
    )


def block(fields: Sequence[tuple[str, Column]]) -> Column:
    """The lines of a row of scalars, and the blank line that ends a row."""
    return F.concat(*[field_line(name, value) for name, value in fields], F.lit("\n"))


def clean_record(fields: Sequence[tuple[str, Column]]) -> Column:
    """A record as a map of its non-null fields."""
    entries = F.map_from_arrays(
        F.array(*[F.lit(name) for name, _ in fields]), F.array(*[v.cast("string") for _, v in fields])
    )
    return F.map_filter(entries, lambda _, v: v.isNotNull())
