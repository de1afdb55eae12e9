"""Joins. No side is hinted for broadcast: Catalyst and AQE broadcast by measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.aggregates import nest_children
from chronoweave.operators.ordered import ordered_scan
from chronoweave.session import stage


def restrict(df: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``ids`` (keyed scan, fetch by id list)."""
    return df.join(ids.select(*on), list(on), "left_semi")


def not_in(df: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``ids``."""
    return df.join(ids.select(*on), list(on), "left_anti")


def enrich(df: DataFrame, dictionary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach dictionary columns; unmatched rows stay, with nulls."""
    return df.join(dictionary, list(on), "left")


def look_up(df: DataFrame, dictionary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach dictionary columns; rows without an entry vanish."""
    return df.join(dictionary, list(on), "inner")


def keep_if_listed(df: DataFrame, applies: Column, ids: DataFrame, on: str) -> DataFrame:
    """Rows for which ``applies`` is not true, and the others only if ``on`` occurs in ``ids``."""
    listed = ids.select(on).where(F.col(on).isNotNull()).distinct().withColumn("__listed", F.lit(True))
    out = df.join(listed, on, "left").where(~F.coalesce(applies, F.lit(False)) | F.col("__listed"))
    return out.select(*df.columns)


def full_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join on shared key columns.

    Written as left join plus the unmatched right rows: AQE can split a skewed
    partition of those two, but not of a full outer join.
    """
    on = list(on)
    matched = left.join(right, on, "left")
    alone = right.join(left.select(*on), on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def first_seen(df: DataFrame, scope: Sequence[str], item: str, event: str) -> DataFrame:
    """Keep an item only at the first event of its scope that lists it.

    Duplicates inside that first event stay, and null is an item like any other.
    The first event comes from a min that combines on the map side.
    """
    first = df.groupBy(*scope, item).agg(F.min(event).alias("__first_event"))
    names = {c: f"__first_{c}" for c in (*scope, item)}
    first = first.withColumnsRenamed(names)
    same = F.col(item).eqNullSafe(F.col(names[item])) & (F.col(event) == F.col("__first_event"))
    for c in scope:
        same = same & (F.col(c) == F.col(names[c]))
    return df.join(first, same, "left_semi")


def counts_before(
    anchors: DataFrame,
    rows: DataFrame,
    subject: str,
    cutoff: str,
    time: str,
    row_id: str,
    value: str,
) -> DataFrame:
    """For each anchor, the subject's rows strictly before its cutoff, as running figures.

    The join ``same subject and time < cutoff`` repeats every row for every later
    anchor. Here anchors and rows are merged into one sequence and scanned once:
    the count, the value total and the last row's id are what precedes the anchor.
    Anchors sort ahead of rows at the same instant, which makes the bound strict.
    """
    a = anchors.where(F.col(cutoff).isNotNull()).withColumns(
        {"__t": F.col(cutoff), "__kind": F.lit(0), "__tie": F.lit(None).cast("bigint")}
    )
    r = rows.where(F.col(time).isNotNull()).select(
        F.col(subject),
        F.col(time).alias("__t"),
        F.lit(1).alias("__kind"),
        F.col(row_id).cast("bigint").alias("__tie"),
        F.lit(1).cast("bigint").alias("__one"),
        F.col(value).alias("__value"),
    )
    both = a.unionByName(r, allowMissingColumns=True)
    order = ["__t", "__kind", "__tie", *[c for c in anchors.columns if c not in (subject, cutoff)]]
    scanned = ordered_scan(
        both,
        [subject],
        order,
        running={"n_before": "__one", "value_before": "__value"},
        carry={"last_before": "__tie"},
    )
    return scanned.where(F.col("__kind") == 0).select(
        *anchors.columns,
        F.coalesce("n_before", F.lit(0)).alias("n_before"),
        "value_before",
        "last_before",
    )


def prefix_lengths(anchors: DataFrame, rows: DataFrame, subject: str, cutoff: str, time: str) -> DataFrame:
    """Anchors with ``n_before``, how many rows of the subject lie strictly before the cutoff; those with none are left out.

    With the subject's rows in order of time, ``(subject, n_before)`` says which rows they are.
    """
    asked = anchors.where(F.col(cutoff).isNotNull()).withColumns({"__t": F.col(cutoff), "__kind": F.lit(0), "__n": F.lit(0).cast("bigint")})
    steps = rows.where(F.col(time).isNotNull()).groupBy(F.col(subject), F.col(time).alias("__t")).agg(
        F.lit(1).alias("__kind"), F.count(F.lit(1)).alias("__n")
    )
    both = asked.unionByName(steps, allowMissingColumns=True)
    scanned = ordered_scan(both, [subject], ["__t", "__kind"], running={"n_before": "__n"})
    return scanned.where("__kind = 0 AND n_before > 0").select(*anchors.columns, "n_before")


def history_parts(rows: DataFrame, subject: str, time: str, tie: Sequence[str], part_rows: int) -> DataFrame:
    """The rows of each subject in order of time, numbered and in lists of ``part_rows``: ``subject, part, n_rows, history``."""
    fields = [c for c in rows.columns if c != subject]
    return nest_children(rows.where(F.col(time).isNotNull()), [subject], [time, *tie], fields, part_rows=part_rows, out="history")


def rows_before(
    anchors: DataFrame,
    rows: DataFrame,
    subject: str,
    cutoff: str | None,
    time: str,
    tie: Sequence[str] | None = None,
    *,
    last: int | None = None,
    number: str | None = None,
    part_rows: int = 1_000,
) -> DataFrame:
    """The same join with the rows themselves: each anchor with the rows of its subject before its cutoff.

    A subject's rows are numbered and laid in parts once. An anchor is a prefix of them,
    and reads the parts that its prefix reaches into, by an equi-join on (subject, part): no
    pair of an anchor and a row is made or compared that is not in the result. With
    ``last``, only the latest so many rows are read. ``cutoff=None`` takes the whole history.

    tie     columns that order rows of equal time; by default all others
    number  output column for the row's number in the subject's history, from 1
    """
    tie = [c for c in rows.columns if c not in (subject, time)] if tie is None else list(tie)
    parts = stage(history_parts(rows, subject, time, tie, part_rows))
    if cutoff is None:
        reads = anchors.join(parts.groupBy(subject).agg(F.sum("n_rows").alias("n_before")), subject)
    else:
        reads = prefix_lengths(anchors, rows, subject, cutoff, time)
    first = F.lit(0).cast("bigint") if last is None else F.greatest(F.col("n_before") - last, F.lit(0))
    reads = reads.withColumn("__first", first)
    reads = reads.withColumn("part", F.explode(F.sequence(F.floor(F.col("__first") / part_rows), F.floor((F.col("n_before") - 1) / part_rows))))
    start = F.col("part") * part_rows
    begin = F.greatest(F.col("__first") - start, F.lit(0))
    held = F.slice("history", (begin + 1).cast("int"), (F.least(F.col("n_before") - start, F.col("n_rows")) - begin).cast("int"))
    each = reads.join(parts, [subject, "part"]).select(*anchors.columns, (start + begin).alias("__before"), F.posexplode(held).alias("__pos", "__row"))
    place = [] if number is None else [(F.col("__before") + F.col("__pos") + 1).alias(number)]
    return each.select(*anchors.columns, *place, "__row.*")
