"""Ordered operators that hold when one key owns a large share of all rows.

``Window.partitionBy(key)`` puts a whole key into one task. ``ordered_scan`` range-partitions
the keys for which that matters: ``key_cuts`` samples one row in so many, as Spark's own range
partitioner does, and cuts a key at every so-many-th sampled row of its order. A key with
fewer rows has no cut and is one stretch; any other has stretches of about ``rows`` rows,
wherever its rows lie, also if all share one hour or one instant (the cuts are values of
the whole order, ties included). Each stretch is one window group; one summary row per
stretch carries the state to the next one. If no key has a cut, the plan is the plain
windows: one shuffle.

Cuts only decide where rows are scanned, never what comes out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.session import cut_lineage, stage

STRETCH = 1_000_000  # rows of one key that one task is meant to sort
SAMPLED = 256  # sampled rows per stretch: its length is met within a few percent
MOST_CUTS = 1 << 14  # of one key; beyond, its stretches grow

_S = "__stretch"
_B = "__bucket"
_HEX = 4  # digits of a digest that choose the bucket
_POSITION_BITS = 33  # monotonically_increasing_id() keeps the row position in its low 33 bits


@dataclass(frozen=True)
class Cuts:
    """Where long keys are cut: ``table`` has ``keys`` and ``__cuts``, a sorted list of ``order`` values; None: no key is long."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    table: DataFrame | None

    def stretch(self) -> Column:
        """The stretch of a row joined with ``table``: how many cuts are not above it. Null without cuts."""
        here = F.struct(*[F.col(f"`{c}`") for c in self.order])
        steps = F.array(*[F.lit(MOST_CUTS >> i) for i in range(1, MOST_CUTS.bit_length())])
        # Binary search: beyond the end of the list get() is null, which counts as above.
        found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("__cuts", at + step - 1) <= here, at + step).otherwise(at))
        return F.when(F.col("__cuts").isNotNull(), found)

    def placed(self, df: DataFrame, out: str = _S) -> DataFrame:
        """``df`` with the stretch of each row."""
        if self.table is None:
            return df.withColumn(out, F.lit(None).cast("int"))
        return df.join(self.table, list(self.keys), "left").withColumn(out, self.stretch()).drop("__cuts")


def key_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = STRETCH, seed: int = 7) -> Cuts:
    """Cut every key into stretches of about ``rows`` rows along ``order``, by a sample of the key and order columns.

    The cuts serve any table with these keys whose rows lie along the same order, so
    several scans of one pipeline can share them. They are staged, so retried tasks see the same ones.
    """
    share = min(1.0, SAMPLED / rows)
    step = max(int(rows * share), 1)
    narrow = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *order])])
    sampled = narrow.sample(share, seed) if share < 1 else narrow
    if sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > step).isEmpty():
        return Cuts(tuple(keys), tuple(order), None)
    in_order = Window.partitionBy(*keys).orderBy(*order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    width = F.lit(step) * F.ceil(n / F.lit(step * (MOST_CUTS - 1)))
    marked = sampled.select(*keys, F.struct(*order).alias("__at"), F.row_number().over(in_order).alias("__i"), width.alias("__width"))
    picked = marked.where((F.col("__i") > 1) & ((F.col("__i") - 1) % F.col("__width") == 0))
    lists = picked.groupBy(*keys).agg(F.array_sort(F.collect_list("__at")).alias("__cuts"))  # at most MOST_CUTS long
    return Cuts(tuple(keys), tuple(order), stage(lists))


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    running: Mapping[str, str] | None = None,
    carry: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    monotone: Sequence[str] = (),
    cuts: Cuts | None = None,
    rows: int = STRETCH,
) -> DataFrame:
    """Window functions over ``keys`` ordered by ``order``.

    number     output column for the row number, from 1
    running    {out: value}  sum of value over all rows up to and including this one
    carry      {out: value}  last non-null value up to and including this row
    following  {out: value}  first non-null value strictly after this row
    monotone   outputs of carry/following whose value never falls along the order;
               they are summarised by plain min/max
    cuts       from ``key_cuts`` over some of ``keys`` and the first columns of ``order``;
               by default those of ``df`` itself, in stretches of about ``rows`` rows

    Keys must not be null and ``order`` must be total within a key.
    """
    outs = _Outputs(number, dict(running or {}), dict(carry or {}), dict(following or {}), set(monotone))
    cuts = key_cuts(df, keys, order, rows) if cuts is None else cuts
    if cuts.table is None:
        whole = df.select("*", *outs.windows(list(keys), order))
        return whole.select(*outs.kept(df), *[outs.local(o).alias(o) for o in outs.names])

    d = cuts.placed(df)
    groups = [*keys, _S]
    up = Window.partitionBy(*keys).orderBy(_S).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.col(_S).desc()).rowsBetween(Window.unboundedPreceding, -1)
    # Rows of keys without cuts have no stretch, so they find no state and stay as they are.
    state = d.where(F.col(_S).isNotNull()).groupBy(*groups).agg(*outs.summaries(order)).select(*groups, *outs.before(up, down))
    scanned = d.select("*", *outs.windows(groups, order)).join(state, groups, "left")
    return scanned.select(*outs.kept(df), *[outs.combined(o).alias(o) for o in outs.names])


class _Outputs:
    """The column expressions of one scan."""

    def __init__(self, number, running, carry, following, monotone):
        self.number, self.running, self.carry, self.following = number, running, carry, following
        self.monotone = monotone
        self.names = [*([number] if number else []), *running, *carry, *following]

    def kept(self, df: DataFrame) -> list[Column]:
        return [F.col(f"`{c}`") for c in df.columns if c not in self.names]

    def local(self, out: str) -> Column:
        return F.col(f"__l_{out}")

    def windows(self, groups: Sequence[str], order: Sequence[str]) -> list[Column]:
        inner = Window.partitionBy(*groups).orderBy(*order)
        upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # A frame that ends at UNBOUNDED FOLLOWING is re-read for every row, so "what
        # follows" is computed as "what precedes" in descending order.
        after = Window.partitionBy(*groups).orderBy(*[F.col(c).desc() for c in order])
        after = after.rowsBetween(Window.unboundedPreceding, -1)
        made = []
        if self.number:
            made.append((self.number, F.row_number().over(inner).cast("bigint")))
        made += [(o, F.sum(v).over(upto)) for o, v in self.running.items()]
        made += [(o, F.last(v, ignorenulls=True).over(upto)) for o, v in self.carry.items()]
        made += [(o, F.last(v, ignorenulls=True).over(after)) for o, v in self.following.items()]
        return [c.alias(f"__l_{o}") for o, c in made]

    def summaries(self, order: Sequence[str]) -> list[Column]:
        rank = F.struct(*[F.col(c) for c in order])

        def known(value: str) -> Column:
            return F.when(F.col(value).isNotNull(), rank)

        made = [(self.number, F.count(F.lit(1)))] if self.number else []
        made += [(o, F.sum(v)) for o, v in self.running.items()]
        for o, v in self.carry.items():
            made.append((o, F.max(v) if o in self.monotone else F.max_by(F.col(v), known(v))))
        for o, v in self.following.items():
            made.append((o, F.min(v) if o in self.monotone else F.min_by(F.col(v), known(v))))
        return [c.alias(f"__s_{o}") for o, c in made]

    def before(self, up, down) -> list[Column]:
        made = []
        for o in self.names:
            summary = f"__s_{o}"
            if o in self.following:
                made.append(F.last(summary, ignorenulls=True).over(down).alias(f"__p_{o}"))
            elif o in self.carry:
                made.append(F.last(summary, ignorenulls=True).over(up).alias(f"__p_{o}"))
            else:
                made.append(F.sum(summary).over(up).alias(f"__p_{o}"))
        return made

    def combined(self, out: str) -> Column:
        here, before = self.local(out), F.col(f"__p_{out}")
        if out in self.carry or out in self.following:
            return F.coalesce(here, before)
        return F.when(before.isNull(), here).otherwise(before + F.coalesce(here, F.lit(0)))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per ``keys`` in ``order``, then by its other columns; null keys form a group.

    Spark turns the rank filter into a limit per group that each map task applies ahead of
    the shuffle, so a task sends one row of a key however many it has.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ahead = [*order, *rest] or list(keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ahead))
    return df.withColumn("__first", rank).where("__first = 1").drop("__first")


def global_positions(df: DataFrame, order: Sequence[str], out: str = "position", *, unique: bool = False) -> DataFrame:
    """Number all rows from 1 in global ``order`` without a one-task window.

    ``unique``: the order columns are not null and tell all rows apart. Then they alone are
    sorted and written, and the numbers are joined back to the rows, which move once.

    Range partitioning sorts the rows; the sorted rows are checkpointed so that
    positions inside a partition are fixed; one offset per partition (a table with
    as many rows as there are partitions) turns them into global positions.
    """
    if unique and set(df.columns) - set(order):
        places = stage(global_positions(df.select(*order), order, out))
        return df.join(places, list(order)).select(*df.columns, out)
    sorted_rows = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    tagged = sorted_rows.withColumn("__id", F.monotonically_increasing_id())
    tagged = tagged.withColumn("__part", F.shiftright("__id", _POSITION_BITS))
    offsets = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = (
        tagged.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(offsets), F.lit(0)).alias("__base"))
    )
    local = F.col("__id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return tagged.join(F.broadcast(per_part), "__part").select(
        *df.columns, (F.col("__base") + local + 1).alias(out)
    )


def hash_positions(df: DataFrame, hash_hex: Column, tie: Sequence[str], out: str = "position") -> DataFrame:
    """Number all rows from 1 by the hex digest of a unique id.

    The first digits spread the rows over 65,536 even buckets. Ranks inside a
    bucket plus the sizes of the buckets below give the position; the table of
    sizes has at most 65,536 rows whatever the data, which bounds its broadcast.
    """
    keyed = df.withColumn("__hex", hash_hex)
    bucket = F.conv(F.substring("__hex", 1, _HEX), 16, 10).cast("int")
    keyed = keyed.withColumn(_B, bucket)
    per_bucket = keyed.groupBy(_B).agg(F.count(F.lit(1)).alias("__n"))
    below = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    bases = per_bucket.select(_B, F.coalesce(F.sum("__n").over(below), F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy(_B).orderBy("__hex", *tie))
    numbered = keyed.withColumn("__rank", inside).join(F.broadcast(bases), _B)
    return numbered.select(*df.columns, (F.col("__base") + F.col("__rank")).alias(out))
