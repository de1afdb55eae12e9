"""The nested record of a stay: its own columns, and each child table as a list of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.ordered import ordered_scan
from chronoweave.plans.timeline import sort_key
from chronoweave.spec import Section


def stay_records(
    stays: DataFrame, children: Sequence[tuple[Section, DataFrame]], key: str = "stay_id", *, part_rows: int = 10_000
) -> DataFrame:
    """The columns of ``stays``, ``part``, and for each child an ``array<struct>`` named and typed by its section.

    All children travel in one union, tagged by section, with one shuffle by stay, rather
    than one aggregation and one join each. A list holds ``part_rows`` records, in order of the
    section's time, its ``tie`` columns, then its fields; a stay with a longer child goes on in parts
    1, 2, ..., so that no task collects an unbounded list. Lists are empty, not null, where a stay
    has no (more) rows. Rows of other stays are left out.
    """
    tagged = None
    for i, (section, df) in enumerate(children):
        order = [*section.tie, *[f for f in section.fields if f not in section.tie]]
        time = F.col(f"`{section.time}`").cast("timestamp_ntz") if section.time else F.lit(None).cast("timestamp_ntz")
        record = F.struct(*[F.col(f"`{f}`") for f in section.fields])
        rows = df.where(F.col(f"`{key}`").isNotNull()).select(
            F.col(f"`{key}`").alias(key), F.lit(i).alias("__section"), time.alias("__t"), sort_key(df, order).alias("__tie"), record.alias(f"__{i}")
        )
        tagged = rows if tagged is None else tagged.unionByName(rows, allowMissingColumns=True)
    numbered = ordered_scan(tagged.repartition(key), [key, "__section"], ["__t", "__tie"], number="__n")
    parts = numbered.withColumn("part", F.floor((F.col("__n") - 1) / part_rows))

    def listed(i: int) -> Column:
        mine = F.when(F.col("__section") == i, F.struct("__n", F.col(f"__{i}").alias("record")))
        return F.transform(F.array_sort(F.collect_list(mine)), lambda r: r["record"])

    lists = parts.groupBy(key, "part").agg(*[listed(i).alias(f"__{i}") for i in range(len(children))])
    joined = stays.join(lists, key, "left")
    # A stay without any child has no part yet; one whose children are short has no part but 0.
    nested = [F.coalesce(F.col(f"__{i}"), F.array().cast(lists.schema[f"__{i}"].dataType)).alias(s.name) for i, (s, _) in enumerate(children)]
    return joined.select(*[F.col(f"`{c}`") for c in stays.columns], F.coalesce("part", F.lit(0)).alias("part"), *nested)
