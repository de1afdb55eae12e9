"""Stays from an event stream, the cohort, and stays that cannot be used."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.columns import shorter_than_days
from chronoweave.operators.ordered import ordered_scan


def assign_stays(events: DataFrame, subject: str, time: str, event: str, opens: Column) -> DataFrame:
    """Give every event the stay it falls into: the subject's last opening event.

    Adds ``stay_id, start_t, end_t``; a stay lasts until the next opening event.
    Events ahead of the first opening keep a null stay.
    """
    marked = events.withColumns(
        {
            "__opened": F.when(opens, F.struct(F.col(time), F.col(event))),
            "__next": F.when(opens, F.col(time)),
        }
    )
    scanned = ordered_scan(
        marked,
        [subject],
        [time, event],
        carry={"__stay": "__opened"},
        following={"end_t": "__next"},
        monotone=["__stay", "end_t"],
    )
    return scanned.select(
        *events.columns,
        F.col(f"__stay.{event}").alias("stay_id"),
        F.col(f"__stay.{time}").alias("start_t"),
        "end_t",
    )


def cohort(stays: DataFrame, visits: DataFrame, key: str, start: str, end: str, days: int = 7) -> DataFrame:
    """Stays with at least one visit and fewer than ``days`` whole days; one row per stay."""
    return stays.where(shorter_than_days(start, end, days)).join(visits.select(key), key, "left_semi")


def cohort_per_visit(
    stays: DataFrame, visits: DataFrame, key: str, start: str, end: str, days: int = 7
) -> DataFrame:
    """The same as an inner join: one row per visit of a stay."""
    return stays.where(shorter_than_days(start, end, days)).join(visits, key)


def quarantine(stays: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """``(key, reason)`` for every rule that a stay breaks; a rule is true for a bad stay."""
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for reason, bad in rules.items()]))
    return stays.select(key, F.explode(reasons).alias("reason"))


def missing_children(stays: DataFrame, children: DataFrame, key: str, flag: str) -> DataFrame:
    """Add a flag that is true where a stay has no row in ``children``."""
    present = children.select(key).distinct().withColumn("__has", F.lit(True))
    return stays.join(present, key, "left").withColumn(flag, F.col("__has").isNull()).drop("__has")


def clean_and_bad(stays: DataFrame, key: str, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Usable stays, and the quarantine table. Both read the rules' columns of ``stays``."""
    bad = quarantine(stays, key, rules)
    broken = [F.coalesce(r, F.lit(False)) for r in rules.values()]
    any_broken = broken[0]
    for rule in broken[1:]:
        any_broken = any_broken | rule
    return stays.where(~any_broken), bad
