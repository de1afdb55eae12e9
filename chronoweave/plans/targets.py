"""What happens next: for a snapshot and a section, the rows of its next change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions import text
from chronoweave.operators.ordered import Cuts, ordered_scan
from chronoweave.plans.timeline import sort_key_of, whole_numbers
from chronoweave.spec import Wording


_INSTANT = ("stay_id", "section", "t")


def change_rows(rows: DataFrame, dedupe: str = "distinct") -> DataFrame:
    """Rows of the timed target sections, with a 128-bit key of their text that says which are equal.

    distinct   equal rows of one instant are one row
    unique     rows that occur more than once in their instant are dropped
    """
    timed = rows.where(F.col("target") & (F.col("kind") == "records"))
    same = [F.xxhash64("line_full", "answer").alias("h"), F.xxhash64(F.lit(1), F.col("line_full"), F.col("answer")).alias("g")]
    return timed.select(*_INSTANT, "tie", "line_full", "answer", "answer_size", *same, F.lit(dedupe == "unique").alias("unique"))


def change_groups(changes: DataFrame) -> DataFrame:
    """One row per instant of a section: how many rows appear and how long their text is. Only keys and sizes are shuffled."""
    merged = changes.groupBy(*_INSTANT, "h", "g").agg(
        F.max("answer_size").alias("size"), F.max("unique").alias("unique"), F.count(F.lit(1)).alias("copies")
    )
    stands = ~F.col("unique") | (F.col("copies") == 1)
    return merged.groupBy(*_INSTANT).agg(
        F.count(F.when(stands, 1)).alias("n_rows"), F.coalesce(F.sum(F.when(stands, F.col("size"))), F.lit(0.0)).alias("size")
    )


def next_changes(
    snapshots: DataFrame,
    groups: DataFrame,
    sections: Sequence[str],
    cuts: Cuts | None = None,
) -> DataFrame:
    """For each snapshot and section, the section's next instant after the snapshot.

    ``snapshots`` has ``stay_id, t`` and may carry more columns. Adds ``section,
    next_t, n_rows, answer_size``; a snapshot without a later change gives no row.
    ``cuts``: of some table by ``stay_id`` along ``t``. One backward scan per stay, which knows the next change of every section, replaces the search through later snapshots.
    """
    extra = [c for c in snapshots.columns if c not in ("stay_id", "t")]
    change = F.struct(F.col("t"), F.col("n_rows"), F.col("size"))
    asked = snapshots.select("stay_id", "t", *extra, F.lit(1).alias("__asks"))
    found = groups.where(F.col("section").isin(*sections)).select(
        "stay_id", "t", F.lit(0).alias("__asks"), *[F.when(F.col("section") == s, change).alias(f"__change_{i}") for i, s in enumerate(sections)],
    )
    # A change sorts ahead of a question at the same instant, so that it is not "after" it.
    scanned = ordered_scan(
        asked.unionByName(found, allowMissingColumns=True), ["stay_id"], ["t", "__asks"],
        following={f"__next_{i}": f"__change_{i}" for i in range(len(sections))}, monotone=[f"__next_{i}" for i in range(len(sections))], cuts=cuts,
    )
    each = F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"__next_{i}").alias("next")) for i, s in enumerate(sections)])
    told = scanned.where("__asks = 1").select("stay_id", "t", *extra, F.explode(F.filter(each, lambda x: x["next"].isNotNull())).alias("__told"))
    return told.select(
        "stay_id",
        "t",
        *extra,
        "__told.section",
        F.col("__told.next.t").alias("next_t"),
        F.col("__told.next.n_rows").alias("n_rows"),
        F.col("__told.next.size").alias("answer_size"),
    )


def answer_texts(changes: DataFrame, wanted: DataFrame, wording: Wording) -> DataFrame:
    """Texts of the wanted instants: ``stay_id, section, next_t, answer``.

    Only rows of wanted instants are shuffled with their text. An answer holds all rows
    of one instant of a section, which is what bounds the list that is collected;
    ``build_samples`` with ``max_tokens`` bounds it by their size before.
    """
    keys = wanted.select("stay_id", "section", F.col("next_t").alias("t")).distinct()
    # The keys of the texts are left behind, and whole numbers of a sort key travel as such: they make up half of a row.
    numbers = whole_numbers("tie")
    held = changes.select(*_INSTANT, "line_full", "answer", "unique", numbers.alias("numbers"), F.when(numbers.isNull(), F.col("tie")).alias("tie"))
    held = held.join(keys, list(_INSTANT), "left_semi")
    row = F.struct("line_full", "answer", F.coalesce("tie", sort_key_of("numbers")).alias("tie"))
    listed = held.groupBy(*_INSTANT).agg(F.array_sort(F.collect_list(row)).alias("list"), F.max("unique").alias("unique"))

    def same(row: Column, at: Column) -> Column:
        other = F.get("list", at)
        return F.coalesce(other["line_full"].eqNullSafe(row["line_full"]) & other["answer"].eqNullSafe(row["answer"]), F.lit(False))

    def stands(row: Column, i: Column) -> Column:
        return ~same(row, i - 1) & ~(F.col("unique") & same(row, i + 1))

    # Equal rows lie next to each other, ordered by their tie: the first of them stands.
    first = F.transform(F.filter("list", stands), lambda r: F.struct(r["tie"], r["line_full"], r["answer"]))
    told = listed.select(*_INSTANT, F.transform(F.array_sort(first), lambda r: r["answer"]).alias("told")).where(F.size("told") > 0)
    return told.select(
        "stay_id", "section", F.col("t").alias("next_t"), F.concat(answer_head(wording), text.numbered_list(F.col("told"))).alias("answer")
    )


def answer_head(wording: Wording):
    before, after = wording.answer.split("{section}")
    return F.concat(F.lit(before), F.col("section"), F.lit(f"{after}\n"))
