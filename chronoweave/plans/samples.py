"""Training samples: (snapshot text, question) -> what happens next."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions import text
from chronoweave.functions.identifiers import base_id, numeric_id, sample_id
from chronoweave.functions.prompts import chat_prompt
from chronoweave.functions.tokens import attention_mask
from chronoweave.operators.ordered import ordered_scan
from chronoweave.plans.snapshots import fitting_rows, snapshot_sizes, snapshot_texts, stay_cuts
from chronoweave.plans.targets import answer_head, answer_texts, change_groups, change_rows, next_changes
from chronoweave.session import stage
from chronoweave.spec import Wording


def _by_section(sections: Sequence[str], value: Callable[[str], str]) -> Column:
    """A fixed text per section."""
    return F.element_at(
        F.create_map(*[F.lit(x) for s in sections for x in (s, value(s))]), F.col("section")
    )


def _standing(rows: DataFrame, section: str) -> DataFrame:
    return rows.where((F.col("section") == section) & F.col("target") & (F.col("kind") == "values"))


def standing_sizes(rows: DataFrame, section: str) -> DataFrame:
    """Size of a target without times (a plain list), which is asked whole at every snapshot."""
    sizes = _standing(rows, section).groupBy("stay_id").agg(F.sum("answer_size").alias("answer_size"))
    return sizes.withColumn("section", F.lit(section))


def standing_answers(rows: DataFrame, section: str, stays: DataFrame, wording: Wording) -> DataFrame:
    """The lists of the given stays as texts: ``stay_id, section, answer``. No other list is collected."""
    listed = _standing(rows, section).join(stays, "stay_id", "left_semi")
    lines = F.array_sort(F.collect_list(F.struct("tie", "answer")))
    joined = listed.groupBy("stay_id").agg(F.array_join(F.transform(lines, lambda r: r["answer"]), "").alias("lines"))
    return joined.withColumn("section", F.lit(section)).select(
        "stay_id", "section", F.concat(answer_head(wording), F.col("lines")).alias("answer")
    )


def build_samples(
    rows: DataFrame,
    stays: DataFrame,
    *,
    targets: Sequence[str],
    standing: Sequence[str] = (),
    wording: Wording,
    tokenizer,
    max_tokens: int | None,
    dedupe: str = "distinct",
    keep_empty: bool = False,
    reuse: Callable[[DataFrame], DataFrame] = stage,
) -> DataFrame:
    """``sample_id, subject_id, stay_id, t, section, input, output, n_tokens``.

    Samples are numbered per stay by time, then target order (``targets`` first,
    then ``standing``). From the first sample whose prompt is longer than
    ``max_tokens`` on, a stay gives no samples; one of exactly that length is left
    out alone. Sizes are known before any text is built, so overlong texts never
    are. ``n_tokens`` is the prompt's token figure by ``tokenizer.floor``.

    With ``max_tokens=None`` every snapshot is built and one text may hold a whole
    stay: meant for stays of known length.
    """
    rows = reuse(rows)
    cuts = stay_cuts(rows)  # shared by all scans along the time of a stay
    sections = [*targets, *standing]
    overhead = tokenizer.floor(
        chat_prompt(
            wording.system,
            F.concat(F.lit("\n\n"), _by_section(sections, wording.question)),
            F.concat(answer_head(wording), F.lit("")),
        )
    ).cast("double")

    sizes = snapshot_sizes(rows, tokenizer, cuts)
    if max_tokens is not None:
        sizes = reuse(sizes.where(F.col("size") <= max_tokens))
    snapshots = sizes.where("in_spine").select("stay_id", "t", "size")

    changes = change_rows(rows, dedupe)
    asked = next_changes(snapshots, change_groups(changes), targets, cuts)
    if not keep_empty:
        asked = asked.where(F.col("n_rows") > 0)
    asked = asked.select("stay_id", "t", "size", "section", "next_t", "answer_size")
    # An overlong list counts as a sample until numbering: it cuts its stay like any other.
    for s in standing:
        asked = asked.unionByName(snapshots.join(standing_sizes(rows, s), "stay_id"), allowMissingColumns=True)

    rank = F.element_at(
        F.create_map(*[F.lit(x) for i, s in enumerate(sections) for x in (s, i)]), F.col("section")
    )
    asked = asked.select(
        "stay_id", "t", "section", "next_t", rank.alias("rank"),
        (F.col("size") + F.col("answer_size") + overhead).alias("n_tokens"),
    )
    if max_tokens is None:
        kept = ordered_scan(asked, ["stay_id"], ["t", "rank"], number="number", cuts=cuts)
    else:
        # Every snapshot here fits, so a stay has at most about max_tokens of them: a plain window.
        upto = Window.partitionBy("stay_id").orderBy("t", "rank")
        over = F.max(F.col("n_tokens") > max_tokens).over(upto.rowsBetween(Window.unboundedPreceding, 0))
        kept = asked.withColumns({"number": F.row_number().over(upto), "__over": over})
        kept = kept.where(~F.col("__over") & (F.col("n_tokens") < max_tokens)).drop("__over")

    kept = reuse(kept.withColumn("number", F.col("number") - 1))
    answers = answer_texts(changes, kept.where(F.col("next_t").isNotNull()), wording)
    if keep_empty:
        wanted = kept.where(F.col("next_t").isNotNull()).select("stay_id", "section", "next_t").distinct()
        answers = wanted.join(answers, ["stay_id", "section", "next_t"], "left").withColumn(
            "answer", F.coalesce("answer", answer_head(wording))
        )
    timed = kept.join(answers, ["stay_id", "section", "next_t"])
    for s in standing:
        part = kept.where(F.col("next_t").isNull() & (F.col("section") == s))
        listed = standing_answers(rows, s, part.select("stay_id").distinct(), wording)
        timed = timed.unionByName(part.join(listed, ["stay_id", "section"]))

    # Texts are the bulk of the data, so they are built last: one text per snapshot,
    # next to its few targets, and not shuffled after that.
    target = F.struct("number", "section", "answer", "n_tokens")
    snapshots = (
        timed.groupBy("stay_id", "t")
        .agg(F.collect_list(target).alias("targets"))
        .join(stays.select("stay_id", "subject_id"), "stay_id")
    )
    texts = snapshot_texts(snapshots, fitting_rows(rows, sizes, max_tokens))
    each = texts.select("stay_id", "subject_id", "t", "text", F.inline("targets"))
    return each.select(
        sample_id("stay_id", "number").alias("sample_id"),
        "subject_id",
        "stay_id",
        "t",
        "section",
        F.concat("text", F.lit("\n\n"), _by_section(sections, wording.question)).alias("input"),
        F.col("answer").alias("output"),
        F.col("n_tokens").cast("bigint").alias("n_tokens"),
    )


def cut_after_overflow(
    samples: DataFrame, stay: str, number: str, size: str, max_tokens: int
) -> DataFrame:
    """Drop a stay's samples from its first overlong one on, and those of exactly the limit.

    Order is by number over the whole stay. The first overlong number is a min that
    combines on the map side; samples without a number only meet the length rule.
    """
    first = (
        samples.where(F.col(size) > max_tokens)
        .groupBy(stay)
        .agg(F.min(number).alias("__first"))
        .where(F.col("__first").isNotNull())
    )
    before = F.col("__first").isNull() | F.col(number).isNull() | (F.col(number) < F.col("__first"))
    kept = samples.where(F.col(size) < max_tokens).join(first, stay, "left").where(before)
    return kept.select(*samples.columns)


def tokenise(samples: DataFrame, tokenizer, wording: Wording, *, key: str = "sample_id") -> DataFrame:
    """Prompts as token rows: ``input_ids, attention_mask, token_count``; other columns stay."""
    prompts = samples.withColumn(
        "input_ids", tokenizer.ids(chat_prompt(wording.system, F.col("input"), F.col("output")))
    )
    return prompts.withColumns(
        {"attention_mask": attention_mask("input_ids"), "token_count": F.size("input_ids")}
    ).drop("input", "output")


def token_dataset(
    samples: DataFrame,
    tokenizer,
    wording: Wording,
    max_tokens: int,
    *,
    reuse: Callable[[DataFrame], DataFrame] = stage,
) -> DataFrame:
    """Token rows of the samples that fit: ``sample_id, input_ids, attention_mask, token_count`` and the other columns.

    Stays are cut after their first overlong sample (see ``cut_after_overflow``), by
    true token counts. ``build_samples`` has dropped most of those before by their
    sizes; with a tokenizer whose ``floor`` is only a lower bound, the rest go here.
    """
    tokens = reuse(tokenise(samples, tokenizer, wording))
    numbered = tokens.withColumns({"__base": base_id("sample_id"), "__number": numeric_id("sample_id")})
    kept = cut_after_overflow(numbered, "__base", "__number", "token_count", max_tokens)
    return kept.select(*tokens.columns)


def discharge_samples(
    stays: DataFrame,
    labels: DataFrame,
    *,
    preamble: Column,
    note: str | None,
    label: str,
    tie: Sequence[str],
    question: str,
    tokenizer=None,
    max_tokens: int | None = None,
    heading: str = "Potential diagnoses",
) -> DataFrame:
    """One sample per stay: what is known at the end in, the list of labels out.

    A stay without labels gives no sample. Every other stay gives one; its length is
    judged by the filters on token rows. ``note=None``: the preamble holds the note. With ``max_tokens`` and a ``tokenizer``, lists
    that alone are longer (their prompts would be cut later) are never collected.
    """
    lines = labels.select("stay_id", *tie, text.value_line(F.col(label)).alias("__line"))
    if max_tokens is not None:
        sizes = lines.groupBy("stay_id").agg(F.sum(tokenizer.floor(F.col("__line"))).alias("__size"))
        lines = lines.join(sizes.where(F.col("__size") <= max_tokens), "stay_id", "left_semi")
    listed = lines.groupBy("stay_id").agg(F.array_sort(F.collect_list(F.struct(*tie, "__line"))).alias("__labels"))
    answer = F.array_join(F.transform("__labels", lambda r: r["__line"]), "")
    return stays.join(listed, "stay_id").select(
        F.concat(F.col("stay_id").cast("string"), F.lit("_discharge")).alias("sample_id"),
        "subject_id",
        "stay_id",
        F.concat(preamble, *([] if note is None else [text.field_line("note", F.col(note))]), F.lit(f"\n\n{question}")).alias("input"),
        F.concat(F.lit(f"{heading}:\n"), answer, F.lit("\n")).alias("output"),
    )
