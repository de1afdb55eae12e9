"""Timeline rows and snapshot times.

Everything that a snapshot may print becomes one long table, printed once per row:

    stay_id, event_id, event_t, event_rank   the timeline event a row belongs to
    section, sec_ord, kind                   its place inside the event
    t, t_eff, tie                            own time, time it becomes visible, tie-break (typed values)
    t_end, line_open, line_full              text before and after its end time has passed
                                             (line_open is null where they are the same)
    size_open, size_full                     their token figures
    answer, answer_size                      text as part of an answer
    spine, target, mute                      section flags

A row is visible at T when ``t_eff = greatest(t, event_t) <= T``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.functions import text
from chronoweave.spec import Section

HEADER = -1  # sec_ord of the row that stands for the event itself
NUMBER_LINE = " - 1 of 1\n"


_TIE = "array<struct<whole:decimal(38,10),real:double,words:string>>"


def sort_key(df: DataFrame, names: Sequence[str]) -> Column:
    """Sort key: one struct per column, its value in the field of its kind, so numbers sort as numbers.

    Whole texts count. Nulls sort first.
    """

    def part(name: str) -> Column:
        kind, value = df.select(F.col(f"`{name}`")).schema[0].dataType, F.col(f"`{name}`")
        real = isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)
        whole = isinstance(kind, T.NumericType) and not real
        return F.struct(
            (value if whole else F.lit(None)).cast("decimal(38,10)").alias("whole"),
            (value if real else F.lit(None)).cast("double").alias("real"),
            (F.lit(None) if whole or real else value).cast("string").alias("words"),
        )

    return F.array(*[part(n) for n in names]).cast(_TIE)


def whole_numbers(tie: str) -> Column:
    """A sort key of whole numbers as an array of these; null for any other key."""
    def number(x: Column) -> Column:
        return x["whole"].try_cast("bigint")

    fits = F.forall(tie, lambda x: x["real"].isNull() & x["words"].isNull() & x["whole"].eqNullSafe(number(x).cast("decimal(38,10)")))
    return F.when(fits, F.transform(tie, number))


def sort_key_of(numbers: str) -> Column:
    """The sort key that ``whole_numbers`` gave this array for."""
    nothing = F.lit(None)
    return F.transform(numbers, lambda n: F.struct(
        n.cast("decimal(38,10)").alias("whole"), nothing.cast("double").alias("real"), nothing.cast("string").alias("words")
    ))


def event_rows(
    events: DataFrame,
    tokenizer,
    *,
    event_type: str,
    rank: int,
    preamble: Column | None = None,
    spine: bool = False,
) -> DataFrame:
    """Rows that stand for the events themselves: ``stay_id, event_id, event_t`` in.

    ``preamble`` is the text ahead of all events; only the stay's own event has one.
    """
    head = F.lit(f"{event_type} (1 of 1)\n")
    opening = F.lit("") if preamble is None else preamble
    size = (tokenizer.floor(head) + tokenizer.floor(opening) + tokenizer.floor(F.lit("\n\n"))).cast("double")
    return _canonical(
        events,
        rank=rank,
        section=event_type,
        sec_ord=HEADER,
        kind="event",
        t=F.col("event_t"),
        t_end=None,
        tie=sort_key(events, ()),
        line_open=F.lit(None).cast("string"),
        line_full=opening,
        size_open=size,
        size_full=size,
        answer=F.lit(""),
        answer_size=F.lit(0.0),
        spine=spine,
        target=False,
        mute=False,
    )


def section_rows(
    df: DataFrame, section: Section, sec_ord: int | Column, tokenizer, *, rank: int, name: Column | None = None
) -> DataFrame:
    """Rows of one section: ``stay_id, event_id, event_t`` and the section's columns in.

    Sections that differ in their name only can share one pass: ``name`` and
    ``sec_ord`` are then columns.
    """

    def values(names: Sequence[str]) -> list[tuple[str, Column, Column]]:
        return [(n, F.col(f"__text_{i}"), F.col(f"__size_{i}")) for n in names for i in (section.fields.index(n),)]

    ended = section.end is not None and section.end in section.fields
    shown = values(section.fields)
    told = values([n for n in section.fields if n not in section.hidden]) if section.target else []
    still = values([n for n in section.fields if n != section.end]) if ended else []
    number_line = tokenizer.floor(F.lit(NUMBER_LINE))
    no_line, line_open = F.lit(None).cast("string"), None
    if section.kind == "records":
        line_full, size_full = text.printed_record(shown), text.printed_record_size(shown, tokenizer) + number_line
        answer, answer_size = text.printed_record(told), text.printed_record_size(told, tokenizer) + number_line
        if ended:
            line_open, size_open = text.printed_record(still), text.printed_record_size(still, tokenizer) + number_line
    elif section.kind == "values":
        line_full = answer = text.printed_line("", shown[0][1], " - ")
        size_full = answer_size = text.printed_size("", *shown[0][1:], tokenizer, " - ")
    else:
        line_full = answer = text.printed_line(f"{section.name}: ", shown[0][1])
        size_full = answer_size = text.printed_size(f"{section.name}: ", *shown[0][1:], tokenizer)

    t = F.col(f"`{section.time}`").cast("timestamp_ntz") if section.time else F.col("event_t")
    base = df.where(F.col(f"`{section.time}`").isNotNull()) if section.time else df
    # Each value is printed once, and its tokens are counted once, for all texts and sizes that hold it.
    base = base.select("*", *[text.printable(F.col(f"`{f}`")).alias(f"__text_{i}") for i, f in enumerate(section.fields)])
    base = base.select("*", *[tokenizer.floor(F.col(f"__text_{i}")).alias(f"__size_{i}") for i in range(len(section.fields))])
    if section.kind == "scalar":
        base = base.where(F.col("__text_0").isNotNull())

    return _canonical(
        base,
        rank=rank,
        section=section.name if name is None else name,
        sec_ord=sec_ord,
        kind=section.kind,
        t=t,
        t_end=F.col(f"`{section.end}`").cast("timestamp_ntz") if section.end else None,
        tie=sort_key(df, section.tie),
        line_open=no_line if line_open is None else line_open,
        line_full=line_full,
        size_open=(size_full if line_open is None else size_open).cast("double"),
        size_full=size_full.cast("double"),
        answer=answer if section.target else F.lit(""),
        answer_size=(answer_size if section.target else F.lit(0)).cast("double"),
        spine=section.spine,
        target=section.target,
        mute=section.mute,
    )


def _canonical(df: DataFrame, *, rank, section, sec_ord, kind, t, t_end, tie, spine, target, mute, **lines) -> DataFrame:
    t_end = F.lit(None).cast("timestamp_ntz") if t_end is None else t_end
    section, sec_ord = (c if isinstance(c, Column) else F.lit(c) for c in (section, sec_ord))
    return df.select(
        "stay_id",
        F.col("event_id").cast("string").alias("event_id"),
        "event_t",
        F.lit(rank).alias("event_rank"),
        section.alias("section"),
        sec_ord.alias("sec_ord"),
        F.lit(kind).alias("kind"),
        t.alias("t"),
        F.greatest(t, F.col("event_t")).alias("t_eff"),
        t_end.alias("t_end"),
        tie.alias("tie"),
        *[column.alias(name) for name, column in lines.items()],
        F.lit(spine).alias("spine"),
        F.lit(target).alias("target"),
        F.lit(mute).alias("mute"),
    )


def union_rows(parts: Sequence[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def snapshot_times(rows: DataFrame) -> DataFrame:
    """Distinct times that open a snapshot: ``stay_id, t``, none before the stay starts.

    Start and end times of spine sections count. ``event_t`` of the stay's own
    event is the lower bound, so only sections of that event may be in the spine.
    """
    times = F.array(F.col("t"), F.col("t_end"))
    each = rows.where("spine").select("stay_id", "event_t", F.explode(times).alias("t"))
    return each.where(F.col("t") >= F.col("event_t")).select("stay_id", "t").distinct()
