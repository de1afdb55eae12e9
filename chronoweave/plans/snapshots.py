"""What is known at each snapshot time, without joining snapshots to their past."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions import text
from chronoweave.operators.ordered import STRETCH, Cuts, key_cuts, ordered_scan
from chronoweave.plans.timeline import HEADER, snapshot_times
from chronoweave.session import stage


PART_ROWS = 10_000  # printed rows of a stay that one list is meant to hold

PRINTED = ("event_t", "event_rank", "event_id", "sec_ord", "section", "t", "tie")  # the order of rows in a text
_SECTION = ("stay_id", "event_id", "section")


def stay_cuts(rows: DataFrame, length: int = STRETCH) -> Cuts:
    """Where long stays are cut along time, for all scans over what their rows give."""
    return key_cuts(rows.select("stay_id", F.col("t_eff").alias("t")), ["stay_id"], ["t"], length)


def _section_changes(rows: DataFrame) -> DataFrame:
    """Rows that appear per section and instant: ``stay_id, event_id, section, t, n, own_t``."""
    shown = rows.where((F.col("kind") != "event") & ~F.col("mute"))
    return shown.groupBy(*_SECTION, F.col("t_eff").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("own_t"))


def visibility_runs(rows: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """What is visible when, as run lengths: ``stay_id, event_id, section, from_t, until_t, n_visible, last_t``.

    The visible rows of a section are a prefix of it, so its length says which rows they
    are. It changes only at instants where rows appear: from ``from_t`` on, up to but not at
    ``until_t`` (null: to the end), every snapshot sees ``n_visible`` rows, the last of
    them of ``last_t``. Rows are linear in the input, however many snapshots and events a stay has.
    """
    cuts = stay_cuts(rows) if cuts is None else cuts
    scanned = ordered_scan(
        _section_changes(rows), list(_SECTION), ["t"], running={"n_visible": "n"}, carry={"last_t": "own_t"},
        following={"until_t": "t"}, monotone=["last_t", "until_t"], cuts=cuts,
    )
    return scanned.select(*_SECTION, F.col("t").alias("from_t"), "until_t", "n_visible", "last_t")


def counts_at(changes: DataFrame, asked: DataFrame, keys: Sequence[str], cuts: Cuts | None = None) -> DataFrame:
    """``asked`` (``keys, t`` and more) with ``n_visible``, the sum of ``n`` of the changes up to ``t``, and their last ``own_t``.

    Changes are carried forward to the questions in one scan: linear in both.
    """
    questions = asked.withColumns({"__asks": F.lit(1), "__n": F.lit(0).cast("bigint"), "__own": F.lit(None).cast("timestamp_ntz")})
    steps = changes.select(*keys, "t", F.lit(0).alias("__asks"), F.col("n").alias("__n"), F.col("own_t").alias("__own"))
    # A change sorts ahead of a question at the same instant, which sees it.
    scanned = ordered_scan(
        questions.unionByName(steps, allowMissingColumns=True), keys, ["t", "__asks"],
        running={"n_visible": "__n"}, carry={"last_t": "__own"}, monotone=["last_t"], cuts=cuts,
    )
    return scanned.where("__asks = 1").select(*asked.columns, "n_visible", "last_t")


def visible_counts(rows: DataFrame, asked: DataFrame | None = None, cuts: Cuts | None = None) -> DataFrame:
    """Rows visible per snapshot and section: ``stay_id, event_id, section, t, n_visible, last_t``; none are left out.

    ``visibility_runs`` expanded on demand, for ``asked`` (``stay_id, event_id, section, t``) alone; by
    default every snapshot asks for every section of its stay that has shown a row by then.
    """
    changes = _section_changes(rows)
    if asked is None:
        first = changes.groupBy(*_SECTION).agg(F.min("t").alias("first_t"))
        asked = snapshot_times(rows).join(first, "stay_id").where(F.col("first_t") <= F.col("t"))
    cuts = stay_cuts(rows) if cuts is None else cuts
    return counts_at(changes, asked.select(*_SECTION, "t"), list(_SECTION), cuts).where("n_visible > 0")


def snapshot_sizes(rows: DataFrame, tokenizer, cuts: Cuts | None = None) -> DataFrame:
    """Token figure of the text of every instant: ``stay_id, t, in_spine, size``.

    A text only grows with time, so its size is a running sum: each row adds its
    lines when it becomes visible, a section adds its header with its first row,
    and an end time adds its field when it has passed. Nothing is rendered.
    """
    cuts = stay_cuts(rows) if cuts is None else cuts
    shown = rows.where(~F.col("mute"))
    steps = F.array(
        F.struct(F.col("t_eff").alias("t"), F.col("size_open").alias("size")),
        F.struct(
            F.greatest("t_eff", F.col("t_end")).alias("t"),
            F.when(F.col("t_end").isNotNull(), F.col("size_full") - F.col("size_open")).alias("size"),
        ),
    )
    growth = shown.select("stay_id", F.explode(steps).alias("s")).where("s.size is not null")
    growth = growth.select("stay_id", "s.t", "s.size")
    headers = (
        shown.where(F.col("kind").isin("records", "values"))
        .groupBy("stay_id", "event_id", "section")
        .agg(F.min("t_eff").alias("t"))
        .select(
            "stay_id", "t", tokenizer.floor(F.concat(F.col("section"), F.lit(":\n"))).cast("double").alias("size")
        )
    )
    asked = snapshot_times(rows).withColumn("in_spine", F.lit(True))
    grid = (
        growth.unionByName(headers)
        .unionByName(asked, allowMissingColumns=True)
        .groupBy("stay_id", "t")
        .agg(
            F.coalesce(F.max("in_spine"), F.lit(False)).alias("in_spine"),
            F.coalesce(F.sum("size"), F.lit(0.0)).alias("step"),
        )
    )
    return ordered_scan(grid, ["stay_id"], ["t"], running={"size": "step"}, cuts=cuts).drop("step")


def stay_documents(rows: DataFrame) -> DataFrame:
    """Per stay, its events with their sections and printed rows, nested and sorted.

    The rows must be bounded per stay: ``snapshot_texts`` gives only stays without cuts.
    They are shuffled by stay once; the three levels of nesting and the join with
    snapshots keep to that.
    """
    by_section = (
        rows.where(~F.col("mute"))
        .repartition("stay_id")
        .groupBy("stay_id", "event_t", "event_rank", "event_id", "sec_ord", "section", "kind")
        .agg(F.array_sort(F.collect_list(_line())).alias("rows"))
    )
    by_event = by_section.groupBy("stay_id", "event_t", "event_rank", "event_id").agg(
        F.array_sort(F.collect_list(F.struct("sec_ord", "section", "kind", "rows"))).alias("sections")
    )
    return by_event.groupBy("stay_id").agg(
        F.array_sort(F.collect_list(F.struct("event_t", "event_rank", "event_id", "sections"))).alias("events")
    )


def _line() -> Column:
    return F.struct("t", "tie", "t_eff", "t_end", "line_open", "line_full")


def fitting_rows(rows: DataFrame, sizes: DataFrame, max_tokens: int | None) -> DataFrame:
    """Rows that some snapshot within ``max_tokens`` prints.

    A row shown at T is in every later text as well, so if the text at the row's
    own instant is over the limit, no text that fits holds the row. What remains of a stay
    is at most ``max_tokens`` long, however long the stay is.
    """
    if max_tokens is None:
        return rows
    fitting = sizes.where(F.col("size") <= max_tokens).select("stay_id", F.col("t").alias("t_eff"))
    return rows.join(fitting, ["stay_id", "t_eff"], "left_semi")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _section_text(section: Column, at: Column, before: Column | None = None, n: Column | None = None) -> Column:
    """``before``: rows of the section in earlier parts; ``n``: visible rows in all parts, where they are not those here."""
    earlier = F.lit(0) if before is None else before

    def lines(row: Column) -> Column:
        return F.when(row["t_end"] <= at, row["line_full"]).otherwise(F.coalesce(row["line_open"], row["line_full"]))

    def body(shown: Column) -> Column:
        head = F.when(earlier == 0, F.concat(section["section"], F.lit(":\n"))).otherwise(F.lit(""))
        plain = F.array_join(F.transform(shown, lines), "")
        total = F.size(shown) if n is None else F.coalesce(n, F.size(shown))
        counted = F.array_join(F.transform(shown, lambda r, i: text.numbered(lines(r), earlier + i + 1, total)), "")
        return (
            F.when(F.size(shown) == 0, F.lit(""))
            .when(section["kind"] == "scalar", plain)
            .when(section["kind"] == "values", F.concat(head, plain))
            .otherwise(F.concat(head, counted))
        )

    return _let(F.filter(section["rows"], lambda r: r["t_eff"] <= at), body)


def document_text(events: Column, at: Column) -> Column:
    """The text of a stay as known at ``at``."""

    def header(event: Column) -> Column:
        return event["sections"][0]

    def event_text(event: Column, i: Column, n: Column) -> Column:
        sections = F.filter(event["sections"], lambda s: s["kind"] != "event")
        return F.concat(
            header(event)["section"],
            F.lit(" ("),
            (i + 1).cast("string"),
            F.lit(" of "),
            n.cast("string"),
            F.lit(")\n"),
            F.array_join(F.transform(sections, lambda s: _section_text(s, at)), ""),
            F.lit("\n\n"),
        )

    def body(shown: Column) -> Column:
        preamble = F.array_join(F.transform(shown, lambda e: header(e)["rows"][0]["line_full"]), "")
        blocks = F.array_join(F.transform(shown, lambda e, i: event_text(e, i, F.size(shown))), "")
        return F.concat(preamble, blocks)

    return _let(F.filter(events, lambda e: e["event_t"] <= at), body)


def snapshot_texts(snapshots: DataFrame, rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Add ``text`` to snapshots ``(stay_id, t, ...)``, one per instant of a stay, from the rows of their stays.

    Stays of about ``part_rows`` rows or fewer are one list each. Longer ones lie in parts of
    that length, which all their snapshots share.
    """
    shown = rows.where(~F.col("mute"))
    cuts = key_cuts(shown, ["stay_id"], PRINTED, part_rows)
    if cuts.table is None:
        return _whole_texts(snapshots, rows)
    long = cuts.table.select("stay_id")
    whole = _whole_texts(snapshots.join(long, "stay_id", "left_anti"), rows.join(long, "stay_id", "left_anti"))
    parted = _texts_by_parts(snapshots.join(long, "stay_id", "left_semi"), shown.join(long, "stay_id", "left_semi"), cuts)
    return whole.unionByName(parted)


def _whole_texts(snapshots: DataFrame, rows: DataFrame) -> DataFrame:
    joined = snapshots.join(stay_documents(rows), "stay_id")
    return joined.withColumn("text", document_text(F.col("events"), F.col("t"))).drop("events")


def with_closing_list(texts: DataFrame, items: DataFrame, tie: Sequence[str], item: str, heading: str = "Diagnoses") -> DataFrame:
    """Texts ``(stay_id, text, ...)`` with the stay's items as a list at their end; a stay without items gets no heading."""
    line = F.struct(*tie, text.value_line(F.col(item)).alias("__line"))
    listed = items.groupBy("stay_id").agg(F.array_sort(F.collect_list(line)).alias("__items"))
    joined = texts.join(listed.where(F.size("__items") > 0), "stay_id", "left")
    closing = F.concat(F.lit(f"{heading}:\n"), F.array_join(F.transform("__items", lambda r: r["__line"]), ""))
    full = F.concat("text", F.coalesce(closing, F.lit("")))
    return joined.withColumn("text", full).select(*texts.columns)


def _texts_by_parts(snapshots: DataFrame, rows: DataFrame, cuts: Cuts) -> DataFrame:
    """Texts put together from the pieces that a stay's parts give at an instant.

    Rows lie in parts in the order of a text. A piece needs three figures that its part alone
    does not give: how many events are visible, how many rows of a section lie in
    earlier parts, and how many of a section that runs on are visible in all parts. The
    first and last come from scans along time. A snapshot meets only parts that show something,
    so there are no more pairs than pieces of text.
    """
    snapshots, lines = stage(snapshots), stage(cuts.placed(rows, "part"))
    named = ["event_rank", "event_id", "section"]
    keys = ["stay_id", "event_t", "event_rank", "event_id", "sec_ord", "section", "kind"]
    parts = Window.partitionBy("stay_id", *named)
    spans = lines.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"), F.min("t_eff").alias("first_t")).withColumns(
        {
            "before": F.coalesce(F.sum("n").over(parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "runs_on": F.count(F.lit(1)).over(parts) > 1,
        }
    )
    spans = stage(spans)
    events = ordered_scan(spans.where(F.col("sec_ord") == HEADER).select(*keys[:4]), ["stay_id"], keys[1:4], number="event_no")

    by_section = lines.repartition("stay_id", "part").groupBy(*keys, "part").agg(F.array_sort(F.collect_list(_line())).alias("rows"))
    by_section = by_section.join(spans.select("stay_id", "part", *named, "before", "runs_on"), ["stay_id", "part", *named])
    by_event = by_section.groupBy("stay_id", "part", *keys[1:4]).agg(
        F.array_sort(F.collect_list(F.struct("sec_ord", "section", "kind", "before", "runs_on", "rows"))).alias("sections")
    )
    by_event = by_event.join(events.select("stay_id", *keys[2:4], "event_no"), ["stay_id", *keys[2:4]])
    documents = by_event.groupBy("stay_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("event_t", "event_rank", "event_id", "event_no", "sections"))).alias("events")
    )

    shown = events.groupBy("stay_id", F.col("event_t").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.max("event_t").alias("own_t"))
    asked = counts_at(shown, snapshots.select("stay_id", "t"), ["stay_id"]).select("stay_id", "t", F.col("n_visible").alias("n_events"))
    first = spans.groupBy("stay_id", "part").agg(F.min("first_t").alias("first_t"))
    pairs = stage(asked.join(first, "stay_id").where(F.col("first_t") <= F.col("t")).drop("first_t"))

    open_ = spans.where("runs_on").select("stay_id", "part", *named)
    changes = lines.join(open_.drop("part").distinct(), ["stay_id", *named], "left_semi")
    changes = changes.groupBy("stay_id", *named, F.col("t_eff").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("own_t"))
    seen = counts_at(changes, pairs.select("stay_id", "part", "t").join(open_, ["stay_id", "part"]), ["stay_id", *named])
    # A part holds at most two sections that run on: its first and its last.
    seen = seen.groupBy("stay_id", "part", "t").agg(F.collect_list(F.struct(*named, "n_visible")).alias("seen"))

    pieces = pairs.join(seen, ["stay_id", "part", "t"], "left").join(documents, ["stay_id", "part"])
    visible = F.filter("events", lambda e: e["event_t"] <= F.col("t"))
    pieces = pieces.select(
        "stay_id", "t", "part",
        F.array_join(F.transform(visible, lambda e: F.when(_opens(e), e["sections"][0]["rows"][0]["line_full"]).otherwise("")), "").alias("preamble"),
        F.array_join(F.transform(visible, _event_piece), "").alias("body"),
    )
    texts = pieces.groupBy("stay_id", "t").agg(F.array_sort(F.collect_list(F.struct("part", "preamble", "body"))).alias("__pieces"))
    preamble, body = F.transform("__pieces", lambda p: p["preamble"]), F.transform("__pieces", lambda p: p["body"])
    full = F.concat(F.array_join(preamble, ""), F.array_join(body, ""), F.lit("\n\n"))
    texts = texts.select("stay_id", "t", full.alias("text"))
    return snapshots.join(texts, ["stay_id", "t"], "left").select(*snapshots.columns, F.coalesce("text", F.lit("")).alias("text"))


def _opens(event: Column) -> Column:
    """Whether an event's own row is in this part."""
    return event["sections"][0]["kind"] == "event"


def _event_piece(event: Column) -> Column:
    """What a part says about an event; the blank lines that end an event stand ahead of the next one."""
    gap = F.when(event["event_no"] > 1, F.lit("\n\n")).otherwise(F.lit(""))
    head = F.concat(gap, event["sections"][0]["section"], F.lit(" ("), event["event_no"].cast("string"), F.lit(" of "), F.col("n_events").cast("string"), F.lit(")\n"))
    sections = F.filter(event["sections"], lambda s: s["kind"] != "event")

    def total(section: Column) -> Column:
        here = F.filter(
            "seen", lambda x: (x["event_rank"] == event["event_rank"]) & (x["event_id"] == event["event_id"]) & (x["section"] == section["section"])
        )
        return F.when(section["runs_on"], F.get(here, F.lit(0))["n_visible"])

    told = F.array_join(F.transform(sections, lambda s: _section_text(s, F.col("t"), s["before"], total(s))), "")
    return F.concat(F.when(_opens(event), head).otherwise(F.lit("")), told)
