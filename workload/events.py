"""Stays cut from the events table: a signup opens a stay of its user.

Views, clicks and purchases are sections of the stay; each error is a timeline
event of its own ("Incident").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions import text
from chronoweave.functions.identifiers import base_id, numeric_id, sample_id
from chronoweave.functions.tokens import PatternTokenizer
from chronoweave.operators.columns import known_at, recode, rename, keep_listed, drop_listed, whole_days
from chronoweave.operators.joins import counts_before, look_up, rows_before
from chronoweave.operators.ordered import ordered_scan
from chronoweave.plans.cohort import assign_stays, cohort, cohort_per_visit
from chronoweave.plans.samples import build_samples, token_dataset
from chronoweave.plans.snapshots import snapshot_sizes, snapshot_texts, stay_cuts, visibility_runs, visible_counts, with_closing_list
from chronoweave.plans.targets import answer_texts, change_groups, change_rows, next_changes
from chronoweave.plans.timeline import event_rows, section_rows, snapshot_times, union_rows
from chronoweave.session import stage
from chronoweave.spec import Section, Wording
from workload.base import query, table

TOKENIZER = PatternTokenizer()
WORDING = Wording(title="User:")
MAX_TOKENS = 220  # limit of the queries whose feature is the cut

START = Section("start time", "scalar", ("start_t",), time="start_t", spine=True)
PLAN = Section("plan", "scalar", ("plan",))
VIEWS = Section("views", "records", ("time", "value", "k"), time="time", tie=("row_id",), spine=True)
CLICKS = Section(
    "clicks", "records", ("time", "value", "k"), time="time", tie=("row_id",), spine=True, target=True,
    hidden=("time", "value"),
)
PURCHASES = Section(
    "purchases", "records", ("time", "value", "k"), time="time", tie=("row_id",), spine=True, target=True,
    hidden=("time",),
)
END = Section("end time", "scalar", ("end_t",), time="end_t", spine=True)
CODE = Section("code", "scalar", ("k",))
REPORTED = Section("reported codes", "values", ("k",), tie=("row_id",), target=True, mute=True)
TARGETS = ("clicks", "purchases")


def assigned(spark: SparkSession, sf: str) -> DataFrame:
    return assign_stays(
        table(spark, sf, "events"), "user_id", "ts", "event_id", F.col("event_type") == "signup"
    )


def stays_of(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "signup").select(
        "stay_id", F.col("user_id").alias("subject_id"), "start_t", "end_t", _k().alias("plan")
    )


def children_of(events: DataFrame) -> DataFrame:
    return events.where((F.col("event_type") != "signup") & F.col("stay_id").isNotNull())


def _k():
    return F.regexp_extract("props", "[0-9]+", 0)


def rows_of(spark: SparkSession, sf: str, more: bool = False) -> tuple[DataFrame, DataFrame]:
    """All timeline rows, and the stays they belong to; with ``more`` also the codes that a stay reports, as a list."""
    events = stage(assigned(spark, sf), "event_type")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("subject_id"), "c_name", "c_mktsegment")
    stays = stays_of(events).join(customers, "subject_id", "left")
    preamble = F.concat(
        F.lit(f"{WORDING.title}\n"),
        text.block([("name", F.col("c_name")), ("segment", F.col("c_mktsegment"))]),
        F.lit("\n"),
    )
    stay = stays.select("*", F.col("stay_id").alias("event_id"), F.col("start_t").alias("event_t"))
    child = children_of(events).select(
        "stay_id", F.col("stay_id").alias("event_id"), F.col("start_t").alias("event_t"), "event_type",
        F.col("ts").alias("time"), F.col("value").cast("decimal(18,2)").alias("value"), _k().alias("k"),
        F.col("event_id").alias("row_id"),
    )
    incident = child.where("event_type = 'error'").withColumns(
        {"event_id": F.col("row_id"), "event_t": F.col("time")}
    )

    def kind(name: str) -> DataFrame:
        return child.where(F.col("event_type") == name)

    parts = [
        event_rows(stay, TOKENIZER, event_type="Stay", rank=0, preamble=preamble),
        section_rows(stay, START, 0, TOKENIZER, rank=0),
        section_rows(stay, PLAN, 1, TOKENIZER, rank=0),
        section_rows(kind("view"), VIEWS, 2, TOKENIZER, rank=0),
        section_rows(kind("click"), CLICKS, 3, TOKENIZER, rank=0),
        section_rows(kind("purchase"), PURCHASES, 4, TOKENIZER, rank=0),
        section_rows(stay, END, 5, TOKENIZER, rank=0),
        event_rows(incident, TOKENIZER, event_type="Incident", rank=1),
        section_rows(incident, CODE, 0, TOKENIZER, rank=1),
    ]
    if more:
        parts.append(section_rows(kind("error"), REPORTED, 6, TOKENIZER, rank=0))
    return union_rows(parts), stays


# --- SQL shared by the queries below -----------------------------------------------------

STAYS_SQL = """
stays AS (
  SELECT event_id AS stay_id, user_id AS subject_id, ts AS start_t,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_t,
         regexp_extract(props, '[0-9]+') AS plan
  FROM events WHERE event_type = 'signup'),
marked AS (
  SELECT e.*, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS stay_id
  FROM events e),
child AS (
  SELECT m.*, s.start_t, s.end_t FROM marked m JOIN stays s USING (stay_id) WHERE m.event_type <> 'signup'),
sec AS (
  SELECT stay_id, ts AS t, event_id,
    CASE event_type WHEN 'view' THEN 'views' WHEN 'click' THEN 'clicks' ELSE 'purchases' END AS section,
    CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS sec_ord,
    value, regexp_extract(props, '[0-9]+') AS k
  FROM child WHERE event_type IN ('view', 'click', 'purchase')),
spine AS (
  SELECT stay_id, start_t AS t FROM stays UNION SELECT stay_id, t FROM sec
  UNION SELECT stay_id, end_t FROM stays WHERE end_t IS NOT NULL)
"""

# One snapshot text per spine row, by the naive join of snapshots with their past.
TEXT_SQL = (
    STAYS_SQL
    + """,
lines AS (
  SELECT stay_id, t, event_id, section, sec_ord,
    '   - time: ' || CAST(t AS VARCHAR) || chr(10) ||
    '   - value: ' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || chr(10) ||
    '   - k: ' || k || chr(10) AS line FROM sec),
seen AS (
  SELECT p.stay_id, p.t, l.section, l.sec_ord, l.line,
    row_number() OVER (PARTITION BY p.stay_id, p.t, l.section ORDER BY l.t, l.event_id) AS i,
    count(*) OVER (PARTITION BY p.stay_id, p.t, l.section) AS n
  FROM spine p JOIN lines l ON l.stay_id = p.stay_id AND l.t <= p.t),
sections AS (
  SELECT stay_id, t, sec_ord, section || ':' || chr(10) ||
    string_agg(' - ' || i || ' of ' || n || chr(10) || line, '' ORDER BY i) AS body
  FROM seen GROUP BY stay_id, t, sec_ord, section
  UNION ALL
  SELECT p.stay_id, p.t, 0, 'start time: ' || CAST(s.start_t AS VARCHAR) || chr(10) FROM spine p JOIN stays s USING (stay_id)
  UNION ALL
  SELECT p.stay_id, p.t, 1, 'plan: ' || s.plan || chr(10) FROM spine p JOIN stays s USING (stay_id)
  UNION ALL
  SELECT p.stay_id, p.t, 5, 'end time: ' || CAST(s.end_t AS VARCHAR) || chr(10)
  FROM spine p JOIN stays s USING (stay_id) WHERE s.end_t <= p.t),
stay_body AS (SELECT stay_id, t, string_agg(body, '' ORDER BY sec_ord) AS body FROM sections GROUP BY stay_id, t),
inc AS (
  SELECT p.stay_id, p.t, regexp_extract(c.props, '[0-9]+') AS k,
    1 + row_number() OVER (PARTITION BY p.stay_id, p.t ORDER BY c.ts, lpad(CAST(c.event_id AS VARCHAR), 20, '0')) AS i,
    1 + count(*) OVER (PARTITION BY p.stay_id, p.t) AS n
  FROM spine p JOIN child c ON c.stay_id = p.stay_id AND c.ts <= p.t WHERE c.event_type = 'error'),
inc_body AS (
  SELECT stay_id, t, max(n) AS n, string_agg('Incident (' || i || ' of ' || n || ')' || chr(10) || 'code: ' || k || chr(10)
    || chr(10) || chr(10), '' ORDER BY i) AS body FROM inc GROUP BY stay_id, t),
texts AS (
  SELECT p.stay_id, p.t, s.subject_id,
    'User:' || chr(10) || 'name: ' || c.c_name || chr(10) || 'segment: ' || c.c_mktsegment || chr(10) || chr(10) || chr(10)
    || 'Stay (1 of ' || coalesce(i.n, 1) || ')' || chr(10) || b.body || chr(10) || chr(10) || coalesce(i.body, '') AS text
  FROM spine p JOIN stays s USING (stay_id) JOIN customer c ON c.c_custkey = s.subject_id
  JOIN stay_body b USING (stay_id, t) LEFT JOIN inc_body i USING (stay_id, t))
"""
)

COUNT_SQL = "len(regexp_extract_all({0}, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r]'))"

NEXT_SQL = """,
nexts AS (
  SELECT p.stay_id, p.t, g.section, min(g.t) AS next_t
  FROM spine p JOIN sec g ON g.stay_id = p.stay_id AND g.t > p.t AND g.section <> 'views'
  GROUP BY p.stay_id, p.t, g.section),
plain AS (
  SELECT stay_id, section, t, value, k, min(event_id) AS tie FROM sec GROUP BY ALL),
listed AS (
  SELECT stay_id, section, t, value, k,
    row_number() OVER (PARTITION BY stay_id, section, t ORDER BY tie) AS i,
    count(*) OVER (PARTITION BY stay_id, section, t) AS n FROM plain),
printed AS (
  SELECT *, CASE WHEN section = 'purchases'
      THEN '   - value: ' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || chr(10) ELSE '' END
    || '   - k: ' || k || chr(10) AS line FROM listed),
answers AS (
  SELECT stay_id, section, t AS next_t, any_value(n) AS n_rows, sum(4 + """ + COUNT_SQL.format("line") + """) AS size,
    'Potential ' || section || ':' || chr(10) || string_agg(' - ' || i || ' of ' || n || chr(10) || line, '' ORDER BY i) AS answer
  FROM printed GROUP BY stay_id, section, t)
"""

# Sections sort by name as they rank: clicks, purchases, then the standing list.
FOUND_SQL = "SELECT stay_id, t, section, answer FROM nexts JOIN answers USING (stay_id, section, next_t)"
STANDING_SQL = """
  SELECT p.stay_id, p.t, 'reported codes' AS section, f.answer FROM spine p JOIN (
    SELECT stay_id, 'Potential reported codes:' || chr(10) ||
      string_agg(' - ' || regexp_extract(props, '[0-9]+') || chr(10), '' ORDER BY event_id) AS answer
    FROM child WHERE event_type = 'error' GROUP BY stay_id) f USING (stay_id)"""


def samples_sql(found: str, limit: int | None) -> str:
    """All samples, numbered and counted; then, with a limit, those ahead of a stay's first overlong one."""
    fits = "true" if limit is None else f"n_tokens < {limit} AND (first_over IS NULL OR number < first_over)"
    return (
        TEXT_SQL
        + NEXT_SQL
        + f""",
found AS ({found}),
numbered AS (
  SELECT x.stay_id, x.subject_id, x.t, n.section, x.text || chr(10) || chr(10) || 'Which ' || n.section || ' come next?' AS input,
    n.answer AS output,
    row_number() OVER (PARTITION BY x.stay_id ORDER BY x.t, n.section) - 1 AS number
  FROM texts x JOIN found n USING (stay_id, t)),
prompts AS (
  SELECT *, '<|im_start|>system' || chr(10) || 'You read the course of a stay and say what comes next.' || chr(10) || '<|im_end|>' || chr(10)
    || '<|im_start|>user' || chr(10) || input || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
    || output || chr(10) || '<|im_end|></s>' AS prompt FROM numbered),
counted AS (SELECT *, {COUNT_SQL.format("prompt")} AS n_tokens FROM prompts),
cutoff AS (SELECT stay_id, min(number) AS first_over FROM counted WHERE n_tokens > {limit or 0} GROUP BY stay_id),
samples AS (
  SELECT CAST(stay_id AS VARCHAR) || '_' || number AS sample_id, c.* FROM counted c LEFT JOIN cutoff o USING (stay_id)
  WHERE {fits})
"""
    )


# --- cohort and timeline ------------------------------------------------------------------


@query(
    "cohort_stays",
    f"""WITH {STAYS_SQL}
SELECT stay_id, subject_id, start_t, end_t, CAST(datediff('microsecond', start_t, end_t) // 86400000000 AS BIGINT) AS days
FROM stays s WHERE end_t < start_t + INTERVAL 7 DAY
AND EXISTS (SELECT 1 FROM child c WHERE c.stay_id = s.stay_id AND c.event_type = 'purchase')""",
)
def cohort_stays(spark, sf):
    events = assigned(spark, sf)
    visits = children_of(events).where("event_type = 'purchase'")
    chosen = cohort(stays_of(events), visits, "stay_id", "start_t", "end_t", days=7)
    return chosen.select(
        "stay_id", "subject_id", "start_t", "end_t", whole_days("start_t", "end_t").cast("bigint").alias("days")
    )


@query(
    "cohort_per_visit",
    f"""WITH {STAYS_SQL}
SELECT s.stay_id, s.subject_id, c.event_id AS visit_id FROM stays s
JOIN child c ON c.stay_id = s.stay_id AND c.event_type = 'purchase' WHERE s.end_t < s.start_t + INTERVAL 7 DAY""",
)
def cohort_fan_out(spark, sf):
    events = assigned(spark, sf)
    visits = children_of(events).where("event_type = 'purchase'").select("stay_id", F.col("event_id").alias("visit_id"))
    joined = cohort_per_visit(stays_of(events), visits, "stay_id", "start_t", "end_t", days=7)
    return joined.select("stay_id", "subject_id", "visit_id")


@query(
    "recode",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN 'Stay opened' WHEN 'error' THEN 'Incident' END AS label,
coalesce(event_type, props) AS sort_text FROM events""",
)
def recode_query(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        recode("event_type", {"signup": "Stay opened", "error": "Incident"}).alias("label"),
        F.coalesce("event_type", "props").alias("sort_text"),
    )


@query("rename_reorder", """SELECT event_type AS kind, ts AS "event time", event_id AS id FROM events""")
def rename_reorder(spark, sf):
    events = drop_listed(table(spark, sf, "events"), ["user_id", "props", "no such column"])
    named = rename(events, {"event_type": "kind", "ts": "event time", "event_id": "id"})
    return keep_listed(named, ["kind", "event time", "missing", "id"])


@query(
    "timeline",
    f"""WITH {STAYS_SQL},
ev AS (
  SELECT stay_id, 'Stay' AS event_type, 0 AS event_rank, start_t AS event_t, stay_id AS event_id FROM stays
  UNION ALL SELECT stay_id, 'Incident', 1, ts, event_id FROM child WHERE event_type = 'error')
SELECT stay_id, event_type, event_t, event_id,
  row_number() OVER (PARTITION BY stay_id ORDER BY event_t, event_rank, event_id) AS event_no FROM ev""",
)
def timeline(spark, sf):
    events = assigned(spark, sf)
    stay = stays_of(events).select(
        "stay_id", F.lit("Stay").alias("event_type"), F.lit(0).alias("event_rank"),
        F.col("start_t").alias("event_t"), F.col("stay_id").alias("event_id"),
    )
    incident = children_of(events).where("event_type = 'error'").select(
        "stay_id", F.lit("Incident").alias("event_type"), F.lit(1).alias("event_rank"),
        F.col("ts").alias("event_t"), "event_id",
    )
    numbered = ordered_scan(
        stay.unionByName(incident), ["stay_id"], ["event_t", "event_rank", "event_id"],
        number="event_no",
    )
    return numbered.select("stay_id", "event_type", "event_t", "event_id", "event_no")


@query(
    "subject_cutoff_join",
    f"""WITH {STAYS_SQL}
SELECT s.stay_id, count(e.event_id) AS n_before, CAST(sum(CAST(e.value AS DECIMAL(18,2))) AS DOUBLE) AS value_before,
  max_by(e.event_id, (e.ts, e.event_id)) AS last_before
FROM stays s LEFT JOIN events e ON e.user_id = s.subject_id AND e.event_type = 'error' AND e.ts < s.end_t
WHERE s.end_t IS NOT NULL GROUP BY s.stay_id""",
)
def subject_cutoff(spark, sf):
    events = assigned(spark, sf)
    anchors = stays_of(events).select(F.col("subject_id").alias("user_id"), "stay_id", F.col("end_t").alias("cutoff"))
    notes = table(spark, sf, "events").where("event_type = 'error'")
    notes = notes.withColumn("value", F.col("value").cast("decimal(18,2)"))
    found = counts_before(anchors, notes, "user_id", "cutoff", "ts", "event_id", "value")
    return found.select(
        "stay_id", "n_before", F.when(F.col("n_before") > 0, F.col("value_before").cast("double")).alias("value_before"),
        "last_before",
    )


HISTORY_SQL = (
    STAYS_SQL
    + """,
held AS (
  SELECT user_id, event_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number
  FROM events WHERE event_type = 'error'),
before AS (
  SELECT s.stay_id, h.number, h.event_id, h.ts, h.value, max(h.number) OVER (PARTITION BY s.stay_id) AS n_before
  FROM stays s JOIN held h ON h.user_id = s.subject_id AND h.ts < s.end_t)
"""
)


def _history(spark, sf, last=None):
    events = assigned(spark, sf)
    anchors = stays_of(events).select(F.col("subject_id").alias("user_id"), "stay_id", F.col("end_t").alias("cutoff"))
    notes = table(spark, sf, "events").where("event_type = 'error'").select("user_id", "event_id", "ts", "value")
    found = rows_before(anchors, notes, "user_id", "cutoff", "ts", ["event_id"], last=last, number="number")
    return found.select("stay_id", "number", "event_id", "ts", "value")


@query("subject_rows_before", f"WITH {HISTORY_SQL} SELECT stay_id, number, event_id, ts, value FROM before")
def subject_rows_before(spark, sf):
    """Every error of the subject before the end of the stay, in earlier stays too."""
    return _history(spark, sf)


@query("subject_last_rows", f"WITH {HISTORY_SQL} SELECT stay_id, number, event_id, ts, value FROM before WHERE number > n_before - 3")
def subject_last_rows(spark, sf):
    """The latest three of them: no others are read into a pair."""
    return _history(spark, sf, last=3)


# --- snapshots -----------------------------------------------------------------------------


@query("snapshot_spine", f"WITH {STAYS_SQL} SELECT stay_id, t FROM spine")
def spine(spark, sf):
    return snapshot_times(rows_of(spark, sf)[0])


MARKS_SQL = (
    STAYS_SQL
    + """,
marks AS (
  SELECT stay_id, CAST(stay_id AS VARCHAR) AS event_id, section, t FROM sec
  UNION ALL SELECT stay_id, CAST(stay_id AS VARCHAR), 'start time', start_t FROM stays
  UNION ALL SELECT stay_id, CAST(stay_id AS VARCHAR), 'plan', start_t FROM stays
  UNION ALL SELECT stay_id, CAST(stay_id AS VARCHAR), 'end time', end_t FROM stays WHERE end_t IS NOT NULL
  UNION ALL SELECT stay_id, CAST(event_id AS VARCHAR), 'code', ts FROM child WHERE event_type = 'error')
"""
)


def _marks(spark, sf):
    """What visibility reads of the rows; their texts are not printed."""
    return stage(rows_of(spark, sf)[0].where("kind <> 'event' or spine").select(
        "stay_id", "event_id", "event_t", "section", "kind", "t", "t_eff", "t_end", "spine", "mute"
    ))


@query(
    "snapshot_asof",
    f"""WITH {MARKS_SQL}
SELECT p.stay_id, m.event_id, m.section, p.t, count(*) AS n_visible, max(m.t) AS last_t
FROM spine p JOIN marks m ON m.stay_id = p.stay_id AND m.t <= p.t GROUP BY p.stay_id, m.event_id, m.section, p.t""",
)
def snapshot_asof(spark, sf):
    """What every snapshot sees, of all sections, incidents too."""
    return visible_counts(_marks(spark, sf)).select("stay_id", "event_id", "section", "t", "n_visible", "last_t")


@query(
    "snapshot_runs",
    f"""WITH {MARKS_SQL},
steps AS (SELECT stay_id, event_id, section, t, count(*) AS n FROM marks GROUP BY ALL)
SELECT stay_id, event_id, section, t AS from_t, lead(t) OVER w AS until_t, CAST(sum(n) OVER w AS BIGINT) AS n_visible, t AS last_t
FROM steps WINDOW w AS (PARTITION BY stay_id, event_id, section ORDER BY t)""",
)
def snapshot_runs(spark, sf):
    """The same as run lengths, linear in the events: between which instants the count of a section holds."""
    return visibility_runs(rows_of(spark, sf)[0])


@query(
    "snapshot_counts",
    f"""WITH {STAYS_SQL}
SELECT p.stay_id, l.section, p.t, count(*) AS n_visible, max(l.t) AS last_t
FROM spine p JOIN sec l ON l.stay_id = p.stay_id AND l.t <= p.t GROUP BY p.stay_id, l.section, p.t""",
)
def snapshot_counts(spark, sf):
    """Run lengths expanded to the snapshots, for the three sections that are asked for."""
    rows = stage(rows_of(spark, sf)[0].where("kind = 'records' or spine").select(
        "stay_id", "event_id", "event_t", "section", "kind", "t", "t_eff", "t_end", "spine", "mute"
    ))
    names = F.explode(F.array(*[F.lit(s.name) for s in (VIEWS, CLICKS, PURCHASES)])).alias("section")
    asked = snapshot_times(rows).select("stay_id", F.col("stay_id").cast("string").alias("event_id"), names, "t")
    return visible_counts(rows, asked).select("stay_id", "section", "t", "n_visible", "last_t")


@query(
    "event_visibility",
    f"""WITH {STAYS_SQL}
SELECT p.stay_id, p.t, count(c.event_id) AS n_events FROM spine p
JOIN child c ON c.stay_id = p.stay_id AND c.event_type = 'error' AND c.ts <= p.t GROUP BY p.stay_id, p.t""",
)
def event_visibility(spark, sf):
    """Events visible at each snapshot, as one running count per stay."""
    rows = rows_of(spark, sf)[0]
    incidents = rows.where("kind = 'event' and event_rank = 1").groupBy("stay_id", "t").agg(
        F.count(F.lit(1)).alias("n")
    )
    asked = snapshot_times(rows).withColumn("asked", F.lit(True))
    merged = incidents.unionByName(asked, allowMissingColumns=True).groupBy("stay_id", "t").agg(
        F.sum("n").alias("n"), F.max("asked").alias("asked")
    )
    counted = ordered_scan(merged, ["stay_id"], ["t"], running={"n_events": "n"})
    return counted.where("asked and n_events > 0").select("stay_id", "t", "n_events")


@query(
    "snapshot_censored",
    f"""WITH {STAYS_SQL}
SELECT p.stay_id, p.t, CASE WHEN s.end_t <= p.t THEN s.end_t END AS end_t,
  CASE WHEN s.end_t <= p.t THEN s.plan END AS outcome FROM spine p JOIN stays s USING (stay_id)""",
)
def snapshot_censored(spark, sf):
    rows, stays = rows_of(spark, sf)
    return snapshot_times(rows).join(stays, "stay_id").select(
        "stay_id", "t", known_at("end_t", "end_t", "t").alias("end_t"), known_at("plan", "end_t", "t").alias("outcome")
    )


@query(
    "snapshot_text",
    f"WITH {TEXT_SQL} SELECT stay_id, t, text, {COUNT_SQL.format('text')} AS n_tokens FROM texts",
)
def snapshot_text(spark, sf):
    rows = stage(rows_of(spark, sf)[0])
    sizes = snapshot_sizes(rows, TOKENIZER)
    asked = sizes.where("in_spine").select("stay_id", "t", F.col("size").cast("bigint").alias("n_tokens"))
    return snapshot_texts(asked, rows).select("stay_id", "t", "text", "n_tokens")


def _anchored(spark, sf, kind: str):
    """Stays as anchors, and their events of one kind beside them."""
    events = stage(assigned(spark, sf), "event_type")
    stays = stays_of(events)
    anchor = stays.select("stay_id", F.col("stay_id").alias("event_id"), F.col("start_t").alias("event_t"))
    rows = children_of(events).where(F.col("event_type") == kind).select(
        "stay_id", F.col("stay_id").alias("event_id"), F.col("start_t").alias("event_t"),
        F.col("ts").alias("time"), "value", _k().alias("k"), F.col("event_id").alias("row_id"),
    )
    return stays, anchor, rows


@query(
    "snapshot_end_times",
    f"""WITH {STAYS_SQL},
seen AS (SELECT stay_id, t, event_id, k, t + to_minutes(CAST(floor(value) AS BIGINT)) AS until FROM sec WHERE section = 'views'),
moments AS (SELECT stay_id, start_t AS t FROM stays UNION SELECT stay_id, t FROM seen UNION SELECT stay_id, until FROM seen),
listed AS (
  SELECT m.stay_id, m.t, '   - time: ' || CAST(v.t AS VARCHAR) || chr(10) || '   - k: ' || v.k || chr(10)
      || CASE WHEN v.until <= m.t THEN '   - until: ' || CAST(v.until AS VARCHAR) || chr(10) ELSE '' END AS line,
    row_number() OVER (PARTITION BY m.stay_id, m.t ORDER BY v.t, v.event_id) AS i, count(*) OVER (PARTITION BY m.stay_id, m.t) AS n
  FROM moments m JOIN seen v ON v.stay_id = m.stay_id AND v.t <= m.t),
bodies AS (SELECT stay_id, t, 'views:' || chr(10) || string_agg(' - ' || i || ' of ' || n || chr(10) || line, '' ORDER BY i) AS body FROM listed GROUP BY 1, 2)
SELECT stay_id, t, 'Stay (1 of 1)' || chr(10) || coalesce(body, '') || chr(10) || chr(10) AS text FROM moments LEFT JOIN bodies USING (stay_id, t)""",
)
def snapshot_end_times(spark, sf):
    """Views with an end time, which is printed only once it has passed, and opens a snapshot of its own."""
    _, anchor, views = _anchored(spark, sf, "view")
    views = views.withColumn("until", F.col("time") + F.make_dt_interval(mins=F.floor("value").cast("int")))
    section = Section("views", "records", ("time", "k", "until"), time="time", end="until", tie=("row_id",), spine=True)
    rows = union_rows(
        [event_rows(anchor, TOKENIZER, event_type="Stay", rank=0, spine=True), section_rows(views, section, 0, TOKENIZER, rank=0)]
    )
    rows = stage(rows)
    return snapshot_texts(snapshot_times(rows), rows)


@query(
    "midnight_section",
    f"""WITH {STAYS_SQL}
SELECT stay_id, CAST(CAST(t AS DATE) AS TIMESTAMP) AS t, greatest(CAST(CAST(t AS DATE) AS TIMESTAMP), start_t) AS visible_from,
  '   - day: ' || CAST(CAST(t AS DATE) AS VARCHAR) || chr(10) || '   - k: ' || k || chr(10) AS line
FROM sec JOIN stays USING (stay_id) WHERE section = 'clicks'""",
)
def midnight_section(spark, sf):
    """Clicks known by their day only: a date counts as its first instant, but no row is visible before its stay."""
    _, _, clicks = _anchored(spark, sf, "click")
    days = clicks.withColumn("day", F.to_date("time"))
    rows = section_rows(days, Section("clicks", "records", ("day", "k"), time="day", tie=("row_id",), spine=True), 0, TOKENIZER, rank=0)
    return rows.select("stay_id", "t", F.col("t_eff").alias("visible_from"), F.col("line_full").alias("line"))


@query(
    "subject_block",
    f"""WITH {STAYS_SQL}
SELECT s.stay_id, 'User:' || chr(10) || 'name: ' || c_name || chr(10) || 'segment: ' || c_mktsegment || chr(10) || 'plan: ' || s.plan || chr(10)
  || 'end time: ' || coalesce(CAST(s.end_t AS VARCHAR), '?') || chr(10) || chr(10) AS block
FROM stays s JOIN customer ON c_custkey = s.subject_id WHERE s.end_t IS NOT NULL
UNION ALL
SELECT s.stay_id, 'User:' || chr(10) || 'name: ' || c_name || chr(10) || 'segment: ' || c_mktsegment || chr(10) || 'plan: ' || s.plan || chr(10) || chr(10)
FROM stays s JOIN customer ON c_custkey = s.subject_id WHERE s.end_t IS NULL""",
)
def subject_block(spark, sf):
    """Fields of the stay moved into the block of its subject; one that is null is left out."""
    stays = stays_of(assigned(spark, sf))
    moved = stays.select("stay_id", "plan", F.col("end_t").alias("end time"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("subject_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    block = keep_listed(
        look_up(look_up(stays.select("stay_id", "subject_id"), customers, ["subject_id"]), moved, ["stay_id"]),
        ["stay_id", "name", "segment", "plan", "end time"],
    )
    shown = [(c, F.col(f"`{c}`")) for c in block.columns if c != "stay_id"]
    return block.select("stay_id", F.concat(F.lit(f"{WORDING.title}\n"), text.block(shown)).alias("block"))


@query(
    "closing_list",
    f"""WITH {TEXT_SQL},
codes AS (
  SELECT stay_id, 'Codes:' || chr(10) || string_agg(' - ' || regexp_extract(props, '[0-9]+') || chr(10), '' ORDER BY event_id) AS listed
  FROM child WHERE event_type = 'error' GROUP BY stay_id),
lasts AS (SELECT stay_id, max(t) AS t FROM spine GROUP BY stay_id)
SELECT stay_id, t, text || coalesce(listed, '') AS text FROM texts JOIN lasts USING (stay_id, t) LEFT JOIN codes USING (stay_id)""",
)
def closing_list(spark, sf):
    """The whole course of each stay, with what it reported as a list at its end."""
    rows, _ = rows_of(spark, sf)
    rows = stage(rows)
    last = snapshot_times(rows).groupBy("stay_id").agg(F.max("t").alias("t"))
    codes = rows.where("section = 'code'").select("stay_id", F.col("event_id").cast("bigint").alias("n"), F.regexp_extract("line_full", "[0-9]+", 0).alias("k"))
    return with_closing_list(snapshot_texts(last, rows), codes, ["n"], "k", "Codes").select("stay_id", "t", "text")


# --- targets and samples ---------------------------------------------------------------------


@query("next_change", f"WITH {STAYS_SQL}{NEXT_SQL} SELECT stay_id, t, section, next_t FROM nexts")
def next_change(spark, sf):
    rows = stage(rows_of(spark, sf)[0])
    found = next_changes(snapshot_times(rows), change_groups(change_rows(rows)), TARGETS, stay_cuts(rows))
    return found.select("stay_id", "t", "section", "next_t")


@query(
    "answer_text",
    f"WITH {STAYS_SQL}{NEXT_SQL} SELECT stay_id, section, next_t, answer FROM answers WHERE section <> 'views'"
    " AND next_t IN (SELECT n.next_t FROM nexts n WHERE n.stay_id = answers.stay_id AND n.section = answers.section)",
)
def answer_text(spark, sf):
    rows = stage(rows_of(spark, sf)[0])
    changes = change_rows(rows)
    found = stage(next_changes(snapshot_times(rows), change_groups(changes), TARGETS, stay_cuts(rows)))
    return answer_texts(changes, found, WORDING)


SAMPLE_COLUMNS = "SELECT sample_id, subject_id, stay_id, t, section, input, output, n_tokens FROM samples"


@query("training_samples", f"WITH {samples_sql(FOUND_SQL, None)} {SAMPLE_COLUMNS}")
def training_samples(spark, sf):
    """Every sample, whatever its length."""
    rows, stays = rows_of(spark, sf)
    return build_samples(rows, stays, targets=TARGETS, wording=WORDING, tokenizer=TOKENIZER, max_tokens=None)


@query("standing_samples", f"WITH {samples_sql(f'{FOUND_SQL} UNION ALL {STANDING_SQL}', MAX_TOKENS)} {SAMPLE_COLUMNS}")
def standing_samples(spark, sf):
    """With a list that is asked whole at every snapshot; a stay ends at its first sample over the limit."""
    rows, stays = rows_of(spark, sf, more=True)
    return build_samples(
        rows, stays, targets=TARGETS, standing=(REPORTED.name,), wording=WORDING, tokenizer=TOKENIZER, max_tokens=MAX_TOKENS
    )


@query(
    "token_dataset",
    f"WITH {samples_sql(FOUND_SQL, MAX_TOKENS)} SELECT sample_id, subject_id, n_tokens AS token_count FROM samples",
)
def token_dataset_query(spark, sf):
    """Token rows of the samples that fit, cut by size before texts are built and by true counts after."""
    rows, stays = rows_of(spark, sf)
    samples = build_samples(rows, stays, targets=TARGETS, wording=WORDING, tokenizer=TOKENIZER, max_tokens=MAX_TOKENS)
    tokens = token_dataset(samples.select("sample_id", "subject_id", "input", "output"), TOKENIZER, WORDING, max_tokens=MAX_TOKENS)
    return tokens.select("sample_id", "subject_id", F.col("token_count").cast("bigint").alias("token_count"))


@query(
    "sample_ids",
    """WITH ids AS (SELECT user_id || '_' || event_id AS sample_id FROM events
  UNION ALL SELECT event_id || '_discharge' FROM events WHERE event_type = 'signup')
SELECT sample_id, CASE WHEN sample_id LIKE '%discharge' THEN replace(sample_id, '_discharge', '')
  ELSE array_to_string(list_slice(string_split(sample_id, '_'), 1, -2), '_') END AS base_id,
  CASE WHEN sample_id NOT LIKE '%discharge' THEN CAST(string_split(sample_id, '_')[-1] AS BIGINT) END AS numeric_id FROM ids""",
)
def sample_ids(spark, sf):
    events = table(spark, sf, "events")
    ids = events.select(sample_id("user_id", "event_id").alias("sample_id")).unionByName(
        events.where("event_type = 'signup'").select(sample_id("event_id", F.lit("discharge")).alias("sample_id"))
    )
    return ids.select("sample_id", base_id("sample_id").alias("base_id"), numeric_id("sample_id").alias("numeric_id"))
