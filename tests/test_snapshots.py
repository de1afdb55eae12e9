"""Plans against brute force, on stays of which one holds a third of the rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from chronoweave.functions.tokens import HookTokenizer, PatternTokenizer
from chronoweave.operators.ordered import key_cuts
from chronoweave.plans.samples import build_samples, cut_after_overflow, discharge_samples, token_dataset, tokenise
from chronoweave.plans.snapshots import PRINTED, fitting_rows, snapshot_sizes, snapshot_texts, visibility_runs, visible_counts
from chronoweave.plans.targets import change_groups, change_rows, next_changes
from chronoweave.plans.timeline import event_rows, section_rows, snapshot_times, sort_key, sort_key_of, union_rows, whole_numbers
from chronoweave.session import stage
from chronoweave.spec import Section, Wording

TOKENIZER = PatternTokenizer()
START = datetime(2021, 3, 1)
FINDINGS = Section("findings", "values", ("name",), tie=("n",), target=True, mute=True)
LABS = Section("labs", "records", ("time", "name", "value"), time="time", tie=("id",), spine=True, target=True, hidden=("time", "value"))
BEDS = Section("beds", "records", ("time", "name", "until"), time="time", end="until", tie=("id",), spine=True, target=True)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    labs, beds = [], []
    for i in range(240):
        stay = 0 if i % 3 == 0 else rng.randrange(1, 12)
        t = START + timedelta(hours=rng.randrange(-20, 200))
        value = rng.choice(["low", "None", "high", None])
        if i % 4:
            labs.append((stay, i if i % 5 else i - 1, t, f"lab{rng.randrange(3)}", value))
        else:
            beds.append((stay, i, t, f"ward {i % 7}", t + timedelta(hours=rng.randrange(1, 60)) if i % 8 else None))
    stays = spark.createDataFrame([(s, 100 + s % 3, START) for s in range(13)], "stay_id int, subject_id int, event_t timestamp_ntz")
    anchor = stays.select("stay_id", F.col("stay_id").alias("event_id"), "event_t")
    labs = spark.createDataFrame(labs, "stay_id int, id int, time timestamp_ntz, name string, value string").join(anchor, "stay_id")
    beds = spark.createDataFrame(beds, "stay_id int, id int, time timestamp_ntz, name string, until timestamp_ntz").join(anchor, "stay_id")
    rows = union_rows(
        [
            event_rows(anchor, TOKENIZER, event_type="Stay", rank=0, preamble=F.lit("Who:\nname: x\n\n\n"), spine=True),
            section_rows(labs, LABS, 0, TOKENIZER, rank=0),
            section_rows(beds, BEDS, 1, TOKENIZER, rank=0),
        ]
    )
    return stage(rows), stays


def cuts_of(rows, length):
    return key_cuts(rows, ["stay_id"], ["t"], length)


@pytest.mark.parametrize("length", [1, 40, 10_000])
def test_counts_equal_the_range_join(data, length):
    rows, _ = data
    got = visible_counts(rows, cuts=cuts_of(rows, length)).select("stay_id", "section", "t", "n_visible")
    shown = rows.where("kind <> 'event'").select(F.col("stay_id").alias("s"), "section", "t_eff")
    times = snapshot_times(rows)
    want = times.join(shown, (F.col("stay_id") == F.col("s")) & (F.col("t_eff") <= F.col("t"))).groupBy("stay_id", "section", "t").agg(
        F.count(F.lit(1)).alias("n_visible")
    )
    assert got.count() > 100
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


@pytest.mark.parametrize("length", [1, 40, 10_000])
def test_next_changes_equal_the_search(data, length):
    rows, _ = data
    times, groups = snapshot_times(rows), change_groups(change_rows(rows))
    got = next_changes(times, groups, ["labs", "beds"], cuts_of(rows, length)).select("stay_id", "t", "section", "next_t", "n_rows")
    g = groups.select(F.col("stay_id").alias("s"), "section", F.col("t").alias("gt"), "n_rows")
    later = times.join(g, (F.col("stay_id") == F.col("s")) & (F.col("gt") > F.col("t")))
    first = later.groupBy("stay_id", "t", "section").agg(
        F.min("gt").alias("next_t"), F.min_by("n_rows", "gt").alias("n_rows")
    )
    assert got.count() > 100
    assert got.exceptAll(first).count() == 0 and got.count() == first.count()


def test_a_snapshot_is_scanned_once_for_all_sections(data):
    """Snapshots meet the sections after the scan, so that what is shuffled does not grow with the number of sections."""
    rows, _ = data
    found = next_changes(snapshot_times(rows), change_groups(change_rows(rows)), ["labs", "beds"], cuts_of(rows, 10_000))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Window")


def test_sort_keys_of_whole_numbers_travel_as_numbers(spark):
    whole = spark.createDataFrame([(1, -3), (None, 2**62), (4, None)], "a int, b long")
    other = spark.createDataFrame([(1, "x", 0.5), (2, None, None)], "a int, b string, c double")
    for df, names, packed in ((whole, ("a", "b"), 3), (whole, (), 3), (other, ("a", "b", "c"), 1), (other.selectExpr("a + 0.5BD AS a"), ("a",), 0)):
        keyed = df.select(sort_key(df, names).alias("tie")).withColumn("numbers", whole_numbers("tie"))
        back = keyed.withColumn("again", F.coalesce(sort_key_of("numbers"), "tie"))
        assert keyed.where("numbers IS NOT NULL").count() == packed and back.where("again <=> tie").count() == df.count()


def test_runs_hold_what_snapshots_see(data):
    """One run per section and instant of change, and at every snapshot the run around it says the count."""
    rows, _ = data
    runs = visibility_runs(rows, cuts_of(rows, 25))
    shown = rows.where("kind <> 'event'")
    assert runs.count() == shown.select("stay_id", "event_id", "section", "t_eff").distinct().count()
    asked = visible_counts(rows)
    names = {"stay_id": "s", "event_id": "e", "section": "sec", "n_visible": "n", "last_t": "l"}
    held = asked.join(
        runs.withColumnsRenamed(names),
        F.expr("stay_id = s AND event_id = e AND section = sec AND from_t <= t AND (until_t IS NULL OR t < until_t)"),
    )
    assert held.count() == asked.count() > 100 and held.where("n <> n_visible OR l <> last_t").count() == 0


@pytest.mark.parametrize("part_rows", [1, 7, 60])
def test_texts_by_parts_equal_whole_texts(data, part_rows):
    rows, _ = data
    times = snapshot_times(rows).withColumn("mark", F.lit(3))
    whole, parted = snapshot_texts(times, rows), snapshot_texts(times, rows, part_rows)
    assert key_cuts(rows, ["stay_id"], PRINTED, part_rows).table.count() >= (10 if part_rows < 60 else 1)
    assert parted.columns == whole.columns and parted.count() == whole.count() == times.count()
    assert parted.exceptAll(whole).count() == 0


def test_parts_of_several_events_and_kinds(spark):
    """Events, lists and scalars that run over the ends of parts, one of them later than its event's rows."""
    at = [START + timedelta(hours=h) for h in range(40)]
    stay = spark.createDataFrame([(1, 1, at[0]), (2, 2, at[5])], "stay_id int, event_id int, event_t timestamp_ntz")
    more = spark.createDataFrame([(1, 50 + i, at[3 * i], f"code {i}") for i in range(1, 9)], "stay_id int, event_id int, event_t timestamp_ntz, code string")
    labs = [(1, 1, at[0], i, at[(7 * i) % 40], f"lab{i}") for i in range(60)] + [(1, 53, at[9], i, at[i % 12], f"late{i}") for i in range(20)]
    labs = spark.createDataFrame(labs, "stay_id int, event_id int, event_t timestamp_ntz, id int, time timestamp_ntz, name string").withColumn("value", F.lit("v"))
    lists = labs.where("event_id = 1 AND id % 3 = 0")
    rows = stage(
        union_rows(
            [
                event_rows(stay, TOKENIZER, event_type="Stay", rank=0, preamble=F.lit("Who:\n\n"), spine=True),
                section_rows(lists, Section("names", "values", ("name",), tie=("id",)), 0, TOKENIZER, rank=0),
                section_rows(labs.where("event_id = 1"), LABS, 1, TOKENIZER, rank=0),
                event_rows(more, TOKENIZER, event_type="Visit", rank=1),
                section_rows(more, Section("code", "scalar", ("code",)), 0, TOKENIZER, rank=1),
                section_rows(labs.where("event_id = 53"), LABS, 1, TOKENIZER, rank=1),
            ]
        )
    )
    times = spark.createDataFrame([(1, t) for t in at] + [(2, at[5])], "stay_id int, t timestamp_ntz")
    whole = snapshot_texts(times, rows)
    for part_rows in (1, 4, 13):
        assert snapshot_texts(times, rows, part_rows).exceptAll(whole).count() == 0


def test_a_long_stay_is_built_by_many_tasks(spark):
    """100,000 rows of one stay: lists of bounded length, the text of each snapshot as if it were one list."""
    n, step = 100_000, 25_000
    anchor = F.lit(START).cast("timestamp_ntz")
    each = spark.range(n).select(
        F.lit(1).alias("stay_id"), F.lit(1).alias("event_id"), anchor.alias("event_t"), F.col("id"),
        (anchor + F.make_dt_interval(secs=(F.col("id") / 3).cast("int"))).alias("time"), F.concat(F.lit("lab"), F.col("id") % 5).alias("name"),
        F.lit("v").alias("value"),
    )
    stay = spark.createDataFrame([(1, 1, START)], "stay_id int, event_id int, event_t timestamp_ntz")
    rows = stage(union_rows([event_rows(stay, TOKENIZER, event_type="Stay", rank=0), section_rows(each, LABS, 0, TOKENIZER, rank=0)]))
    times = spark.createDataFrame([(1, START + timedelta(seconds=k)) for k in range(0, n // 3, step // 3)], "stay_id int, t timestamp_ntz")
    placed = key_cuts(rows, ["stay_id"], PRINTED, 10_000).placed(rows).groupBy("__stretch").count().collect()
    assert len(placed) >= 8 and max(r["count"] for r in placed) < 14_000
    for r in snapshot_texts(times, rows).collect():
        seen = [i for i in range(n) if START + timedelta(seconds=i // 3) <= r["t"]]
        body = "".join(
            f" - {i + 1} of {len(seen)}\n   - time: {START + timedelta(seconds=i // 3)}\n   - name: lab{i % 5}\n   - value: v\n" for i in seen
        )
        assert r["text"] == f"Stay (1 of 1)\nlabs:\n{body}\n\n"


@pytest.mark.parametrize("length", [1, 10_000])
def test_sizes_and_texts(data, length):
    rows, _ = data
    sizes = snapshot_sizes(rows, TOKENIZER, cuts_of(rows, length))
    texts = snapshot_texts(sizes.where("in_spine"), rows)
    counted = texts.withColumn("n", TOKENIZER.count(F.col("text")))
    assert counted.where("n <> size").count() == 0 and counted.count() > 100
    limited = sizes.where("size <= 150")
    kept = fitting_rows(rows, limited, 150)
    assert kept.count() < rows.count()
    same = snapshot_texts(limited.where("in_spine"), kept).select("stay_id", "t", "text")
    assert same.exceptAll(texts.select("stay_id", "t", "text")).count() == 0
    assert same.count() == limited.where("in_spine").count()


def test_nothing_from_the_future(data):
    rows, _ = data
    texts = snapshot_texts(snapshot_times(rows), rows)
    stamps = F.explode(F.regexp_extract_all("text", F.lit(r"(?:time|until): ([0-9: -]+[0-9])"), F.lit(1)))
    seen = texts.select("t", stamps.alias("stamp"))
    assert seen.count() > 500
    assert seen.where(F.col("stamp").cast("timestamp_ntz") > F.col("t")).count() == 0


@pytest.fixture(scope="module")
def with_lists(spark, data):
    """A standing list for most stays; that of stay 3 is over every limit, that of stay 5 over some."""
    rows, stays = data
    lengths = {0: 2, 1: 5, 2: 9, 3: 200, 5: 45, 6: 1, 8: 3}
    listed = [(stay, i, f"finding {i}") for stay, n in lengths.items() for i in range(n)]
    anchor = stays.select("stay_id", F.col("stay_id").alias("event_id"), "event_t")
    lists = spark.createDataFrame(listed, "stay_id int, n int, name string").join(anchor, "stay_id")
    return stage(rows.unionByName(section_rows(lists, FINDINGS, 2, TOKENIZER, rank=0))), stays


@pytest.mark.parametrize(("limit", "standing"), [(120, ()), (200, ()), (350, ()), (120, ("findings",)), (350, ("findings",))])
def test_samples_equal_cutting_after_rendering(data, with_lists, limit, standing):
    """Cutting by sizes before rendering keeps exactly what cutting by real token counts keeps."""
    rows, stays = with_lists if standing else data
    wording = Wording()
    common = dict(targets=["labs", "beds"], standing=standing, wording=wording, tokenizer=TOKENIZER)
    early = stage(build_samples(rows, stays, max_tokens=limit, **common))
    every = stage(build_samples(rows, stays, max_tokens=None, **common))
    tokens = tokenise(every, TOKENIZER, wording)
    assert tokens.where("token_count <> n_tokens").count() == 0
    numbered = every.withColumn("number", F.substring_index("sample_id", "_", -1).cast("int"))
    late = cut_after_overflow(numbered, "stay_id", "number", "n_tokens", limit).drop("number")
    assert 0 < early.count() < every.count()
    assert early.exceptAll(late).count() == 0 and early.count() == late.count()


def test_a_lower_bound_cuts_nothing_that_fits(spark, data):
    """With a tokenizer whose size is only bounded from below, the true counts decide in the end."""

    def load():
        return lambda s: [len(s[i : i + 3]) for i in range(0, len(s), 3)]

    tokenizer = HookTokenizer(load, longest=3)
    rng = random.Random(9)
    stays = spark.createDataFrame([(s, s, START) for s in range(5)], "stay_id int, subject_id int, event_t timestamp_ntz")
    anchor = stays.select("stay_id", F.col("stay_id").alias("event_id"), "event_t")
    labs = [(0 if i % 3 == 0 else rng.randrange(1, 5), i, START + timedelta(hours=rng.randrange(100)), "lab", "v") for i in range(60)]
    labs = spark.createDataFrame(labs, "stay_id int, id int, time timestamp_ntz, name string, value string").join(anchor, "stay_id")
    rows = union_rows(
        [
            event_rows(anchor, tokenizer, event_type="Stay", rank=0, preamble=F.lit("Who:\n\n"), spine=True),
            section_rows(labs, LABS, 0, tokenizer, rank=0),
        ]
    )
    common = dict(targets=["labs"], wording=Wording(), tokenizer=tokenizer)
    limit = 260
    early = build_samples(rows, stays, max_tokens=limit, **common)
    every = build_samples(rows, stays, max_tokens=None, **common)
    kept = token_dataset(early, tokenizer, Wording(), limit).select("sample_id", "token_count")
    want = token_dataset(every, tokenizer, Wording(), limit).select("sample_id", "token_count")
    assert 0 < kept.count() == want.count() < every.count()
    assert kept.exceptAll(want).count() == 0
    assert early.count() < every.count()


def test_ties_are_typed_and_whole(spark):
    """Numbers sort as numbers, texts by their whole length."""
    anchor = spark.createDataFrame([(1, START)], "stay_id int, event_t timestamp_ntz").withColumn("event_id", F.col("stay_id"))
    drug = "Acetaminophen 325 mg "
    made = [(1, 10, drug + "tablet"), (1, -5, "b"), (1, 10, drug + "suppository"), (1, 9, "a"), (1, -40, "ab")]
    df = spark.createDataFrame(made, "stay_id int, n long, name string").join(anchor, "stay_id")

    def order(*tie):
        rows = section_rows(df, Section("drugs", "values", ("name",), tie=tie), 0, TOKENIZER, rank=0)
        return [r["line_full"][3:-1] for r in rows.orderBy("tie").collect()]

    assert order("n", "name") == ["ab", "b", "a", drug + "suppository", drug + "tablet"]
    assert order("name") == [drug + "suppository", drug + "tablet", "a", "ab", "b"]


def test_discharge_samples_keep_every_label(spark):
    stays = spark.createDataFrame([(1, 7, "note"), (2, 7, "note")], "stay_id int, subject_id int, note string")
    labels = spark.createDataFrame([(1, i, f"d{i}") for i in range(500)], "stay_id int, n int, name string")
    got = discharge_samples(stays, labels, preamble=F.lit(""), note="note", label="name", tie=["n"], question="Which?").collect()
    assert [r["output"] for r in got] == ["Potential diagnoses:\n" + "".join(f" - d{i}\n" for i in range(500)) + "\n"]


def test_long_label_lists_give_no_discharge_sample(spark):
    stays = spark.createDataFrame([(1, 7, "note"), (2, 7, "note"), (3, 7, "note")], "stay_id int, subject_id int, note string")
    labels = spark.createDataFrame([(1, i, f"d{i}") for i in range(3)] + [(2, i, f"d{i}") for i in range(50)], "stay_id int, n int, name string")
    got = discharge_samples(
        stays, labels, preamble=F.lit("x: y\n\n"), note="note", label="name", tie=["n"], question="Which?",
        tokenizer=TOKENIZER, max_tokens=20,
    ).collect()
    assert [(r["sample_id"], r["input"], r["output"]) for r in got] == [
        ("1_discharge", "x: y\n\nnote: note\n\n\nWhich?", "Potential diagnoses:\n - d0\n - d1\n - d2\n\n")
    ]


def test_asof_query_tells_every_snapshot_all_its_sections(spark, tmp_path):
    """A row per snapshot and section seen by then, incidents too: against a plain count over all pairs."""
    kinds = ["signup", "view", "error", "view", "click", "error", "purchase", "signup", "error", "view"]
    events = [(100 * u + i, u, START + timedelta(hours=i), k, 1.5, '{"k": 7}') for u in (1, 2) for i, k in enumerate(kinds)]
    schema = "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, "a", "x")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = queries()["snapshot_asof"](spark, str(tmp_path)).collect()

    names = {"view": "views", "click": "clicks", "purchase": "purchases"}
    want = {}
    for u in (1, 2):
        for first, last in ((0, 7), (7, 10)):
            stay, at = 100 * u + first, lambda i: START + timedelta(hours=i)
            marks = [(str(stay), "start time", at(first)), (str(stay), "plan", at(first))] + [(str(stay), "end time", at(7))] * (first == 0)
            marks += [(str(stay), names[kinds[i]], at(i)) for i in range(first, last) if kinds[i] in names]
            marks += [(str(100 * u + i), "code", at(i)) for i in range(first, last) if kinds[i] == "error"]
            for t in {t for event, section, t in marks if section != "code"}:
                for event, section, shown in marks:
                    if shown <= t:
                        n, latest = want.get((stay, event, section, t), (0, shown))
                        want[stay, event, section, t] = n + 1, max(shown, latest)
    assert {(r.stay_id, r.event_id, r.section, r.t): (r.n_visible, r.last_t) for r in got} == want and len(got) == len(want) > 40
