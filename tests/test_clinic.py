from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from chronoweave.functions.tokens import PatternTokenizer
from chronoweave.plans import clinic
from chronoweave.plans.cohort import clean_and_bad, cohort_per_visit
from chronoweave.plans.samples import build_samples
from chronoweave.plans.snapshots import snapshot_sizes, snapshot_texts, with_closing_list
from chronoweave.plans.timeline import snapshot_times
from chronoweave.session import stage
from chronoweave.sources.catalog import child_tables, structure_of
from chronoweave.spec import Wording
from tests.clinic_data import tables as build

D = datetime
TOKENIZER = PatternTokenizer()
OPTIONS = clinic.Options(order_details=("Level", "Reason"))
WORDING = Wording(title="Patient Information:")


@pytest.fixture(scope="module")
def tables(spark):
    return {name: stage(df) for name, df in build(spark).items()}


@pytest.fixture(scope="module")
def stays(tables):
    return stage(clinic.cohort_stays(tables))


@pytest.fixture(scope="module")
def rows(tables, stays):
    return stage(clinic.timeline_rows(tables, stays, TOKENIZER, max_tokens=4000, wording=WORDING, options=OPTIONS))


def test_cohort_counts_whole_days_once_per_stay(tables, stays, rows_of):
    # exactly seven days (2), open end (4) and no emergency stay (5) are out; two visits (1) give one row
    assert rows_of(stays, "stay_id") == [(1,), (3,)]
    adm = tables["admissions"]
    visits = tables["edstays"].select("hadm_id", F.col("stay_id").alias("visit"))
    assert rows_of(cohort_per_visit(adm, visits, "hadm_id", "admittime", "dischtime"), "hadm_id", "visit") == [
        (1, 51), (1, 52), (3, 54),
    ]


def test_child_discovery(spark, tables):
    found = child_tables(structure_of(spark, {"hosp": tables}), "hosp", "hadm_id", clinic.IGNORED_TABLES)
    names = {r["table"] for r in found.collect()}
    assert {"labevents", "poe", "transfers", "diagnoses_icd"} <= names
    assert not names & {"admissions", "patients", "omr"}
    columns = structure_of(spark, {"hosp": tables}).where("table = 'services'").first()["columns"]
    assert columns == ["subject_id", "hadm_id", "transfertime", "curr_service"]


def test_diagnoses_follow_first_code_order(tables, stays, rows_of):
    assert rows_of(clinic.diagnoses(tables, stays), "stay_id", "seq_num", "name") == [
        (1, 1, "Hypertension"), (1, 2, "Primary hypertension"), (1, 5, "Other version"),
    ]


def test_procedures_keep_untitled_codes(tables, stays, rows_of):
    assert rows_of(clinic.procedures(tables, stays), "stay_id", "`chart date`", "name") == [
        (1, date(2020, 5, 1), "First procedure"), (1, date(2020, 5, 3), "Second procedure"), (3, date(2020, 6, 2), None),
    ]


def test_labs_keep_unknown_items(tables, stays):
    labs = clinic.lab_tests(tables, stays)
    assert labs.columns[2:] == list(clinic.LAB_ORDER)
    assert labs.count() == 6
    assert labs.where("label IS NULL").count() == 1


def test_orders_merge(tables, stays, rows_of):
    orders = clinic.provider_orders(tables, stays, OPTIONS)
    got = rows_of(orders, "`poe id`", "drug", "`start time`", "`order time`", "Level", "Reason")
    assert got == [
        ("10-1", "Aspirin", D(2020, 5, 1, 14), None, None, None),  # both times set: the order time goes
        ("10-2", None, None, D(2020, 5, 1, 13), "High", None),  # three details stay three rows
        ("10-2", None, None, D(2020, 5, 1, 13), None, "Pain"),
        ("10-2", None, None, D(2020, 5, 1, 13), None, None),  # a null name fills nothing
        ("10-5", None, None, D(2020, 5, 2, 13), "Low", None),  # a null order type is not denied
    ]  # 10-3 has no time, 10-4 is denied, 10-6 is a medication without prescription
    assert rows_of(orders, "visible")[0] == (D(2020, 5, 1, 13),)
    any_null = clinic.provider_orders(tables, stays, clinic.Options(order_time_null="any"))
    assert any_null.count() == 0
    strict = clinic.provider_orders(tables, stays, clinic.Options(strict_first_column=True))
    assert strict.where("visible IS NOT NULL").count() == 1


def test_orders_without_prescriptions_keep_their_schema(tables, rows_of):
    stays = tables["admissions"].where("hadm_id = 5").select(
        F.col("hadm_id").alias("stay_id"), "subject_id", F.col("admittime").alias("event_t"), F.col("dischtime").alias("end_t")
    )
    orders = clinic.provider_orders(tables, stays, OPTIONS)
    assert rows_of(orders, "`poe id`", "visible") == [("12-1", D(2020, 7, 1, 10))]


def test_patient_information_takes_admission_fields(tables, stays, rows_of):
    assert rows_of(clinic.patient_information(tables, stays), "stay_id", "race", "`marital status`", "language") == [
        (1, "R1", "SINGLE", "ENGLISH"), (3, "R2", None, "None"),
    ]


def test_later_emergency_stays_list_new_medications_only(tables, stays, rows_of):
    listed = clinic.medication_lists(tables, clinic.emergency_stays(tables, stays))
    assert rows_of(listed, "event_id", "name") == [(51, "Aspirin"), (51, "Aspirin"), (51, None), (52, "Ibuprofen")]


def test_dispensed_medications_once_per_name_and_time(tables, stays, rows_of):
    given = clinic.dispensed_medications(tables, clinic.emergency_stays(tables, stays))
    assert rows_of(given, "name", "`chart time`") == [("Aspirin", D(2020, 5, 1, 8)), ("Aspirin", D(2020, 5, 1, 9))]


def test_radiology_cutoff(tables, stays, rows_of):
    notes = clinic.radiology_notes(tables, stays)
    assert rows_of(notes, "`note id`", "type", "`exam name`", "`parent note id`") == [
        ("10-AR-2", "Radiology Report Addendum", None, "10-RR-1"),
        ("10-RR-1", "Radiology Report", "CHEST", None),
        ("10-XX-3", None, None, None),
    ]
    late = clinic.radiology_notes(tables, stays, clinic.Options(radiology_cutoff="stay_end"))
    assert late.count() == 5


def test_spine(rows, rows_of):
    assert rows_of(snapshot_times(rows).where("stay_id = 1"), "t") == sorted(
        [
            (D(2020, 5, 1, 10),), (D(2020, 5, 1, 12),), (D(2020, 5, 1, 13),), (D(2020, 5, 1, 14),), (D(2020, 5, 2, 6),),
            (D(2020, 5, 2, 9),), (D(2020, 5, 2, 12),), (D(2020, 5, 2, 13),), (D(2020, 5, 3),), (D(2020, 5, 3, 5, 59),),
            (D(2020, 5, 4, 12),), (D(2020, 5, 5, 9),),
        ],
        key=str,
    )


def _text(rows, stay, t):
    snapshot = rows.sparkSession.createDataFrame([(stay, t)], "stay_id long, t timestamp_ntz")
    return snapshot_texts(snapshot, rows).first()["text"]


def test_snapshot_text(rows):
    got = _text(rows, 1, D(2020, 5, 1, 12))
    assert got == (
        "Patient Information:\ngender: F\nage at anchor year: 50\nanchor year: 2100\nrace: R1\nmarital status: SINGLE\n"
        "language: ENGLISH\n\n\n"
        "Emergency Department Stay (1 of 2)\narrival time: 2020-05-01 06:00:00\narrival transport: WALK IN\n"
        "triage:\n - 1 of 1\n   - chief complaint: Fever\n   - pain: 4\n   - emergency severity index: 2\n"
        "   - temperature: 37.5\n   - heart rate: 80.0\n"
        "vital signs:\n - 1 of 1\n   - chart time: 2020-05-01 07:00:00\n   - heart rate: 82.0\n"
        "   - systolic blood pressure: 120.0\n"
        "medication reconciliation:\n - 1 of 3\n   - enhanced therapeutic class: Unknown\n"
        " - 2 of 3\n   - name: Aspirin\n   - enhanced therapeutic class: Analgesic\n"
        " - 3 of 3\n   - name: Aspirin\n   - enhanced therapeutic class: Antiplatelet\n"
        "dispensed medications:\n - 1 of 2\n   - chart time: 2020-05-01 08:00:00\n   - name: Aspirin\n"
        " - 2 of 2\n   - chart time: 2020-05-01 09:00:00\n   - name: Aspirin\n"
        "exit time: 2020-05-01 10:00:00\ndisposition: ADMITTED\ndiagnosis:\n - Fever, unspecified\n - Headache\n\n\n"
        "Hospital Stay (2 of 2)\nadmission time: 2020-05-01 10:00:00\nadmission type: URGENT\nadmission location: ED\n"
        "hospital services:\n - 1 of 1\n   - transfer time: 2020-05-01 10:30:00\n   - current service: MED\n"
        "transfers:\n - 1 of 1\n   - event type: admit\n   - care unit: Ward A\n   - in time: 2020-05-01 10:00:00\n"
        "lab tests:\n - 1 of 3\n   - chart time: 2020-05-01 08:00:00\n   - category: Chemistry\n   - fluid: Blood\n"
        "   - label: Glucose\n   - priority: STAT\n   - value: 4\n   - numerical value: 4.0\n   - unit of measure: mg\n"
        "   - normal lower end: 1.0\n   - normal upper end: 9.0\n"
        " - 2 of 3\n   - chart time: 2020-05-01 12:00:00\n   - category: Chemistry\n   - fluid: Blood\n"
        "   - label: Glucose\n   - priority: STAT\n   - value: 5\n   - numerical value: 5.0\n   - unit of measure: mg\n"
        "   - normal lower end: 1.0\n   - normal upper end: 9.0\n"
        " - 3 of 3\n   - chart time: 2020-05-01 12:00:00\n   - category: Chemistry\n   - fluid: Blood\n"
        "   - label: Glucose\n   - priority: STAT\n   - value: 5\n   - numerical value: 5.0\n   - unit of measure: mg\n"
        "   - normal lower end: 1.0\n   - normal upper end: 9.0\n"
        "procedures:\n - 1 of 1\n   - chart date: 2020-05-01\n   - name: First procedure\n"
        "other patient information:\n - 1 of 1\n   - chart date: 2020-04-01\n   - name: Weight\n   - value: 70\n"
        "radiology notes:\n - 1 of 1\n   - note id: 10-RR-1\n   - type: Radiology Report\n   - chart time: 2020-04-01 09:00:00\n"
        "   - text: Old film.\n   - exam code: C1\n   - exam name: CHEST\n\n\n"
    )


def test_end_times_and_late_scalars_wait(rows):
    before, after = _text(rows, 1, D(2020, 5, 2, 6)), _text(rows, 1, D(2020, 5, 2, 9))
    assert "out time: 2020-05-02 09:00:00" not in before
    assert "out time: 2020-05-02 09:00:00" in after
    assert "discharge" not in _text(rows, 1, D(2020, 5, 3))
    end = _text(rows, 1, D(2020, 5, 4, 12))
    assert "discharge time: 2020-05-04 12:00:00\ndischarge location: HOME\n" in end
    assert "Went home." not in end
    assert "Went home." in _text(rows, 1, D(2020, 5, 5, 9))
    assert "date of death" not in _text(rows, 3, D(2020, 6, 8, 8, 59, 59))
    assert "language" not in end.split("Emergency")[0].replace("language: ENGLISH", "")
    assert "language" not in _text(rows, 3, D(2020, 6, 1, 9))  # the word "None" is not printed
    assert "exit time: 2020-05-03" not in _text(rows, 1, D(2020, 5, 3, 6))


def test_policies(tables, stays):
    options = clinic.Options(strict_asof=True, death_policy="asof")
    strict = stage(clinic.timeline_rows(tables, stays, TOKENIZER, max_tokens=4000, wording=WORDING, options=options))
    assert "date of death: 2020-06-08" in _text(strict, 3, D(2020, 6, 8, 8))
    assert "date of death" not in _text(strict, 3, D(2020, 6, 7))
    assert "Ibuprofen" not in _text(strict, 1, D(2020, 5, 3, 7))
    assert "Ibuprofen" in _text(strict, 1, D(2020, 5, 4, 12))


def test_sizes_are_the_token_counts_of_the_texts(rows):
    sizes = snapshot_sizes(rows, TOKENIZER).where("in_spine")
    texts = snapshot_texts(sizes, rows).withColumn("n", TOKENIZER.count(F.col("text")))
    assert texts.count() > 12
    assert texts.where(F.col("n") != F.col("size")).count() == 0


def test_samples(rows, stays):
    samples = build_samples(
        rows, stays, targets=clinic.TARGETS, standing=clinic.STANDING, wording=WORDING, tokenizer=TOKENIZER, max_tokens=4000
    ).orderBy("stay_id", "t").collect()
    first = {s["section"]: s for s in samples if s["stay_id"] == 1 and s["t"] == D(2020, 5, 1, 10)}
    assert first["lab tests"]["output"] == (
        "Potential lab tests:\n - 1 of 1\n   - category: Chemistry\n   - fluid: Blood\n   - label: Glucose\n   - priority: STAT\n"
    )  # two equal rows are one
    assert first["diagnoses"]["output"] == (
        "Potential diagnoses:\n - Hypertension\n - Primary hypertension\n - Other version\n"
    )
    assert first["procedures"]["output"] == "Potential procedures:\n - 1 of 1\n   - name: Second procedure\n"
    assert first["provider orders"]["output"].startswith("Potential provider orders:\n - 1 of 3\n")
    assert "poe id" not in first["provider orders"]["output"]
    assert not [s for s in samples if s["stay_id"] == 3 and s["section"] == "diagnoses"]  # none: no sample
    for stay in (1, 3):
        numbers = sorted(int(s["sample_id"].split("_")[1]) for s in samples if s["stay_id"] == stay)
        assert numbers == list(range(len(numbers)))


def test_unique_dedupe_and_empty_answers(rows, stays):
    def labs(**more):
        found = build_samples(
            rows, stays, targets=clinic.TARGETS, wording=WORDING, tokenizer=TOKENIZER, max_tokens=4000, dedupe="unique", **more
        )
        return found.where((F.col("section") == "lab tests") & (F.col("t") == F.lit(D(2020, 5, 1, 10)).cast("timestamp_ntz")))

    assert labs().count() == 0
    assert labs(keep_empty=True).first()["output"] == "Potential lab tests:\n"


def test_unlimited_equals_a_generous_limit(rows, stays):
    def ids(limit):
        return build_samples(
            rows, stays, targets=clinic.TARGETS, standing=clinic.STANDING, wording=WORDING, tokenizer=TOKENIZER,
            max_tokens=limit,
        ).select("sample_id", "input", "output", "n_tokens")

    assert ids(None).exceptAll(ids(100_000)).count() == 0
    assert ids(None).count() == ids(100_000).count()


def test_quarantine(tables, rows_of):
    flagged, rules = clinic.quarantine_rules(tables)
    good, bad = clean_and_bad(flagged, "stay_id", rules)
    assert rows_of(bad) == [(3, "unmatched procedure code"), (5, "no emergency stay")]
    assert rows_of(good, "stay_id") == [(1,), (2,), (4,)]


def test_admission_scalars(spark, tables):
    at = spark.createDataFrame([(1, D(2020, 5, 2)), (1, D(2020, 5, 4, 12))], "stay_id long, t timestamp_ntz")
    got = {r["t"]: r for r in clinic.admission_scalars(tables, at).collect()}
    assert got[D(2020, 5, 2)]["discharge_location"] is None
    assert got[D(2020, 5, 4, 12)]["discharge_location"] == "HOME"


@pytest.mark.parametrize("part_rows", [2, 100])
def test_nested_stays(tables, stays, part_rows):
    """Every child of a stay in its record, in lists of bounded length, and nothing of other stays."""
    got = clinic.nested_stays(tables, stays, OPTIONS, part_rows=part_rows)
    children = dict((s.name, (s, df)) for s, df in clinic.admission_children(tables, stays, OPTIONS))
    assert set(clinic.CHILDREN) == set(children) and set(clinic.CHILDREN) <= set(got.columns)
    rows = got.orderBy("stay_id", "part").collect()
    assert {r["stay_id"] for r in rows} == {1, 3} and all(r["gender"] == {1: "F", 3: "M"}[r["stay_id"]] for r in rows)
    for name, (section, df) in children.items():
        held = df.collect()
        for stay in (1, 3):
            listed = [x for r in rows if r["stay_id"] == stay for x in r[name]]
            assert sorted(map(str, listed)) == sorted(str(Row(**{f: h[f] for f in section.fields})) for h in held if h["stay_id"] == stay)
            times = [x[section.time] for x in listed if section.time in section.fields and x[section.time] is not None]
            assert times == sorted(times)
    assert max(len(r[name]) for r in rows for name in clinic.CHILDREN) <= part_rows
    assert [x["name"] for r in rows for x in r["diagnoses"]] == ["Hypertension", "Primary hypertension", "Other version"]


def test_clinic_discharge_samples(tables, stays):
    made = clinic.discharge_samples(tables, stays, question="Which?").collect()
    assert [(r["sample_id"], r["subject_id"], r["stay_id"]) for r in made] == [("1_discharge", 10, 1)]  # stay 3 has no diagnoses
    assert made[0]["output"] == "Potential diagnoses:\n - Hypertension\n - Primary hypertension\n - Other version\n\n"
    assert made[0]["input"].startswith("patient information:\n - 1 of 1\n   - gender: F\n   - age at anchor year: 50\n")
    note = tables["discharge"].where("hadm_id = 1").first()
    assert "discharge note:\n - 1 of 1\n" in made[0]["input"] and f"   - discharge note: {note['text']}\n" in made[0]["input"]
    assert made[0]["input"].endswith("\n\n\nWhich?")


def test_closing_list(tables, stays, rows):
    last = snapshot_times(rows).groupBy("stay_id").agg(F.max("t").alias("t"))
    texts = snapshot_texts(last, rows)
    plain = {r["stay_id"]: r["text"] for r in texts.collect()}
    closed = {r["stay_id"]: r["text"] for r in with_closing_list(texts, clinic.diagnoses(tables, stays), ["seq_num"], "name").collect()}
    assert closed[1] == plain[1] + "Diagnoses:\n - Hypertension\n - Primary hypertension\n - Other version\n"
    assert closed[3] == plain[3]


def test_other_information_takes_the_whole_history(tables, stays, rows_of):
    got = clinic.other_information(tables, stays)
    assert rows_of(got, "stay_id", "name", "value") == [(1, "Weight", "70"), (1, "Weight", "71"), (3, "Weight", "80")]
