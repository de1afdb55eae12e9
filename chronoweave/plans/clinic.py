"""Hospital tables as stays, sections and timeline events.

Every function takes ``tables``, a mapping from table name to DataFrame, and works
on all stays at once. ``stay_id`` is the admission (``hadm_id``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions import text
from chronoweave.operators.aggregates import pivot_first, spread_attributes
from chronoweave.operators.columns import (
    drop_listed, drop_unset, first_set, keep_listed, known_at, midnight, not_denied, null_second_if_both, recode, rename,
    shorter_than_days,
)
from chronoweave.operators.joins import enrich, first_seen, full_merge, keep_if_listed, look_up, restrict, rows_before
from chronoweave.operators.ordered import first_by
from chronoweave.plans.records import stay_records
from chronoweave.plans.samples import discharge_samples as label_samples
from chronoweave.plans.timeline import event_rows, section_rows, union_rows
from chronoweave.spec import Section, Wording

Tables = Mapping[str, DataFrame]

# Columns that texts never show, per table.
DROPPED = {
    "admissions": (
        "admit_provider_id", "insurance", "edregtime", "edouttime", "hospital_expire_flag",
    ),
    "diagnoses_icd": ("subject_id",),
    "labevents": ("subject_id", "order_provider_id", "storetime", "specimen_id"),
    "microbiologyevents": (
        "subject_id", "order_provider_id", "storetime", "micro_specimen_id", "spec_itemid", "test_seq",
        "test_itemid", "chartdate", "storedate", "org_itemid", "ab_itemid",
    ),
    "poe": ("subject_id", "order_provider_id", "order_status", "poe_seq"),
    "prescriptions": (
        "subject_id", "pharmacy_id", "order_provider_id", "gsn", "ndc", "formulary_drug_cd", "poe_seq",
    ),
    "procedures_icd": ("subject_id",),
    "services": ("subject_id",),
    "transfers": ("subject_id", "transfer_id"),
    "omr": (),
    "patients": ("anchor_year_group",),
    "medrecon": ("subject_id", "charttime", "gsn", "ndc", "etc_rn", "etccode"),
    "pyxis": ("subject_id", "gsn", "gsn_rn"),
    "triage": ("subject_id",),
    "vitalsign": ("subject_id",),
    "radiology": ("note_seq", "storetime"),
}
# Tables that hold the stay key and are not children.
IGNORED_TABLES = ("admissions", "drgcodes", "emar", "hcpcsevents", "pharmacy")
# Order types that are left out.
DENIED_ORDERS = ("ADT orders", "Lab", "Consult", "Blood Bank")
# Readable column names, per table.
NAMES = {
    "omr": {"chartdate": "chart date", "result_name": "name", "result_value": "value"},
    "labevents": {
        "charttime": "chart time", "valuenum": "numerical value", "valueuom": "unit of measure",
        "ref_range_lower": "normal lower end", "ref_range_upper": "normal upper end",
    },
    "microbiologyevents": {
        "charttime": "chart time", "spec_type_desc": "specimen type", "test_name": "test name",
        "org_name": "organism name", "isolate_num": "isolated colony", "ab_name": "antibiotic name",
        "dilution_text": "dilution", "dilution_comparison": "dilution comparison", "dilution_value": "dilution value",
    },
    "patients": {"anchor_age": "age at anchor year", "anchor_year": "anchor year", "dod": "date of death"},
    "orders": {
        "poe_id": "poe id", "order_type": "order type", "ordertime": "order time", "transaction_type": "transaction type",
        "order_subtype": "order subtype", "drug_type": "drug type", "prod_strength": "strength", "dose_val_rx": "dose",
        "dose_unit_rx": "dose unit", "form_val_disp": "amount of medication", "form_unit_disp": "amount unit",
        "route": "route of administration", "doses_per_24_hrs": "doses per 24 hours",
        "discontinue_of_poe_id": "discontinues poe id", "discontinued_by_poe_id": "discontinued by poe id",
        "starttime": "start time", "stoptime": "stop time",
    },
    "procedures_icd": {"chartdate": "chart date"},
    "services": {"transfertime": "transfer time", "curr_service": "current service"},
    "transfers": {"eventtype": "event type", "careunit": "care unit", "intime": "in time", "outtime": "out time"},
    "triage": {
        "heartrate": "heart rate", "resprate": "respiratory rate", "o2sat": "oxygen saturation",
        "sbp": "systolic blood pressure", "dbp": "diastolic blood pressure", "chiefcomplaint": "chief complaint",
        "acuity": "emergency severity index",
    },
    "vitalsign": {
        "charttime": "chart time", "heartrate": "heart rate", "resprate": "respiratory rate",
        "o2sat": "oxygen saturation", "sbp": "systolic blood pressure", "dbp": "diastolic blood pressure",
    },
    "medrecon": {"etcdescription": "enhanced therapeutic class"},
    "pyxis": {"charttime": "chart time"},
    "discharge": {"storetime": "chart time", "text": "discharge note"},
    "radiology": {
        "note_id": "note id", "note_type": "type", "charttime": "chart time", "parent_note_id": "parent note id",
        "cpt_code": "cpt code", "exam_code": "exam code", "addendum_note_id": "addendum note id", "exam_name": "exam name",
    },
}
# Column order of the tables that have one.
LAB_ORDER = (
    "chart time", "category", "fluid", "label", "priority", "value", "numerical value", "unit of measure",
    "normal lower end", "normal upper end", "flag",
)
TRIAGE_ORDER = (
    "chief complaint", "pain", "emergency severity index", "temperature", "heart rate", "respiratory rate",
    "oxygen saturation", "systolic blood pressure", "diastolic blood pressure",
)
PATIENT_ORDER = ("gender", "age at anchor year", "anchor year", "date of death", "race", "marital status", "language")
# Note types, and the details of a note that become columns.
NOTE_TYPES = {"RR": "Radiology Report", "AR": "Radiology Report Addendum"}
NOTE_DETAILS = ("addendum_note_id", "cpt_code", "exam_code", "exam_name", "parent_note_id")
# What answers leave out, per section.
HIDDEN = {
    "lab tests": (
        "chart time", "value", "numerical value", "unit of measure", "normal lower end", "normal upper end", "flag",
    ),
    "microbiology tests": (
        "chart time", "organism name", "isolated colony", "comments", "interpretation", "quantity",
    ),
    "procedures": ("chart date",),
    "provider orders": (
        "poe id", "order time", "start time", "stop time", "discontinues poe id", "discontinued by poe id",
    ),
}
# Names of the sections, and which of them a snapshot asks for. Names of scalars are those of their columns below.
CHILDREN = (
    "hospital services", "transfers", "lab tests", "microbiology tests", "procedures", "provider orders",
    "other patient information", "radiology notes", "discharge note", "diagnoses",
)
TARGETS = ("lab tests", "microbiology tests", "provider orders", "procedures")
STANDING = ("diagnoses",)

_KEYS = ("stay_id", "subject_id", "hadm_id", "event_id", "event_t", "cutoff")


@dataclass(frozen=True)
class Options:
    """Choices where readings of the data differ.

    order_details       names of order details that become columns
    order_time_null     "all": drop orders without any time; "any": drop those that lack one
    strict_first_column orders become visible at their start time only
    strict_asof         emergency diagnoses, triage and medication lists wait for the exit time
    death_policy        "always": the date of death is never shown; "asof": from that date on
    radiology_cutoff    "last_event_start" or "stay_end"
    """

    order_details: tuple[str, ...] = ()
    order_time_null: str = "all"
    strict_first_column: bool = False
    strict_asof: bool = False
    death_policy: str = "always"
    radiology_cutoff: str = "last_event_start"


# --- stays ---------------------------------------------------------------------------------------


def cohort_stays(tables: Tables, days: int = 7) -> DataFrame:
    """Admissions under ``days`` whole days with an emergency stay: ids, start and end."""
    chosen = tables["admissions"].where(shorter_than_days("admittime", "dischtime", days))
    return restrict(chosen, tables["edstays"], ["hadm_id"]).select(
        F.col("hadm_id").alias("stay_id"), "subject_id",
        F.col("admittime").alias("event_t"), F.col("dischtime").alias("end_t"),
    )


def children(tables: Tables, stays: DataFrame, name: str) -> DataFrame:
    """One child table, restricted to the stays, without the columns that are never shown."""
    keyed = stays.select(F.col("stay_id").alias("hadm_id"))
    held = restrict(tables[name], keyed, ["hadm_id"])
    return drop_listed(held, DROPPED.get(name, ())).withColumnRenamed("hadm_id", "stay_id")


def _named(df: DataFrame, name: str) -> DataFrame:
    return rename(df, NAMES[name])


def patient_information(tables: Tables, stays: DataFrame) -> DataFrame:
    """Patient columns per stay; race, marital status and language come from the admission."""
    moved = tables["admissions"].select(
        F.col("hadm_id").alias("stay_id"), "race", F.col("marital_status").alias("marital status"), "language"
    )
    patients = _named(drop_listed(tables["patients"], DROPPED["patients"]), "patients")
    joined = stays.select("stay_id", "subject_id").join(patients, "subject_id", "left").join(moved, "stay_id", "left")
    return keep_listed(joined, ["stay_id", "subject_id", *PATIENT_ORDER])


# --- children of the admission -------------------------------------------------------------------


def diagnoses(tables: Tables, stays: DataFrame) -> DataFrame:
    """Titles of the distinct codes in their order; codes without a title vanish."""
    return _titles(tables, stays, "diagnoses_icd", "d_icd_diagnoses", look_up).select("stay_id", "seq_num", "name")


def procedures(tables: Tables, stays: DataFrame) -> DataFrame:
    """Procedures with their titles; one without a title keeps its date, with a null name."""
    titled = _titles(tables, stays, "procedures_icd", "d_icd_procedures", enrich)
    return _named(titled.select("stay_id", "chartdate", "name", "seq_num"), "procedures_icd")


def _titles(tables: Tables, stays: DataFrame, name: str, dictionary: str, join) -> DataFrame:
    coded = children(tables, stays, name).withColumn("icd_code", F.trim("icd_code"))
    distinct = first_by(coded, ["stay_id", "icd_code", "icd_version"], ["seq_num"])
    titles = tables[dictionary].select(
        F.trim("icd_code").alias("icd_code"), "icd_version", F.col("long_title").alias("name")
    )
    return join(distinct, titles, ["icd_code", "icd_version"])


def lab_tests(tables: Tables, stays: DataFrame) -> DataFrame:
    labs = enrich(children(tables, stays, "labevents"), tables["d_labitems"], ["itemid"])
    return keep_listed(_named(labs, "labevents"), ["stay_id", "labevent_id", *LAB_ORDER])


def microbiology_tests(tables: Tables, stays: DataFrame) -> DataFrame:
    return _named(children(tables, stays, "microbiologyevents"), "microbiologyevents")


def provider_orders(tables: Tables, stays: DataFrame, options: Options = Options()) -> DataFrame:
    """Orders with their details and prescriptions; ``visible`` is when a row becomes known."""
    orders = children(tables, stays, "poe").where(not_denied("order_type", DENIED_ORDERS))
    details = drop_listed(tables["poe_detail"], ["poe_seq", "subject_id"])
    orders = spread_attributes(
        enrich(orders, details, ["poe_id"]), "field_name", "field_value", options.order_details
    )
    filled = children(tables, stays, "prescriptions").where("poe_id IS NOT NULL")
    orders = keep_if_listed(orders, F.col("order_type") == "Medications", filled, "poe_id")
    merged = full_merge(filled, orders, ["stay_id", "poe_id"])
    merged = merged.withColumn("ordertime", null_second_if_both("starttime", "ordertime"))
    merged = drop_unset(merged, ["starttime", "ordertime"], how=options.order_time_null)
    visible = F.col("starttime") if options.strict_first_column else first_set("starttime", "ordertime")
    return _named(merged.withColumn("visible", visible), "orders")


def services(tables: Tables, stays: DataFrame) -> DataFrame:
    return _named(children(tables, stays, "services"), "services")


def transfers(tables: Tables, stays: DataFrame) -> DataFrame:
    return _named(children(tables, stays, "transfers"), "transfers")


def discharge_notes(tables: Tables, stays: DataFrame) -> DataFrame:
    """Note text, visible from the time it was stored."""
    notes = restrict(tables["discharge"], stays.select(F.col("stay_id").alias("hadm_id")), ["hadm_id"])
    notes = notes.select(F.col("hadm_id").alias("stay_id"), "storetime", "text", "note_id")
    return _named(notes, "discharge")


# --- history of the subject ----------------------------------------------------------------------


def other_information(tables: Tables, stays: DataFrame) -> DataFrame:
    """Outpatient measurements of the stay's subject, all of them: stays share the lists of their subject."""
    measured = restrict(tables["omr"], stays, ["subject_id"])
    return _named(rows_before(stays.select("stay_id", "subject_id"), measured, "subject_id", None, "chartdate"), "omr")


def radiology_notes(tables: Tables, stays: DataFrame, options: Options = Options()) -> DataFrame:
    """Notes of the subject before the cutoff, with their details as columns and their type spelled out."""
    if options.radiology_cutoff == "stay_end":
        anchors = stays.select("stay_id", "subject_id", F.col("end_t").alias("cutoff"))
    else:
        arrivals = tables["edstays"].groupBy(F.col("hadm_id").alias("stay_id")).agg(F.max("intime").alias("last_t"))
        anchors = stays.join(arrivals, "stay_id", "left").select(
            "stay_id", "subject_id", F.greatest("event_t", "last_t").alias("cutoff")
        )
    notes = drop_listed(restrict(tables["radiology"], stays, ["subject_id"]), ["hadm_id", *DROPPED["radiology"]])
    notes = notes.withColumn("note_type", recode("note_type", NOTE_TYPES))
    notes = notes.where(F.col("charttime").isNotNull())
    details = pivot_first(
        tables["radiology_detail"], ["note_id", "subject_id"], "field_name", "field_value", NOTE_DETAILS, ["field_value"]
    )
    detailed = enrich(notes, details, ["note_id", "subject_id"])
    before = rows_before(anchors, detailed, "subject_id", "cutoff", "charttime", ["note_id"])
    return _named(before, "radiology")


# --- emergency stays -----------------------------------------------------------------------------


def emergency_stays(tables: Tables, stays: DataFrame) -> DataFrame:
    """Emergency stays of the admissions: one timeline event each."""
    held = restrict(tables["edstays"], stays.select(F.col("stay_id").alias("hadm_id")), ["hadm_id"])
    return held.select(
        F.col("hadm_id").alias("stay_id"), F.col("stay_id").alias("event_id"), F.col("intime").alias("event_t"),
        F.col("intime").alias("arrival time"), F.col("arrival_transport").alias("arrival transport"),
        F.col("outtime").alias("exit time"), "disposition",
    )


def _emergency_child(tables: Tables, visits: DataFrame, name: str) -> DataFrame:
    keys = visits.select("stay_id", "event_id", "event_t", "exit time")
    child = drop_listed(tables[name], DROPPED.get(name, ())).withColumnRenamed("stay_id", "event_id")
    return keys.join(child, "event_id")


def triage(tables: Tables, visits: DataFrame) -> DataFrame:
    named = _named(_emergency_child(tables, visits, "triage"), "triage")
    return keep_listed(named, ["stay_id", "event_id", "event_t", "exit time", *TRIAGE_ORDER])


def vital_signs(tables: Tables, visits: DataFrame) -> DataFrame:
    return _named(_emergency_child(tables, visits, "vitalsign"), "vitalsign")


def medication_lists(tables: Tables, visits: DataFrame) -> DataFrame:
    """Medications; at a later emergency stay only names that no earlier one lists."""
    listed = _emergency_child(tables, visits, "medrecon").withColumn("__event", F.struct("event_t", "event_id"))
    return _named(first_seen(listed, ["stay_id"], "name", "__event").drop("__event"), "medrecon")


def dispensed_medications(tables: Tables, visits: DataFrame) -> DataFrame:
    """One row per name and time."""
    given = _emergency_child(tables, visits, "pyxis")
    return _named(first_by(given, ["event_id", "name", "charttime"], ["med_rn"]).drop("med_rn"), "pyxis")


def emergency_diagnoses(tables: Tables, visits: DataFrame) -> DataFrame:
    named = _emergency_child(tables, visits, "diagnosis")
    return named.select("stay_id", "event_id", "event_t", "exit time", "seq_num", F.col("icd_title").alias("name"))


# --- timeline ------------------------------------------------------------------------------------


def _fields(df: DataFrame, *without: str) -> tuple[str, ...]:
    return tuple(c for c in df.columns if c not in _KEYS and c not in without)


def admission_children(tables: Tables, stays: DataFrame, options: Options = Options()) -> list[tuple[Section, DataFrame]]:
    """Each child of the admission with its section, in the order of ``CHILDREN``."""

    def records(name: str, df: DataFrame, time: str, tie: Sequence[str], *without: str, **more) -> tuple[Section, DataFrame]:
        fields = _fields(df, *without)
        return Section(name, "records", fields, time=time, tie=tuple(tie), hidden=HIDDEN.get(name, ()), **more), df

    titles = Section("diagnoses", "values", ("name",), tie=("seq_num",), target=True, mute=True)
    return [
        records("hospital services", services(tables, stays), "transfer time", ["current service"]),
        records("transfers", transfers(tables, stays), "in time", ["care unit"], spine=True, end="out time"),
        records("lab tests", lab_tests(tables, stays), "chart time", ["labevent_id"], "labevent_id", spine=True, target=True),
        records("microbiology tests", microbiology_tests(tables, stays), "chart time", ["microevent_id"], "microevent_id", spine=True, target=True),
        records("procedures", procedures(tables, stays), "chart date", ["seq_num"], "seq_num", spine=True, target=True),
        records("provider orders", provider_orders(tables, stays, options), "visible", ["poe id", "drug"], "visible", spine=True, target=True),
        records("other patient information", other_information(tables, stays), "chart date", ["seq_num", "name", "value"], "seq_num"),
        records("radiology notes", radiology_notes(tables, stays, options), "chart time", ["note id"], spine=True),
        records("discharge note", discharge_notes(tables, stays), "chart time", ["note_id"], "note_id", spine=True),
        (titles, diagnoses(tables, stays)),
    ]


def nested_stays(tables: Tables, stays: DataFrame, options: Options = Options(), *, part_rows: int = 10_000) -> DataFrame:
    """The nested record of each stay: patient and admission fields, and every child as a list (see ``stay_records``)."""
    admission = drop_listed(tables["admissions"], ("subject_id", "admittime", "dischtime", *DROPPED["admissions"])).withColumnRenamed("hadm_id", "stay_id")
    patients = patient_information(tables, stays).drop("subject_id", "race", "marital status", "language")
    whole = stays.join(patients, "stay_id", "left").join(admission, "stay_id", "left")
    return stay_records(whole, admission_children(tables, stays, options), part_rows=part_rows)


def discharge_samples(
    tables: Tables, stays: DataFrame, *, question: str = "Which diagnoses fit this stay?", heading: str = "Potential diagnoses", **limits
) -> DataFrame:
    """One sample per stay with diagnoses: who the patient is and the discharge notes in, the diagnoses out."""
    patients = patient_information(tables, stays)
    who = text.record_lines([(c, F.col(f"`{c}`")) for c in patients.columns if c not in ("stay_id", "subject_id")])
    about = patients.select("stay_id", F.concat(F.lit("patient information:\n"), text.numbered(who, F.lit(1), F.lit(1))).alias("__who"))
    notes = discharge_notes(tables, stays)
    line = text.record_lines([(c, F.col(f"`{c}`")) for c in notes.columns if c not in ("stay_id", "note_id")])
    notes = notes.select("stay_id", F.struct(F.col("`chart time`").alias("t"), "note_id", line.alias("line")).alias("note"))
    letters = notes.groupBy("stay_id").agg(F.array_sort(F.collect_list("note")).alias("__notes"))  # a stay has few discharge notes
    letter = F.concat(F.lit("discharge note:\n"), text.numbered_list(F.transform("__notes", lambda n: n["line"])))
    told = stays.join(about, "stay_id", "left").join(letters, "stay_id", "left")
    told = told.select("stay_id", "subject_id", F.concat(F.coalesce("__who", F.lit("")), F.coalesce(letter, F.lit("")), F.lit("\n")).alias("__told"))
    return label_samples(
        told, diagnoses(tables, stays), preamble=F.col("__told"), note=None, label="name", tie=["seq_num"], question=question, heading=heading, **limits
    )


def timeline_rows(
    tables: Tables,
    stays: DataFrame,
    tokenizer,
    *,
    max_tokens: int | None,
    wording: Wording = Wording(title="Patient Information:"),
    options: Options = Options(),
) -> DataFrame:
    """All rows of the stays' timelines (see ``chronoweave.plans.timeline``)."""
    anchor = stays.select("stay_id", F.col("stay_id").alias("event_id"), "event_t")

    def own(df: DataFrame) -> DataFrame:
        return df.drop("event_t", "event_id").join(anchor, "stay_id")

    patients = patient_information(tables, stays)
    shown = [c for c in patients.columns if c not in ("stay_id", "subject_id", "date of death")]
    preamble = F.concat(
        F.lit(f"{wording.title}\n"), text.block([(c, F.col(f"`{c}`")) for c in shown]), F.lit("\n")
    )
    head = own(patients)
    scalars = own(
        tables["admissions"].select(
            F.col("hadm_id").alias("stay_id"), F.col("admittime").alias("admission time"),
            F.col("admission_type").alias("admission type"), F.col("admission_location").alias("admission location"),
            F.col("dischtime").alias("discharge time"), F.col("discharge_location").alias("discharge location"),
            F.col("deathtime").alias("death time"),
        )
    )
    held = {section.name: (own(df), section) for section, df in admission_children(tables, stays, options)}

    def scalar(name: str, time: str | None = None, spine: bool = False) -> tuple[DataFrame, Section]:
        return scalars, Section(name, "scalar", (name,), time=time, spine=spine)

    main = [
        scalar("admission time", "admission time", spine=True),
        scalar("admission type"),
        scalar("admission location"),
        *[held[name] for name in CHILDREN[:7]],
        scalar("discharge time", "discharge time", spine=True),
        scalar("discharge location", "discharge time"),
        scalar("death time", "death time", spine=True),
        *[held[name] for name in CHILDREN[7:]],
    ]
    if options.death_policy == "asof":
        dated = head.withColumn("since", midnight(F.col("`date of death`")))
        main.append((dated, Section("date of death", "scalar", ("date of death",), time="since")))

    visits = emergency_stays(tables, stays)
    late = "exit time" if options.strict_asof else None
    first, vitals, listed = triage(tables, visits), vital_signs(tables, visits), medication_lists(tables, visits)
    given, named = dispensed_medications(tables, visits), emergency_diagnoses(tables, visits)

    def visit(name: str, time: str | None = None) -> tuple[DataFrame, Section]:
        return visits, Section(name, "scalar", (name,), time=time)

    def always(name: str, df: DataFrame, tie: Sequence[str]) -> tuple[DataFrame, Section]:
        return df, Section(name, "records", _fields(df, "exit time"), time=late, tie=tuple(tie))

    emergency = [
        visit("arrival time"),
        visit("arrival transport"),
        always("triage", first, []),
        (vitals, Section("vital signs", "records", _fields(vitals, "exit time"), time="chart time")),
        always("medication reconciliation", listed, ["name"]),
        (given, Section("dispensed medications", "records", _fields(given, "exit time"), time="chart time", tie=("name",))),
        visit("exit time", "exit time"),
        visit("disposition", "exit time"),
        (named, Section("diagnosis", "values", ("name",), time=late, tie=("seq_num",))),
    ]
    parts = [
        event_rows(head, tokenizer, event_type="Hospital Stay", rank=0, preamble=preamble),
        event_rows(visits, tokenizer, event_type="Emergency Department Stay", rank=1),
    ]
    parts += [section_rows(df, replace(s), i, tokenizer, rank=0) for i, (df, s) in enumerate(main)]
    parts += [section_rows(df, s, i, tokenizer, rank=1) for i, (df, s) in enumerate(emergency)]
    return union_rows(parts)


def quarantine_rules(tables: Tables) -> tuple[DataFrame, dict[str, Column]]:
    """Admissions with what the rules need, and the rules: reasons why a stay cannot be used as it is."""
    adm = tables["admissions"].select(F.col("hadm_id").alias("stay_id"), "subject_id", "admittime")

    def has(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(F.col(key).alias("__k")).distinct().withColumn(name, F.lit(True))

    visits = has(tables["edstays"], "hadm_id", "has_visit")
    people = has(tables["patients"], "subject_id", "has_patient")
    untitled = has(procedures(tables, adm).where("name IS NULL"), "stay_id", "has_untitled")
    flagged = adm
    for found, key in ((visits, "stay_id"), (people, "subject_id"), (untitled, "stay_id")):
        flagged = flagged.join(found, flagged[key] == F.col("__k"), "left").drop("__k")
    return flagged, {
        "no emergency stay": F.col("has_visit").isNull(),
        "no patient row": F.col("has_patient").isNull(),
        "unmatched procedure code": F.col("has_untitled").isNotNull(),
        "no time": F.col("admittime").isNull(),
    }


def admission_scalars(tables: Tables, snapshots: DataFrame) -> DataFrame:
    """Scalar fields of the admission as known at each snapshot ``(stay_id, t)``."""
    held = tables["admissions"].withColumnRenamed("hadm_id", "stay_id")
    joined = snapshots.join(held, "stay_id")
    return joined.select(
        "stay_id", "t", "admittime",
        known_at("dischtime", "dischtime", "t").alias("dischtime"),
        known_at("discharge_location", "dischtime", "t").alias("discharge_location"),
        known_at("deathtime", "deathtime", "t").alias("deathtime"),
    )
