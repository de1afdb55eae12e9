"""Invented clinic tables: three admissions of two people, with the awkward cases."""

from datetime import date, datetime

D = datetime

SCHEMAS = {
    "admissions": "hadm_id long, subject_id long, admittime timestamp_ntz, dischtime timestamp_ntz, deathtime timestamp_ntz,"
    " admission_type string, admission_location string, discharge_location string, race string, marital_status string,"
    " language string, insurance string",
    "patients": "subject_id long, gender string, anchor_age int, anchor_year int, anchor_year_group string, dod date",
    "omr": "subject_id long, seq_num int, chartdate date, result_name string, result_value string",
    "diagnoses_icd": "subject_id long, hadm_id long, seq_num int, icd_code string, icd_version int",
    "procedures_icd": "subject_id long, hadm_id long, seq_num int, chartdate date, icd_code string, icd_version int",
    "d_icd_diagnoses": "icd_code string, icd_version int, long_title string",
    "d_icd_procedures": "icd_code string, icd_version int, long_title string",
    "labevents": "labevent_id long, subject_id long, hadm_id long, specimen_id long, itemid int, charttime timestamp_ntz,"
    " storetime timestamp_ntz, value string, valuenum double, valueuom string, ref_range_lower double,"
    " ref_range_upper double, flag string, priority string, order_provider_id string",
    "d_labitems": "itemid int, label string, fluid string, category string",
    "microbiologyevents": "microevent_id long, subject_id long, hadm_id long, micro_specimen_id long, charttime timestamp_ntz,"
    " spec_type_desc string, test_name string, org_name string, isolate_num int, quantity string, interpretation string,"
    " comments string",
    "poe": "poe_id string, poe_seq int, subject_id long, hadm_id long, ordertime timestamp_ntz, order_type string,"
    " order_subtype string, transaction_type string, order_status string",
    "poe_detail": "poe_id string, poe_seq int, subject_id long, field_name string, field_value string",
    "prescriptions": "subject_id long, hadm_id long, pharmacy_id long, poe_id string, poe_seq int, starttime timestamp_ntz,"
    " stoptime timestamp_ntz, drug string, route string",
    "services": "subject_id long, hadm_id long, transfertime timestamp_ntz, curr_service string",
    "transfers": "subject_id long, hadm_id long, transfer_id long, eventtype string, careunit string,"
    " intime timestamp_ntz, outtime timestamp_ntz",
    "edstays": "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz, gender string,"
    " race string, arrival_transport string, disposition string",
    "triage": "subject_id long, stay_id long, temperature double, heartrate double, pain string, acuity int, chiefcomplaint string",
    "vitalsign": "subject_id long, stay_id long, charttime timestamp_ntz, heartrate double, sbp double",
    "diagnosis": "subject_id long, stay_id long, seq_num int, icd_code string, icd_version int, icd_title string",
    "medrecon": "subject_id long, stay_id long, charttime timestamp_ntz, name string, gsn string, etcdescription string",
    "pyxis": "subject_id long, stay_id long, charttime timestamp_ntz, med_rn int, name string, gsn_rn int, gsn string",
    "discharge": "note_id string, subject_id long, hadm_id long, note_type string, note_seq int, charttime timestamp_ntz,"
    " storetime timestamp_ntz, text string",
    "radiology": "note_id string, subject_id long, hadm_id long, note_type string, note_seq int, charttime timestamp_ntz,"
    " storetime timestamp_ntz, text string",
    "radiology_detail": "note_id string, subject_id long, field_name string, field_value string",
}

ROWS = {
    "admissions": [
        (1, 10, D(2020, 5, 1, 10), D(2020, 5, 4, 12), None, "URGENT", "ED", "HOME", "R1", "SINGLE", "ENGLISH", "x"),
        (2, 10, D(2020, 8, 1, 8), D(2020, 8, 8, 8), None, "URGENT", "ED", "HOME", "R1", "SINGLE", "ENGLISH", "x"),
        (3, 11, D(2020, 6, 1, 9), D(2020, 6, 8, 8, 59, 59), D(2020, 6, 8, 8), "EW", "ED", "DIED", "R2", None, "None", "x"),
        (4, 12, D(2020, 6, 1, 9), None, None, "EW", "ED", None, "R2", None, "ENGLISH", "x"),
        (5, 12, D(2020, 7, 1, 9), D(2020, 7, 2, 9), None, "EW", "ED", "HOME", "R2", None, "ENGLISH", "x"),
    ],
    "patients": [(10, "F", 50, 2100, "g", None), (11, "M", 70, 2100, "g", date(2020, 6, 8)), (12, "M", 20, 2100, "g", None)],
    "omr": [
        (10, 1, date(2020, 4, 1), "Weight", "70"),
        (10, 2, date(2020, 5, 2), "Weight", "71"),
        (10, 3, None, "Height", "160"),
        (11, 1, date(2020, 7, 1), "Weight", "80"),
    ],
    "diagnoses_icd": [
        (10, 1, 1, " 4019", 9), (10, 1, 2, "I10", 10), (10, 1, 3, "4019", 9), (10, 1, 4, "ZZZ", 9), (10, 1, 5, "4019", 10),
    ],
    "procedures_icd": [
        (10, 1, 1, date(2020, 5, 1), "P1", 9), (10, 1, 2, date(2020, 5, 3), "P2", 9), (10, 1, 3, date(2020, 5, 3), "P1", 9),
        (11, 3, 1, date(2020, 6, 2), "NOPE", 9),
    ],
    "d_icd_diagnoses": [("4019", 9, "Hypertension"), ("I10", 10, "Primary hypertension"), ("4019", 10, "Other version")],
    "d_icd_procedures": [("P1", 9, "First procedure"), ("P2", 9, "Second procedure")],
    "labevents": [
        (100, 10, 1, 1, 7, D(2020, 5, 1, 12), None, "5", 5.0, "mg", 1.0, 9.0, None, "STAT", "p"),
        (101, 10, 1, 1, 7, D(2020, 5, 1, 12), None, "5", 5.0, "mg", 1.0, 9.0, None, "STAT", "p"),
        (102, 10, 1, 1, 8, D(2020, 5, 2, 12), None, "nan", None, None, None, None, "abnormal", "ROUTINE", "p"),
        (103, 10, 1, 1, 7, D(2020, 5, 2, 12), None, "6", 6.0, "mg", 1.0, 9.0, None, "ROUTINE", "p"),
        (104, 10, 1, 1, 9, None, None, "7", 7.0, "mg", 1.0, 9.0, None, "ROUTINE", "p"),
        (105, 10, 1, 1, 7, D(2020, 5, 1, 8), None, "4", 4.0, "mg", 1.0, 9.0, None, "STAT", "p"),
    ],
    "d_labitems": [(7, "Glucose", "Blood", "Chemistry"), (8, "Sodium", "Blood", "Chemistry")],
    "microbiologyevents": [
        (200, 10, 1, 1, D(2020, 5, 2, 6), "BLOOD", "Culture", "E. COLI", 1, None, "S", "c"),
    ],
    "poe": [
        ("10-1", 1, 10, 1, D(2020, 5, 1, 11), "Medications", None, "New", "x"),
        ("10-2", 2, 10, 1, D(2020, 5, 1, 13), "General Care", "Vitals", "New", "x"),
        ("10-3", 3, 10, 1, None, "General Care", None, "New", "x"),
        ("10-4", 4, 10, 1, D(2020, 5, 1, 13), "Lab", None, "New", "x"),
        ("10-5", 5, 10, 1, D(2020, 5, 2, 13), None, None, "New", "x"),
        ("10-6", 6, 10, 1, D(2020, 5, 2, 14), "Medications", None, "New", "x"),
        ("11-1", 1, 11, 3, D(2020, 6, 2), "Lab", None, "New", "x"),
        ("12-1", 1, 12, 5, D(2020, 7, 1, 10), "General Care", None, "New", "x"),
    ],
    "poe_detail": [
        ("10-2", 1, 10, "Level", "High"), ("10-2", 2, 10, "Reason", "Pain"), ("10-2", 3, 10, None, "lost"),
        ("10-5", 1, 10, "Level", "Low"),
    ],
    "prescriptions": [
        (10, 1, 1, "10-1", 1, D(2020, 5, 1, 14), D(2020, 5, 3), "Aspirin", "PO"),
        (10, 1, 2, None, 1, D(2020, 5, 1, 15), None, "Unlinked", "PO"),
    ],
    "services": [(10, 1, D(2020, 5, 1, 10, 30), "MED")],
    "transfers": [
        (10, 1, 1, "admit", "Ward A", D(2020, 5, 1, 10), D(2020, 5, 2, 9)),
        (10, 1, 2, "transfer", "Ward B", D(2020, 5, 2, 9), D(2020, 5, 4, 12)),
    ],
    "edstays": [
        (10, 1, 51, D(2020, 5, 1, 6), D(2020, 5, 1, 10), "F", "R1", "WALK IN", "ADMITTED"),
        (10, 1, 52, D(2020, 5, 3, 6), D(2020, 5, 3, 20), "F", "R1", "AMBULANCE", "ADMITTED"),
        (10, 2, 53, D(2020, 8, 1, 6), D(2020, 8, 1, 8), "F", "R1", "WALK IN", "ADMITTED"),
        (11, 3, 54, D(2020, 6, 1, 5), D(2020, 6, 1, 9), "M", "R2", "WALK IN", "ADMITTED"),
        (12, 4, 55, D(2020, 6, 1, 5), D(2020, 6, 1, 9), "M", "R2", "WALK IN", "ADMITTED"),
    ],
    "triage": [(10, 51, 37.5, 80.0, "4", 2, "Fever")],
    "vitalsign": [(10, 51, D(2020, 5, 1, 7), 82.0, 120.0), (10, 52, D(2020, 5, 3, 7), 90.0, 110.0)],
    "diagnosis": [(10, 51, 1, "R50", 10, "Fever, unspecified"), (10, 51, 2, "R51", 10, "Headache")],
    "medrecon": [
        (10, 51, D(2020, 5, 1, 6), "Aspirin", "1", "Analgesic"), (10, 51, D(2020, 5, 1, 6), "Aspirin", "1", "Antiplatelet"),
        (10, 51, D(2020, 5, 1, 6), None, "1", "Unknown"), (10, 52, D(2020, 5, 3, 6), "Aspirin", "1", "Analgesic"),
        (10, 52, D(2020, 5, 3, 6), None, "1", "Unknown"), (10, 52, D(2020, 5, 3, 6), "Ibuprofen", "2", "Analgesic"),
    ],
    "pyxis": [
        (10, 51, D(2020, 5, 1, 8), 1, "Aspirin", 1, "1"), (10, 51, D(2020, 5, 1, 8), 1, "Aspirin", 2, "2"),
        (10, 51, D(2020, 5, 1, 9), 2, "Aspirin", 1, "1"),
    ],
    "discharge": [("10-DS-1", 10, 1, "DS", 1, D(2020, 5, 4), D(2020, 5, 5, 9), "Went home.")],
    "radiology": [
        ("10-RR-1", 10, None, "RR", 1, D(2020, 4, 1, 9), None, "Old film."),
        ("10-AR-2", 10, 1, "AR", 2, D(2020, 5, 2, 9), None, "Addendum."),
        ("10-XX-3", 10, 1, "XX", 3, D(2020, 5, 3, 5, 59), None, "Odd type."),
        ("10-RR-4", 10, 1, "RR", 4, D(2020, 5, 3, 6), None, "At the cutoff."),
        ("10-RR-5", 10, 1, "RR", 5, D(2020, 5, 3, 18), None, "Late film."),
    ],
    "radiology_detail": [
        ("10-RR-1", 10, "exam_name", "CHEST"), ("10-RR-1", 10, "exam_code", "C1"), ("10-AR-2", 10, "parent_note_id", "10-RR-1"),
    ],
}


def tables(spark):
    return {name: spark.createDataFrame(ROWS[name], schema) for name, schema in SCHEMAS.items()}
