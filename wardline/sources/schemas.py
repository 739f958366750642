"""Columns each source table must bring, so no scan has to infer them."""

from __future__ import annotations

from pyspark.sql import types as T

_PRESSOR = "stay_id bigint, starttime timestamp_ntz, endtime timestamp_ntz"

_FIRST = {
    "chartevents": "subject_id bigint, hadm_id bigint, stay_id bigint, charttime timestamp_ntz, "
    "itemid bigint, value string, valuenum double",
    "icustays": "subject_id bigint, hadm_id bigint, stay_id bigint, intime timestamp_ntz, "
    "outtime timestamp_ntz, los double",
    "ventilator_setting": "stay_id bigint, charttime timestamp_ntz, ventilator_mode string, "
    "ventilator_mode_hamilton string",
    "oxygen_delivery": "stay_id bigint, charttime timestamp_ntz, o2_delivery_device_1 string, "
    "o2_delivery_device_2 string, o2_delivery_device_3 string, o2_delivery_device_4 string, o2_flow double",
    "vitalsign": "stay_id bigint, charttime timestamp_ntz, resp_rate double, spo2 double",
    "procedureevents": "stay_id bigint, starttime timestamp_ntz, itemid bigint",
    "icustay_detail": "stay_id bigint, hadm_id bigint, hospstay_seq int, icustay_seq int, admission_age double",
    "admissions": "subject_id bigint, hadm_id bigint, admission_type string, discharge_location string, "
    "admission_location string, ethnicity string, language string, insurance string, "
    "marital_status string, admittime timestamp_ntz, dischtime timestamp_ntz, deathtime timestamp_ntz",
    "patients": "subject_id bigint, anchor_year int, anchor_year_group string, anchor_age int, gender string",
    "labevents": "subject_id bigint, charttime timestamp_ntz, itemid bigint, valuenum double",
    "bg": "subject_id bigint, charttime timestamp_ntz, po2 double, specimen string",
    "urine_output_rate": "stay_id bigint, charttime timestamp_ntz, uo_mlkghr_6hr double",
    "norepinephrine": _PRESSOR,
    "vasopressin": _PRESSOR,
    "dopamine": _PRESSOR,
    "phenylephrine": _PRESSOR,
    "epinephrine": _PRESSOR,
    "emar": "hadm_id bigint, charttime timestamp_ntz, medication string, event_txt string",
    "diagnoses_icd": "hadm_id bigint, icd_code string",
    "services": "hadm_id bigint, transfertime timestamp_ntz, curr_service string",
    "transfers": "hadm_id bigint, intime timestamp_ntz, careunit string",
    "height": "stay_id bigint, height double",
    "first_day_weight": "stay_id bigint, weight_admit double",
}

_SECOND = {
    "admissions": "patientid bigint, admissionid bigint, admissioncount bigint, admittedat bigint, "
    "dischargedat bigint, dateofdeath bigint, location string, urgency string, gender string, "
    "agegroup string, weightgroup string, heightgroup string, specialty string, admissionyeargroup string",
    "numericitems": "admissionid bigint, itemid bigint, unitid bigint, item string, value double, "
    "measuredat bigint, registeredby string",
    "listitems": "admissionid bigint, itemid bigint, valueid bigint, item string, value string, "
    "measuredat bigint, registeredby string",
    "freetextitems": "admissionid bigint, itemid bigint, measuredat bigint, value string",
    "drugitems": "admissionid bigint, itemid bigint, item string, start bigint, stop bigint",
    "procedureorderitems": "admissionid bigint, itemid bigint, registeredat bigint",
    "processitems": "admissionid bigint, itemid bigint, start bigint",
    "respiratory_rate": "admissionid bigint, chartminute double, value double, validated boolean",
    "coma_score": "admissionid bigint, chartminute double, gcs_score double",
}


def _parsed(tables: dict[str, str]) -> dict[str, T.StructType]:
    return {n: T._parse_datatype_string(text) for n, text in tables.items()}


def first_database() -> dict[str, T.StructType]:
    """Tables with calendar timestamps."""
    return _parsed(_FIRST)


def second_database() -> dict[str, T.StructType]:
    """Tables with epoch-millisecond timestamps."""
    return _parsed(_SECOND)
