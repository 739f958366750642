"""First study: stays with calendar timestamps, from raw tables to rule outcomes.

Each step takes and returns frames. Steps read several times downstream (device table,
cohort, long table) are meant to be written with ``sources.tables.materialise`` between calls;
``build`` does so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from wardline.functions import recode
from wardline.functions.scalars import constant_for_null, flag, truthy
from wardline.functions.timeaxis import between, minute_number, minutes_between
from wardline.operators import summary
from wardline.operators.blocks import EverBy, Last, Whole, along_time
from wardline.operators.impute import (
    GaussianProcess,
    completed_grid,
    completed_lanes,
    gaussian_imputations,
    on_raw_scale,
)
from wardline.operators.joins import asof_join, exclude_listed, keyed_join, restrict
from wardline.operators.longtable import (
    censor_at_end,
    censor_at_first,
    collapse,
    dedupe_max,
    indicators,
    reconcile_events,
    replace_parts,
    stack_long,
    to_long,
    union_long,
)
from wardline.operators.outcomes import end_event, evaluate_rules, evaluate_rules_over_draws
from wardline.operators.pick import best_row, code_set_flags, latest_at_index
from wardline.operators.reshape import carried_grid
from wardline.operators.sample import dense_index, sample_entities
from wardline.operators.spine import align, prefer_mean, product_mean, sum_and_count
from wardline.operators.state import cumulative_states, interval_state, on_off_events
from wardline.operators.transform import (
    carried_dataset,
    mean_sd,
    model_extract,
    standardised,
    transformed,
)
from wardline.plans import fixed_values as fixed
from wardline.sources.tables import materialise

Tables = Mapping[str, DataFrame]
KEY = ["stay_id", "charttime"]


def _second_number(ts) -> "F.Column":
    ts = F.col(ts) if isinstance(ts, str) else ts
    return minute_number(ts) * 60 + F.second(ts)


def device_table(t: Tables, prefer_charted: bool = False) -> DataFrame:
    """Device category, rate, saturation and oxygen percentage per stay and time.

    The five sources are aligned by one grouped aggregate. ``fio2`` averages charted and
    estimated values with the weights a row-by-row join of the sources gives them;
    ``prefer_charted`` uses the estimates only where nothing usable was charted.
    """
    slots = [f"o2_delivery_device_{k}" for k in range(1, 5)]
    everywhere = lambda members: {s: members for s in slots}
    device = recode.first_match(
        [
            (7, everywhere(fixed.TRACHEOSTOMY)),
            (6, everywhere(fixed.INTUBATED)),
            (5, everywhere(fixed.NONINVASIVE)),
            (4, everywhere(fixed.HIGH_FLOW)),
            (3, everywhere(fixed.NON_REBREATHER)),
            (2, everywhere(fixed.OTHER_OXYGEN)),
            (1, everywhere(fixed.NASAL_PRONGS)),
            (0, {slots[0]: fixed.NO_DEVICE}),
        ]
    )
    mode = recode.first_match(
        [
            (6, {"ventilator_mode": fixed.VENTILATOR_MODES, "ventilator_mode_hamilton": fixed.HAMILTON_INVASIVE}),
            (5, {"ventilator_mode_hamilton": fixed.HAMILTON_NONINVASIVE}),
        ]
    )
    first_slot = F.col(slots[0])
    estimate = recode.percent_from_flow(F.col("o2_flow"), first_slot, fixed.FLOW_DEVICES)
    charted = F.col("itemid") == fixed.CHARTED_FIO2
    present = recode.any_present
    one = F.lit(1)
    sources = [
        t["ventilator_setting"].select(
            *KEY,
            mode.alias("code"),
            F.when(present(F.col("ventilator_mode"), F.col("ventilator_mode_hamilton")), one).alias("seen"),
        ),
        # A row whose first slot is empty counts only beside another source at its time.
        t["oxygen_delivery"].select(
            *KEY,
            F.when(first_slot.isNotNull(), device).alias("code"),
            F.when(first_slot.isNull(), device).alias("side_code"),
            F.when(first_slot.isNotNull(), one).alias("device_seen"),
            one.alias("flow_row"),
            estimate.alias("estimate"),
        ),
        t["vitalsign"].select(
            *KEY,
            F.col("resp_rate"),
            F.when(F.col("spo2").between(5, 100), F.col("spo2")).alias("spo2"),
            F.when(present(F.col("resp_rate"), F.col("spo2")), one).alias("seen"),
        ),
        t["chartevents"].select(
            *KEY,
            F.when(charted, recode.charted_percent(F.col("valuenum"))).alias("charted"),
            F.when(charted, one).alias("marked_row"),
            F.when(~truthy(charted), one).alias("unmarked_row"),
            F.when(charted, one).alias("seen"),
        ),
        t["procedureevents"]
        .filter(F.col("itemid") == fixed.INTUBATION_PROCEDURE)
        .select("stay_id", F.col("starttime").alias("charttime"), F.lit(6).alias("code"), one.alias("seen")),
    ]
    aligned = align(
        sources,
        KEY,
        [
            F.max("code").alias("code"),
            F.max("side_code").alias("side_code"),
            F.max("seen").alias("seen"),
            F.max("device_seen").alias("device_seen"),
            F.avg("resp_rate").alias("resp_rate"),
            F.avg("spo2").alias("spo2"),
            *sum_and_count("charted", F.col("charted")),
            *sum_and_count("estimate", F.col("estimate")),
            F.count("flow_row").alias("flow_rows"),
            F.count("marked_row").alias("marked_rows"),
            F.count("unmarked_row").alias("unmarked_rows"),
        ],
    ).filter(present(F.col("seen"), F.col("device_seen")))
    fio2 = (
        prefer_mean("charted", "estimate")
        if prefer_charted
        else product_mean("charted", "marked_rows", "estimate", "flow_rows", "unmarked_rows")
    )
    side = F.when(F.col("seen") == 1, F.col("side_code"))
    return aligned.select(
        *KEY, F.greatest("code", side).alias("o2_device"), "resp_rate", "spo2", fio2.alias("fio2")
    )


def stay_states(t: Tables, device: DataFrame) -> DataFrame:
    """Per stay and minute since admission: carried device, oxygen, saturation and ever-flags."""
    stays = t["icustays"].select("stay_id", "intime")
    status = t["chartevents"].filter(F.col("itemid") == fixed.CODE_STATUS).select(
        *KEY,
        F.when(F.col("value").isin(fixed.CODE_STATUS_LIMITED), 1)
        .when(F.col("value").isin(fixed.CODE_STATUS_FULL), 0)
        .alias("goc"),
    )
    code = F.col("o2_device")
    devices = device.select(
        *KEY,
        F.when(code == 7, 1).otherwise(0).alias("trach"),
        F.when(code == 6, 1).otherwise(0).alias("imv"),
        code.alias("o2_device_bl"),
        "fio2",
        "spo2",
    )
    timed = keyed_join(union_long([status, devices]), stays, "stay_id", "inner", ["charttime"])
    minute = minutes_between("charttime", "intime")
    kept = timed.withColumn("time", minute).filter(
        F.col("goc").isNull() | (F.col("time") < fixed.STAY_LIMIT)
    )
    names = ["goc", "trach", "imv", "o2_device_bl", "fio2", "spo2"]
    rows = collapse(kept, ["stay_id", "time"], {n: F.max(n) for n in names})
    return along_time(
        rows,
        ["stay_id"],
        "time",
        [
            EverBy("trach_ever", "trach", 7200),
            EverBy("ineligible_imv", "imv", 30),
            Last("fio2", "fio2", within=480),
            Last("o2_device_bl", "o2_device_bl", within=480),
            Last("spo2", "spo2", within=120),
            Whole("goc", "goc"),
            Whole("imv_first", F.when(F.col("imv") == 1, F.col("time")), "min"),
            Whole("imv_last", F.when(F.col("imv") == 1, F.col("time")), "max"),
        ],
        fixed.DAY,
    )


def _state_conditions(oxygen_at_least: float, saturation_at_most: float):
    code = F.col("o2_device_bl")
    return {
        "eligible_o2_device": (code >= 3) & (code < 6),
        "sfratio_eligible": (F.col("spo2") <= saturation_at_most) & (F.col("fio2") >= oxygen_at_least),
        "not_intubated": F.col("ineligible_imv") == 0,
        "eligibility_trach": ~truthy(F.col("trach_ever") == 1),
        "goc_eligible": ~truthy(F.col("goc") == 1),
        "early": F.col("time") < fixed.SCREENING_LIMIT,
    }


def stay_flags(t: Tables) -> DataFrame:
    """Admission, age and outcome criteria per stay."""
    planned = F.col("admission_type").isin(fixed.PLANNED_ADMISSIONS)
    detail = t["icustay_detail"].select(
        "stay_id", F.col("hadm_id").alias("_hadm"), "hospstay_seq", "icustay_seq", "admission_age"
    )
    admissions = t["admissions"].select(
        F.col("hadm_id").alias("_hadm"), F.col("subject_id").alias("_subject"),
        "admission_type", "discharge_location",
    )
    return (
        t["icustays"]
        .select("subject_id", "hadm_id", "stay_id", "intime")
        .join(detail, "stay_id", "left")
        .join(admissions, "_hadm", "left")
        .select(
            F.coalesce("_subject", "subject_id").alias("subject_id"),
            F.coalesce("_hadm", "hadm_id").alias("hadm_id"),
            "stay_id",
            "intime",
            "hospstay_seq",
            "icustay_seq",
            flag(~truthy(planned)).alias("eligibility_admission"),
            flag(F.col("discharge_location").isNotNull()).alias("eligibility_outcome"),
            flag(F.col("admission_age") >= 18).alias("eligibility_age"),
        )
    )


def eligibility(
    t: Tables,
    device: DataFrame,
    states: DataFrame | None = None,
    oxygen_at_least: float = 40,
    saturation_at_most: float = 100,
) -> DataFrame:
    """The cohort: one row per subject at its earliest eligible moment."""
    states = stay_states(t, device) if states is None else states
    moment = F.lit(True)
    for cond in _state_conditions(oxygen_at_least, saturation_at_most).values():
        moment = moment & cond
    stays = stay_flags(t).filter(
        "eligibility_admission = 1 AND eligibility_outcome = 1 AND eligibility_age = 1"
    )
    moments = keyed_join(states.filter(moment), stays, "stay_id", "inner", bounded=True)
    index = best_row(
        moments,
        ["subject_id"],
        [F.col("hospstay_seq"), F.col("icustay_seq"), F.col("time"), F.col("stay_id")],
        [
            "hadm_id",
            "stay_id",
            F.lit(1).alias("eligible"),
            F.col("time").alias("eligibility_time"),
            "intime",
            "o2_device_bl",
            F.col("fio2").alias("fio2_bl"),
            F.col("spo2").alias("spo2_bl"),
            "eligibility_admission",
            "eligibility_age",
            "eligibility_outcome",
            F.lit(1).alias("eligibility_trach"),
            F.lit(1).alias("goc_eligible"),
            (F.col("imv_first") - F.col("time")).alias("imv_time"),
            (F.col("imv_last") - F.col("time")).alias("_imv_last"),
        ],
    )
    # No intubation precedes an eligible moment, so the first and last one of the stay decide.
    return (
        index.withColumn("imv_ever", flag(F.col("imv_time") < fixed.FOLLOW_UP))
        .withColumn("imv_after_censor", flag(F.col("_imv_last") >= fixed.FOLLOW_UP))
        .drop("_imv_last")
    )


def screening(t: Tables, states: DataFrame, cohort: DataFrame) -> DataFrame:
    """Every stay with its criteria, for the attrition table."""
    cond = _state_conditions(40, 100)
    every = F.lit(True)
    for c in cond.values():
        every = every & c
    per_stay = states.groupBy("stay_id").agg(
        F.max(flag(cond["eligibility_trach"])).alias("eligibility_trach"),
        F.min(flag(cond["goc_eligible"])).alias("goc_eligible"),
        F.max("ineligible_imv").alias("ineligible_imv"),
        F.max(flag(F.col("fio2") >= 40)).alias("fio2_geq_40"),
        F.max(flag(cond["eligible_o2_device"])).alias("eligible_o2_device"),
        F.max(flag(every)).alias("_moment"),
    )
    chosen = cohort.select("stay_id", "eligible")
    return (
        stay_flags(t)
        .join(per_stay, "stay_id", "left")
        .join(chosen, "stay_id", "left")
        .withColumn("eligible", constant_for_null(F.col("eligible"), 0))
        .withColumn(
            "repeat_eligible_admission", flag((F.col("_moment") == 1) & (F.col("eligible") == 0))
        )
        .drop("_moment")
    )


def attrition_table(screened: DataFrame) -> DataFrame:
    on = lambda name: F.col(name) == 1
    return summary.attrition(
        screened,
        [
            ("outcome known", on("eligibility_outcome")),
            ("unplanned admission", on("eligibility_admission")),
            ("no treatment limit", ~truthy(F.col("goc_eligible") == 0)),
            ("no tracheostomy", on("eligibility_trach")),
            ("not intubated before", (F.col("ineligible_imv") == 0) | on("eligible")),
            ("enough oxygen", on("fio2_geq_40")),
            ("on a listed device", on("eligible_o2_device")),
            ("index stay", on("eligible")),
        ],
    )


def long_table(t: Tables, cohort: DataFrame, device: DataFrame) -> DataFrame:
    """``(stay_id, time, variable, value)`` from 48 hours before admission to 120 hours after index."""
    columns = ["stay_id", "intime", "eligibility_time"]
    at = F.col("charttime")
    since = minutes_between(at, "intime")

    def relative(df, on="stay_id", spread=("charttime",), bounded=True):
        ids = cohort.select(*dict.fromkeys([on, *columns]))
        df = df if on == "stay_id" else df.drop("stay_id")
        joined = keyed_join(df, ids, on, "inner", list(spread))
        timed = joined.withColumn("_since", since).withColumn(
            "time", F.col("_since") - F.col("eligibility_time")
        )
        cond = F.col("time") < fixed.FOLLOW_UP
        if bounded:
            cond = cond & (F.col("_since") > -fixed.BEFORE_ADMISSION)
        return timed.filter(cond)

    def branch(df, variable="variable", value="value", **kw):
        name = F.col(variable) if isinstance(variable, str) else variable
        amount = F.col(value) if isinstance(value, str) else value
        return to_long(relative(df, **kw), ["stay_id", "time"], name, amount)

    one = F.lit(1)
    charted = recode.map_concepts(
        t["chartevents"].select(*KEY, "itemid", F.col("value").alias("text"), "valuenum"),
        fixed.CHARTED, "itemid", "valuenum", text="text",
    )
    deaths = t["admissions"].select("hadm_id", F.col("deathtime").alias("charttime"))
    leaving = t["icustays"].select("stay_id", F.col("outtime").alias("charttime"))
    labs = recode.map_concepts(
        t["labevents"].select("subject_id", "charttime", "itemid", "valuenum"),
        fixed.LABS, "itemid", "valuenum",
    )
    gases = t["bg"].filter(F.col("specimen") == fixed.ARTERIAL).select("subject_id", "charttime", "po2")
    oxygen = stack_long(
        device, KEY, {"fio2": F.col("fio2"), "o2_device": F.col("o2_device")}
    )
    urine = t["urine_output_rate"].filter(between(F.col("uo_mlkghr_6hr"), after=0, before=50))
    procedures = recode.map_concepts(
        t["procedureevents"].select("stay_id", F.col("starttime").alias("charttime"), "itemid", one.alias("n")),
        [recode.Concept(c, v) for c, v in fixed.PROCEDURES.items()], "itemid", "n",
    )
    given = t["emar"].filter(F.col("event_txt").isin(fixed.GIVEN))
    drugs = recode.text_class(given, "medication", fixed.DRUG_CLASSES, "variable").select(
        "hadm_id", "charttime", "variable"
    )
    return censor_at_first(
        dedupe_max(
            union_long(
                [
                    branch(charted, spread=["charttime", "itemid", "text"]),
                    branch(deaths, F.lit("death"), one, on="hadm_id", bounded=False),
                    branch(leaving, F.lit("icu_dc"), one, bounded=False),
                    branch(labs, on="subject_id", spread=["charttime", "itemid"]),
                    branch(gases, F.lit("po2"), "po2", on="subject_id", bounded=False),
                    branch(oxygen, spread=["charttime", "variable"]),
                    branch(urine, F.lit("uo_6h_rate"), "uo_mlkghr_6hr"),
                    branch(procedures, spread=["charttime", "itemid"]),
                    pressor_state(t, cohort),
                    branch(drugs.filter("variable IS NOT NULL"), "variable", one, on="hadm_id"),
                ]
            ),
            ["stay_id", "time", "variable"],
        ),
        cohort,
        "stay_id",
        "imv_time",
        keep_event_row=True,
        ever="imv_ever",
        spread=["time", "variable"],
    )


def pressor_state(t: Tables, cohort: DataFrame) -> DataFrame:
    """On/off series over all vasopressor infusions, relative to the index time."""
    infusions = union_long(
        [
            t[name].select("stay_id", F.lit(name).alias("channel"), "starttime", "endtime")
            for name in fixed.PRESSORS
        ]
    )
    ids = cohort.select(
        "stay_id", minute_number("intime").alias("_in"), F.col("eligibility_time").alias("_index")
    )
    switches = keyed_join(
        on_off_events(
            infusions.select(
                "stay_id", "channel",
                _second_number("starttime").alias("start"), _second_number("endtime").alias("stop"),
            ),
            ["stay_id"], "channel", "start", "stop",
        ),
        ids, "stay_id", "inner", ["time", "channel"],
    )
    minute = F.floor(F.col("time") / 60)
    in_window = (minute - F.col("_in") > -fixed.BEFORE_ADMISSION) & (
        minute - F.col("_in") - F.col("_index") < fixed.FOLLOW_UP
    )
    state = interval_state(
        switches.filter(in_window), ["stay_id"], "time", "channel", fixed.PRESSORS, 86_400
    )
    return keyed_join(state, ids, "stay_id", "inner", bounded=True).select(
        "stay_id",
        (minute - F.col("_in") - F.col("_index")).alias("time"),
        F.lit("pressor").alias("variable"),
        F.col("value").cast("double").alias("value"),
    )


def baseline(t: Tables, cohort: DataFrame, long: DataFrame) -> DataFrame:
    """One wide row per cohort stay: identity, admission, latest values, comorbidity, events."""
    latest = latest_at_index(long, "stay_id", fixed.BASELINE_VARIABLES)
    ends = long.groupBy("stay_id").agg(
        *[
            c
            for name, out in (("death", "death_obs"), ("icu_dc", "icu_dc"))
            for c in (
                F.max(F.when(F.col("variable") == name, 1).otherwise(0)).alias(out),
                F.min(F.when(F.col("variable") == name, F.col("time"))).alias(f"{out}_time"),
            )
        ]
    )
    coded = restrict(t["diagnoses_icd"].select("hadm_id", "icd_code"), cohort, "hadm_id", ["icd_code"])
    comorbid = code_set_flags(coded, ["hadm_id"], "icd_code", fixed.DIAGNOSES)
    anchors = cohort.select("hadm_id", _second_number("intime").alias("_at"))
    services = t["services"].select(
        "hadm_id", _second_number("transfertime").alias("_service_at"), "curr_service"
    )
    service = asof_join(
        anchors, services, ["hadm_id"], "_at", "_service_at", ["curr_service"], 86_400, strict=True
    ).select("hadm_id", "curr_service")
    unit = collapse(t["transfers"], ["hadm_id", "intime"], {"careunit": F.max("careunit")})
    stays = t["icustays"].select("stay_id", "outtime", F.col("los").alias("LOS"))
    people = t["patients"].select("subject_id", "anchor_year", "anchor_year_group", "anchor_age", "gender")
    height = collapse(t["height"], ["stay_id"], {"height": F.max("height")})
    weight = collapse(t["first_day_weight"], ["stay_id"], {"weight_admit": F.max("weight_admit")})
    admissions = t["admissions"].drop("subject_id")
    device = F.col("o2_device_bl")
    wide = (
        cohort.join(stays, "stay_id", "left")
        .join(admissions, "hadm_id", "left")
        .join(people, "subject_id", "left")
        .join(service, "hadm_id", "left")
        .join(unit, ["hadm_id", "intime"], "left")
        .join(height, "stay_id", "left")
        .join(weight, "stay_id", "left")
        .join(comorbid, "hadm_id", "left")
        .join(latest, "stay_id", "left")
        .join(ends, "stay_id", "left")
    )
    return wide.select(
        "subject_id", "hadm_id", "stay_id", "eligibility_time", "intime", "outtime",
        "imv_ever", "imv_time", "imv_after_censor",
        "death_obs", "death_obs_time", "icu_dc", "icu_dc_time",
        minutes_between("outtime", "intime").alias("icu_discharge_time"),
        "LOS", "admission_type",
        minutes_between("intime", "admittime").alias("preICU_LOS"),
        "curr_service", "careunit", "anchor_year", "anchor_year_group", "anchor_age", "gender",
        "height", "weight_admit", "ethnicity", "language", "insurance", "marital_status",
        "admission_location", "discharge_location",
        flag(F.col("discharge_location") == fixed.DIED).alias("hosp_death"),
        minutes_between("dischtime", "intime").alias("time_to_discharge"),
        minutes_between("deathtime", "intime").alias("time_to_death"),
        *fixed.DIAGNOSES,
        "spo2_bl", "fio2_bl",
        flag(device == 5).alias("niv_bl"), flag(device == 4).alias("hfnc_bl"),
        *[f"{v}_bl" for v in fixed.BASELINE_VARIABLES],
    )


def clean_baseline(wide: DataFrame, excluded: Sequence[int] = ()) -> DataFrame:
    """Excluded stays out, known gaps filled, end events reconciled, admission hour."""
    kept = exclude_listed(wide, "stay_id", excluded).fillna(0, ["copd", "chf"])
    return reconcile_events(
        kept, "death_obs", "death_obs_time", "icu_dc", "icu_dc_time"
    ).withColumn("intime", F.hour("intime"))


def prepared_table(long: DataFrame, clean: DataFrame) -> DataFrame:
    """Scored, transformed and censored long table with device indicators."""
    ids = clean.select("stay_id", "death_obs", "death_obs_time", "icu_dc", "icu_dc_time")
    scored = replace_parts(long, ["stay_id", "time"], fixed.COMA_PARTS, "GCS").filter(
        between(F.col("time"), after=-12 * fixed.HOUR, to=fixed.FOLLOW_UP)
    )
    moved = transformed(scored, fixed.FIRST_TRANSFORMS)
    before = moved.filter(~((F.col("variable") == "o2_device") & (F.col("value") == 6)))
    censored = censor_at_end(
        before, ids, "stay_id", "death_obs", "death_obs_time", "icu_dc", "icu_dc_time",
        spread=["time", "variable"],
    )
    return indicators(censored, "o2_device", fixed.FIRST_DEVICES)


def standard_table(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The standardised long table, and its means and deviations."""
    scale = mean_sd(prepared, fixed.FIRST_STANDARDISED)
    return standardised(prepared, scale), scale


MODEL_ORDER = fixed.FIRST_CONTINUOUS + fixed.FIRST_BINARY


def model_grid(standard: DataFrame) -> DataFrame:
    """Wide grid of the modelled variables, slow ones carried forward."""
    used = standard.filter(
        F.col("variable").isin(MODEL_ORDER) & (F.col("time") > -12 * fixed.HOUR)
    )
    return carried_grid(used, "stay_id", "time", MODEL_ORDER, fixed.FIRST_CARRIED, fixed.DAY)


def model_cells(grid: DataFrame) -> DataFrame:
    """Cells in days with variable numbers; empty ones only where they are to be predicted."""
    cells = model_extract(
        grid, "stay_id", "time", MODEL_ORDER, fixed.FIRST_CONTINUOUS, fixed.DAY, ["pressor"]
    )
    predicted = F.col("variable").isin(fixed.FIRST_PREDICTED) & (F.col("time") >= 0)
    return cells.filter(F.col("value").isNotNull() | predicted)


def carried_forward(standard: DataFrame, scale: DataFrame) -> DataFrame:
    """Single imputation of the modelled variables by carry-forward, in hours and raw units."""
    used = standard.filter(
        F.col("variable").isin(MODEL_ORDER) & (F.col("time") > -12 * fixed.HOUR)
    )
    filled = [v for v in MODEL_ORDER if v != "wob"]
    return carried_dataset(
        used, scale, fixed.FIRST_TRANSFORMS, "stay_id", "time", MODEL_ORDER, filled, ["pressor"],
        fixed.DAY, 60,
    )


def hyperparameter_sample(clean: DataFrame) -> DataFrame:
    """The seeded entity sample for fitting, with dense numbers."""
    return dense_index(
        sample_entities(clean, "stay_id", fixed.SAMPLE_SIZE, fixed.SAMPLE_SEED), "stay_id"
    )


def impute(
    cells: DataFrame, scale: DataFrame, gp: GaussianProcess, draws: int = 100, seed: int = fixed.SAMPLE_SEED,
    lanes: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Observed cells and the draws for the empty ones, from time 0, in hours and raw units.

    With ``lanes`` an empty cell is one row with the array of its draws, the form to use at scale.
    """
    drawn = gaussian_imputations(cells, "stay_id", "time", gp, draws, seed, lanes)
    return on_raw_scale(cells, drawn, scale, fixed.FIRST_TRANSFORMS, "time", MODEL_ORDER, 24)


def outcomes(observed: DataFrame, drawn: DataFrame, clean: DataFrame, draws: int = 100) -> DataFrame:
    """Every rule on every completed series, from draws as rows or as lanes. No rule reads the blood pressure."""
    used = [v for v in MODEL_ORDER if v != "sbp"]
    flags = clean.select(
        "stay_id", F.col("imv_ever").alias("imv"), F.col("death_obs").alias("death")
    )
    if drawn.schema["value"].dataType.typeName() == "array":
        predicted = [v for v in used if v in fixed.FIRST_PREDICTED]
        grid = completed_lanes(observed, drawn, "stay_id", "time", used, predicted)
        return evaluate_rules_over_draws(grid, flags, "stay_id", draws, predicted)
    grid = completed_grid(observed, drawn, "stay_id", "time", used, draws)
    return evaluate_rules(grid, flags, "stay_id")


def report_table(clean: DataFrame) -> DataFrame:
    """Baseline characteristics by device at the index time."""
    device = (
        F.when(F.col("hfnc_bl") == 1, "HFNC").when(F.col("niv_bl") == 1, "NIV").otherwise("NRB")
    )
    people = (
        clean.withColumnRenamed("gender", "sex")
        .withColumn("o2_device", device)
        .withColumn("agegroup", recode.bin_left_closed(F.col("anchor_age"), fixed.AGE_BREAKS, fixed.AGE_LABELS))
        .withColumn("careunit", recode.collapse_category(F.col("careunit"), fixed.CARE_UNITS, "Medical-surgical"))
        .withColumn("ethnicity", recode.collapse_category(F.col("ethnicity"), fixed.ETHNICITIES, "Unknown"))
        .withColumn("death28", flag(F.col("time_to_death") < 28 * fixed.DAY))
    )
    return summary.stratified_summary(
        people, "o2_device", fixed.FIRST_REPORT, fixed.FIRST_REPORT_CONTINUOUS
    )


def states_over_time(clean: DataFrame, grid: DataFrame) -> DataFrame:
    """How many stays are in each state at every end time."""
    last = grid.groupBy("stay_id").agg(F.max("time").alias("lastobs"))
    event, time = end_event(
        F.col("imv_time"), F.col("icu_dc_time"), F.col("death_obs_time"), F.col("lastobs")
    )
    ended = clean.join(last, "stay_id", "left").select(event.alias("event"), time.alias("time"))
    return cumulative_states(ended, "time", "event", ["IMV", "DC", "Death"], fixed.DAY, "ICU, no IMV")


def build(t: Tables, excluded: Sequence[int] = (), folder: str | None = None) -> dict[str, DataFrame]:
    """All tables up to the model input; what several steps read is written once."""
    keep = lambda df, name: materialise(df, f"first-{name}", folder)
    device = keep(device_table(t), "device")
    states = keep(stay_states(t, device), "states")
    cohort = keep(eligibility(t, device, states), "cohort")
    long = keep(long_table(t, cohort, device), "long")
    wide = keep(baseline(t, cohort, long), "baseline")
    clean = clean_baseline(wide, excluded)
    kept = exclude_listed(long, "stay_id", excluded)
    standard, scale = standard_table(keep(prepared_table(kept, clean), "prepared"))
    standard, scale = keep(standard, "standard"), keep(scale, "scale")
    grid = keep(model_grid(standard), "grid")
    return {
        "device": device,
        "cohort": cohort,
        "attrition": attrition_table(screening(t, states, cohort)),
        "long": kept,
        "baseline": clean,
        "standard": standard,
        "mean_sd": scale,
        "grid": grid,
        "cells": model_cells(grid),
        "carried": carried_forward(standard, scale),
        "missing": summary.missingness(grid, MODEL_ORDER),
        "report": report_table(clean),
        "states": states_over_time(clean, grid),
    }
