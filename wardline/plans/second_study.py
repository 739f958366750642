"""Second study: admissions with epoch-millisecond timestamps, from raw tables to rule outcomes.

Same operators as the first study under another configuration. ``respiratory_rate`` and
``coma_score`` are inputs: ``(admissionid, chartminute, value, validated)`` and
``(admissionid, chartminute, gcs_score)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from wardline.functions import recode
from wardline.functions.scalars import flag, truthy
from wardline.functions.timeaxis import between, minutes_from_ms
from wardline.operators import summary
from wardline.operators.blocks import Last, along_time
from wardline.operators.impute import (
    GaussianProcess,
    completed_grid,
    gaussian_imputations,
    on_raw_scale,
)
from wardline.operators.joins import exclude, exclude_listed, join_where, keyed_join, restrict
from wardline.operators.longtable import (
    censor_at_first,
    collapse,
    dedupe_mixed,
    first_event_time,
    indicators,
    stack_long,
    to_long,
    union_distinct,
    union_long,
)
from wardline.operators.outcomes import evaluate_rules_without_effort
from wardline.operators.pick import best_row, first_of_subject, latest_at_index
from wardline.operators.reshape import carried_grid, from_grid, guarantee_columns
from wardline.operators.state import signed_delta_state
from wardline.operators.transform import (
    carried_dataset,
    mean_sd,
    standardised,
    transformed,
)
from wardline.plans import fixed_values as fixed
from wardline.sources.tables import materialise

Tables = Mapping[str, DataFrame]
ENTITY = "admissionid"
AT = [ENTITY, "chartminute"]


def _on_admission(df: DataFrame, t: Tables, ms: str, spread: Sequence[str]) -> DataFrame:
    """Adds ``chartminute``, fractional minutes since the admission."""
    admitted = t["admissions"].select(ENTITY, "admittedat")
    return (
        keyed_join(df, admitted, ENTITY, "left", spread)
        .withColumn("chartminute", minutes_from_ms(ms, "admittedat"))
        .drop("admittedat")
    )


def _near_stay(df: DataFrame, before: float = fixed.BEFORE_ADMISSION) -> DataFrame:
    return df.filter(between(F.col("chartminute"), from_=-before, to=fixed.STAY_LIMIT))


def oxygen_table(t: Tables) -> DataFrame:
    """Device and oxygen per admission and minute, from settings, flows, orders and processes."""
    routes = t["listitems"].filter(F.col("itemid") == fixed.OXYGEN_ROUTE).select(
        ENTITY, "measuredat", "valueid", F.col("registeredby").alias("_route_by")
    )
    measured = (
        t["numericitems"]
        .filter(
            F.col("itemid").isin(fixed.OXYGEN_FLOW + fixed.OXYGEN_SETTINGS) & (F.col("value") > 0)
        )
        .select(ENTITY, "itemid", "value", "measuredat", "registeredby")
    )
    timed = _near_stay(_on_admission(measured, t, "measuredat", ["measuredat", "itemid"]))
    joined = timed.join(routes, [ENTITY, "measuredat"], "left")
    item, value, route = F.col("itemid"), F.col("value"), F.col("valueid")
    estimate = recode.fraction_from_flow(
        value, route, fixed.ROUTES_FLOORED, fixed.ROUTES_SCALED, fixed.ROUTES_ROOM_AIR
    )
    charted = joined.select(
        *AT,
        recode.override(item, fixed.NONINVASIVE_SETTINGS, fixed.ROUTE_NIV, route.cast("int")).alias("o2_device"),
        F.when(item.isin(fixed.OXYGEN_SETTINGS), value).otherwise(estimate).alias("fio2"),
        F.col("_route_by").isNotNull().alias("lvalidated"),
        F.col("registeredby").isNotNull().alias("nvalidated"),
    )
    marked = lambda df, ms, device: _on_admission(df, t, ms, [ms, "itemid"]).select(
        *AT, device.cast("int").alias("o2_device"), F.lit(None).cast("double").alias("fio2"),
        F.lit(True).alias("lvalidated"), F.lit(True).alias("nvalidated"),
    )
    orders = t["procedureorderitems"].filter(F.col("itemid") == fixed.INTUBATION_ORDER)
    processes = t["processitems"].filter(
        F.col("itemid").isin(fixed.INTUBATION_PROCESS, fixed.NONINVASIVE_PROCESS)
    )
    process_device = F.when(item == fixed.INTUBATION_PROCESS, fixed.ROUTE_IMV).otherwise(fixed.ROUTE_NIV)
    return union_distinct(
        [
            charted,
            marked(orders.select(ENTITY, "itemid", "registeredat"), "registeredat", F.lit(fixed.ROUTE_IMV)),
            marked(processes.select(ENTITY, "itemid", "start"), "start", process_device),
        ]
    ).filter(recode.any_present(F.col("fio2"), F.col("o2_device")))


def code_status(t: Tables) -> DataFrame:
    """Care-goal records with their minute."""
    records = t["listitems"].filter(F.col("item") == fixed.CODE_STATUS_ITEM)
    return _on_admission(records, t, "measuredat", ["measuredat", "valueid"]).select(
        ENTITY, "item", "chartminute", "valueid"
    )


def _specimens(t: Tables) -> DataFrame:
    return t["freetextitems"].select(
        ENTITY, "measuredat", F.col("itemid").alias("_item"), F.col("value").alias("specimen_source")
    )


def acidity(t: Tables) -> DataFrame:
    """pH measurements from arterial or unspecified samples."""
    ph = t["numericitems"].filter(F.col("itemid").isin(fixed.PH_ITEMS))
    sampled = join_where(
        ph, _specimens(t), [ENTITY, "measuredat"], F.col("_item") == fixed.SPECIMEN_ITEM
    ).filter(recode.arterial_or_unknown(F.col("specimen_source")))
    timed = _near_stay(_on_admission(sampled, t, "measuredat", ["measuredat", "itemid"]))
    return timed.select(
        ENTITY, "itemid", "item", "value", "specimen_source", "registeredby",
        recode.entered_by_hand(F.col("registeredby")).alias("manual_entry"),
        F.col("chartminute").alias("time"),
    )


def blood_gases(t: Tables, before_minutes: float = 48) -> DataFrame:
    """Oxygen tension with the carbon dioxide and pH measured at the same moment.

    The lower bound is 48 *minutes* before admission by default, as the source study has it.
    """
    items = t["numericitems"]
    mmhg = F.when(F.col("unitid") == fixed.KPA_UNIT, F.col("value") * fixed.MMHG_PER_KPA).otherwise(F.col("value"))
    key = [ENTITY, "measuredat"]
    po2 = items.filter(F.col("itemid").isin(fixed.PO2_ITEMS)).select(*key, mmhg.alias("po2"), "registeredby")
    pco2 = items.filter(F.col("itemid").isin(fixed.PCO2_ITEMS)).select(*key, mmhg.alias("pco2"))
    ph = items.filter(F.col("itemid").isin(fixed.PH_ITEMS)).select(*key, F.col("value").alias("ph"))
    arterial = (
        join_where(po2, _specimens(t), key, F.col("_item") == fixed.SPECIMEN_ITEM)
        .filter(recode.arterial_or_unknown(F.col("specimen_source")))
        .drop("_item")
    )
    timed = _near_stay(_on_admission(arterial, t, "measuredat", ["measuredat"]), before_minutes)
    return timed.join(pco2, key, "left").join(ph, key, "left").select(
        *AT, "po2", "pco2", "ph", "specimen_source",
        recode.entered_by_hand(F.col("registeredby")).alias("manual_entry"),
    )


def vital_signs(t: Tables) -> DataFrame:
    """Validated pressure, heart rate and saturation."""
    concepts = [recode.Concept(code, name) for code, name in fixed.VITAL_ITEMS.items()]
    rows = t["numericitems"].select(ENTITY, "itemid", "value", "measuredat", "registeredby").filter(
        F.col("registeredby").isNotNull()
    )
    named = recode.map_concepts(rows, concepts, "itemid", "value", variable_out="item")
    timed = _near_stay(_on_admission(named, t, "measuredat", ["measuredat", "itemid"]))
    return timed.select(*AT, "item", "value", F.lit(True).alias("validated"))


def eligibility(t: Tables, oxygen: DataFrame, goals: DataFrame) -> DataFrame:
    """Each admission's first moment on a listed device, with its diagnosis flags and care goal."""
    checked = oxygen.filter("nvalidated OR lvalidated")
    rows = collapse(checked, AT, {"o2_device": F.max("o2_device"), "fio2": F.max("fio2")})
    carried = along_time(
        rows, [ENTITY], "chartminute", [Last("o2_device", "o2_device"), Last("fio2", "fio2", within=480)],
        fixed.HOUR * 6,
    )
    device, fio2 = F.col("o2_device"), F.col("fio2")
    enough = fio2.between(0.4, 1) | fio2.between(40, 100)
    moments = carried.filter(
        (device == fixed.ROUTE_IMV) | (device.isin(fixed.ROUTE_NIV, fixed.ROUTE_NRB) & enough)
    )
    first = best_row(
        moments, [ENTITY], [F.col("chartminute")], [F.col("chartminute").alias("eligibletime"), "o2_device"]
    )
    item, text = F.col("itemid"), F.col("value")
    coded = (
        t["listitems"]
        .filter(item.isin(fixed.DIAGNOSIS_ITEMS))
        .select(
            ENTITY,
            "measuredat",
            recode.diagnosis_flag(item, text, fixed.OPERATIVE).alias("operative"),
            recode.diagnosis_flag(item, text, fixed.RESPIRATORY).alias("respiratory"),
            recode.diagnosis_flag(item, text, fixed.SEPSIS).alias("sepsis"),
            text.alias("diagnosis"),
        )
    )
    flags = ["operative", "respiratory", "sepsis", "diagnosis"]
    diagnosis = best_row(
        coded, [ENTITY], [F.col("measuredat"), F.col("diagnosis"), F.col("operative")], flags
    )
    worst = (
        goals.filter(F.col("chartminute") < 8640).groupBy(ENTITY).agg(F.max("valueid").alias("goc"))
    )
    admitted = t["admissions"].select(ENTITY, F.lit(0).alias("_zero"))
    # Admissions without a coded diagnosis have flags of 0; moments without an admission have none.
    return (
        first.join(admitted, ENTITY, "left")
        .join(diagnosis, ENTITY, "left")
        .join(worst, ENTITY, "left")
        .select(
            ENTITY, "eligibletime", "o2_device",
            *[F.coalesce(n, "_zero").alias(n) for n in flags[:3]], "diagnosis", "goc",
        )
    )


def cohort(eligible: DataFrame) -> DataFrame:
    """Unplanned, early, on non-invasive support, without a treatment limit."""
    return eligible.filter(
        (F.col("operative") == 0)
        & (F.col("eligibletime") < fixed.SCREENING_LIMIT)
        & F.col("o2_device").isin(fixed.ROUTE_NIV, fixed.ROUTE_NRB)
        & (F.col("goc").isNull() | F.col("goc").isin(1, 2))
    )


def attrition_table(eligible: DataFrame) -> DataFrame:
    return summary.attrition(
        eligible,
        [
            ("not operative", F.col("operative") == 0),
            ("not intubated at index", F.col("o2_device") != fixed.ROUTE_IMV),
            ("no treatment limit", F.col("goc").isNull() | (F.col("goc") != 3)),
            ("within a day", F.col("eligibletime") < fixed.SCREENING_LIMIT),
        ],
    )


def long_table(
    t: Tables, chosen: DataFrame, oxygen: DataFrame, vitals: DataFrame, gases: DataFrame
) -> DataFrame:
    """``(admissionid, chartminute, var, value)`` relative to the index time."""
    index = chosen.select(ENTITY, "eligibletime")

    def relative(df, spread):
        return keyed_join(df, index, ENTITY, "inner", spread).withColumn(
            "chartminute", F.col("chartminute") - F.col("eligibletime")
        )

    def stacked(df, columns):
        return stack_long(relative(df, AT), AT, {c: F.col(c) for c in columns})

    single = lambda df, name, value: to_long(relative(df, AT), AT, name, F.col(value))
    ends = F.array(
        F.struct(F.col("start").alias("ms"), F.lit(1).alias("delta")),
        F.struct(F.col("stop").alias("ms"), F.lit(-1).alias("delta")),
    )
    drugs = (
        t["drugitems"]
        .filter(F.col("itemid").isin(fixed.PRESSOR_ITEMS))
        .select(ENTITY, "item", F.explode(ends).alias("_e"))
        .select(ENTITY, "item", "_e.*")
    )
    timed = _on_admission(drugs, t, "ms", ["ms", "item"]).filter(F.col("chartminute") < fixed.FOLLOW_UP)
    long = union_long(
        [
            stacked(oxygen.filter("lvalidated OR nvalidated"), ["o2_device", "fio2"]),
            single(t["respiratory_rate"].filter("validated"), "resp_rate", "value"),
            to_long(relative(vitals, AT), AT, F.col("item"), F.col("value")),
            single(t["coma_score"], "GCS", "gcs_score"),
            stacked(gases, ["po2", "pco2", "ph"]),
            to_long(relative(timed, AT), AT, F.col("item"), F.col("delta")),
        ]
    )
    return (
        long.withColumnRenamed("variable", "var")
        .filter(F.col("chartminute").isNotNull())
        .distinct()
    )


def clean_table(
    long: DataFrame, t: Tables, excluded: Sequence[int] = ()
) -> tuple[DataFrame, DataFrame]:
    """The cleaned long table (``time``, ``variable``) and the admissions left in it."""
    early = long.select(ENTITY, F.col("chartminute").alias("time"), F.col("var").alias("variable"), "value").filter(
        F.col("time") < fixed.FOLLOW_UP
    )
    intubated = first_event_time(early, ENTITY, "o2_device", fixed.ROUTE_IMV, out="imv_time")
    name, value = F.col("variable"), F.col("value")
    spread = ["time", "variable"]
    before = censor_at_first(early, intubated, ENTITY, "imv_time", spread=spread).filter(
        F.col("time") > -fixed.DAY
    )
    percent = F.when(name == "fio2", recode.fraction_to_percent(value, 0.21)).otherwise(value)
    usable = before.filter(~truthy((name == "fio2") & (value > 1) & (value < 21))).withColumn("value", percent)
    usable = recode.drop_out_of_range(usable, fixed.SECOND_LIMITS, "variable", "value")
    at_index = latest_at_index(usable.filter(name == "fio2"), ENTITY, ["fio2"])
    on_oxygen = at_index.filter("fio2_bl >= 40")
    usable = restrict(usable, on_oxygen, ENTITY, spread)
    channel = None
    for drug in fixed.PRESSOR_NAMES:
        cond = name.contains(drug)
        channel = F.when(cond, drug) if channel is None else channel.when(cond, drug)
    deltas = usable.withColumn("channel", channel).filter(F.col("channel").isNotNull())
    pressor = signed_delta_state(
        deltas, [ENTITY], "time", "channel", fixed.PRESSOR_NAMES, "value", fixed.HOUR * 6
    ).select(ENTITY, "time", F.lit("pressor").alias("variable"), F.col("value").cast("double").alias("value"))
    measured = fixed.SECOND_STANDARDISED + ["o2_device"]
    rows = usable.filter(name.isin(measured)).unionByName(pressor)
    tracheostomy = rows.filter((name == "o2_device") & value.isin(fixed.ROUTES_TRACHEOSTOMY))
    rows = exclude(rows, tracheostomy, ENTITY, spread)
    people = (
        rows.select(ENTITY)
        .distinct()
        .join(intubated, ENTITY, "left")
        .join(t["admissions"].drop("admittedat"), ENTITY, "left")
    )
    people = exclude_listed(first_of_subject(people, "patientid", "admissioncount", [ENTITY]), ENTITY, excluded)
    rows = restrict(rows, people, ENTITY, spread)
    marked = indicators(rows, "o2_device", fixed.SECOND_DEVICES)
    return dedupe_mixed(marked, [ENTITY, "time", "variable"], fixed.SECOND_STANDARDISED), people


MODEL_ORDER = fixed.SECOND_CONTINUOUS + fixed.SECOND_BINARY


def standard_table(moved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The standardised long table from the transformed one, and its means and deviations."""
    scale = mean_sd(moved, fixed.SECOND_STANDARDISED)
    return standardised(moved, scale), scale


def _used(standard: DataFrame) -> DataFrame:
    return standard.filter(
        F.col("variable").isin(MODEL_ORDER) & (F.col("time") > -12 * fixed.HOUR)
    )


def model_grid(standard: DataFrame) -> DataFrame:
    """Long grid cells, NULL where a predicted variable has to be imputed."""
    grid = carried_grid(_used(standard), ENTITY, "time", MODEL_ORDER, fixed.SECOND_CARRIED, fixed.HOUR * 6)
    cells = from_grid(grid, [ENTITY, "time"], MODEL_ORDER).filter(
        (F.col("time") >= 0) | F.col("value").isNotNull()
    )
    value = F.when(F.col("variable") == "pressor", F.coalesce("value", F.lit(0.0))).otherwise(F.col("value"))
    return cells.withColumn("value", value).filter(
        ~(F.col("variable").isin(fixed.SECOND_SPARSE) & F.col("value").isNull())
    )


def model_cells(cells: DataFrame) -> DataFrame:
    """The cells in days with variable numbers; empty ones only where they are predicted."""
    position = F.array_position(F.array(*[F.lit(v) for v in MODEL_ORDER]), F.col("variable"))
    predicted = F.col("variable").isin(fixed.SECOND_PREDICTED) & (F.col("time") >= 0)
    return cells.filter(F.col("value").isNotNull() | predicted).select(
        ENTITY, (F.col("time") / float(fixed.DAY)).alias("time"), "variable",
        position.cast("int").alias("var"), "value",
    )


def carried_forward(cells: DataFrame, scale: DataFrame) -> DataFrame:
    """Single imputation by carry-forward of the model grid, in hours and raw units."""
    return carried_dataset(
        cells.filter(F.col("value").isNotNull()), scale, fixed.SECOND_TRANSFORMS, ENTITY, "time",
        MODEL_ORDER, MODEL_ORDER, ["pressor"], fixed.HOUR * 6, 60,
    )


def impute(
    cells: DataFrame, scale: DataFrame, gp: GaussianProcess, draws: int = 100, seed: int = fixed.SAMPLE_SEED
) -> tuple[DataFrame, DataFrame]:
    """Observed cells and the draws for the empty ones, from time 0, in hours and raw units."""
    drawn = gaussian_imputations(cells, ENTITY, "time", gp, draws, seed)
    return on_raw_scale(cells, drawn, scale, fixed.SECOND_TRANSFORMS, "time", MODEL_ORDER, 24)


def entity_table(people: DataFrame, eligible: DataFrame) -> DataFrame:
    """Admissions with their index record; death relative to the index time."""
    return people.join(eligible, ENTITY, "left").withColumn(
        "dateofdeath", F.col("dateofdeath") / 60_000.0 - F.col("eligibletime")
    )


def outcomes(observed: DataFrame, drawn: DataFrame, entities: DataFrame, draws: int = 100) -> DataFrame:
    """Every rule on every completed series; death counts within follow-up, unless intubated.

    The work-of-breathing column does not exist here and stays empty.
    """
    grid = guarantee_columns(
        completed_grid(observed, drawn, ENTITY, "time", MODEL_ORDER, draws), ["wob"]
    )
    flags = entities.select(
        ENTITY,
        flag(F.col("imv_time").isNotNull()).alias("imv"),
        (F.col("imv_time") / 60.0).alias("imv_time"),
        flag((F.col("dateofdeath") < fixed.FOLLOW_UP) & F.col("imv_time").isNull()).alias("death"),
    )
    return evaluate_rules_without_effort(grid, flags, ENTITY)


def report_table(clean: DataFrame, entities: DataFrame) -> DataFrame:
    """Baseline characteristics by device at the index time."""
    latest = latest_at_index(clean, ENTITY, ["stdo2", "resp_rate", "fio2", "spo2"])
    imv = F.col("imv_time") < fixed.FOLLOW_UP
    people = (
        latest.filter("stdo2_bl IS NOT NULL")
        .withColumn("device", F.when(F.col("stdo2_bl") == 1, "NRB").otherwise("NIV"))
        .join(entities, ENTITY, "left")
        .withColumn("sex", F.when(F.col("gender") == "Vrouw", 1).when(F.col("gender") == "Man", 0))
        .withColumn("imv", flag(imv))
        .withColumn("death28", flag(F.col("dateofdeath") < 28 * fixed.DAY))
        .withColumn(
            "death_obs", ((F.col("dateofdeath") < fixed.FOLLOW_UP) & F.col("imv_time").isNull()).cast("int")
        )
        .withColumn(
            "icu_dc", flag(~truthy(imv) & truthy(F.col("dischargedat") / 60_000.0 < fixed.FOLLOW_UP))
        )
    )
    return summary.stratified_summary(
        people, "device", fixed.SECOND_REPORT, fixed.FIRST_REPORT_CONTINUOUS
    )


def build(t: Tables, excluded: Sequence[int] = (), folder: str | None = None) -> dict[str, DataFrame]:
    """All tables up to the model input; what several steps read is written once."""
    keep = lambda df, name: materialise(df, f"second-{name}", folder)
    oxygen = keep(oxygen_table(t), "oxygen")
    eligible = keep(eligibility(t, oxygen, code_status(t)), "eligible")
    long = keep(long_table(t, cohort(eligible), oxygen, vital_signs(t), blood_gases(t)), "long")
    rows, people = clean_table(long, t, excluded)
    rows, people = keep(rows, "clean"), keep(people, "people")
    standard, scale = standard_table(keep(transformed(rows, fixed.SECOND_TRANSFORMS), "moved"))
    standard, scale = keep(standard, "standard"), keep(scale, "scale")
    cells = keep(model_grid(standard), "cells")
    entities = entity_table(people, eligible.withColumnRenamed("o2_device", "o2_device_index"))
    return {
        "oxygen": oxygen,
        "eligible": eligible,
        "attrition": attrition_table(eligible),
        "long": long,
        "clean": rows,
        "entities": entities,
        "mean_sd": scale,
        "standard": standard,
        "cells": model_cells(cells),
        "carried": carried_forward(cells, scale),
        "missing": summary.missing_cells(cells),
        "gaps": summary.gap_between_observations(rows, ENTITY, MODEL_ORDER),
        "report": report_table(rows, entities),
    }
