"""Grids, indicators, samples, transforms and the carried dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CONTINUOUS,
    DAY,
    DEVICE_LEVELS,
    VITALS,
    VITALS_SQL,
    carried_sql,
    device_long,
    grid_sql,
    load,
    query,
    rounded,
    vitals_long,
)
from wardline.operators import reshape, sample, transform
from wardline.operators.longtable import indicators
from wardline.sources.tables import materialise

TRANSFORMS = transform.Transforms(
    logged=["resp_rate", "heart_rate", "po2", "ph", "pco2"],
    bounded={"GCS": (2.9, 12.2), "spo2": (0.0, 101.0), "fio2": (20.9, 79.3)},
)
CARRIED = ["fio2", "pressor", "hfnc", "niv", "stdo2"]
GRID_KEYS = ["user_id", "time"]


def grid(spark, folder):
    return reshape.to_grid(vitals_long(spark, folder), GRID_KEYS, VITALS)


def cells_sql(source: str, variables=VITALS) -> str:
    """Long cells of a wide SQL source, NULL cells included."""
    return " UNION ALL ".join(
        f"SELECT user_id, time, '{v}' AS variable, {v} AS value FROM {source}" for v in variables
    )


def _logit(x):
    return f"CASE WHEN {x} > 0 AND {x} < 1 THEN ln({x} / (1 - {x})) END"


FORWARD_SQL = f"""
  CASE WHEN variable IN ('resp_rate', 'heart_rate', 'po2', 'ph', 'pco2') THEN CASE WHEN value > 0 THEN ln(value) END
       WHEN variable = 'GCS' THEN {_logit("((value - 2.9) / 12.2)")}
       WHEN variable = 'spo2' THEN {_logit("(value / 101)")}
       WHEN variable = 'fio2' THEN {_logit("((value - 20.9) / 79.3)")}
       ELSE value END
"""
TRANSFORMED_SQL = f"""
  SELECT * FROM (SELECT user_id, time, variable, {FORWARD_SQL} AS value FROM ({VITALS_SQL})) WHERE value IS NOT NULL
"""
SCALE_SQL = f"""
  SELECT variable, avg(value) AS mean, stddev_samp(value) AS sd FROM ({TRANSFORMED_SQL})
  WHERE variable IN ({", ".join(f"'{v}'" for v in CONTINUOUS)}) GROUP BY 1
"""
STANDARD_SQL = f"""
  SELECT user_id, time, t.variable, CASE WHEN mean IS NOT NULL THEN (value - mean) / sd ELSE value END AS value
  FROM ({TRANSFORMED_SQL}) t LEFT JOIN ({SCALE_SQL}) s ON t.variable = s.variable
"""


def _expit(x):
    return f"(1 / (1 + exp(-({x}))))"


INVERSE_SQL = f"""
  CASE WHEN variable IN ('resp_rate', 'heart_rate', 'po2', 'ph', 'pco2') THEN exp(value)
       WHEN variable = 'GCS' THEN round_even({_expit("value")} * 12.2 + 2.9, 0)
       WHEN variable = 'spo2' THEN round_even({_expit("value")} * 101.0, 0)
       WHEN variable = 'fio2' THEN round_even({_expit("value")} * 79.3 + 20.9, 0)
       ELSE value END
"""


def standard(spark, folder):
    """Transformed and standardised vitals with their means and deviations.

    Two passes over the transformed table, so it is written first. The scale is written too: summed anew it could differ
    in its last bits, and the way back has to undo the way there.
    """
    moved = materialise(transform.transformed(vitals_long(spark, folder), TRANSFORMS), "moved")
    scale = materialise(transform.mean_sd(moved, CONTINUOUS), "scale")
    return transform.standardised(moved, scale), scale


@query("pivot_grid", grid_sql())
def pivot_grid(spark, folder):
    return grid(spark, folder)


@query(
    "pivot_missing_columns",
    f"SELECT user_id, time, max(CASE WHEN variable = 'spo2' THEN value END) AS spo2, CAST(NULL AS DOUBLE) AS lactate "
    f"FROM ({VITALS_SQL}) GROUP BY 1, 2",
)
def pivot_missing(spark, folder):
    return reshape.guarantee_columns(
        reshape.to_grid(vitals_long(spark, folder), GRID_KEYS, ["spo2"]), ["spo2", "lactate"]
    )


@query("unpivot_grid", f"WITH g AS MATERIALIZED ({grid_sql()}) {cells_sql('g')}")
def unpivot_grid(spark, folder):
    return reshape.from_grid(grid(spark, folder), GRID_KEYS, VITALS)


@query("indicators", VITALS_SQL)
def device_indicators(spark, folder):
    return indicators(device_long(spark, folder), "o2_device", DEVICE_LEVELS)


@query(
    "one_hot",
    f"""
SELECT user_id, time, list_position([{", ".join(f"'{v}'" for v in VITALS)}], variable) AS var,
  {", ".join(f"CASE WHEN variable = '{v}' THEN 1 ELSE 0 END AS is_{v}" for v in VITALS)}
FROM ({VITALS_SQL})
""",
)
def one_hot(spark, folder):
    numbered = reshape.variable_index(vitals_long(spark, folder), VITALS)
    return reshape.one_hot(numbered, VITALS).drop("variable", "value")


@query(
    "sample_entities",
    """
WITH s AS (SELECT c_custkey FROM customer ORDER BY md5('20210205:' || c_custkey), c_custkey LIMIT 400)
SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS id FROM s
""",
)
def sample_entities(spark, folder):
    chosen = sample.sample_entities(load(spark, folder, "customer"), "c_custkey", 400, 20210205)
    return sample.dense_index(chosen, "c_custkey")


@query(
    "dense_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS id FROM (SELECT DISTINCT o_orderkey FROM orders)",
)
def dense_index(spark, folder):
    return sample.dense_index(load(spark, folder, "orders"), "o_orderkey")


@query(
    "forward_transform",
    f"SELECT user_id, time, variable, round(value, 6) AS value FROM ({TRANSFORMED_SQL})",
)
def forward_transform(spark, folder):
    return rounded(transform.transformed(vitals_long(spark, folder), TRANSFORMS), "value")


@query("zscore", f"SELECT user_id, time, variable, round(value, 6) AS value FROM ({STANDARD_SQL})")
def zscore(spark, folder):
    return rounded(standard(spark, folder)[0], "value")


@query(
    "inverse_transform",
    f"""
SELECT user_id, time, variable, round({INVERSE_SQL}, 6) AS value FROM (
  SELECT user_id, time, z.variable, CASE WHEN mean IS NOT NULL THEN value * sd + mean ELSE value END AS value
  FROM ({STANDARD_SQL}) z LEFT JOIN ({SCALE_SQL}) s ON z.variable = s.variable)
""",
)
def inverse_transform(spark, folder):
    z, scale = standard(spark, folder)
    return rounded(transform.restored(z, scale, TRANSFORMS), "value")


@query(
    "prediction_grid",
    f"""
WITH g AS MATERIALIZED ({grid_sql()})
SELECT user_id, time, variable FROM ({cells_sql('g')})
WHERE value IS NULL AND variable IN ('resp_rate', 'heart_rate', 'spo2', 'GCS') AND time >= {7 * DAY}
""",
)
def prediction_grid(spark, folder):
    return reshape.prediction_cells(
        grid(spark, folder), "user_id", "time", VITALS, ["resp_rate", "heart_rate", "spo2", "GCS"], 7 * DAY
    ).select("user_id", "time", "variable")


FILLED = [v for v in VITALS if v != "wob"]


@query(
    "locf_dataset",
    f"""
WITH g AS MATERIALIZED ({grid_sql(f"SELECT user_id, time - {7 * DAY} AS time, variable, value FROM ({STANDARD_SQL})")}),
 c AS MATERIALIZED (SELECT * REPLACE (coalesce(pressor, 0) AS pressor) FROM ({carried_sql("SELECT * FROM g", FILLED, ["wob"])})),
 l AS (SELECT * FROM ({cells_sql('c')}) WHERE time >= 0 AND value IS NOT NULL),
 s AS MATERIALIZED ({SCALE_SQL})
SELECT user_id, time, variable, round({INVERSE_SQL}, 6) AS value FROM (
  SELECT user_id, round(time / 60, 6) AS time, l.variable, CASE WHEN mean IS NOT NULL THEN value * sd + mean ELSE value END AS value
  FROM l LEFT JOIN s ON l.variable = s.variable)
""",
)
def locf_dataset(spark, folder):
    z, scale = standard(spark, folder)
    return rounded(
        transform.carried_dataset(
            z.withColumn("time", F.col("time") - 7 * DAY),
            scale,
            TRANSFORMS,
            "user_id",
            "time",
            VITALS,
            FILLED,
            ["pressor"],
            DAY,
            60,
        ),
        "time",
        "value",
    )


@query(
    "model_extract",
    f"""
WITH g AS MATERIALIZED ({grid_sql(STANDARD_SQL)}),
 c AS MATERIALIZED (SELECT * REPLACE (coalesce(pressor, 0) AS pressor)
      FROM ({carried_sql("SELECT * FROM g", CARRIED, [v for v in VITALS if v not in CARRIED])}))
SELECT user_id, round(time / {DAY}, 6) AS time, variable, list_position([{", ".join(f"'{v}'" for v in VITALS)}], variable) AS var,
  CASE WHEN variable IN ({", ".join(f"'{v}'" for v in CONTINUOUS)}) THEN 'continuous' ELSE 'binary' END AS kind,
  round(value, 6) AS value
FROM ({cells_sql('c')}) ORDER BY 1, 4, 2
""",
)
def model_extract(spark, folder):
    z, _ = standard(spark, folder)
    carried = reshape.carried_grid(z, "user_id", "time", VITALS, CARRIED, DAY)
    cells = transform.model_extract(carried, "user_id", "time", VITALS, CONTINUOUS, DAY, ["pressor"])
    return rounded(cells, "time", "value").orderBy("user_id", "var", "time")
