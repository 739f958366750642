"""End-to-end builds on the stand-in tables, and results written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.base import (
    CONTINUOUS,
    DAY,
    DEVICE_SQL,
    EVENTS_SQL,
    SIGNALS_SQL,
    VITALS,
    carried_sql,
    device_long,
    events,
    grid_sql,
    load,
    query,
    rounded,
    written_signals,
)
from registry.reshaping import FILLED, INVERSE_SQL, SCALE_SQL, STANDARD_SQL, TRANSFORMS, cells_sql, standard
from registry.rules_outcomes import FLAGS_SQL, outcome_flags_frame, outcomes_sql
from wardline.operators import transform
from wardline.operators.blocks import EverBy, Last, along_time
from wardline.operators.joins import keyed_join
from wardline.operators.longtable import censor_at_first
from wardline.operators.outcomes import evaluate_rules
from wardline.operators.pick import latest_at_index
from wardline.operators.reshape import to_grid
from wardline.sources.tables import (
    gather_results,
    materialise,
    remaining,
    shared_folder,
    write_report,
    write_results,
)

INDEX_SQL = f"""
  SELECT user_id, min(minute) AS index_time FROM (
    SELECT user_id, minute,
      last_value(oxy IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN 4320 PRECEDING AND CURRENT ROW) AS oxy,
      last_value(sat IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN 2880 PRECEDING AND CURRENT ROW) AS sat,
      max(vent) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN UNBOUNDED PRECEDING AND 30 FOLLOWING) AS vent
    FROM ({SIGNALS_SQL}))
  WHERE sat <= 100 AND oxy >= 20 AND coalesce(vent, 0) = 0 AND minute < 20160 GROUP BY 1
"""


def index_times(spark, folder):
    state = along_time(
        written_signals(spark, folder),
        ["user_id"],
        "minute",
        [
            Last("oxy", "oxy", within=4320),
            Last("sat", "sat", within=2880),
            EverBy("vent", "vent", 30),
        ],
        DAY,
    )
    eligible = (
        (F.col("sat") <= 100)
        & (F.col("oxy") >= 20)
        & (F.coalesce("vent", F.lit(0)) == 0)
        & (F.col("minute") < 20160)
    )
    return state.filter(eligible).groupBy("user_id").agg(F.min("minute").alias("index_time"))


BASE = [v for v in CONTINUOUS if v != "pco2"] + ["o2_device", "pressor"]


@query(
    "cohort_build",
    f"""
WITH i AS MATERIALIZED ({INDEX_SQL}),
 d AS MATERIALIZED ({DEVICE_SQL}),
 r AS (SELECT d.user_id, d.time - i.index_time AS time, variable, value FROM d JOIN i USING (user_id)
       WHERE d.time - i.index_time < 7200 AND d.time > -2880),
 f AS (SELECT user_id, min(time) AS imv_time FROM r WHERE variable = 'o2_device' AND value = 6 AND time > 0 GROUP BY 1),
 l AS (SELECT r.* FROM r LEFT JOIN f USING (user_id) WHERE imv_time IS NULL OR time <= imv_time)
SELECT i.user_id, i.index_time, f.imv_time, CASE WHEN f.imv_time IS NULL THEN 0 ELSE 1 END AS imv_ever, c_mktsegment, n_name,
  n.rows_after, {", ".join(f"round(b.{v}_bl, 6) AS {v}_bl" for v in BASE)}
FROM i LEFT JOIN f USING (user_id) LEFT JOIN customer ON c_custkey = i.user_id LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN (SELECT user_id, count(*) FILTER (WHERE time > 0) AS rows_after FROM l GROUP BY 1) n ON n.user_id = i.user_id
  LEFT JOIN (SELECT user_id, {", ".join(f"arg_max(value, time) FILTER (WHERE variable = '{v}') AS {v}_bl" for v in BASE)}
             FROM l WHERE time <= 0 GROUP BY 1) b ON b.user_id = i.user_id
""",
)
def cohort_build(spark, folder):
    """Index time, long table relative to it, censoring, baseline snapshot and star join.

    The index and the censored long table are each read by several later steps, so they are
    written once and read back.
    """
    index = materialise(index_times(spark, folder), "index")
    time = F.col("time") - F.col("index_time")
    relative = (
        keyed_join(
            device_long(spark, folder).filter(F.col("time") > -2880), index, "user_id", "inner", ["time", "variable"]
        )
        .withColumn("time", time)
        .drop("index_time")
        .filter(F.col("time") < 7200)
    )
    relative = materialise(relative, "relative")
    first = (
        relative.filter("variable = 'o2_device' AND value = 6 AND time > 0")
        .groupBy("user_id")
        .agg(F.min("time").alias("imv_time"))
    )
    long = censor_at_first(
        relative, first, "user_id", "imv_time", keep_event_row=True, spread=["time", "variable"]
    )
    snapshot = latest_at_index(long, "user_id", BASE)
    after = long.groupBy("user_id").agg(F.count_if(F.col("time") > 0).alias("rows_after"))
    people = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = load(spark, folder, "nation").select("n_nationkey", "n_name")
    wide = (
        index.join(first, "user_id", "left")
        .join(people, "user_id", "left")
        .join(F.broadcast(nations), "n_nationkey", "left")
        .join(after, "user_id", "left")
        .join(snapshot, "user_id", "left")
    )
    return rounded(
        wide.select(
            "user_id",
            "index_time",
            "imv_time",
            F.when(F.col("imv_time").isNull(), 0).otherwise(1).alias("imv_ever"),
            "c_mktsegment",
            "n_name",
            "rows_after",
            *[f"{v}_bl" for v in BASE],
        ),
        *[f"{v}_bl" for v in BASE],
    )


CARRIED_HOURS_SQL = f"""
  z0 AS MATERIALIZED (SELECT user_id, time - {7 * DAY} AS time, variable, value FROM ({STANDARD_SQL})),
  g0 AS MATERIALIZED ({grid_sql("SELECT * FROM z0")}),
  c0 AS MATERIALIZED (SELECT * REPLACE (coalesce(pressor, 0) AS pressor) FROM ({carried_sql("SELECT * FROM g0", FILLED, ["wob"])})),
  l0 AS (SELECT * FROM ({cells_sql('c0')}) WHERE time >= 0 AND value IS NOT NULL),
  s0 AS MATERIALIZED ({SCALE_SQL}),
  r0 AS (SELECT user_id, time, variable, {INVERSE_SQL} AS value FROM (
    SELECT user_id, time / 60 AS time, l0.variable, CASE WHEN mean IS NOT NULL THEN value * sd + mean ELSE value END AS value
    FROM l0 LEFT JOIN s0 ON l0.variable = s0.variable)),
  g AS MATERIALIZED (SELECT *, 1 AS iter FROM ({grid_sql("SELECT * FROM r0")}))
"""
OUTCOME_COLUMNS = (
    "user_id, threshold, met, followed, fol8, fol24, fol48, fol72, fol120, death3, niv3, hfnc3, round(hour, 4) AS hour"
)


@query(
    "carry_and_evaluate",
    f"SELECT {OUTCOME_COLUMNS} FROM ({outcomes_sql(CARRIED_HOURS_SQL, FLAGS_SQL)})",
)
def carry_and_evaluate(spark, folder):
    """Transform, standardise, carry forward, restore, and evaluate every rule."""
    z, scale = standard(spark, folder)
    shifted = z.withColumn("time", F.col("time") - 7 * DAY)
    carried = transform.carried_dataset(
        shifted, scale, TRANSFORMS, "user_id", "time", VITALS, FILLED, ["pressor"], DAY, 60
    )
    grid = materialise(
        to_grid(carried.withColumn("iter", F.lit(1)), ["user_id", "iter", "time"], VITALS), "grid"
    )
    out = evaluate_rules(grid, outcome_flags_frame(spark, folder), "user_id")
    return out.select(
        "user_id", "threshold", "met", "followed", "fol8", "fol24", "fol48", "fol72", "fol120", "death3", "niv3",
        "hfnc3", F.round("hour", 4).alias("hour"),
    )


def _user_results(spark, folder):
    return events(spark, folder).groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("largest")
    )


@query(
    "written_results",
    f"SELECT user_id, event_type, count(*) AS n, max(value) AS largest FROM ({EVENTS_SQL}) GROUP BY 1, 2",
)
def written_results(spark, folder):
    """Per-entity results written into hash folders and gathered again."""
    path = f"{shared_folder(spark)}/results-{uuid.uuid4().hex[:12]}"
    write_results(_user_results(spark, folder), path, "user_id", buckets=8)
    return gather_results(spark, path).select("user_id", "event_type", "n", "largest")


@query(
    "csv_report",
    f"SELECT event_type, count(*) AS n, round(max(value), 4) AS largest FROM ({EVENTS_SQL}) GROUP BY 1",
)
def csv_report(spark, folder):
    """A report written as CSV, sorted at the sink, and read back."""
    path = f"{shared_folder(spark)}/report-{uuid.uuid4().hex[:12]}"
    table = events(spark, folder).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 4).alias("largest")
    )
    write_report(table, path, ["event_type"])
    return spark.read.schema("event_type string, n bigint, largest double").csv(path, header=True)


@query(
    "remaining_entities",
    "SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN "
    "(SELECT user_id FROM events GROUP BY user_id, event_type HAVING max(value) > 150)",
)
def remaining_entities(spark, folder):
    """Entities a restarted run still has to process."""
    path = f"{shared_folder(spark)}/done-{uuid.uuid4().hex[:12]}"
    write_results(_user_results(spark, folder).filter("largest > 150"), path, "user_id", buckets=8)
    todo = load(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return remaining(todo, path, "user_id")
