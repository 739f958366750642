"""Registration, table schemas and the stand-in frames the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardline.functions.recode import Concept, map_concepts
from wardline.functions.timeaxis import minute_number
from wardline.operators.longtable import dedupe_max, indicators
from wardline.sources.tables import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under ``name``, with its SQL where plain SQL can express it."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# Start of the event table's calendar, and of the order calendar, in minutes since 1970.
EVENTS_ORIGIN = 28_401_120  # 2024-01-01
ORDERS_ORIGIN = 13_148_640  # 1995-01-01
DAY = 1440


def events(spark, folder) -> DataFrame:
    """Events with ``minute``, whole minutes since the calendar start."""
    return load(spark, folder, "events").withColumn("minute", minute_number("ts") - EVENTS_ORIGIN)


EVENTS_SQL = """
  SELECT event_id, user_id, event_type, value, props, ts,
         date_diff('minute', TIMESTAMP '2024-01-01', ts) AS minute
  FROM events
"""


def signals(spark, folder) -> DataFrame:
    """One row per user and minute: two measurements and two 0/1 states."""
    kind, value = F.col("event_type"), F.col("value")
    return (
        events(spark, folder)
        .groupBy("user_id", "minute")
        .agg(
            F.max(F.when(kind == "view", value)).alias("sat"),
            F.max(F.when(kind == "click", value)).alias("oxy"),
            F.max(F.when(kind == "error", F.when(value >= 100, 1).otherwise(0))).alias("vent"),
            F.max(F.when(kind == "purchase", F.when(value >= 120, 1).otherwise(0))).alias("limit"),
        )
    )


def written_signals(spark, folder) -> DataFrame:
    """``signals`` written and read back, for walks whose two passes need different columns."""
    return materialise(signals(spark, folder), "signals")


SIGNALS_SQL = f"""
  SELECT user_id, minute,
         max(CASE WHEN event_type = 'view' THEN value END) AS sat,
         max(CASE WHEN event_type = 'click' THEN value END) AS oxy,
         max(CASE WHEN event_type = 'error' THEN CASE WHEN value >= 100 THEN 1 ELSE 0 END END) AS vent,
         max(CASE WHEN event_type = 'purchase' THEN CASE WHEN value >= 120 THEN 1 ELSE 0 END END) AS "limit"
  FROM ({EVENTS_SQL}) GROUP BY 1, 2
"""

# Stand-in concept table: event type and a quarter of the property range -> vital sign.
VITAL_CONCEPTS = [
    Concept("view:0", "spo2", scale=-0.15, offset=100.0),
    Concept("view:1", "spo2", scale=-0.15, offset=100.0),
    Concept("view:2", "fio2", high=225, scale=0.35, offset=21.0),
    Concept("view:3", "fio2", high=225, scale=0.35, offset=21.0),
    Concept("click:0", "resp_rate", low=0, high=190, scale=0.3, offset=12.0),
    Concept("click:1", "resp_rate", low=0, high=190, scale=0.3, offset=12.0),
    Concept("click:2", "heart_rate", low=0, high=300, scale=0.6, offset=70.0),
    Concept("click:3", "heart_rate", low=0, high=300, scale=0.6, offset=70.0),
    Concept("error:0", "po2", scale=0.8, offset=40.0),
    Concept("error:1", "pco2", scale=0.4, offset=25.0),
    Concept("error:2", "ph", scale=-0.004, offset=7.5),
    Concept("error:3", "GCS", high=200, high_closed=True, scale=-0.06, offset=15.0),
    Concept("purchase:0", "o2_device"),
    Concept("purchase:1", "o2_device"),
    Concept("purchase:2", "o2_device"),
    Concept("purchase:3", "wob"),
    Concept("signup:0", "pressor"),
    Concept("signup:1", "pressor"),
    Concept("signup:2", "o2_device"),
    Concept("signup:3", "o2_device"),
]
DEVICE_LEVELS = {"niv": [5], "hfnc": [4], "stdo2": [2, 3]}
CONTINUOUS = ["resp_rate", "heart_rate", "spo2", "fio2", "GCS", "po2", "ph", "pco2"]
BINARY = ["wob", "pressor", "hfnc", "niv", "stdo2"]
VITALS = CONTINUOUS + BINARY


def device_long(spark, folder) -> DataFrame:
    """Long vitals with the device still a category: ``(user_id, time, variable, value)``."""
    quarter = F.floor(F.regexp_extract("props", r"(\d+)", 1).cast("int") / 25).cast("int")
    coded = events(spark, folder).select(
        "user_id",
        F.col("minute").alias("time"),
        F.concat_ws(":", "event_type", quarter.cast("string")).alias("code"),
        "value",
    )
    mapped = map_concepts(coded, VITAL_CONCEPTS, "code", "value").drop("code")
    name, raw = F.col("variable"), F.col("value")
    value = (
        F.when(name == "o2_device", F.least(F.floor(raw / 15).cast("double"), F.lit(6.0)))
        .when(name.isin("wob", "pressor"), F.when(raw > 60, 1.0).otherwise(0.0))
        .otherwise(raw)
    )
    return dedupe_max(mapped.withColumn("value", value), ["user_id", "time", "variable"])


def vitals_long(spark, folder) -> DataFrame:
    return indicators(device_long(spark, folder), "o2_device", DEVICE_LEVELS)


DEVICE_SQL = f"""
  SELECT user_id, time, variable, max(value) AS value FROM (
    SELECT user_id, minute AS time,
      CASE WHEN code IN ('view:0', 'view:1') THEN 'spo2'
           WHEN code IN ('view:2', 'view:3') THEN 'fio2'
           WHEN code IN ('click:0', 'click:1') THEN 'resp_rate'
           WHEN code IN ('click:2', 'click:3') THEN 'heart_rate'
           WHEN code = 'error:0' THEN 'po2'
           WHEN code = 'error:1' THEN 'pco2'
           WHEN code = 'error:2' THEN 'ph'
           WHEN code = 'error:3' THEN 'GCS'
           WHEN code = 'purchase:3' THEN 'wob'
           WHEN code IN ('signup:0', 'signup:1') THEN 'pressor'
           ELSE 'o2_device' END AS variable,
      CASE WHEN code IN ('view:0', 'view:1') THEN value * CAST(-0.15 AS DOUBLE) + 100
           WHEN code IN ('view:2', 'view:3') THEN CASE WHEN value < 225 THEN value * CAST(0.35 AS DOUBLE) + 21 END
           WHEN code IN ('click:0', 'click:1') THEN CASE WHEN value > 0 AND value < 190 THEN value * CAST(0.3 AS DOUBLE) + 12 END
           WHEN code IN ('click:2', 'click:3') THEN CASE WHEN value > 0 AND value < 300 THEN value * CAST(0.6 AS DOUBLE) + 70 END
           WHEN code = 'error:0' THEN value * CAST(0.8 AS DOUBLE) + 40
           WHEN code = 'error:1' THEN value * CAST(0.4 AS DOUBLE) + 25
           WHEN code = 'error:2' THEN value * CAST(-0.004 AS DOUBLE) + CAST(7.5 AS DOUBLE)
           WHEN code = 'error:3' THEN CASE WHEN value <= 200 THEN value * CAST(-0.06 AS DOUBLE) + 15 END
           WHEN code IN ('purchase:3', 'signup:0', 'signup:1') THEN CASE WHEN value > 60 THEN 1.0 ELSE 0.0 END
           ELSE least(floor(value / 15), 6) END AS value
    FROM (
      SELECT *, event_type || ':' || (CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) // 25) AS code
      FROM ({EVENTS_SQL})
    )
  ) WHERE value IS NOT NULL GROUP BY 1, 2, 3
"""

VITALS_SQL = f"""
  SELECT user_id, time, variable, value FROM ({DEVICE_SQL}) WHERE variable <> 'o2_device'
  UNION ALL
  SELECT user_id, time, k.name AS variable,
         CASE WHEN (k.name = 'niv' AND value = 5) OR (k.name = 'hfnc' AND value = 4)
                OR (k.name = 'stdo2' AND value IN (2, 3)) THEN 1.0 ELSE 0.0 END AS value
  FROM ({DEVICE_SQL}), (VALUES ('niv'), ('hfnc'), ('stdo2')) AS k(name)
  WHERE variable = 'o2_device'
"""


def grid_sql(source: str = VITALS_SQL, variables=None, entity="user_id") -> str:
    """Wide grid of a long SQL source."""
    cells = ", ".join(
        f"max(CASE WHEN variable = '{v}' THEN value END) AS {v}" for v in (variables or VITALS)
    )
    return f"SELECT {entity}, time, {cells} FROM ({source}) GROUP BY 1, 2"


def carried_sql(grid: str, carried, kept=(), entity="user_id") -> str:
    """Grid with the listed columns carried forward."""
    cells = ", ".join(
        [
            f"last_value({v} IGNORE NULLS) OVER (PARTITION BY {entity} ORDER BY time "
            f"ROWS UNBOUNDED PRECEDING) AS {v}"
            for v in carried
        ]
        + list(kept)
    )
    return f"SELECT {entity}, time, {cells} FROM ({grid})"


def orders(spark, folder) -> DataFrame:
    """Orders with ``day``, whole days since the order calendar's start."""
    day = ((minute_number("o_orderdate") - ORDERS_ORIGIN) / DAY).cast("int")
    return load(spark, folder, "orders").withColumn("day", day)


ORDERS_SQL = """
  SELECT *, CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS INTEGER) AS day FROM orders
"""


def infusions(spark, folder) -> DataFrame:
    """Intervals per supplier: ``(entity, channel, start, stop)`` in minutes."""
    start = minute_number("l_shipdate") - ORDERS_ORIGIN
    return load(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.col("l_returnflag").alias("channel"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("long") * 60).alias("stop"),
    )


INFUSIONS_SQL = """
  SELECT l_suppkey AS entity, l_returnflag AS channel,
         date_diff('minute', TIMESTAMP '1995-01-01', l_shipdate) AS start,
         date_diff('minute', TIMESTAMP '1995-01-01', l_shipdate) + CAST(l_quantity AS BIGINT) * 60 AS stop
  FROM lineitem
"""
CHANNELS = ["A", "N", "R"]


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Floating results to fixed places, as the SQL side does; the order of sums differs."""
    return df.select(
        *[F.round(F.col(c), places).alias(c) if c in columns else F.col(c) for c in df.columns]
    )
