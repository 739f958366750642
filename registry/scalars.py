"""Time axis, recoding, plausibility, text and scalar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import EVENTS_SQL, SIGNALS_SQL, events, load, orders, query, rounded, signals
from wardline.functions import recode
from wardline.functions.scalars import (
    constant_for_null,
    flag,
    half_even,
    inv_logit,
    logit,
    ratio,
    to_int,
    truthy,
)
from wardline.functions.timeaxis import between, minutes_from_ms
from wardline.operators.joins import keyed_join


@query(
    "minute_axis",
    f"""
WITH e AS ({EVENTS_SQL}), f AS (SELECT user_id, min(minute) AS first FROM e GROUP BY 1)
SELECT event_id, minute, minute - first AS from_first, CAST(hour(ts) AS INTEGER) AS hour
FROM e JOIN f USING (user_id)
""",
)
def minute_axis(spark, folder):
    ev = events(spark, folder)
    first = ev.groupBy("user_id").agg(F.min("minute").alias("first"))
    return keyed_join(ev, first, "user_id", "inner", ["event_id"]).select(
        "event_id", "minute", (F.col("minute") - F.col("first")).alias("from_first"), F.hour("ts").alias("hour")
    )


@query(
    "epoch_minutes",
    """
WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms FROM events),
     a AS (SELECT user_id, min(ms) AS admitted FROM e WHERE event_type = 'signup' GROUP BY 1)
SELECT event_id, round((ms - admitted) / 60000.0, 6) AS chartminute
FROM e JOIN a USING (user_id)
WHERE ms - admitted <= 144 * 3600000 AND ms - admitted >= -48 * 3600000
""",
)
def epoch_minutes(spark, folder):
    ts = F.col("ts")
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    second = F.floor(F.expr("extract(SECOND FROM ts)") * 1000).cast("long")
    ms = day * 86_400_000 + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000 + second
    ev = load(spark, folder, "events").select("event_id", "user_id", "event_type", ms.alias("ms"))
    admitted = ev.filter("event_type = 'signup'").groupBy("user_id").agg(F.min("ms").alias("admitted"))
    minute = minutes_from_ms("ms", "admitted")
    joined = keyed_join(ev, admitted, "user_id", "inner", ["event_id"])
    return joined.filter(between(minute, from_=-48 * 60, to=144 * 60)).select(
        "event_id", F.round(minute, 6).alias("chartminute")
    )


PRIORITY = [
    (3, {"p_type": ["PROMO"], "p_brand": ["Brand#7", "Brand#21"]}),
    (2, {"p_type": ["ECONOMY", "SMALL"], "p_brand": ["Brand#1"]}),
    (1, {"p_type": ["STANDARD"]}),
    (0, {"p_brand": ["Brand#2", "Brand#3", "Brand#5"]}),
]


@query(
    "recode_priority",
    """
SELECT p_partkey,
  CASE WHEN p_type IN ('PROMO') OR p_brand IN ('Brand#7', 'Brand#21') THEN 3
       WHEN p_type IN ('ECONOMY', 'SMALL') OR p_brand IN ('Brand#1') THEN 2
       WHEN p_type = 'STANDARD' THEN 1
       WHEN p_brand IN ('Brand#2', 'Brand#3', 'Brand#5') THEN 0 END AS category
FROM part
""",
)
def recode_priority(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey", recode.first_match(PRIORITY).alias("category")
    )


@query(
    "recode_override",
    r"""
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 16
                      ELSE CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) END AS valueid
FROM events
""",
)
def recode_override(spark, folder):
    charted = F.regexp_extract("props", r"(\d+)", 1).try_cast("int")
    return load(spark, folder, "events").select(
        "event_id",
        recode.override(F.col("event_type"), ["error", "signup"], 16, charted).alias("valueid"),
    )


CONCEPTS = [
    recode.Concept("view", "spo2", low=0, high=100, high_closed=True),
    recode.Concept("click", "temperature", low=70, high=120, scale=1 / 1.8, offset=-32 / 1.8),
    recode.Concept("error", "po2", low=0, scale=7.50061683),
    recode.Concept("purchase", "heart_rate", low=0, high=300),
]


@query(
    "concept_map",
    """
SELECT event_id,
  CASE event_type WHEN 'view' THEN 'spo2' WHEN 'click' THEN 'temperature'
                  WHEN 'error' THEN 'po2' WHEN 'purchase' THEN 'heart_rate' END AS variable,
  round(CASE event_type WHEN 'click' THEN (value - 32) / 1.8 WHEN 'error' THEN value * 7.50061683
                        ELSE value END, 6) AS value
FROM events
WHERE (event_type = 'view' AND value > 0 AND value <= 100) OR (event_type = 'click' AND value > 70 AND value < 120)
   OR (event_type = 'error' AND value > 0) OR (event_type = 'purchase' AND value > 0 AND value < 300)
""",
)
def concept_map(spark, folder):
    ev = load(spark, folder, "events").select("event_id", "event_type", "value")
    return rounded(
        recode.map_concepts(ev, CONCEPTS, "event_type", "value").drop("event_type"), "value"
    )


SIGNS = [
    recode.Concept("F", "wob", text=t, constant=v)
    for t, v in [("1-URGENT", 1), ("2-HIGH", 1), ("5-LOW", 0)]
] + [
    recode.Concept("P", "wob", text=t, constant=v) for t, v in [("1-URGENT", 1), ("3-MEDIUM", 0)]
]


@query(
    "sign_map",
    """
SELECT o_orderkey, 'wob' AS variable,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS value
FROM orders
WHERE (o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW'))
   OR (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM'))
""",
)
def sign_map(spark, folder):
    od = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    mapped = recode.map_concepts(od, SIGNS, "o_orderstatus", "o_totalprice", text="o_orderpriority")
    return mapped.select("o_orderkey", "variable", "value")


@query(
    "proxy_estimate",
    """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
  round(CASE WHEN l_discount >= 0.20 AND l_discount <= 1 THEN l_discount * 100
             WHEN l_quantity >= 20 AND l_quantity <= 100 AND l_linestatus = 'O' THEN l_quantity END, 6) AS charted,
  round(CASE WHEN l_returnflag IN ('A', 'R') AND l_quantity > 25 AND l_quantity <= 100 THEN l_quantity
             WHEN l_returnflag IN ('A', 'R') AND 21 + l_quantity * 3 <= 100 THEN 21 + l_quantity * 3 END, 6) AS percent,
  round(CASE WHEN l_linenumber IN (1, 2, 3, 4) AND 0.21 + (l_quantity - 5) * 0.03 < 0.21 THEN 0.21
             WHEN l_linenumber IN (1, 3, 4) AND 0.21 + (l_quantity - 5) * 0.03 > 1 THEN 1
             WHEN l_linenumber IN (1, 3, 4) THEN 0.21 + (l_quantity - 5) * 0.03
             WHEN l_linenumber = 5 THEN 0.21 END, 6) AS fraction
FROM lineitem
""",
)
def proxy_estimate(spark, folder):
    flow, device = F.col("l_quantity"), F.col("l_returnflag")
    charted = F.coalesce(
        F.when(F.col("l_discount") >= 0.20, recode.charted_percent(F.col("l_discount"))),
        F.when((F.col("l_linestatus") == "O") & (flow >= 20), recode.charted_percent(flow)),
    )
    return rounded(
        load(spark, folder, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_quantity",
            "l_returnflag",
            charted.alias("charted"),
            recode.percent_from_flow(flow, device, ["A", "R"]).alias("percent"),
            recode.fraction_from_flow(
                flow - 5, F.col("l_linenumber"), [1, 2, 3, 4], [1, 3, 4], [5]
            ).alias("fraction"),
        ),
        "charted",
        "percent",
        "fraction",
    )


LIMITS = {"view": (10, 200), "click": (1, None), "error": (None, 150), "purchase": (5, 100)}


@query(
    "range_clean",
    """
SELECT event_id, event_type,
  round(CASE WHEN event_type = 'signup' AND value >= 0.21 AND value <= 1 THEN value * 100 ELSE value END, 6) AS value
FROM events
WHERE NOT (event_type = 'view' AND (value < 10 OR value > 200)) AND NOT (event_type = 'click' AND value < 1)
  AND NOT (event_type = 'error' AND value > 150) AND NOT (event_type = 'purchase' AND (value < 5 OR value > 100))
""",
)
def range_clean(spark, folder):
    ev = load(spark, folder, "events").select("event_id", "event_type", "value")
    percent = F.when(
        F.col("event_type") == "signup", recode.fraction_to_percent(F.col("value"), 0.21)
    ).otherwise(F.col("value"))
    cleaned = recode.drop_out_of_range(ev, LIMITS, "event_type", "value")
    return rounded(cleaned.withColumn("value", percent), "value")


@query(
    "provenance_flags",
    """
SELECT d.doc_id, CASE WHEN lower(source) NOT LIKE '%src1%' THEN 1 ELSE 0 END AS by_hand,
       CASE WHEN l.quality IS NOT NULL THEN 1 ELSE 0 END AS validated,
       CASE WHEN lang ILIKE 'E%' OR lang IS NULL THEN 1 ELSE 0 END AS specimen
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL OR l.toxic IS NOT NULL OR d.source IS NOT NULL
""",
)
def provenance_flags(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "lang", "source")
    joined = docs.join(load(spark, folder, "labels"), "doc_id", "left")
    present = recode.any_present(F.col("quality"), F.col("toxic"), F.col("source"))
    return joined.filter(present).select(
        "doc_id",
        flag(recode.entered_by_hand(F.col("source"), "%src1%")).alias("by_hand"),
        flag(F.col("quality").isNotNull()).alias("validated"),
        flag(recode.arterial_or_unknown(F.col("lang"), "E%")).alias("specimen"),
    )


TEXT_CLASSES = [
    ("contact", ["http", "@", "www."]),
    ("rights", ["copyright", "license", "all rights reserved"]),
    ("english", ["the ", "and "]),
    ("german", ["der ", "und ", "die "]),
    ("romance", ["les ", "que "]),
]


@query(
    "text_class",
    """
SELECT doc_id, n_chars,
  CASE WHEN t LIKE '%http%' OR t LIKE '%@%' OR t LIKE '%www.%' THEN 'contact'
       WHEN t LIKE '%copyright%' OR t LIKE '%license%' OR t LIKE '%all rights reserved%' THEN 'rights'
       WHEN t LIKE '%the %' OR t LIKE '%and %' THEN 'english'
       WHEN t LIKE '%der %' OR t LIKE '%und %' OR t LIKE '%die %' THEN 'german'
       WHEN t LIKE '%les %' OR t LIKE '%que %' THEN 'romance' END AS class
FROM (SELECT doc_id, n_chars, lower(text) AS t FROM documents)
""",
)
def classified_text(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "n_chars", "text")
    return recode.text_class(docs, "text", TEXT_CLASSES, "class").drop("text")


@query(
    "diagnosis_flags",
    """
SELECT conv_id, turn,
  CASE WHEN role = 'user' AND lower(text) LIKE '%the%' THEN 1
       WHEN role = 'assistant' AND lower(text) LIKE 'the%' THEN 1 ELSE 0 END AS operative,
  CASE WHEN role = 'system' AND lower(text) LIKE '%you%' THEN 1 ELSE 0 END AS sepsis
FROM conversations
""",
)
def diagnosis_flags(spark, folder):
    role, text = F.col("role"), F.col("text")
    return load(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        recode.diagnosis_flag(role, text, {"user": "%the%", "assistant": "the%"}).alias("operative"),
        recode.diagnosis_flag(role, text, {"system": "%you%"}).alias("sepsis"),
    )


@query(
    "obs_window",
    f"""
WITH e AS ({EVENTS_SQL}), i AS (SELECT user_id, min(minute) AS index_time FROM e WHERE event_type = 'purchase' GROUP BY 1)
SELECT event_id, minute - index_time AS time FROM e JOIN i USING (user_id)
WHERE minute > -48 * 60 AND minute - index_time < 120 * 60 AND minute - index_time > -12 * 60
""",
)
def obs_window(spark, folder):
    ev = events(spark, folder)
    index = ev.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("minute").alias("index_time"))
    time = F.col("minute") - F.col("index_time")
    # The entity-side bound does not need the index, so it reaches the scan.
    early = ev.filter(between(F.col("minute"), after=-48 * 60))
    return (
        keyed_join(early, index, "user_id", "inner", ["event_id"])
        .filter(between(time, after=-12 * 60, before=120 * 60))
        .select("event_id", time.alias("time"))
    )


SIZE_BREAKS = [1, 10, 20, 30, 40, 50]
SIZE_LABELS = ["1-9", "10-19", "20-29", "30-39", "40-49"]


@query(
    "bin_numeric",
    """
SELECT p_partkey,
  CASE WHEN p_size >= 1 AND p_size < 10 THEN '1-9' WHEN p_size >= 10 AND p_size < 20 THEN '10-19'
       WHEN p_size >= 20 AND p_size < 30 THEN '20-29' WHEN p_size >= 30 AND p_size < 40 THEN '30-39'
       WHEN p_size >= 40 AND p_size < 50 THEN '40-49' END AS size_group,
  CASE WHEN p_size >= 1 AND p_size < 10 THEN 1 WHEN p_size >= 10 AND p_size < 20 THEN 2
       WHEN p_size >= 20 AND p_size < 30 THEN 3 WHEN p_size >= 30 AND p_size < 40 THEN 4
       WHEN p_size >= 40 AND p_size < 50 THEN 5 END AS size_rank
FROM part
""",
)
def bin_numeric(spark, folder):
    size = F.col("p_size")
    return load(spark, folder, "part").select(
        "p_partkey",
        recode.bin_left_closed(size, SIZE_BREAKS, SIZE_LABELS).alias("size_group"),
        recode.bin_ordinal(size, SIZE_BREAKS).alias("size_rank"),
    )


@query(
    "collapse_category",
    """
SELECT c_custkey AS entity, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Industrial'
                                 WHEN c_mktsegment IN ('AUTOMOBILE') THEN 'Vehicles' ELSE 'Home' END AS sector
FROM customer
""",
)
def collapse_category(spark, folder):
    groups = {"Industrial": ["BUILDING", "MACHINERY"], "Vehicles": ["AUTOMOBILE"]}
    sector = recode.collapse_category(F.col("c_mktsegment"), groups, "Home")
    return (
        load(spark, folder, "customer")
        .withColumn("sector", sector)
        .withColumnRenamed("c_custkey", "entity")
        .drop("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    )


@query(
    "null_safe_rule",
    f"""
SELECT user_id, minute,
  CASE WHEN sat < 40 AND oxy > 20 THEN 1 ELSE 0 END AS met,
  CAST(sat < 40 OR vent = 1 AS INTEGER) AS three_valued,
  round(CASE WHEN oxy = 0 THEN NULL ELSE sat / oxy END, 6) AS ratio
FROM ({SIGNALS_SQL})
""",
)
def null_safe_rule(spark, folder):
    rule = truthy((F.col("sat") < 40) & (F.col("oxy") > 20))
    return rounded(
        signals(spark, folder).select(
            "user_id",
            "minute",
            to_int(rule).alias("met"),
            to_int((F.col("sat") < 40) | (F.col("vent") == 1)).alias("three_valued"),
            ratio(F.col("sat"), F.col("oxy")).alias("ratio"),
        ),
        "ratio",
    )


@query(
    "fill_constant",
    "SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def fill_constant(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id")
    return docs.join(load(spark, folder, "labels"), "doc_id", "left").select(
        "doc_id",
        constant_for_null(F.col("quality"), 0).alias("quality"),
        constant_for_null(F.col("toxic"), 0).alias("toxic"),
    )


@query(
    "scalar_functions",
    r"""
SELECT c_custkey, CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) AS parsed,
  'id_' || c_custkey || '.out' AS file_name,
  CASE WHEN regexp_matches(c_mktsegment, 'BUILD|MACH') THEN 1 ELSE 0 END AS listed,
  round(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 6) AS logged,
  round(exp(c_acctbal / 10000), 6) AS expd,
  round(CASE WHEN c_acctbal / 10000 > 0 AND c_acctbal / 10000 < 1
             THEN ln((c_acctbal / 10000) / (1 - c_acctbal / 10000)) END, 6) AS log_odds,
  round(1 / (1 + exp(-c_acctbal / 10000)), 6) AS inv,
  round_even(c_acctbal / 2, 0) AS halves,
  least(c_acctbal, CASE WHEN c_custkey < 500 THEN 100.0 END, 5000.0) AS smallest
FROM customer
""",
)
def scalar_functions(spark, folder):
    bal = F.col("c_acctbal")
    share = bal / 10000
    return rounded(
        load(spark, folder, "customer").select(
            "c_custkey",
            F.regexp_replace("c_name", "[^0-9]", "").try_cast("bigint").alias("parsed"),
            F.concat(F.lit("id_"), F.col("c_custkey").cast("string"), F.lit(".out")).alias("file_name"),
            flag(F.col("c_mktsegment").rlike("BUILD|MACH")).alias("listed"),
            F.ln(bal).alias("logged"),
            F.exp(share).alias("expd"),
            logit(share).alias("log_odds"),
            inv_logit(share).alias("inv"),
            half_even(bal / 2).alias("halves"),
            F.least(bal, F.when(F.col("c_custkey") < 500, F.lit(100.0)), F.lit(5000.0)).alias("smallest"),
        ),
        "logged",
        "expd",
        "log_odds",
        "inv",
    )


@query(
    "time_limited_flags",
    """
WITH o AS (SELECT o_custkey, o_orderstatus, CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS INTEGER) AS day FROM orders),
     p AS (SELECT o_custkey, min(CASE WHEN o_orderstatus = 'F' THEN day END) AS imv_time,
                  min(CASE WHEN o_orderstatus = 'P' THEN day END) AS death_time, max(day) AS dischargedat FROM o GROUP BY 1)
SELECT o_custkey, CASE WHEN imv_time < 120 THEN 1 ELSE 0 END AS imv,
  CASE WHEN death_time < 28 THEN 1 ELSE 0 END AS death28,
  CASE WHEN death_time < 120 AND imv_time IS NULL THEN 1 ELSE 0 END AS death_obs,
  CASE WHEN NOT coalesce(imv_time < 120, FALSE) AND coalesce(dischargedat < 2200, FALSE) THEN 1 ELSE 0 END AS icu_dc
FROM p
""",
)
def time_limited_flags(spark, folder):
    status, day = F.col("o_orderstatus"), F.col("day")
    per = (
        orders(spark, folder)
        .groupBy("o_custkey")
        .agg(
            F.min(F.when(status == "F", day)).alias("imv_time"),
            F.min(F.when(status == "P", day)).alias("death_time"),
            F.max(day).alias("dischargedat"),
        )
    )
    imv = truthy(F.col("imv_time") < 120)
    return per.select(
        "o_custkey",
        flag(imv).alias("imv"),
        flag(F.col("death_time") < 28).alias("death28"),
        flag((F.col("death_time") < 120) & F.col("imv_time").isNull()).alias("death_obs"),
        flag(~imv & truthy(F.col("dischargedat") < 2200)).alias("icu_dc"),
    )
