"""Grouped aggregates, audits and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CONTINUOUS,
    DAY,
    DEVICE_SQL,
    EVENTS_SQL,
    ORDERS_SQL,
    SIGNALS_SQL,
    VITALS,
    VITALS_SQL,
    device_long,
    events,
    grid_sql,
    load,
    orders,
    query,
    rounded,
    signals,
    vitals_long,
)
from wardline.operators import summary
from wardline.operators.joins import exclude, keyed_join
from wardline.operators.longtable import (
    collapse,
    composite_score,
    dedupe_max,
    dedupe_mixed,
    first_event_time,
)
from wardline.operators.pick import (
    best_row,
    code_set_flags,
    ever_flags,
    first_of_subject,
    latest_at_index,
    repeated,
)
from wardline.operators.quantiles import exact_quantiles
from wardline.operators.reshape import to_grid
from wardline.operators.transform import mean_sd
from wardline.sources.tables import materialise


@query(
    "guarded_average",
    """
SELECT l_suppkey, l_returnflag, round(avg(CASE WHEN l_quantity <= 40 AND l_quantity >= 5 THEN l_quantity END), 6) AS quantity,
       round(avg(l_extendedprice), 6) AS price
FROM lineitem GROUP BY 1, 2
""",
)
def guarded_average(spark, folder):
    q = F.col("l_quantity")
    df = load(spark, folder, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.avg(F.when((q <= 40) & (q >= 5), q)).alias("quantity"), F.avg("l_extendedprice").alias("price")
    )
    return rounded(df, "quantity", "price")


@query(
    "ever_flags",
    f"""
SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS death_obs,
  max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent,
  min(CASE WHEN o_orderstatus = 'F' THEN day END) AS death_obs_time, max(o_orderstatus) AS any_status
FROM ({ORDERS_SQL}) GROUP BY 1
""",
)
def ever_flag_columns(spark, folder):
    od = orders(spark, folder)
    flags = ever_flags(
        od,
        ["o_custkey"],
        {"death_obs": F.col("o_orderstatus") == "F", "urgent": F.col("o_orderpriority") == "1-URGENT"},
    )
    times = collapse(
        od,
        ["o_custkey"],
        {
            "death_obs_time": F.min(F.when(F.col("o_orderstatus") == "F", F.col("day"))),
            "any_status": F.max("o_orderstatus"),
        },
    )
    return flags.join(times, "o_custkey")


CODE_SETS = {
    "diabetes": ["Brand#1", "Brand#4", "Brand#11"],
    "ckd": ["Brand#7", "Brand#8"],
    "obesity": ["Brand#9", "Brand#2%"],
}


@query(
    "code_set_flags",
    """
SELECT l_orderkey, max(CASE WHEN p_brand IN ('Brand#1', 'Brand#4', 'Brand#11') THEN 1 ELSE 0 END) AS diabetes,
  max(CASE WHEN p_brand IN ('Brand#7', 'Brand#8') THEN 1 ELSE 0 END) AS ckd,
  max(CASE WHEN p_brand IN ('Brand#9', 'Brand#2%') THEN 1 ELSE 0 END) AS obesity,
  max(CASE WHEN p_brand LIKE 'Brand#2%' THEN 1 ELSE 0 END) AS family
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""",
)
def code_sets(spark, folder):
    li = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    codes = keyed_join(
        li,
        load(spark, folder, "part").select("p_partkey", "p_brand"),
        "p_partkey",
        "inner",
        ["l_orderkey", "l_linenumber"],
    )
    return code_set_flags(codes, ["l_orderkey"], "p_brand", CODE_SETS, {"family": ["Brand#2"]})


INDEX_MINUTE = 14 * DAY


@query(
    "latest_at_index",
    f"""
SELECT user_id, {", ".join(f"arg_max(value, time) FILTER (WHERE variable = '{v}') AS {v}_bl" for v in VITALS)}
FROM ({VITALS_SQL}) WHERE time <= {INDEX_MINUTE} GROUP BY 1
""",
)
def latest_values(spark, folder):
    return latest_at_index(vitals_long(spark, folder), "user_id", VITALS, at=INDEX_MINUTE)


@query(
    "best_row",
    """
SELECT o_custkey, o_orderpriority AS priority_bl, o_totalprice AS price_bl FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END DESC,
                               o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1
""",
)
def best_rows(spark, folder):
    od = load(spark, folder, "orders")
    order = [
        -F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        F.col("o_orderdate"),
        F.col("o_orderkey"),
    ]
    return best_row(od, ["o_custkey"], order, ["o_orderpriority", "o_totalprice"]).select(
        "o_custkey",
        F.col("o_orderpriority").alias("priority_bl"),
        F.col("o_totalprice").alias("price_bl"),
    )


@query(
    "dedupe_max",
    "SELECT l_suppkey AS entity, l_shipdate AS time, l_returnflag AS variable, max(l_quantity) AS value "
    "FROM lineitem GROUP BY 1, 2, 3",
)
def dedupe_by_max(spark, folder):
    long = load(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.col("l_shipdate").alias("time"),
        F.col("l_returnflag").alias("variable"),
        F.col("l_quantity").alias("value"),
    )
    return dedupe_max(long, ["entity", "time", "variable"])


@query(
    "dedupe_mixed",
    """
SELECT l_suppkey AS entity, l_shipdate AS time, l_returnflag AS variable,
  round(CASE WHEN l_returnflag IN ('A', 'R') THEN avg(l_quantity) ELSE max(l_quantity) END, 6) AS value
FROM lineitem GROUP BY 1, 2, 3
""",
)
def dedupe_by_kind(spark, folder):
    long = load(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.col("l_shipdate").alias("time"),
        F.col("l_returnflag").alias("variable"),
        F.col("l_quantity").alias("value"),
    )
    return rounded(dedupe_mixed(long, ["entity", "time", "variable"], ["A", "R"]), "value")


@query(
    "composite_score",
    """
SELECT l_suppkey AS entity, l_shipdate AS time, 'GCS' AS variable, sum(value) AS value
FROM (SELECT l_suppkey, l_shipdate, l_returnflag, max(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3)
GROUP BY 1, 2 HAVING count(*) = 3
""",
)
def composite(spark, folder):
    return composite_score(
        dedupe_by_max(spark, folder), ["entity", "time"], ["A", "N", "R"], "GCS"
    )


@query(
    "mean_sd",
    "SELECT event_type AS variable, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd "
    "FROM events WHERE event_type <> 'signup' GROUP BY 1",
)
def means(spark, folder):
    long = load(spark, folder, "events").withColumnRenamed("event_type", "variable")
    return rounded(mean_sd(long, ["click", "error", "purchase", "view"]), "mean", "sd")


@query(
    "kind_counts",
    f"""
SELECT user_id, count(*) AS n_all, count(*) FILTER (WHERE variable IN ({", ".join(f"'{v}'" for v in CONTINUOUS)})) AS n_continuous,
  count(*) FILTER (WHERE variable NOT IN ({", ".join(f"'{v}'" for v in CONTINUOUS)})) AS n_binary
FROM ({VITALS_SQL}) GROUP BY 1
""",
)
def counts_by_kind(spark, folder):
    return summary.kind_counts(vitals_long(spark, folder), "user_id", CONTINUOUS)


def _long_grid_sql():
    cells = " UNION ALL ".join(f"SELECT '{v}' AS variable, {v} AS value FROM g" for v in VITALS)
    return f"WITH g AS MATERIALIZED ({grid_sql()}), c AS ({cells})"


@query(
    "missingness",
    f"""
{_long_grid_sql()}
SELECT variable, count(*) FILTER (WHERE value IS NULL) AS missing,
  round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_share, count(value) AS present
FROM c GROUP BY 1
""",
)
def missing_table(spark, folder):
    grid = to_grid(vitals_long(spark, folder), ["user_id", "time"], VITALS)
    return rounded(summary.missingness(grid, VITALS), "missing_share")


@query(
    "gap_between_obs",
    f"""
WITH v AS MATERIALIZED ({VITALS_SQL}), l AS (SELECT user_id, max(time) + 1 AS lastobs FROM v GROUP BY 1),
     c AS (SELECT user_id, variable, count(*) AS n FROM v GROUP BY 1, 2)
SELECT variable, round(avg(lastobs) / avg(n), 6) AS gap FROM c JOIN l USING (user_id) GROUP BY 1
""",
)
def gaps(spark, folder):
    return rounded(
        summary.gap_between_observations(vitals_long(spark, folder), "user_id", VITALS), "gap"
    )


@query(
    "last_observed",
    f"SELECT user_id, max(minute) AS lastobs FROM ({EVENTS_SQL}) GROUP BY 1",
)
def last_observed(spark, folder):
    return collapse(events(spark, folder), ["user_id"], {"lastobs": F.max("minute")})


@query(
    "first_event",
    f"SELECT user_id, min(time) AS imv_time FROM ({DEVICE_SQL}) WHERE variable = 'o2_device' AND value = 6 GROUP BY 1",
)
def first_event(spark, folder):
    return first_event_time(device_long(spark, folder), "user_id", "o2_device", 6, out="imv_time")


@query(
    "ever_share",
    f"""
SELECT variable, sum(m) AS ever, round(avg(m), 6) AS share, count(*) AS measured FROM (
  SELECT user_id, variable, max(value) AS m FROM ({VITALS_SQL}) WHERE variable IN ('niv', 'hfnc', 'stdo2') GROUP BY 1, 2)
GROUP BY 1
""",
)
def shares(spark, folder):
    return rounded(
        summary.ever_share(vitals_long(spark, folder), "user_id", ["niv", "hfnc", "stdo2"]), "share"
    )


@query(
    "attrition",
    """
WITH s AS (SELECT *, coalesce(quality, 1) = 1 AS ok FROM documents LEFT JOIN labels USING (doc_id)),
 n AS (SELECT count(*) AS c0, count(*) FILTER (WHERE ok) AS c1,
   count(*) FILTER (WHERE ok AND toxic = 0) AS c2, count(*) FILTER (WHERE ok AND toxic = 0 AND lang = 'en') AS c3,
   count(*) FILTER (WHERE ok AND toxic = 0 AND lang = 'en' AND n_chars >= 200) AS c4 FROM s)
SELECT 0 AS step_no, 'all' AS step, c0 AS remaining, CAST(0 AS BIGINT) AS removed FROM n
UNION ALL SELECT 1, 'quality', c1, c0 - c1 FROM n UNION ALL SELECT 2, 'not toxic', c2, c1 - c2 FROM n
UNION ALL SELECT 3, 'english', c3, c2 - c3 FROM n UNION ALL SELECT 4, 'long enough', c4, c3 - c4 FROM n
""",
)
def attrition_counts(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return summary.attrition(
        docs.join(load(spark, folder, "labels"), "doc_id", "left"),
        [
            ("quality", F.coalesce(F.col("quality"), F.lit(1)) == 1),
            ("not toxic", F.col("toxic") == 0),
            ("english", F.col("lang") == "en"),
            ("long enough", F.col("n_chars") >= 200),
        ],
    )


@query(
    "table_one",
    """
WITH p AS (SELECT o.*, c_mktsegment, r_name FROM orders o JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 s AS (SELECT c_mktsegment AS stratum, * FROM p UNION ALL SELECT 'Overall', * FROM p),
 z AS (SELECT stratum, count(*) AS size FROM s GROUP BY 1),
 f AS (SELECT stratum, 'o_orderpriority' AS variable, o_orderpriority AS level FROM s
       UNION ALL SELECT stratum, 'o_orderstatus', o_orderstatus FROM s UNION ALL SELECT stratum, 'r_name', r_name FROM s),
 v AS (SELECT stratum, 'o_totalprice' AS variable, o_totalprice AS value FROM s)
SELECT stratum, variable, level, n, round(n / size, 6) AS share, median, q1, q3 FROM (
  SELECT stratum, variable, level, count(*) AS n, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS q1,
         CAST(NULL AS DOUBLE) AS q3 FROM f GROUP BY 1, 2, 3
  UNION ALL
  SELECT stratum, variable, NULL, count(*), round(quantile_cont(value, 0.5), 6), round(quantile_cont(value, 0.25), 6),
         round(quantile_cont(value, 0.75), 6) FROM v GROUP BY 1, 2) JOIN z USING (stratum)
""",
)
def table_one(spark, folder):
    od = load(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    cu = load(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    na = load(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    re = load(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    people = keyed_join(od, cu, "c_custkey", "inner", ["o_orderkey"])
    people = keyed_join(people, na, "c_nationkey", "inner", ["o_orderkey"])
    people = keyed_join(people, re, "n_regionkey", "inner", ["o_orderkey"])
    # Counts, sizes, sketch and ranks each pass over the people: write them once.
    people = materialise(
        people.select("c_mktsegment", "o_orderpriority", "o_orderstatus", "r_name", "o_totalprice"), "people"
    )
    return rounded(
        summary.stratified_summary(
            people, "c_mktsegment", ["o_orderpriority", "o_orderstatus", "r_name"], ["o_totalprice"]
        ),
        "share",
        "median",
        "q1",
        "q3",
    )


@query(
    "exact_quantiles",
    """
SELECT l_returnflag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
FROM lineitem GROUP BY 1
""",
)
def quantiles(spark, folder):
    df = load(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    q = exact_quantiles(df, ["l_returnflag"], "l_extendedprice", [0.01, 0.5, 0.99])
    return rounded(
        q.select(
            "l_returnflag",
            "n",
            F.col("q")[0].alias("p01"),
            F.col("q")[1].alias("p50"),
            F.col("q")[2].alias("p99"),
        ),
        "p01",
        "p50",
        "p99",
    )


@query(
    "zero_fill_counts",
    """
SELECT n_nationkey, coalesce(entities, 0) AS entities FROM nation LEFT JOIN (
  SELECT s_nationkey, count(DISTINCT s_suppkey) AS entities FROM supplier GROUP BY 1)
ON n_nationkey = s_nationkey
""",
)
def zero_filled(spark, folder):
    su = load(spark, folder, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return summary.entities_per_category(su, load(spark, folder, "nation"), "n_nationkey", "s_suppkey")


@query(
    "exclude_by_category",
    "SELECT event_id, user_id FROM events WHERE user_id NOT IN "
    "(SELECT user_id FROM events WHERE event_type = 'error' AND value > 180)",
)
def exclude_by_category(spark, folder):
    ev = load(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    marked = ev.filter("event_type = 'error' AND value > 180")
    return exclude(ev, marked, "user_id", ["event_id"]).select("event_id", "user_id")


@query(
    "duplicate_audit",
    "SELECT l_suppkey, l_shipdate, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1",
)
def duplicates(spark, folder):
    return repeated(load(spark, folder, "lineitem"), ["l_suppkey", "l_shipdate", "l_returnflag"])


@query(
    "distinct_counts",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers "
    "FROM lineitem GROUP BY 1",
)
def distinct_counts(spark, folder):
    return load(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query(
    "range_audit",
    "SELECT event_type AS variable, min(value) AS low, max(value) AS high FROM events GROUP BY 1",
)
def ranges(spark, folder):
    return summary.range_audit(
        load(spark, folder, "events").withColumnRenamed("event_type", "variable")
    )


@query(
    "first_per_subject",
    "SELECT o_orderkey, o_custkey FROM orders o JOIN (SELECT o_custkey AS c, min(o_orderdate) AS d FROM orders GROUP BY 1) "
    "ON o_custkey = c AND o_orderdate = d",
)
def first_per_subject(spark, folder):
    od = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return first_of_subject(od, "o_custkey", "o_orderdate", ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query(
    "multi_admission_audit",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1",
)
def multi_admissions(spark, folder):
    return repeated(load(spark, folder, "orders"), ["o_custkey"])


@query(
    "worst_goal",
    f"SELECT user_id, max(CAST(floor(value / 50) AS BIGINT)) AS goc FROM ({EVENTS_SQL}) "
    "WHERE event_type = 'purchase' AND minute < 8640 GROUP BY 1",
)
def worst_goal(spark, folder):
    early = events(spark, folder).filter("event_type = 'purchase' AND minute < 8640")
    return collapse(early, ["user_id"], {"goc": F.max(F.floor(F.col("value") / 50))})


@query(
    "eligibility_rollup",
    f"""
SELECT user_id, min(minute) AS eligibility_time, max(vent) AS imv_ever, min(CASE WHEN vent = 1 THEN minute END) AS imv_time,
  min(CASE WHEN "limit" = 1 THEN 0 ELSE 1 END) AS goc_eligible, max(sat) AS best, count(*) AS moments
FROM ({SIGNALS_SQL}) GROUP BY 1
""",
)
def eligibility_rollup(spark, folder):
    return collapse(
        signals(spark, folder),
        ["user_id"],
        {
            "eligibility_time": F.min("minute"),
            "imv_ever": F.max("vent"),
            "imv_time": F.min(F.when(F.col("vent") == 1, F.col("minute"))),
            "goc_eligible": F.min(F.when(F.col("limit") == 1, 0).otherwise(1)),
            "best": F.max("sat"),
            "moments": F.count(F.lit(1)),
        },
    )
