"""Spine, joins, as-of joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import DAY, EVENTS_SQL, ORDERS_SQL, events, load, orders, query, rounded
from wardline.functions.scalars import flag
from wardline.operators.joins import (
    asof_join,
    exclude,
    exclude_listed,
    join_where,
    keyed_join,
    nearest_in_window,
    restrict,
)
from wardline.operators.longtable import route, stack_long, to_long, union_distinct, union_long
from wardline.operators.reshape import to_grid
from wardline.operators.spine import align, prefer_mean, product_mean, spine, sum_and_count
from wardline.sources.tables import materialise


def written(timeline):
    return materialise(timeline, "timeline")


def _observed(spark, folder):
    """Events with their day: device settings, a flow, vital signs, charted values and procedures in one table."""
    return events(spark, folder).withColumn("day", F.floor(F.col("minute") / DAY))


@query(
    "spine_union",
    f"""
WITH e AS (SELECT *, minute // {DAY} AS day FROM ({EVENTS_SQL}))
SELECT user_id, day FROM e WHERE event_type = 'signup' UNION SELECT user_id, day FROM e WHERE event_type = 'click'
UNION SELECT user_id, day FROM e WHERE event_type = 'view' UNION SELECT user_id, day FROM e WHERE event_type = 'error'
UNION SELECT o_custkey, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) FROM orders
""",
)
def spine_union(spark, folder):
    od = orders(spark, folder).select(F.col("o_custkey").alias("user_id"), F.col("day").cast("long"))
    seen = _observed(spark, folder).filter(F.col("event_type").isin("signup", "click", "view", "error"))
    return spine([seen, od], ["user_id", "day"])


@query(
    "spine_align",
    f"""
WITH e AS (SELECT *, minute // {DAY} AS day FROM ({EVENTS_SQL})),
 vs AS (SELECT user_id, day, value AS mode FROM e WHERE event_type = 'signup'),
 od AS (SELECT user_id, day, value AS flow, CASE WHEN value < 80 THEN value END AS device FROM e WHERE event_type = 'click'),
 vi AS (SELECT user_id, day, value AS spo2 FROM e WHERE event_type = 'view'),
 ce AS (SELECT user_id, day, value AS charted, CASE WHEN value > 30 THEN 1 ELSE 0 END AS item FROM e WHERE event_type = 'error'),
 pe AS (SELECT user_id, day, 1 AS proc FROM e WHERE event_type = 'purchase' AND value > 100),
 tm AS (SELECT user_id, day FROM vs UNION SELECT user_id, day FROM od UNION SELECT user_id, day FROM vi
        UNION SELECT user_id, day FROM ce UNION SELECT user_id, day FROM pe)
SELECT tm.user_id, tm.day,
  max(CASE WHEN pe.proc = 1 OR mode > 120 THEN 6 WHEN mode > 60 OR device > 60 THEN 5 WHEN device > 30 THEN 4
           WHEN device > 10 THEN 1 END) AS o2_device,
  round(avg(CASE WHEN spo2 <= 100 AND spo2 >= 5 THEN spo2 END), 6) AS spo2,
  round(avg(CASE WHEN ce.item = 1 THEN CASE WHEN charted >= 20 AND charted <= 100 THEN charted END
                 WHEN device IS NOT NULL AND 21 + flow * 3 <= 100 THEN 21 + flow * 3 END), 6) AS fio2
FROM tm LEFT JOIN vs USING (user_id, day) LEFT JOIN od USING (user_id, day) LEFT JOIN vi USING (user_id, day)
  LEFT JOIN ce USING (user_id, day) LEFT JOIN pe USING (user_id, day)
WHERE spo2 IS NOT NULL OR mode IS NOT NULL OR device IS NOT NULL OR ce.item = 1 OR pe.proc = 1
GROUP BY 1, 2
""",
)
def spine_align(spark, folder):
    key = ["user_id", "day"]
    kind, v = F.col("event_type"), F.col("value")
    device = F.when(v < 80, v)
    estimate = F.when(device.isNotNull() & (21 + v * 3 <= 100), 21 + v * 3)
    marked = v > 30
    one = F.lit(1)
    rows = route(
        _observed(spark, folder),
        key,
        [
            (kind == "signup", {"code": F.when(v > 120, 6).when(v > 60, 5), "seen": one}),
            (kind == "click", {
                "code": F.when(device > 60, 5).when(device > 30, 4).when(device > 10, 1),
                "seen": F.when(device.isNotNull(), 1), "flow_row": one, "estimate": estimate,
            }),
            (kind == "view", {"spo2": F.when((v <= 100) & (v >= 5), v), "seen": one}),
            (kind == "error", {
                "charted": F.when(marked & (v >= 20) & (v <= 100), v), "marked_row": F.when(marked, 1),
                "unmarked_row": F.when(~marked, 1), "seen": F.when(marked, 1),
            }),
            ((kind == "purchase") & (v > 100), {"code": F.lit(6), "seen": one}),
        ],
    )
    aligned = align(
        [rows],
        key,
        [
            F.max("code").alias("o2_device"),
            F.avg("spo2").alias("spo2"),
            F.max("seen").alias("seen"),
            *sum_and_count("charted", F.col("charted")),
            *sum_and_count("estimate", F.col("estimate")),
            F.count("flow_row").alias("flow_rows"),
            F.count("marked_row").alias("marked_rows"),
            F.count("unmarked_row").alias("unmarked_rows"),
        ],
    )
    fio2 = product_mean("charted", "marked_rows", "estimate", "flow_rows", "unmarked_rows")
    return rounded(
        aligned.filter("seen = 1").select(*key, "o2_device", "spo2", fio2.alias("fio2")), "spo2", "fio2"
    )


@query(
    "spine_prefer_charted",
    f"""
WITH e AS (SELECT *, minute // {DAY} AS day FROM ({EVENTS_SQL}))
SELECT user_id, day,
  round(coalesce(avg(CASE WHEN event_type = 'error' AND value BETWEEN 20 AND 100 THEN value END),
                 avg(CASE WHEN event_type = 'click' AND 21 + value * 3 <= 100 THEN 21 + value * 3 END)), 6) AS fio2
FROM e WHERE event_type IN ('error', 'click') GROUP BY 1, 2
""",
)
def spine_prefer_charted(spark, folder):
    key = ["user_id", "day"]
    kind, v = F.col("event_type"), F.col("value")
    rows = route(
        _observed(spark, folder),
        key,
        [
            (kind == "error", {"charted": F.when(v.between(20, 100), v)}),
            (kind == "click", {"estimate": F.when(21 + v * 3 <= 100, 21 + v * 3)}),
        ],
    )
    columns = sum_and_count("charted", F.col("charted")) + sum_and_count("estimate", F.col("estimate"))
    aligned = align([rows], key, columns)
    return rounded(aligned.select(*key, prefer_mean("charted", "estimate").alias("fio2")), "fio2")


@query(
    "left_join_constant",
    """
SELECT o_orderkey, l_partkey, l_quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber = 1
""",
)
def left_join_constant(spark, folder):
    od = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    li = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    return join_where(od, li, "l_orderkey", F.col("l_linenumber") == 1).select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity"
    )


@query(
    "cotimed_measurements",
    f"""
WITH e AS (SELECT user_id, minute // {DAY} AS day, event_type, max(value) AS value FROM ({EVENTS_SQL}) GROUP BY ALL)
SELECT a.user_id, a.day, round(a.value * 7.50061683, 6) AS po2, round(b.value * 7.50061683, 6) AS pco2, c.value AS ph
FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND a.day = b.day AND b.event_type = 'click'
  LEFT JOIN e c ON a.user_id = c.user_id AND a.day = c.day AND c.event_type = 'view'
WHERE a.event_type = 'error'
""",
)
def cotimed_measurements(spark, folder):
    long = events(spark, folder).select(
        "user_id",
        F.floor(F.col("minute") / DAY).alias("day"),
        F.col("event_type").alias("variable"),
        "value",
    )
    grid = to_grid(long, ["user_id", "day"], ["error", "click", "view"]).filter("error IS NOT NULL")
    return rounded(
        grid.select(
            "user_id",
            "day",
            (F.col("error") * 7.50061683).alias("po2"),
            (F.col("click") * 7.50061683).alias("pco2"),
            F.col("view").alias("ph"),
        ),
        "po2",
        "pco2",
    )


@query(
    "asof_last",
    f"""
WITH o AS ({ORDERS_SQL}),
     r AS (SELECT o_custkey, day AS before_day, max(o_orderpriority) AS service FROM o GROUP BY 1, 2)
SELECT o_orderkey, r.before_day, r.service
FROM o ASOF LEFT JOIN r ON o.o_custkey = r.o_custkey AND o.day > r.before_day
""",
)
def asof_last(spark, folder):
    od = orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderstatus", "day", "o_orderpriority")
    records = od.select(
        "o_custkey",
        F.col("day").alias("before_day"),
        F.col("o_orderpriority").alias("service"),
    )
    return asof_join(
        od, records, ["o_custkey"], "day", "before_day", ["before_day", "service"], 60, strict=True, cut=written
    ).select("o_orderkey", "before_day", "service")


@query(
    "join_equal_instant",
    f"""
WITH e AS (SELECT user_id, minute // {DAY} AS day, event_type, max(value) AS value FROM ({EVENTS_SQL}) GROUP BY ALL)
SELECT a.user_id, a.day, a.value AS admitted, b.value AS unit
FROM e a JOIN e b ON a.user_id = b.user_id AND a.day = b.day AND a.event_type = 'signup' AND b.event_type = 'purchase'
""",
)
def join_equal_instant(spark, folder):
    ev, key = _observed(spark, folder), ["user_id", "day"]
    stays = ev.filter("event_type = 'signup'").groupBy(*key).agg(F.max("value").alias("admitted"))
    moves = ev.filter("event_type = 'purchase'").groupBy(*key).agg(F.max("value").alias("unit"))
    return stays.join(moves, key)


@query(
    "nearest_in_window",
    f"""
WITH e AS ({EVENTS_SQL}),
 l AS (SELECT event_id, user_id, minute FROM e WHERE event_type = 'error'),
 r AS (SELECT user_id, minute AS at, max(value) AS fio2 FROM e WHERE event_type = 'click' GROUP BY 1, 2),
 p AS (SELECT l.event_id, r.fio2, r.at - l.minute AS gap,
         row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r.at - l.minute), r.at) AS priority
       FROM l JOIN r ON l.user_id = r.user_id AND r.at > l.minute - 1440 AND r.at < l.minute + 360)
SELECT l.event_id, p.gap, p.fio2 FROM l LEFT JOIN p ON l.event_id = p.event_id AND p.priority = 1
""",
)
def nearest(spark, folder):
    ev = events(spark, folder)
    left = ev.filter("event_type = 'error'").select("event_id", "user_id", "minute")
    right = ev.filter("event_type = 'click'").select(
        "user_id", F.col("minute").alias("at"), F.col("value").alias("fio2")
    )
    return nearest_in_window(
        left, right, ["user_id"], "minute", "at", ["fio2"], 1440, 360, DAY, cut=written
    ).select("event_id", "gap", "fio2")


@query(
    "star_baseline",
    f"""
WITH o AS ({ORDERS_SQL}),
 dx AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned,
               max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS closed, max(l_quantity) AS largest
        FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, c_mktsegment, n_name, r_name, c_acctbal, dx.returned, dx.closed, dx.largest,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS hosp_death
FROM o LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN dx ON dx.l_orderkey = o.o_orderkey
""",
)
def star_baseline(spark, folder):
    od = orders(spark, folder).select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    cu = load(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    na = load(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    re = load(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    dx = (
        load(spark, folder, "lineitem")
        .withColumnRenamed("l_orderkey", "o_orderkey")
        .groupBy("o_orderkey")
        .agg(
            F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
            F.max(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("closed"),
            F.max("l_quantity").alias("largest"),
        )
    )
    out = keyed_join(od, cu, "c_custkey", "left", ["o_orderkey"])
    out = keyed_join(out, na, "c_nationkey", "left", ["o_orderkey"])
    out = keyed_join(out, re, "n_regionkey", "left", ["o_orderkey"])
    return out.join(dx, "o_orderkey", "left").select(
        "o_orderkey",
        "c_mktsegment",
        "n_name",
        "r_name",
        "c_acctbal",
        "returned",
        "closed",
        "largest",
        flag(F.col("o_orderstatus") == "F").alias("hosp_death"),
    )


@query(
    "right_join_flags",
    """
SELECT d.doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END AS operative, l.quality
FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id
WHERE d.lang = 'en' OR d.lang IN ('de', 'fr') AND d.n_chars >= 400 AND d.n_chars <= 100000
""",
)
def right_join_flags(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    wanted = (F.col("lang") == "en") | (
        F.col("lang").isin("de", "fr") & (F.col("n_chars") >= 400) & (F.col("n_chars") <= 100000)
    )
    return (
        load(spark, folder, "labels")
        .join(docs.filter(wanted), "doc_id", "right")
        .select(
            "doc_id",
            flag((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("operative"),
            "quality",
        )
    )


@query(
    "resume_anti",
    """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_custkey NOT IN (3, 17, 40)
""",
)
def resume_anti(spark, folder):
    done = load(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey")
    )
    todo = exclude_listed(load(spark, folder, "customer").select("c_custkey"), "c_custkey", [3, 17, 40])
    return exclude(todo, done, "c_custkey")


@query(
    "semi_restrict",
    """
SELECT event_id, user_id FROM events
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
  AND user_id NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)
""",
)
def semi_restrict(spark, folder):
    ev = load(spark, folder, "events").select("event_id", "user_id")
    keep = load(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    drop = load(spark, folder, "orders").filter("o_totalprice > 480000")
    kept = restrict(ev, keep.withColumnRenamed("c_custkey", "user_id"), "user_id", ["event_id"])
    return exclude(kept, drop.withColumnRenamed("o_custkey", "user_id"), "user_id", ["event_id"])


@query(
    "union_long",
    f"""
SELECT user_id AS entity, minute AS time, event_type AS variable, value FROM ({EVENTS_SQL})
UNION ALL
SELECT o_custkey, day * 1440, 'price', o_totalprice FROM ({ORDERS_SQL})
UNION ALL
SELECT o_custkey, day * 1440, 'urgent', CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END
FROM ({ORDERS_SQL}) WHERE o_orderpriority <> '5-LOW'
""",
)
def union_all_long(spark, folder):
    ev = events(spark, folder).select(
        F.col("user_id").alias("entity"), F.col("minute").alias("time"), "event_type", "value"
    )
    first = to_long(ev, ["entity", "time"], F.col("event_type"), F.col("value"))
    od = orders(spark, folder).select(
        F.col("o_custkey").alias("entity"),
        (F.col("day") * 1440).cast("long").alias("time"),
        "o_totalprice",
        "o_orderpriority",
    )
    urgent = F.when(
        F.col("o_orderpriority") != "5-LOW",
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0),
    )
    second = stack_long(od, ["entity", "time"], {"price": F.col("o_totalprice"), "urgent": urgent})
    return union_long([first, second])


@query(
    "union_distinct",
    """
SELECT o_custkey AS entity, o_orderstatus AS code FROM orders
UNION SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'O' END FROM customer
UNION SELECT user_id, event_type FROM events
""",
)
def union_of_sources(spark, folder):
    od = load(spark, folder, "orders")
    cu = load(spark, folder, "customer")
    ev = load(spark, folder, "events")
    return union_distinct(
        [
            od.select(F.col("o_custkey").alias("entity"), F.col("o_orderstatus").alias("code")),
            cu.select(
                F.col("c_custkey").alias("entity"),
                F.when(F.col("c_acctbal") < 0, "F").otherwise("O").alias("code"),
            ),
            ev.select(F.col("user_id").alias("entity"), F.col("event_type").alias("code")),
        ]
    )


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, folder):
    return load(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()
