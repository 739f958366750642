"""State along the time axis: look-back, ever-flags, intervals, carry-forward, index time."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CHANNELS,
    DAY,
    EVENTS_SQL,
    INFUSIONS_SQL,
    SIGNALS_SQL,
    events,
    infusions,
    load,
    query,
    signals,
    written_signals,
)
from wardline.functions.scalars import flag
from wardline.operators.blocks import EverBy, FirstRow, Last, RunningMax, Whole, along_time
from wardline.operators.joins import keyed_join
from wardline.operators.pick import best_row
from wardline.operators.state import (
    cumulative_states,
    interval_state,
    locf,
    lookback,
    on_off_events,
    signed_delta_state,
)


@query(
    "lookback_last",
    f"""
SELECT user_id, minute, sat, oxy,
  last_value(oxy IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN 480 PRECEDING AND CURRENT ROW) AS oxy_480,
  last_value(sat IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN 120 PRECEDING AND CURRENT ROW) AS sat_120,
  last_value(sat IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute ROWS UNBOUNDED PRECEDING) AS sat_ever
FROM ({SIGNALS_SQL})
""",
)
def lookback_last(spark, folder):
    wanted = {"oxy_480": ("oxy", 480), "sat_120": ("sat", 120), "sat_ever": ("sat", None)}
    return lookback(signals(spark, folder), ["user_id"], "minute", wanted, DAY).drop("vent", "limit")


@query(
    "ever_with_slack",
    f"""
SELECT user_id, minute,
  max(vent) OVER (PARTITION BY user_id ORDER BY minute RANGE UNBOUNDED PRECEDING) AS ever,
  max(vent) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN UNBOUNDED PRECEDING AND 30 FOLLOWING) AS ever_30,
  max(vent) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN UNBOUNDED PRECEDING AND 7200 FOLLOWING) AS ever_7200,
  max("limit") OVER (PARTITION BY user_id) AS limit_ever
FROM ({SIGNALS_SQL})
""",
)
def ever_with_slack(spark, folder):
    return along_time(
        written_signals(spark, folder),
        ["user_id"],
        "minute",
        [
            RunningMax("ever", "vent"),
            EverBy("ever_30", "vent", 30),
            EverBy("ever_7200", "vent", 7200),
            Whole("limit_ever", "limit"),
        ],
        DAY,
    ).select("user_id", "minute", "ever", "ever_30", "ever_7200", "limit_ever")


@query(
    "pick_one",
    f"""
SELECT user_id, event_id, minute FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END DESC,
                               minute, event_id) AS rn FROM ({EVENTS_SQL})) WHERE rn = 1
""",
)
def pick_one(spark, folder):
    marked = F.when((F.col("event_type") == "error") & (F.col("value") > 60), 1).otherwise(0)
    return best_row(
        events(spark, folder), ["user_id"], [-marked, F.col("minute"), F.col("event_id")], ["event_id", "minute"]
    )


@query(
    "interval_state",
    f"""
WITH i AS ({INFUSIONS_SQL}),
 e AS (SELECT entity, channel, start AS time, 1 AS on_, 0 AS off_ FROM i UNION ALL SELECT entity, channel, stop, 0, 1 FROM i),
 n AS (SELECT entity, time, channel, max(on_) - max(off_) AS net FROM e GROUP BY 1, 2, 3),
 w AS (SELECT entity, time, {", ".join(f"max(CASE WHEN channel = '{c}' THEN net END) AS n_{c}" for c in CHANNELS)} FROM n GROUP BY 1, 2),
 r AS (SELECT entity, time, {", ".join(f"sum(n_{c}) OVER (PARTITION BY entity ORDER BY time RANGE UNBOUNDED PRECEDING) AS r_{c}" for c in CHANNELS)} FROM w)
SELECT entity, time, CASE WHEN {" OR ".join(f"r_{c} >= 1" for c in CHANNELS)} THEN 1 ELSE 0 END AS value FROM r
""",
)
def intervals(spark, folder):
    switches = on_off_events(infusions(spark, folder), ["entity"], "channel", "start", "stop")
    return interval_state(switches, ["entity"], "time", "channel", CHANNELS, 60 * DAY)


@query(
    "signed_delta_state",
    f"""
WITH i AS ({INFUSIONS_SQL}),
 e AS (SELECT entity, channel, start AS time, 1 AS delta FROM i UNION ALL SELECT entity, channel, stop, -1 FROM i),
 n AS (SELECT entity, time, {", ".join(f"sum(CASE WHEN channel = '{c}' THEN delta END) AS n_{c}" for c in CHANNELS)} FROM e GROUP BY 1, 2),
 s AS (SELECT entity, time, {", ".join(f"last_value(CASE WHEN n_{c} > 0 THEN 1 WHEN n_{c} < 0 THEN 0 END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY time ROWS UNBOUNDED PRECEDING) AS s_{c}" for c in CHANNELS)} FROM n)
SELECT entity, time, greatest({", ".join(f"s_{c}" for c in CHANNELS)}) AS value FROM s WHERE value IS NOT NULL
""",
)
def signed_deltas(spark, folder):
    ends = F.array(
        F.struct(F.col("start").alias("time"), F.lit(1).alias("delta")),
        F.struct(F.col("stop").alias("time"), F.lit(-1).alias("delta")),
    )
    deltas = infusions(spark, folder).select("entity", "channel", F.explode(ends).alias("e")).select(
        "entity", "channel", "e.*"
    )
    return signed_delta_state(deltas, ["entity"], "time", "channel", CHANNELS, "delta", 60 * DAY)


@query(
    "first_value",
    f"""
SELECT user_id, minute, first_value(sat) OVER (PARTITION BY user_id ORDER BY minute RANGE UNBOUNDED PRECEDING) AS sat_first,
  first_value(oxy) OVER (PARTITION BY user_id ORDER BY minute RANGE UNBOUNDED PRECEDING) AS oxy_first
FROM ({SIGNALS_SQL})
""",
)
def first_value(spark, folder):
    return along_time(
        written_signals(spark, folder),
        ["user_id"],
        "minute",
        [FirstRow("sat_first", "sat"), FirstRow("oxy_first", "oxy")],
        DAY,
    ).select("user_id", "minute", "sat_first", "oxy_first")


@query(
    "locf_grid",
    f"""
SELECT user_id, minute,
  {", ".join(f'last_value("{c}" IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute ROWS UNBOUNDED PRECEDING) AS "{c}"' for c in ("sat", "oxy", "vent", "limit"))}
FROM ({SIGNALS_SQL})
""",
)
def locf_grid(spark, folder):
    return locf(signals(spark, folder), ["user_id"], "minute", ["sat", "oxy", "vent", "limit"], DAY)


@query(
    "cumulative_states",
    """
WITH e AS (SELECT o_custkey, min(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS f,
             min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) AS u, max(o_orderdate) AS m FROM orders GROUP BY 1),
 t AS (SELECT CASE WHEN f IS NOT NULL THEN 'IMV' WHEN u IS NOT NULL THEN 'DC' ELSE 'None' END AS event,
         CAST(date_diff('day', TIMESTAMP '1995-01-01', least(f, u, m)) AS INTEGER) AS time FROM e),
 c AS (SELECT time, count(*) FILTER (WHERE event = 'IMV') AS imv, count(*) FILTER (WHERE event = 'DC') AS dc FROM t GROUP BY 1),
 r AS (SELECT time, CAST(sum(imv) OVER (ORDER BY time) AS BIGINT) AS imv, CAST(sum(dc) OVER (ORDER BY time) AS BIGINT) AS dc FROM c)
SELECT time, 'IMV' AS state, imv AS n FROM r UNION ALL SELECT time, 'DC', dc FROM r
UNION ALL SELECT time, 'rest', (SELECT count(*) FROM t) - imv - dc FROM r
""",
)
def states_over_time(spark, folder):
    from registry.base import orders

    od = orders(spark, folder)
    per = od.groupBy("o_custkey").agg(
        F.min(F.when(F.col("o_orderstatus") == "F", F.col("day"))).alias("f"),
        F.min(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("day"))).alias("u"),
        F.max("day").alias("m"),
    )
    ended = per.select(
        F.when(F.col("f").isNotNull(), "IMV").when(F.col("u").isNotNull(), "DC").otherwise("None").alias("event"),
        F.least("f", "u", "m").alias("time"),
    )
    return cumulative_states(ended, "time", "event", ["IMV", "DC"], 60, "rest")


@query(
    "eligibility_index",
    f"""
WITH s AS ({SIGNALS_SQL}),
 w AS (SELECT user_id, minute,
   last_value(oxy IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN 4320 PRECEDING AND CURRENT ROW) AS oxy,
   last_value(sat IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN 2880 PRECEDING AND CURRENT ROW) AS sat,
   max(vent) OVER (PARTITION BY user_id ORDER BY minute RANGE BETWEEN UNBOUNDED PRECEDING AND 30 FOLLOWING) AS vent_ever,
   max("limit") OVER (PARTITION BY user_id) AS limit_ever FROM s),
 m AS (SELECT w.*, c_nationkey AS subject, CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS admission_ok FROM w JOIN customer ON user_id = c_custkey),
 p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY user_id, minute) AS rn FROM m
       WHERE sat <= 100 AND oxy >= 20 AND coalesce(vent_ever, 0) = 0 AND coalesce(limit_ever, 0) = 0 AND admission_ok = 1 AND minute < 20160)
       WHERE rn = 1)
SELECT p.subject, p.user_id, p.minute AS eligibility_time, p.sat AS sat_bl, p.oxy AS oxy_bl,
  max(CASE WHEN s.vent = 1 AND s.minute - p.minute < 7200 THEN 1 ELSE 0 END) AS imv_ever,
  min(CASE WHEN s.vent = 1 THEN s.minute - p.minute END) AS imv_time,
  max(CASE WHEN s.vent = 1 AND s.minute - p.minute >= 7200 THEN 1 ELSE 0 END) AS imv_after_censor
FROM p JOIN s ON s.user_id = p.user_id GROUP BY 1, 2, 3, 4, 5
""",
)
def eligibility_index(spark, folder):
    """Signals, look-back state, eligible moments, one index time per subject, roll-up.

    A moment is eligible only if nothing of the ventilator is seen up to 30 minutes later, so
    the first and last such minute of the user tell everything about the time after it.
    """
    on = F.when(F.col("vent") == 1, F.col("minute"))
    state = along_time(
        written_signals(spark, folder),
        ["user_id"],
        "minute",
        [
            Last("oxy", "oxy", within=4320),
            Last("sat", "sat", within=2880),
            EverBy("vent_ever", "vent", 30),
            Whole("limit_ever", "limit"),
            Whole("vent_first", on, "min"),
            Whole("vent_last", on, "max"),
        ],
        DAY,
    )
    people = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("subject"), "c_acctbal"
    )
    eligible = (
        (F.col("sat") <= 100)
        & (F.col("oxy") >= 20)
        & (F.coalesce("vent_ever", F.lit(0)) == 0)
        & (F.coalesce("limit_ever", F.lit(0)) == 0)
        & (F.col("minute") < 20160)
    )
    moments = keyed_join(
        state.filter(eligible), people.filter("c_acctbal >= 0"), "user_id", "inner", bounded=True
    )
    index = best_row(
        moments,
        ["subject"],
        [F.col("user_id"), F.col("minute")],
        [
            "user_id",
            F.col("minute").alias("eligibility_time"),
            F.col("sat").alias("sat_bl"),
            F.col("oxy").alias("oxy_bl"),
            (F.col("vent_first") - F.col("minute")).alias("imv_time"),
            (F.col("vent_last") - F.col("minute")).alias("_last"),
        ],
    )
    return index.select(
        "subject",
        "user_id",
        "eligibility_time",
        "sat_bl",
        "oxy_bl",
        flag(F.col("imv_time") < 7200).alias("imv_ever"),
        "imv_time",
        flag(F.col("_last") >= 7200).alias("imv_after_censor"),
    )
