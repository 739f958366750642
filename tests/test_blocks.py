"""Block-wise running values against a plain loop over each entity."""

import random

import pytest
from pyspark.sql import Window, functions as F

from wardline.operators.blocks import (
    EverBy,
    FirstRow,
    Last,
    Next,
    RunningMax,
    RunningSum,
    Whole,
    along_time,
)

SPECS = [
    Last("last", "v"),
    Last("last_8", "v", within=8, time_out="last_8_at"),
    Last("last_before", "v", strict=True),
    Next("next", "v"),
    Next("next_5", "v", within=5, strict=True, time_out="next_5_at"),
    RunningMax("top", "v"),
    RunningSum("total", "v"),
    EverBy("ever", "f"),
    EverBy("ever_6", "f", 6),
    Whole("most", "v"),
    Whole("sum_all", "v", "sum"),
    FirstRow("first", "v"),
]


def expected(series):
    out = {}
    for e, items in series.items():
        items = sorted(items)
        known = [(t, v) for t, v, _ in items if v is not None]
        flags = [(t, f) for t, _, f in items if f is not None]
        for t, v, f in items:
            past = [x for x in known if x[0] <= t]
            before = [x for x in known if x[0] < t]
            ahead = [x for x in known if x[0] >= t]
            later = [x for x in known if x[0] > t]
            near = past[-1] if past and past[-1][0] >= t - 8 else (None, None)
            soon = later[0] if later and later[0][0] <= t + 5 else (None, None)

            def ever(slack):
                seen = [x[1] for x in flags if x[0] <= t + slack]
                return max(seen) if seen else None

            out[(e, t)] = (
                past[-1][1] if past else None,
                near[1], near[0],
                before[-1][1] if before else None,
                ahead[0][1] if ahead else None,
                soon[1], soon[0],
                max(x[1] for x in past) if past else None,
                sum(x[1] for x in past) if past else None,
                ever(0), ever(6),
                max(x[1] for x in known) if known else None,
                sum(x[1] for x in known) if known else None,
                items[0][1],
            )
    return out


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_against_loop(spark, width):
    rng = random.Random(5)
    series = {}
    for e in range(40):
        times = rng.sample(range(-30, 60), rng.randint(1, 40))
        series[e] = [
            (t, rng.choice([None, rng.randint(0, 9)]), rng.choice([None, 0, 0, 1])) for t in times
        ]
    data = [(e, t, v, f) for e, items in series.items() for t, v, f in items]
    df = spark.createDataFrame(data, "e int, t int, v int, f int")
    got = along_time(df, ["e"], "t", SPECS, width)
    names = [
        "last", "last_8", "last_8_at", "last_before", "next", "next_5", "next_5_at", "top", "total", "ever",
        "ever_6", "most", "sum_all", "first",
    ]
    rows = {(r.e, r.t): tuple(r[n] for n in names) for r in got.collect()}
    assert rows == expected(series)


def test_fractional_time_and_one_axis(spark):
    df = spark.createDataFrame([(0.25, 1), (0.75, 2), (5.5, 4), (-3.0, 8)], "t double, v int")
    got = along_time(df, [], "t", [RunningSum("s", "v"), Whole("all", "v", "sum")], 0.5)
    assert {r.t: (r.s, r["all"]) for r in got.collect()} == {
        -3.0: (8, 15), 0.25: (9, 15), 0.75: (11, 15), 5.5: (15, 15)
    }


@pytest.mark.parametrize("width", [3, 1000])
def test_rows_without_entity_or_time_are_as_in_plain_windows(spark, width):
    rng = random.Random(8)
    data = []
    for e in [None, *range(12)]:
        times = rng.sample(range(-30, 60), rng.randint(1, 25)) + ([None] if e is None or e % 3 else [])
        data += [(e, t, rng.choice([None, rng.randint(0, 9)]), rng.choice([None, 0, 1])) for t in times]
    df = spark.createDataFrame(data, "e int, t int, v int, f int")
    start, end = Window.unboundedPreceding, Window.unboundedFollowing
    w = Window.partitionBy("e").orderBy("t")
    plain = df.select(
        "e", "t",
        F.last("v", True).over(w.rangeBetween(start, 0)).alias("last"),
        F.last("v", True).over(w.rangeBetween(-8, 0)).alias("last_8"),
        F.first("v", True).over(w.rangeBetween(0, end)).alias("next"),
        F.first("v", True).over(w.rangeBetween(0, 5)).alias("next_5"),
        F.max("v").over(w.rangeBetween(start, 0)).alias("top"),
        F.sum("v").over(w.rangeBetween(start, 0)).cast("int").alias("total"),
        F.max("f").over(w.rangeBetween(start, 0)).alias("ever"),
        F.max("f").over(w.rangeBetween(start, 6)).alias("ever_6"),
        F.max("v").over(w.rangeBetween(start, end)).alias("most"),
        F.first("v").over(w.rangeBetween(start, 0)).alias("first"),
    )
    specs = [
        Last("last", "v"), Last("last_8", "v", within=8), Next("next", "v"), Next("next_5", "v", within=5), RunningMax("top", "v"),
        RunningSum("total", "v"), EverBy("ever", "f"), EverBy("ever_6", "f", 6), Whole("most", "v"), FirstRow("first", "v"),
    ]
    got = along_time(df, ["e"], "t", specs, width)
    rows = lambda x: sorted((tuple(r) for r in x.select(*plain.columns).collect()), key=str)
    assert rows(got) == rows(plain)


def test_several_keys_some_unknown(spark):
    data = [("a", None, 1, 5), ("a", None, 2, None), (None, 1, 1, 7), (None, 1, 3, None), ("", 0, 4, None), (None, None, 1, None)]
    df = spark.createDataFrame(data, "a string, b int, t int, v int")
    got = {(r.a, r.b, r.t): r.l for r in along_time(df, ["a", "b"], "t", [Last("l", "v")], 2).collect()}
    assert got == {("a", None, 1): 5, ("a", None, 2): 5, (None, 1, 1): 7, (None, 1, 3): 7, ("", 0, 4): None, (None, None, 1): None}


def test_hot_entity_is_spread_over_tasks(spark):
    """One entity with nearly all rows: its blocks finish in many tasks, not in one."""
    hot = spark.range(60_000).select(F.lit(1).alias("e"), F.col("id").alias("t"), (F.col("id") % 5).alias("v"))
    rest = spark.range(200).select((F.col("id") + 2).cast("int").alias("e"), F.col("id").alias("t"), F.lit(1).cast("long").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = along_time(hot.unionByName(rest), ["e"], "t", [RunningSum("s", "v"), Last("l", "v")], 1000)
        per_task = got.filter("e = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 50_000
    assert got.filter("e = 1").agg(F.max("s")).first()[0] == 60_000 // 5 * 10
