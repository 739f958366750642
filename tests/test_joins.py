"""Hot-key joins and as-of joins against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from wardline.operators.joins import (
    asof_join,
    exclude,
    exclude_listed,
    join_where,
    keyed_join,
    nearest_in_window,
    planned_bytes,
    restrict,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third exact copies of one row."""
    rng = random.Random(3)
    rows = [(1, i) for i in range(200)] + [(2, 7)] * 200 + [(rng.randint(3, 60), i) for i in range(200)]
    big = spark.createDataFrame(rows, "k int, x int").repartition(4)
    small = spark.createDataFrame([(k, k * 10) for k in range(0, 50)] + [(1, -1)], "k int, y int")
    return big, small


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(skewed, rows, how):
    big, small = skewed
    salted = keyed_join(big, small, "k", how, limit=0, rows_per_task=20)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(salted) == rows(big.join(small, "k", how))


def test_salts_spread_the_hot_key(skewed):
    big, small = skewed
    plan = keyed_join(big, small, "k", "inner", limit=0, rows_per_task=20)
    per_task = plan.filter("k = 1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 400


def test_small_side_is_broadcast_only_when_small(skewed):
    big, small = skewed
    assert planned_bytes(small) > 0
    plan = keyed_join(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_unsupported_join_type(skewed):
    with pytest.raises(ValueError):
        keyed_join(*skewed, "k", "full")


def test_restrict_and_exclude_cover_everything(skewed):
    big, small = skewed
    for kw in ({}, {"limit": 0, "rows_per_task": 20}):
        kept, gone = restrict(big, small, "k", **kw), exclude(big, small, "k", **kw)
        assert kept.count() + gone.count() == big.count()
    assert exclude_listed(big, "k", [1, 2]).filter("k <= 2").count() == 0
    assert exclude_listed(big, "k", []).count() == big.count()


def test_join_where_with_hot_right_side(skewed, rows):
    big, small = skewed
    want = small.join(big.filter("x > 5"), "k", "left")
    got = join_where(small, big, "k", F.col("x") > 5, limit=0, rows_per_task=20)
    assert rows(got, "k", "y", "x") == rows(want, "k", "y", "x")
    broadcast = join_where(small, big, "k", F.col("x") > 5)
    assert rows(broadcast, "k", "y", "x") == rows(want, "k", "y", "x")


def _sides(seed):
    rng = random.Random(seed)
    left = [(i, rng.randint(0, 4), rng.randint(0, 60)) for i in range(120)]
    right = [(rng.randint(0, 4), rng.randint(0, 60), rng.randint(0, 99)) for _ in range(60)]
    return left, right


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("within", [None, 6])
def test_asof_against_loop(spark, strict, within):
    left, right = _sides(8)
    l = spark.createDataFrame(left, "id int, e int, t int")
    r = spark.createDataFrame(right, "e int, at int, v int")
    got = {x.id: (x.at, x.v) for x in asof_join(l, r, ["e"], "t", "at", ["at", "v"], 7, strict, within).collect()}
    for i, e, t in left:
        fit = [(a, v) for k, a, v in right if k == e and (a < t if strict else a <= t) and (within is None or a >= t - within)]
        assert got[i] == (max(fit) if fit else (None, None))


def test_nearest_against_loop(spark):
    left, right = _sides(9)
    l = spark.createDataFrame(left, "id int, e int, t int")
    r = spark.createDataFrame(right, "e int, at int, v int")
    out = nearest_in_window(l, r, ["e"], "t", "at", ["v"], 6, 3, 10).collect()
    got = {x.id: (x.gap, x.v) for x in out}
    assert len(out) == len(left)
    for i, e, t in left:
        fit = [(abs(a - t), a - t, -v) for k, a, v in right if k == e and a > t - 6 and a < t + 3]
        best = min(fit) if fit else None
        assert got[i] == ((best[1], -best[2]) if best else (None, None))


def test_asof_forms_no_pairs(spark):
    left, right = _sides(1)
    l = spark.createDataFrame(left, "id int, e int, t int")
    r = spark.createDataFrame(right, "e int, at int, v int")
    plan = asof_join(l, r, ["e"], "t", "at", ["v"], 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_with_unknown_keys_spread_over_tasks(spark, how):
    """Half the keys are NULL: they match nothing and must not meet in one task."""
    big = spark.range(40_000).selectExpr("if(id % 2 = 0, null, id % 997) as k", "id as v")
    small = spark.range(997).selectExpr("id as k", "id * 2 as w")
    joined = keyed_join(big, small, "k", how, ["v"], limit=-1, rows_per_task=1000)
    assert joined.count() == (40_000 if how == "left" else 20_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = keyed_join(big, small, "k", how, ["v"], limit=-1, rows_per_task=1000)
        sizes = plain.filter("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 20_000
    assert max(r["count"] for r in sizes) <= 2 * 20_000 / 4
