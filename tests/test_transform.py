"""Recoding, transforms and rounding."""

import math

import pytest
from pyspark.sql import functions as F

from wardline.functions import recode
from wardline.functions.scalars import half_even, significant
from wardline.operators import reshape, sample, transform
from wardline.plans import fixed_values as fixed

T = fixed.FIRST_TRANSFORMS


def moved(frame, pairs):
    df = frame([(i, n, float(v)) for i, (n, v) in enumerate(pairs)], "i int, variable string, value double")
    return {(r.variable, r.i): r.value for r in transform.transformed(df, T).collect()}


def test_domain(frame):
    got = moved(frame, [("fio2", 20), ("GCS", 15), ("heart_rate", 0), ("heart_rate", -1), ("spo2", 101), ("wob", 0), ("fio2", 100.2)])
    assert set(got) == {("GCS", 1), ("wob", 5)}
    assert got[("GCS", 1)] == pytest.approx(math.log((12.1 / 12.2) / (1 - 12.1 / 12.2)))


def test_round_trip(frame):
    values = [("spo2", v) for v in range(60, 101)] + [("GCS", v) for v in range(3, 16)] + [("fio2", v) for v in range(21, 101)]
    values += [("heart_rate", v) for v in (40, 77.5, 180)] + [("wob", 1)]
    df = frame([(i, n, float(v)) for i, (n, v) in enumerate(values)], "i int, variable string, value double")
    up = transform.transformed(df, T)
    scale = transform.mean_sd(up, fixed.FIRST_STANDARDISED)
    back = transform.restored(transform.standardised(up, scale), scale, T)
    got = {r.i: r.value for r in back.collect()}
    assert len(got) == len(values)
    for i, (_, v) in enumerate(values):
        assert got[i] == pytest.approx(v, rel=1e-9)


def test_standardised_has_unit_spread(frame):
    df = frame([(i, "a", float(i * i)) for i in range(10)] + [(0, "b", 3.0)], "i int, variable string, value double")
    z = transform.standardised(df, transform.mean_sd(df, ["a"]))
    r = z.filter("variable = 'a'").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).first()
    assert (r.m, r.s) == (pytest.approx(0, abs=1e-9), pytest.approx(1))
    assert z.filter("variable = 'b'").first().value == 3.0


def test_half_even(frame):
    got = frame([(2.5,), (3.5,), (-2.5,)], "x double").select(half_even(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == [2.0, 4.0, -2.0]


def test_bins(frame):
    df = frame([(39,), (40,), (100,), (17,), (None,)], "a int")
    got = df.select(recode.bin_left_closed(F.col("a"), fixed.AGE_BREAKS, fixed.AGE_LABELS).alias("g")).collect()
    assert [r.g for r in got] == ["18-39", "40-49", None, None, None]


def test_proxy_from_flow(frame):
    df = frame([(10.0, "Face tent"), (30.0, "Face tent"), (26.0, "Face tent"), (10.0, "High flow neb"), (101.0, "Oxymizer")],
               "f double, d string")
    got = df.select(recode.percent_from_flow(F.col("f"), F.col("d"), fixed.FLOW_DEVICES).alias("v")).collect()
    assert [r.v for r in got] == [51.0, 30.0, 26.0, None, None]


def test_fraction_from_flow_follows_the_device_lists(frame):
    df = frame([(10.0, 17), (40.0, 17), (10.0, 2), (-1.0, 2), (5.0, 12), (5.0, None)], "f double, d int")
    est = recode.fraction_from_flow(F.col("f"), F.col("d"), fixed.ROUTES_FLOORED, fixed.ROUTES_SCALED, fixed.ROUTES_ROOM_AIR)
    got = [r.v for r in df.select(est.alias("v")).collect()]
    assert got == [pytest.approx(0.51), 1.0, None, 0.21, 0.21, None]


def test_charted_concepts(frame, rows):
    df = frame([(1, 223990, "Labored", None), (2, 223990, "Normal", None), (3, 223990, "Odd", None), (4, 220277, None, 100.0),
                (5, 220277, None, 100.5), (6, 999, None, 1.0), (7, 223761, None, 98.6)], "i int, code bigint, text string, num double")
    got = rows(recode.map_concepts(df, fixed.CHARTED, "code", "num", text="text"), "i", "variable", "value")
    assert got == [(1, "wob", 1.0), (2, "wob", 0.0), (4, "spo2", 100.0), (7, "temperature", pytest.approx(37.0))]


def test_drug_classes_in_order(frame):
    df = frame([("FUROSEMIDE and morphine",), ("Albuterol neb",), ("Septra DS",), ("Torsemide",), ("water",)], "m string")
    got = [r.c for r in recode.text_class(df, "m", fixed.DRUG_CLASSES, "c").collect()]
    assert got == ["lasix", "puffer", "abx", None, None]


def test_range_limits_keep_other_variables(frame):
    df = frame([("ph", 6.0), ("ph", 7.0), ("other", -5.0), ("mbp", None)], "variable string, value double")
    got = recode.drop_out_of_range(df, fixed.SECOND_LIMITS, "variable", "value").collect()
    assert [tuple(r) for r in got] == [("ph", 7.0), ("other", -5.0), ("mbp", None)]


def test_grid_has_every_column(frame):
    grid = reshape.to_grid(frame([(1, 0, "a", 1.0)], "e int, time int, variable string, value double"), ["e", "time"], ["a", "ph"])
    assert grid.columns == ["e", "time", "a", "ph"] and grid.first().ph is None


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "e")
    a = {r.e for r in sample.sample_entities(df.repartition(1), "e", 50, 7).collect()}
    b = {r.e for r in sample.sample_entities(df.repartition(13), "e", 50, 7).collect()}
    c = {r.e for r in sample.sample_entities(df, "e", 50, 8).collect()}
    assert a == b and len(a) == 50 and a != c


def test_dense_index(spark):
    df = spark.createDataFrame([(v,) for v in (-5, 3, 3, 900, 1_000_000, 7)], "e bigint")
    got = {r.e: r.id for r in sample.dense_index(df, "e").collect()}
    assert got == {-5: 1, 3: 2, 7: 3, 900: 4, 1_000_000: 5}


def test_dense_index_of_scattered_ids(spark):
    """Hashed 64-bit ids: every bucket holds about the same number of them."""
    df = spark.range(20_000).select(F.xxhash64("id").alias("e"))
    got = sample.dense_index(df, "e", buckets=100).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 20_001))
    assert [r.e for r in got] == sorted(r.e for r in got)
    borders = df.agg(F.percentile_approx("e", [k / 100 for k in range(1, 100)], 1000).alias("b")).first().b
    sizes = df.groupBy(sample._range_number(F.col("e"), borders).alias("n")).count().collect()
    assert len(sizes) == 100 and max(r["count"] for r in sizes) < 300


def test_dense_index_edges(spark):
    df = spark.createDataFrame([(None,), (4,), (4,), (2,)], "e bigint")
    assert {r.e: r.id for r in sample.dense_index(df, "e").collect()} == {None: 1, 2: 2, 4: 3}
    assert sample.dense_index(df.limit(0), "e").count() == 0


def test_routed_rows_equal_filtered_sources(frame, rows):
    from pyspark.sql import functions as F

    from wardline.operators.longtable import route, union_long

    df = frame([(1, "a", 5.0), (1, "b", None), (2, "a", 7.0), (None, "c", 1.0), (3, None, 2.0)], "id int, kind string, v double")
    kind = F.col("kind")
    got = route(df, ["id"], [(kind == "a", {"x": F.col("v")}), (kind.isin("a", "b"), {"y": F.lit(1), "x": F.col("v") * 2})])
    want = union_long([
        df.filter(kind == "a").select("id", F.col("v").alias("x")),
        df.filter(kind.isin("a", "b")).select("id", F.lit(1).alias("y"), (F.col("v") * 2).alias("x")),
    ])
    assert rows(got, "id", "x", "y") == rows(want, "id", "x", "y")
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def there_and_back(frame, values, drift):
    """Values after the way there and back, with a scale whose last bits differ on the way back."""
    from registry.reshaping import CONTINUOUS, TRANSFORMS

    df = frame([(i, n, v) for i, (n, v) in enumerate(values)], "i int, variable string, value double")
    up = transform.transformed(df, TRANSFORMS)
    scale = frame([(v, 2.345678901 + k / 7, 0.987654321 / (k + 3)) for k, v in enumerate(CONTINUOUS)], "variable string, mean double, sd double")
    summed_anew = scale.withColumn("mean", F.col("mean") * F.lit(1 + drift))
    back = transform.restored(transform.standardised(up, scale), summed_anew, TRANSFORMS)
    return [r.value for r in back.orderBy("i").collect()]


@pytest.mark.parametrize("drift", [0.0, 4e-15, -4e-15])
def test_measured_values_come_back_exactly(frame, drift):
    """A value on a rule's limit stays on it, whatever the order in which means were summed."""
    values = [("ph", v) for v in (7.25, 7.3, 7.35)] + [("resp_rate", v) for v in (30.0, 35.0, 40.0, 44.496)]
    values += [("heart_rate", v) for v in (86.5, 120.0)] + [("po2", 114.0), ("pco2", 57.484)]
    assert there_and_back(frame, values, drift) == [v for _, v in values]


def test_significant(frame):
    given = [0.0, 7.299999999999995, -86.49999999999987, 1.234e-9, 1e300, 5e-324, float("inf"), None]
    got = frame([(i, v) for i, v in enumerate(given)], "i int, x double").select("i", significant(F.col("x")).alias("y"))
    assert [r.y for r in got.orderBy("i").collect()] == [0.0, 7.3, -86.5, 1.234e-9, 1e300, 5e-324, float("inf"), None]


@pytest.mark.parametrize("drift", [0.0, 4e-15, -4e-15])
def test_measured_ties_are_rounded_half_even(frame, drift):
    values = [("GCS", v + 0.5) for v in range(3, 15)] + [("spo2", v + 0.5) for v in range(60, 100)]
    values += [("fio2", v + 0.5) for v in range(21, 100)]
    assert there_and_back(frame, values, drift) == [float(round(v)) for _, v in values]


def test_scale_is_summed_once(spark):
    """The way there and the way back read one written scale."""
    from registry.reshaping import standard

    scale = standard(spark, "/root/testdata/sf0.001")[1]
    assert "Aggregate" not in scale._jdf.queryExecution().optimizedPlan().toString()
    assert scale.count() == 8


def test_lanes_come_back_as_single_values_do(frame):
    """Bit for bit, and without choosing the way back anew for every draw."""
    lane = [-3.0, -0.7, 0.0, 0.3, 2.5, None, float("nan")]
    names = ["spo2", "GCS", "fio2", "heart_rate", "wob", "po2"]
    scale = frame([(n, 0.4, 0.7) for n in names[:4]], "variable string, mean double, sd double")
    lanes = transform.restored(frame([(n, lane) for n in names], "variable string, value array<double>"), scale, T)
    raw = F.when(F.col("mean").isNotNull(), F.col("value") * F.col("sd") + F.col("mean")).otherwise(F.col("value"))
    cells = frame([(n, k, v) for n in names for k, v in enumerate(lane)], "variable string, k int, value double")
    want = cells.join(scale, "variable", "left").withColumn("value", transform.inverse(F.col("variable"), raw, T))
    want = {(r.variable, r.k): r.value for r in want.collect()}
    got = {(r.variable, k): v for r in lanes.collect() for k, v in enumerate(r.value)}
    assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in want.items()}
    assert "bround" not in lanes._jdf.queryExecution().optimizedPlan().toString()
