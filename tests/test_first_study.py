"""First study on a hand-written database, step by step."""

import pytest
from pyspark.sql import functions as F

from tests.first_database import at, tables
from wardline.operators.impute import GaussianProcess
from wardline.plans import fixed_values as fixed, first_study as study


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark)


@pytest.fixture(scope="module")
def built(spark, t, tmp_path_factory):
    return study.build(t, folder=str(tmp_path_factory.mktemp("first")))


def device_row(df, stay, minute):
    got = df.filter((F.col("stay_id") == stay) & (F.col("charttime") == F.lit(at(minute)).cast("timestamp_ntz"))).collect()
    return got[0] if got else None


def test_device_table(built):
    d = built["device"]
    assert device_row(d, 1, 50).o2_device == 5
    r = device_row(d, 1, 60)
    assert (r.spo2, r.resp_rate, r.fio2) == (92.0, 24.0, 80.0)
    # Product of 3 charted-table rows and 1 flow row: (50 + 60 + 51) / 3.
    assert device_row(d, 1, 70).fio2 == pytest.approx((50 + 60 + 51) / 3)
    assert device_row(d, 1, 80).fio2 is None
    assert device_row(d, 1, 90).fio2 == 30.0
    assert device_row(d, 1, 95) is None
    assert device_row(d, 1, 96).o2_device == 1
    assert device_row(d, 1, 1000).o2_device == 6


def test_prefer_charted(t):
    d = study.device_table(t, prefer_charted=True)
    assert device_row(d, 1, 70).fio2 == 55.0


def test_cohort(built):
    got = {r.subject_id: r for r in built["cohort"].collect()}
    assert set(got) == {10, 12}
    first = got[10]
    assert (first.stay_id, first.eligibility_time, first.o2_device_bl) == (1, 60, 5)
    assert (first.fio2_bl, first.spo2_bl) == (80.0, 92.0)
    assert (first.imv_ever, first.imv_time, first.imv_after_censor) == (1, 940, 0)
    assert (got[12].imv_ever, got[12].imv_time) == (0, None)


def test_attrition(built):
    steps = {r.step: (r.remaining, r.removed) for r in built["attrition"].collect()}
    assert steps["all"] == (4, 0)
    assert steps["unplanned admission"] == (3, 1)
    assert steps["index stay"][0] == 2
    left = [r.remaining for r in built["attrition"].orderBy("step_no").collect()]
    assert left == sorted(left, reverse=True)


def test_long_table(built):
    got = {(r.time, r.variable): r.value for r in built["long"].filter("stay_id = 1").collect()}
    assert got[(-20, "resp_rate")] == 30.0
    assert got[(40, "resp_rate")] == 34.0
    assert got[(-20, "wob")] == 1.0
    assert got[(-20, "temperature")] == pytest.approx(37.0)
    assert got[(-5, "ph")] == 7.3 and (-5, "lactate") not in got
    assert got[(-5, "po2")] == 65.0 and (-4, "po2") not in got
    assert got[(-10, "uo_6h_rate")] == 1.2 and (-9, "uo_6h_rate") not in got
    assert got[(-2, "cxr")] == 1.0
    assert got[(-1, "lasix")] == 1.0 and got[(-1, "abx")] == 1.0 and (-1, "opioid") not in got
    pressor = {k[0]: v for k, v in got.items() if k[1] == "pressor"}
    assert pressor == {140: 1.0, 240: 1.0, 290: 1.0, 340: 1.0, 360: 0.0}
    # Censored at intubation, its own row kept.
    assert max(k[0] for k in got) == 940 and got[(940, "o2_device")] == 6.0


def test_baseline(built):
    rows = {r.stay_id: r for r in built["baseline"].collect()}
    one, four = rows[1], rows[4]
    assert (one.diabetes, one.copd, one.obesity, one.chf) == (1, 1, 0, 0)
    assert one.curr_service == "CMED" and one.careunit == "Coronary Care Unit (CCU)"
    assert (one.resp_rate_bl, one.heart_rate_bl, one.ph_bl) == (30.0, 110.0, 7.3)
    assert (one.niv_bl, one.hfnc_bl) == (1, 0) and four.hfnc_bl == 1
    assert one.preICU_LOS == 600 and one.intime == 8
    assert (four.death_obs, four.death_obs_time, four.hosp_death) == (1, 2940, 1)
    # Death at 2940 precedes discharge (outside follow-up): discharge is not observed.
    assert four.icu_dc == 0 and four.icu_dc_time is None


def test_standard_and_grid(built):
    names = {r.variable for r in built["standard"].select("variable").distinct().collect()}
    assert {"GCS", "niv", "hfnc", "stdo2"} <= names
    assert not names & {"GCS_eyes", "GCS_motor", "GCS_verbal", "o2_device"}
    scored = built["standard"].filter("variable = 'GCS'").select("stay_id", "time").collect()
    assert [tuple(r) for r in scored] == [(1, -20)]
    gaps = built["cells"].filter("value IS NULL").select("variable").distinct().collect()
    assert {r.variable for r in gaps} <= set(fixed.FIRST_PREDICTED)
    assert built["cells"].filter("value IS NULL AND time < 0").count() == 0


def test_carried_dataset(built):
    got = {(r.stay_id, round(r.time, 6), r.variable): r.value for r in built["carried"].collect()}
    assert got[(1, 0.0, "fio2")] == 80.0
    assert got[(1, 0.666667, "spo2")] == 88.0 and got[(4, 0.033333, "spo2")] == 95.0
    assert (1, 0.0, "spo2") not in got
    assert got[(1, 0.0, "resp_rate")] == pytest.approx(30.0) and got[(1, 2.333333, "resp_rate")] == pytest.approx(34.0)
    assert got[(1, 0.0, "pressor")] == 0.0
    assert min(k[1] for k in got) >= 0


def test_impute_and_outcomes(built):
    size = len(study.MODEL_ORDER)
    eye = [[float(i == j) for j in range(size)] for i in range(size)]
    gp = GaussianProcess(0.5, [1.0] * size, [0.3] * 9, [0.0] * 5, eye)
    observed, drawn = study.impute(built["cells"], built["mean_sd"], gp, draws=4)
    per_cell = drawn.groupBy("stay_id", "time", "variable").agg(F.count("*").alias("n"))
    assert per_cell.filter("n <> 4").count() == 0
    assert per_cell.count() == built["cells"].filter("value IS NULL").count()
    out = study.outcomes(observed, drawn, built["baseline"], draws=4)
    assert out.count() == 2 * 4 * 17
    met = {(r.threshold, r.met) for r in out.filter("stay_id = 1 AND threshold = 'SF120'").collect()}
    assert met == {("SF120", 1)}
    assert out.filter("met = 0 AND (hour IS NOT NULL OR followed IS NOT NULL)").count() == 0
    observed, lanes = study.impute(built["cells"], built["mean_sd"], gp, draws=4, lanes=True)
    assert lanes.filter("size(value) <> 4").count() == 0 and lanes.count() == per_cell.count()
    by_lane = study.outcomes(observed, lanes, built["baseline"], draws=4)
    assert sorted(map(str, by_lane.collect())) == sorted(map(str, out.collect()))


def test_reports(built):
    report = built["report"].collect()
    overall = {(r.variable, r.level): r.n for r in report if r.stratum == "Overall"}
    assert overall[("careunit", "Cardiac")] == 2
    assert overall[("agegroup", "60-69")] == 1 and overall[("agegroup", "80 or more")] == 1
    medians = {(r.stratum, r.variable): r.median for r in report if r.level is None}
    assert medians[("Overall", "spo2_bl")] == 92.0
    totals = built["states"].groupBy("time").agg(F.sum("n").alias("n")).collect()
    assert {r.n for r in totals} == {2}


def test_sample(built):
    picked = study.hyperparameter_sample(built["baseline"])
    assert sorted(r.id for r in picked.collect()) == [1, 2]
