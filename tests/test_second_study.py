"""Second study on a hand-written database, step by step."""

import pytest

from tests.second_database import tables
from wardline.operators.impute import GaussianProcess
from wardline.plans import second_study as study


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark)


@pytest.fixture(scope="module")
def built(t, tmp_path_factory):
    return study.build(t, folder=str(tmp_path_factory.mktemp("second")))


def test_oxygen_table(built):
    got = {(r.admissionid, r.chartminute): r for r in built["oxygen"].collect()}
    one = got[(1, 10.0)]
    assert one.o2_device == 17 and one.fio2 == pytest.approx(0.66)
    assert (one.lvalidated, one.nvalidated) == (True, True)
    room = got[(1, 200.0)]
    assert room.fio2 == 0.21 and (room.lvalidated, room.nvalidated) == (False, False)
    assert (1, 250.0) not in got
    assert got[(1, 2000.0)].o2_device == 20
    assert (got[(4, 30.0)].o2_device, got[(4, 30.0)].fio2) == (16, 60.0)
    assert got[(4, 40.0)].o2_device == 16 and (4, 41.0) not in got


def test_eligibility(built):
    got = {r.admissionid: r for r in built["eligible"].collect()}
    assert (got[1].eligibletime, got[1].o2_device, got[1].respiratory) == (10.0, 17, 1)
    assert got[3].operative == 1 and got[2].sepsis == 1
    assert (got[4].eligibletime, got[4].sepsis, got[4].goc) == (30.0, 1, 2)
    assert got[5].operative == 0 and got[5].diagnosis is None
    steps = {r.step: r.remaining for r in built["attrition"].collect()}
    assert steps["all"] == 5 and steps["not operative"] == 4


def test_preprocessing(t):
    gases = {r.chartminute: r for r in study.blood_gases(t).collect()}
    assert set(gases) == {20.0, -47.0}
    assert gases[20.0].po2 == pytest.approx(8 * 7.50061683)
    assert gases[20.0].pco2 == pytest.approx(6 * 7.50061683)
    assert gases[20.0].ph == 7.31 and gases[20.0].manual_entry is False and gases[-47.0].manual_entry is True
    ph = study.acidity(t).collect()
    assert [(r.value, r.time, r.manual_entry) for r in ph] == [(7.31, 20.0, True)]
    vitals = study.vital_signs(t)
    assert vitals.filter("item = 'mbp'").count() == 2  # the unvalidated one is gone
    goals = study.code_status(t).collect()
    assert [(r.admissionid, r.chartminute, r.valueid) for r in goals] == [(4, 60.0, 2)]


def test_long_and_clean(built):
    long = {(r.admissionid, r.chartminute, r.var): r.value for r in built["long"].collect()}
    assert long[(1, 90.0, "Noradrenaline (Norepinefrine)")] == 1.0
    assert long[(1, 290.0, "Noradrenaline (Norepinefrine)")] == -1.0
    assert (1, 190.0, "fio2") not in long
    assert 3 not in {k[0] for k in long}
    clean = {(r.admissionid, r.time, r.variable): r.value for r in built["clean"].collect()}
    assert {k[0] for k in clean} == {1, 4}  # second admission, operative and tracheostomy are out
    assert clean[(1, 0.0, "fio2")] == pytest.approx(66.0)
    assert clean[(1, 0.0, "stdo2")] == 1.0 and clean[(4, 0.0, "niv")] == 1.0
    assert (1, 40.0, "resp_rate") not in clean  # 90 per minute is implausible
    assert (1, 21.0, "mbp") not in clean
    pressor = {k[1]: v for k, v in clean.items() if k[2] == "pressor"}
    assert pressor == {90.0: 1.0, 190.0: 1.0, 290.0: 1.0, 390.0: 0.0}
    assert max(k[1] for k in clean) < 1990.0


def test_cells(built):
    cells = built["cells"].collect()
    assert all(r.time >= 0 or r.value is not None for r in cells)
    assert {r.variable for r in cells if r.value is None} <= {"resp_rate", "heart_rate", "spo2", "GCS"}
    carried = {(r.admissionid, round(r.time, 4), r.variable): r.value for r in built["carried"].collect()}
    assert carried[(1, 0.0, "spo2")] == 94.0 and carried[(1, 0.5, "spo2")] == 91.0
    assert carried[(1, 1.5, "pressor")] == 1.0


def test_impute_and_outcomes(built):
    size = len(study.MODEL_ORDER)
    eye = [[float(i == j) for j in range(size)] for i in range(size)]
    gp = GaussianProcess(0.5, [1.0] * size, [0.3] * 8, [0.0] * 3, eye)
    observed, drawn = study.impute(built["cells"], built["mean_sd"], gp, draws=3)
    out = study.outcomes(observed, drawn, built["entities"], draws=3)
    assert out.count() == 2 * 3 * 16
    assert out.filter("threshold = 'DeMontBauer'").count() == 0
    one = out.filter("admissionid = 1 AND threshold = 'Pressor'").collect()
    assert {(r.met, r.hour, r.fol48, r.followed) for r in one} == {(1, 1.5, 1, 0)}
    assert out.filter("admissionid = 4 AND met = 1 AND followed <> 0").count() == 0


def test_reports(built):
    report = {(r.stratum, r.variable, r.level): r for r in built["report"].collect()}
    assert report[("Overall", "sex", "1")].n == 1 and report[("NIV", "death28", "1")].n == 1
    assert report[("NRB", "fio2_bl", None)].median == pytest.approx(66.0)
    assert {r.variable for r in built["missing"].collect()} >= {"resp_rate", "GCS"}
    assert built["gaps"].filter("variable = 'GCS' AND gap > 0").count() == 1
