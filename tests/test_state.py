"""Intervals, carry-forward, de-duplication, censoring and counts on hand-checked cases."""

import random

import pytest
from pyspark.sql import functions as F

from wardline.functions.timeaxis import minutes_between
from wardline.operators import longtable, pick, state, summary


def test_minute_boundaries(frame):
    df = frame([("2024-01-01 00:00:59", "2024-01-01 00:01:01"), ("2023-12-31 23:59:59", "2024-03-10 02:30:00")],
               "a string, b string").select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"])
    got = [r.m for r in df.select(minutes_between("b", "a").alias("m")).collect()]
    assert got == [1, (69 * 24 + 2) * 60 + 30 + 1 + 0]


def switches(frame, rows):
    return state.on_off_events(frame(rows, "e int, c string, a int, b int"), ["e"], "c", "a", "b")


def test_interval_state(frame, rows):
    ev = switches(frame, [(1, "x", 0, 60), (1, "x", 60, 90), (2, "x", None, 5), (2, "x", 20, None)])
    got = rows(state.interval_state(ev, ["e"], "time", "c", ["x", "y"], 25), "e", "time", "value")
    assert got == [(1, 0, 1), (1, 60, 1), (1, 90, 0), (2, 5, 0), (2, 20, 0)]


def test_interval_channels_are_ored(frame, rows):
    ev = switches(frame, [(1, "x", 0, 10), (1, "y", 5, 30)])
    got = rows(state.interval_state(ev, ["e"], "time", "c", ["x", "y"], 7), "time", "value")
    assert got == [(0, 1), (5, 1), (10, 1), (30, 0)]


def test_signed_delta(frame, rows):
    df = frame([(1, "x", 0, 1), (1, "x", 10, 1), (1, "x", 10, -1), (1, "y", 5, -1), (1, "x", 20, -1), (1, "x", 30, 1),
                (1, "x", 30, 1)], "e int, c string, t int, d int")
    got = rows(state.signed_delta_state(df, ["e"], "t", "c", ["x", "y"], "d", 8), "t", "value")
    assert got == [(0, 1), (5, 1), (10, 1), (20, 0), (30, 1)]


def test_locf_keeps_known_cells(frame):
    rng = random.Random(2)
    data = [(e, t, rng.choice([None, rng.random()])) for e in range(5) for t in range(30)]
    df = frame(data, "e int, t int, v double")
    got = {(r.e, r.t): r.v for r in state.locf(df, ["e"], "t", ["v"], 4).collect()}
    assert all(got[(e, t)] == v for e, t, v in data if v is not None)
    first = {e: min([t for k, t, v in data if k == e and v is not None]) for e in range(5)}
    assert all((got[(e, t)] is None) == (t < first[e]) for e, t, _ in data)


def test_composite_score(frame, rows):
    df = frame([(1, 0, "a", 4.0), (1, 0, "b", 5.0), (1, 0, "c", 6.0), (1, 9, "a", 4.0), (1, 9, "b", 5.0), (1, 9, "z", 1.0)],
               "e int, time int, variable string, value double")
    got = rows(longtable.replace_parts(df, ["e", "time"], ["a", "b", "c"], "s"), "time", "variable", "value")
    assert got == [(0, "s", 15.0), (9, "z", 1.0)]


def test_mixed_dedupe_and_idempotence(frame, rows):
    df = frame([(1, 0, "hr", 80.0), (1, 0, "hr", 90.0), (1, 0, "pr", 0.0), (1, 0, "pr", 1.0), (1, 0, "pr", None)],
               "e int, time int, variable string, value double")
    once = longtable.dedupe_mixed(df, ["e", "time", "variable"], ["hr"])
    assert rows(once, "variable", "value") == [("hr", 85.0), ("pr", 1.0)]
    assert rows(longtable.dedupe_mixed(once, ["e", "time", "variable"], ["hr"])) == rows(once)
    most = longtable.dedupe_max(df, ["e", "time", "variable"])
    assert rows(longtable.dedupe_max(most, ["e", "time", "variable"])) == rows(most)


@pytest.mark.parametrize(
    "given, want",
    [((1, 100, 1, 50), (0, None, 1, 50)), ((1, 50, 1, 50), (1, 50, 0, None)), ((1, 50, 0, None), (1, 50, 0, None)),
     ((0, None, 1, 70), (0, None, 1, 70))],
)
def test_reconcile(frame, given, want):
    df = frame([given], "d int, dt int, c int, ct int")
    assert tuple(longtable.reconcile_events(df, "d", "dt", "c", "ct").first()) == want


def test_censor_at_end(frame, rows):
    long = frame([(1, t, v, 0.0) for t, v in ((10, "hr"), (50, "hr"), (50, "death"), (60, "hr"))]
                 + [(2, 5, "hr", 0.0), (2, 80, "icu_dc", 1.0), (2, 81, "hr", 0.0), (3, 999, "hr", 0.0)],
                 "e int, time int, variable string, value double")
    ends = frame([(1, 1, 50, 0, None), (2, 0, None, 1, 80), (3, 0, None, 0, None)], "e int, d int, dt int, c int, ct int")
    got = rows(longtable.censor_at_end(long, ends, "e", "d", "dt", "c", "ct"), "e", "time", "variable")
    assert got == [(1, 10, "hr"), (1, 50, "death"), (2, 5, "hr"), (2, 80, "icu_dc"), (3, 999, "hr")]


def test_cumulative_states_add_up(frame):
    rng = random.Random(4)
    data = [(rng.randint(0, 50), rng.choice(["IMV", "DC", "Death", "None"])) for _ in range(200)]
    got = state.cumulative_states(frame(data, "t int, ev string"), "t", "ev", ["IMV", "DC", "Death"], 7, "rest").collect()
    by_time = {}
    for r in got:
        by_time.setdefault(r.t, {})[r.state] = r.n
    assert all(sum(v.values()) == 200 for v in by_time.values())
    for t, v in by_time.items():
        assert v["DC"] == sum(1 for a, k in data if k == "DC" and a <= t)


def test_attrition_never_grows(frame):
    df = frame([(i, None if i % 7 == 0 else i % 2, i % 3) for i in range(100)], "i int, a int, b int")
    got = summary.attrition(df, [("a", F.col("a") == 1), ("b", F.col("b") == 1)]).orderBy("step_no").collect()
    left = [r.remaining for r in got]
    assert left == sorted(left, reverse=True) and left[0] == 100
    assert left[-1] == df.filter("a = 1 AND b = 1").count()


def test_best_row_and_latest(frame, rows):
    df = frame([(1, 2, 5, "x"), (1, 1, 9, "y"), (1, 1, 3, "z"), (2, 7, 1, "w")], "g int, a int, b int, n string")
    assert rows(pick.best_row(df, ["g"], [F.col("a"), F.col("b")], ["n"])) == [(1, "z"), (2, "w")]
    long = frame([(1, -5, "hr", 80.0), (1, 0, "hr", None), (1, -1, "hr", 82.0), (1, 3, "hr", 99.0)],
                 "e int, time int, variable string, value double")
    assert pick.latest_at_index(long, "e", ["hr", "bp"]).first().asDict() == {"e": 1, "hr_bl": 82.0, "bp_bl": None}


def test_code_sets_match_exactly(frame):
    df = frame([(1, "E660"), (1, "I10"), (2, "E661")], "h int, c string")
    got = {r.h: (r.obese, r.family) for r in
           pick.code_set_flags(df, ["h"], "c", {"obese": ["E660%", "E661"]}, {"family": ["E66"]}).collect()}
    assert got == {1: (0, 1), 2: (1, 1)}


def test_cumulative_states_count_unknown_ends(frame, rows):
    """An entity without a known end stays in the rest; one with another end does too."""
    df = frame([(1, "IMV"), (3, "DC"), (None, None), (None, "DC"), (3, "other")], "t int, ev string")
    got = state.cumulative_states(df, "t", "ev", ["IMV", "DC"], 7, "rest")
    assert rows(got, "t", "state", "n") == [
        (1, "DC", 0), (1, "IMV", 1), (1, "rest", 4), (3, "DC", 1), (3, "IMV", 1), (3, "rest", 3),
    ]
