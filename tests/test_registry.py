"""Every registered query: agreement with its SQL on the smallest tables, and its plan."""

import os
import re

import pytest

import __spark_entry__ as entry
from registry import ORACLES, QUERIES
from tools.check_oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")
# Answers that are rightly empty on the smallest tables.
MAY_BE_EMPTY = {"first_event", "exclude_by_category"}
# Plans of these begin at tables they have just written; the rest are planned from the source.
WRITES = {"cohort_build", "carry_and_evaluate", "impute_and_evaluate", "written_results", "remaining_entities", "csv_report", "sampler_draws"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns[0] == "subject"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    problems = compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "EMPTY result"]
    assert not problems


# Queries whose joins go through ``keyed_join`` or ``join_where``.
SALTED = [
    "minute_axis", "epoch_minutes", "obs_window", "star_baseline", "left_join_constant", "semi_restrict",
    "resume_anti", "code_set_flags", "first_per_subject", "exclude_by_category", "asof_last",
    "nearest_in_window", "censor_first_event", "censor_at_end", "eligibility_index", "exact_quantiles",
    "followed_within", "outcomes_without_effort",
]


@pytest.mark.parametrize("name", SALTED)
def test_agrees_with_sql_without_broadcasts(spark, con, monkeypatch, name):
    """The path of tables too large to broadcast, with nearly every key split over salts."""
    from wardline.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_LIMIT", -1)
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 3)
    assert not [p for p in compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) if p != "EMPTY result"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_is_distributed(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
    # A window over a whole frame may only walk block summaries.
    for spec in re.findall(r"windowspecdefinition\((\w+#\d+L?) (?:ASC|DESC)", plan):
        assert spec.startswith(("_block", "_bucket")), spec
