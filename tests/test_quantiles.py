"""Exact quantiles, on the whole-group path and the bracketed one."""

import random

import numpy as np
import pytest

from wardline.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("accuracy", [20, 10_000])
@pytest.mark.parametrize("kind", ["spread", "ties", "heavy_tail"])
def test_against_numpy(spark, accuracy, kind):
    rng = random.Random(11)
    draw = {
        "spread": lambda: rng.gauss(0, 100),
        "ties": lambda: float(rng.randint(0, 4)),
        "heavy_tail": lambda: rng.paretovariate(0.3),
    }[kind]
    sizes = {"a": 1, "b": 2, "c": 7, "d": 500}
    data = [(g, draw()) for g, n in sizes.items() for _ in range(n)]
    got = exact_quantiles(spark.createDataFrame(data, "g string, v double"), ["g"], "v", PROBS, accuracy)
    found = {r.g: (r.n, r.q) for r in got.collect()}
    for g, n in sizes.items():
        values = [v for k, v in data if k == g]
        assert found[g][0] == n
        assert found[g][1] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-9, abs=1e-9)
