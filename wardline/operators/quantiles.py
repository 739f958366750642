"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wardline.operators.blocks import RunningSum, along_time
from wardline.operators.joins import keyed_join

ACCURACY = 10_000
# Edges that cut a bracket by rank, and even pieces between two of them.
INNER = 7
PIECES = 32


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Linearly interpolated quantiles, as an array ``q`` beside the count ``n``.

    The built-in exact percentile keeps every distinct value of a group in one buffer. Here
    a mergeable sketch of fixed size first brackets each quantile to about
    ``8 / accuracy`` of the ranks, with a guaranteed error bound; values below the bracket
    are only counted, and ranks are resolved among the counted values inside it.
    ``value`` is a double without NULL or NaN.
    """
    by = list(by)
    probs = [float(p) for p in probabilities]
    slack = 4.0 / accuracy
    steps = [slack * (2 * k / (INNER + 1) - 1) for k in range(INNER + 2)]
    edges = [min(max(p + d, 0.0), 1.0) for p in probs for d in steps]
    sketch = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.percentile_approx(value, edges, accuracy).alias("_e"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    # A group no larger than the accuracy is small enough to rank whole.
    whole = F.col("n") <= accuracy
    asked = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                ((F.col("n") - 1) * F.lit(p)).alias("rank"),
                F.when(whole | F.lit(p - slack <= 0), F.col("_min"))
                .otherwise(F.col("_e")[(INNER + 2) * i])
                .alias("from"),
                F.when(whole | F.lit(p + slack >= 1), F.col("_max"))
                .otherwise(F.col("_e")[(INNER + 2) * i + INNER + 1])
                .alias("to"),
                F.slice("_e", (INNER + 2) * i + 2, INNER).alias("inner"),
            )
            for i, p in enumerate(probs)
        ]
    )
    wanted = sketch.select(*by, "n", asked.alias("_asked"))
    counted = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    near = (
        keyed_join(counted, wanted, by, "inner", [value])
        .select(*by, "n", F.col(value).alias("_v"), "_c", F.explode("_asked").alias("_a"))
        .select(*by, "n", "_v", "_c", "_a.*")
        .filter(F.col("_v") <= F.col("to"))
    )
    below = near.groupBy(*by, "i").agg(
        F.coalesce(F.sum(F.when(F.col("_v") < F.col("from"), F.col("_c"))), F.lit(0)).alias("_below")
    )
    inside = near.filter(F.col("_v") >= F.col("from"))
    # A block is an even piece of the values between two neighbouring edges. The edges are ranks, so however the
    # values are spread a block holds no more of them than two edges enclose.
    part = F.size(F.filter("inner", lambda b: b <= F.col("_v")))
    low = F.get(F.concat(F.array("from"), "inner"), F.col("_part"))
    high = F.get(F.concat("inner", F.array("to")), F.col("_part"))
    place = F.coalesce(F.try_divide(F.col("_v") - low, high - low), F.lit(0.0))
    walked = along_time(
        inside.withColumn("_part", part).withColumn("_place", F.col("_part") * PIECES + F.floor(place * (PIECES - 1))).drop("inner", "_part"),
        [*by, "i"],
        "_v",
        [RunningSum("_upto", "_c")],
        block=F.col("_place"),
    )
    ranked = keyed_join(walked, below, [*by, "i"], "inner", ["_v"]).withColumn(
        "_upto", F.col("_upto") + F.col("_below")
    )
    low, high = F.floor("rank"), F.ceil("rank")
    ends = ranked.groupBy(*by, "i", "n", "rank").agg(
        F.min(F.when(F.col("_upto") > low, F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("_upto") > high, F.col("_v"))).alias("_hi"),
    )
    resolved = ends.withColumn(
        "_q", F.col("_lo") + (F.col("rank") - F.floor("rank")) * (F.col("_hi") - F.col("_lo"))
    )
    return resolved.groupBy(*by, "n").agg(
        *[F.max(F.when(F.col("i") == i, F.col("_q"))).alias(f"_q{i}") for i in range(len(probs))]
    ).select(*by, "n", F.array(*[F.col(f"_q{i}") for i in range(len(probs))]).alias("q"))
