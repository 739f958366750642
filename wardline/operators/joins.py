"""Joins that survive a hot key, and as-of joins that never form pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardline.operators.blocks import Last, Next, along_time

BROADCAST_LIMIT = 8 * 1024 * 1024
ROWS_PER_TASK = 5_000_000
# Rows with an unknown key match nothing; they are dealt out over this many salts.
UNKNOWN_SALTS = 1 << 16


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame: file sizes at the leaves, never reduced by filters."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def keyed_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    spread: Sequence[str] | None = None,
    limit: int | None = None,
    rows_per_task: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Equi-join of a long table to a narrower one, with any share of rows under one key.

    A right side whose planned size is within ``limit`` is broadcast, which no key can
    skew. Beyond it, keys of ``big`` with over ``rows_per_task`` rows are split: each gets
    ``ceil(rows / rows_per_task)`` salts, its rows are spread over them by a hash of
    ``spread`` (columns that tell rows of one key apart; default all) and of the partition a
    row comes from, so exact copies spread too and a repeated task salts its rows alike. The
    ``small`` rows of such a key are repeated once per salt. Rows of ``big`` with a NULL in the key meet
    nothing and are spread over all tasks by the same hash. The list of these keys has fewer
    than ``rows(big) / rows_per_task`` entries, which is what allows broadcasting it.

    ``bounded`` says that ``big`` has a limited number of rows per key by construction (one per
    minute, one per rule), so no key needs counting or salting.

    ``how``: inner, left, left_semi or left_anti, all from the side of ``big``.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    limit = BROADCAST_LIMIT if limit is None else limit
    rows_per_task = ROWS_PER_TASK if rows_per_task is None else rows_per_task
    if planned_bytes(small) <= limit:
        return big.join(F.broadcast(small), on, how)
    if bounded:
        return big.join(small, on, how)
    hot = F.broadcast(
        big.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select(*on, F.ceil(F.col("_n") / rows_per_task).cast("long").alias("_salts"))
    )
    apart = spread or [c for c in big.columns if c not in on] or on
    mixed = F.xxhash64(*apart, F.spark_partition_id())
    one = F.array(F.lit(0).cast("long"))
    unknown = F.lit(False)
    for key in on:
        unknown = unknown | F.col(key).isNull()
    salts = F.when(unknown, F.lit(UNKNOWN_SALTS).cast("long")).otherwise(F.coalesce("_salts", F.lit(1).cast("long")))
    salted = big.join(hot, on, "left").withColumn("_salt", F.pmod(mixed, salts))
    repeated = small.join(hot, on, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_salts").isNull(), one).otherwise(
                F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)
            )
        ),
    )
    return salted.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def restrict(df: DataFrame, ids: DataFrame, on, spread=None, **kw) -> DataFrame:
    """Rows whose entity is in ``ids``."""
    on = [on] if isinstance(on, str) else list(on)
    return keyed_join(df, ids.select(*on).distinct(), on, "left_semi", spread, **kw)


def exclude(df: DataFrame, ids: DataFrame, on, spread=None, **kw) -> DataFrame:
    """Rows whose entity is not in ``ids``."""
    on = [on] if isinstance(on, str) else list(on)
    return keyed_join(df, ids.select(*on).distinct(), on, "left_anti", spread, **kw)


def exclude_listed(df: DataFrame, on: str, ids: Sequence) -> DataFrame:
    """Rows whose entity is not on a short fixed list; a NULL entity is kept."""
    return df.filter(F.coalesce(~F.col(on).isin(list(ids)), F.lit(True))) if ids else df


def join_where(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | str,
    condition: Column,
    spread: Sequence[str] | None = None,
    limit: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Left join with a constant predicate on the right side: filter it first, then join.

    Where the filtered right side is too large to broadcast, its hot keys are the danger. It
    then leads an inner ``keyed_join``, and left rows without a partner are added back.
    """
    on = [on] if isinstance(on, str) else list(on)
    wanted = right.filter(condition)
    if planned_bytes(wanted) <= (BROADCAST_LIMIT if limit is None else limit):
        return left.join(F.broadcast(wanted), on, "left")
    columns = [*left.columns, *[c for c in wanted.columns if c not in on]]
    matched = keyed_join(wanted, left, on, "inner", spread, limit, rows_per_task).select(*columns)
    single = exclude(left, wanted, on, limit=limit, rows_per_task=rows_per_task)
    return matched.unionByName(single, allowMissingColumns=True)


def _timeline(left, right, by, left_time, right_time, columns):
    """One row per ``(by, time)`` of either side; ``_rec`` is the right record there, if any."""
    record = F.struct(*[F.col(c) for c in columns])
    asked = left.select(*by, F.col(left_time).alias("_at"), F.lit(1).alias("_ask"))
    known = right.select(*by, F.col(right_time).alias("_at"), record.alias("_rec"))
    return (
        asked.unionByName(known, allowMissingColumns=True)
        .filter(F.col("_at").isNotNull())
        .groupBy(*by, "_at")
        .agg(F.max("_ask").alias("_ask"), F.max("_rec").alias("_rec"))
    )


def _answer(left, answered, by, left_time, picked):
    answers = answered.filter(F.col("_ask") == 1).select(
        *by, F.col("_at").alias(left_time), *picked
    )
    return keyed_join(left, answers, [*by, left_time], "left")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    width: float,
    strict: bool = False,
    within: float | None = None,
    forward: bool = False,
    cut: Callable[[DataFrame], DataFrame] = lambda timeline: timeline,
) -> DataFrame:
    """The right record nearest before (or after) each left time, per entity.

    Both sides become one timeline with a row per ``(by, time)``, and the latest record is
    carried along it; no pair of rows is formed. Right records at one instant are reduced
    to the largest, so the result does not depend on row order. Left rows keep their
    columns and gain ``columns``, NULL where there is no record.

    The timeline is read by two passes that need different columns of it. Give ``cut`` a
    function that writes it and reads it back to scan long inputs once.
    """
    by = list(by)
    marks = cut(_timeline(left, right, by, left_time, right_time, columns))
    spec = (Next if forward else Last)("_hit", "_rec", within=within, strict=strict)
    answered = along_time(marks, by, "_at", [spec], width)
    return _answer(left, answered, by, left_time, [F.col("_hit")[c].alias(c) for c in columns])


def nearest_in_window(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    before: float,
    after: float,
    width: float,
    gap_out: str = "gap",
    cut: Callable[[DataFrame], DataFrame] = lambda timeline: timeline,
) -> DataFrame:
    """The right record closest in time, less than ``before`` back or ``after`` ahead.

    The closest record is either the latest at or before or the earliest at or after, so
    two carried columns decide it. An equal distance goes to the earlier record. ``gap_out``
    is the signed time from the left row to the record. ``cut`` is as for ``asof_join``.
    """
    by = list(by)
    marks = cut(_timeline(left, right, by, left_time, right_time, columns))
    answered = along_time(
        marks,
        by,
        "_at",
        [
            Last("_prev", "_rec", time_out="_prev_at"),
            Next("_next", "_rec", time_out="_next_at"),
        ],
        width,
    )
    back = F.when(F.col("_at") - F.col("_prev_at") < before, F.col("_at") - F.col("_prev_at"))
    ahead = F.when(F.col("_next_at") - F.col("_at") < after, F.col("_next_at") - F.col("_at"))
    use_back = back.isNotNull() & (ahead.isNull() | (back <= ahead))
    hit = F.when(use_back, F.col("_prev")).when(ahead.isNotNull(), F.col("_next"))
    gap = F.when(use_back, -back).when(ahead.isNotNull(), ahead)
    picked = answered.withColumn("_hit", hit).withColumn("_gap", gap)
    return _answer(
        left,
        picked,
        by,
        left_time,
        [F.col("_gap").alias(gap_out), *[F.col("_hit")[c].alias(c) for c in columns]],
    )
