"""Long to wide and back, with a fixed list of variables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wardline.operators.state import locf


def to_grid(
    long: DataFrame,
    keys: Sequence[str],
    variables: Sequence[str],
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """One row per key and one column per listed variable, the largest value of duplicates.

    The list makes the schema static: a variable without any row is a column of NULLs, and
    no job is spent on finding the names. Conditional aggregates need one shuffle, where a
    pivot would aggregate twice.
    """
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col(variable) == v, F.col(value))).alias(v) for v in variables]
    )


def from_grid(
    grid: DataFrame,
    keys: Sequence[str],
    variables: Sequence[str],
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """One row per cell, NULL cells included."""
    return grid.unpivot(list(keys), list(variables), variable, value)


def guarantee_columns(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Adds the missing ones as NULL."""
    absent = [c for c in columns if c not in df.columns]
    return df.select("*", *[F.lit(None).cast(kind).alias(c) for c in absent])


def variable_index(long: DataFrame, order: Sequence[str], variable="variable", out="var") -> DataFrame:
    """Position of the variable in a fixed order, from 1; unlisted variables are NULL."""
    position = None
    for k, name in enumerate(order, start=1):
        cond = F.col(variable) == name
        position = F.when(cond, F.lit(k)) if position is None else position.when(cond, F.lit(k))
    return long.withColumn(out, position)


def one_hot(long: DataFrame, order: Sequence[str], variable="variable", prefix="is_") -> DataFrame:
    """A 0/1 column per variable."""
    return long.select(
        "*",
        *[
            F.when(F.col(variable) == v, F.lit(1)).otherwise(F.lit(0)).alias(f"{prefix}{v}")
            for v in order
        ],
    )


def carried_grid(
    long: DataFrame,
    entity: str,
    time: str,
    variables: Sequence[str],
    carried: Sequence[str],
    width: float,
    zero_filled: Sequence[str] = (),
) -> DataFrame:
    """Grid with the ``carried`` variables filled forward and ``zero_filled`` gaps set to 0."""
    grid = locf(to_grid(long, [entity, time], variables), [entity], time, carried, width)
    for name in zero_filled:
        grid = grid.withColumn(name, F.coalesce(F.col(name), F.lit(0.0)))
    return grid


def prediction_cells(
    grid: DataFrame,
    entity: str,
    time: str,
    variables: Sequence[str],
    wanted: Sequence[str],
    since: float = 0,
) -> DataFrame:
    """Empty cells of the wanted variables from ``since`` on: what imputation has to fill."""
    cells = from_grid(grid.select(entity, time, *variables), [entity, time], variables)
    return cells.filter(
        F.col("value").isNull() & F.col("variable").isin(list(wanted)) & (F.col(time) >= since)
    )


def observed_cells(grid: DataFrame, entity: str, time: str, variables: Sequence[str]) -> DataFrame:
    cells = from_grid(grid.select(entity, time, *variables), [entity, time], variables)
    return cells.filter(F.col("value").isNotNull())
