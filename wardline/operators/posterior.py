"""Summaries of sampler draws: means, and the covariance behind Cholesky factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def posterior_mean(draws: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Mean over chains and iterations per parameter element."""
    return draws.groupBy(*by).agg(F.avg(value).alias("mean"))


def factor_cells(factor: str | Column, size: int, row_major: bool = True) -> Column:
    """Rows of a flat ``size x size`` factor stored in one array column, as an array of arrays."""
    factor = F.col(factor) if isinstance(factor, str) else factor
    if row_major:
        return F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.slice(factor, i * size + 1, size)
        )
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.element_at(factor, j * size + i + 1)
        ),
    )


def mean_covariance(
    draws: DataFrame, factor: str, size: int, cap: float = 1.0, row_major: bool = True
) -> DataFrame:
    """Mean over draws of ``L L'``, capped: ``(i, j, value)`` counted from 1.

    A draw is one row with its factor in an array, so the product is an expression on that
    row and only the ``size * size`` running means are shuffled.
    """
    rows = F.col("_rows")
    cells = F.flatten(
        F.transform(
            rows,
            lambda a, i: F.transform(
                rows,
                lambda b, j: F.struct(
                    (i + 1).alias("i"),
                    (j + 1).alias("j"),
                    F.aggregate(
                        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                        F.lit(0.0),
                        lambda acc, x: acc + x,
                    ).alias("v"),
                ),
            ),
        )
    )
    return (
        draws.withColumn("_rows", factor_cells(factor, size, row_major))
        .select(F.explode(cells).alias("_c"))
        .groupBy("_c.i", "_c.j")
        .agg(F.least(F.avg("_c.v"), F.lit(cap)).alias("value"))
    )


def labelled_triangle(matrix: DataFrame, order: Sequence[str], lower: bool = True) -> DataFrame:
    """Matrix cells with variable names and the other triangle blanked.

    The lower form keeps the diagonal and sets the upper cells to 0; the upper form is text
    to two decimals with the rest empty.
    """
    names = F.array(*[F.lit(n) for n in order])
    labelled = matrix.select(
        "i",
        "j",
        F.element_at(names, F.col("i")).alias("row"),
        F.element_at(names, F.col("j")).alias("column"),
        "value",
    )
    if lower:
        return labelled.withColumn(
            "value", F.when(F.col("i") < F.col("j"), F.lit(0.0)).otherwise(F.col("value"))
        )
    return labelled.withColumn(
        "value",
        F.when(F.col("i") >= F.col("j"), F.lit("")).otherwise(
            F.round("value", 2).cast("string")
        ),
    )
