"""Observation spine: every ``(entity, time)`` any source observed, with the sources aligned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardline.operators.longtable import union_long


def spine(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys over all sources."""
    return union_long([s.select(*keys) for s in sources]).distinct()


def align(sources: Sequence[DataFrame], keys: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """Sources side by side on their common keys, without joining them.

    The sources are stacked with NULLs for each other's columns and reduced by one grouped
    aggregate. A key with many rows in several sources never multiplies into their product,
    and the whole alignment is one shuffle of partial aggregates instead of a distinct
    followed by one join per source.
    """
    return union_long(list(sources)).groupBy(*keys).agg(*columns)


def product_mean(
    charted: str, charted_rows: str, other: str, other_rows: str, unmarked_rows: str
) -> Column:
    """Mean of ``charted else other`` over the row product two left joins would have formed.

    ``charted`` and ``other`` are columns with one value per source row. In the product
    each charted row meets every row of the other source, and each other row meets every
    uncharted row of the first source, so the mean needs only per-key sums and counts.
    ``charted_rows`` counts rows of the first source that are charted (usable or not),
    ``unmarked_rows`` its remaining rows, ``other_rows`` the rows of the other source. A
    source without rows at the key takes part as one empty row.
    """
    other_weight = F.greatest(F.col(other_rows), F.lit(1))
    unmarked = F.when(
        F.col(charted_rows) + F.col(unmarked_rows) == 0, F.lit(1)
    ).otherwise(F.col(unmarked_rows))
    total = F.coalesce(F.col(f"{charted}_sum"), F.lit(0.0)) * other_weight + F.coalesce(
        F.col(f"{other}_sum"), F.lit(0.0)
    ) * unmarked
    rows = F.col(f"{charted}_n") * other_weight + F.col(f"{other}_n") * unmarked
    return F.try_divide(total, rows)


def prefer_mean(first: str, second: str) -> Column:
    """Mean of the first source, or of the second where the first has no value."""
    return F.coalesce(
        F.try_divide(F.col(f"{first}_sum"), F.col(f"{first}_n")),
        F.try_divide(F.col(f"{second}_sum"), F.col(f"{second}_n")),
    )


def sum_and_count(name: str, value: Column) -> list[Column]:
    """The two partial columns ``product_mean`` and ``prefer_mean`` read."""
    return [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
