"""One row per group by a total order, and other choices that need no window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardline.operators.joins import keyed_join


def best_row(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], columns: Sequence[str | Column]
) -> DataFrame:
    """The row smallest in ``order``, ties settled by the chosen columns themselves.

    An aggregate instead of ``row_number() = 1``: each map task keeps one candidate per
    group, so a group of any size shuffles as a handful of rows. NULL sorts first; give
    descending keys negated.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    row = F.struct(key.alias("k"), F.struct(*columns).alias("r"))
    return df.groupBy(*by).agg(F.min(row).alias("_b")).select(*by, "_b.r.*")


def first_of_subject(
    df: DataFrame, subject: str, order: str, spread: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose ``order`` is the subject's smallest (all of them when tied)."""
    least = df.groupBy(subject).agg(F.min(order).alias(order))
    return keyed_join(df, least, [subject, order], "left_semi", spread)


def repeated(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def latest_at_index(
    long: DataFrame,
    entity: str,
    variables: Sequence[str],
    time: str = "time",
    suffix: str = "_bl",
    at: float = 0,
) -> DataFrame:
    """Each variable's latest value at or before the index time, one row per entity."""
    picked = [
        F.max_by(
            F.when(F.col("variable") == v, F.col("value")),
            F.when((F.col("variable") == v) & F.col("value").isNotNull(), F.col(time)),
        ).alias(f"{v}{suffix}")
        for v in variables
    ]
    return long.filter(F.col(time) <= at).groupBy(entity).agg(*picked)


def ever_flags(df: DataFrame, by: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """1 per group where the condition ever held, else 0."""
    return df.groupBy(*by).agg(
        *[F.max(F.when(c, F.lit(1)).otherwise(F.lit(0))).alias(n) for n, c in flags.items()]
    )


def code_set_flags(
    df: DataFrame,
    by: Sequence[str],
    code: str,
    sets: Mapping[str, Sequence[str]],
    prefixes: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One 0/1 column per named code set, over all rows of the group.

    Codes match exactly; ``prefixes`` adds code families. A group without any listed code
    still gets its row of zeros.
    """
    prefixes = prefixes or {}
    flags = {}
    for name in dict.fromkeys([*sets, *prefixes]):
        cond = F.lit(False)
        if sets.get(name):
            cond = cond | F.col(code).isin(list(sets[name]))
        for p in prefixes.get(name, ()):
            cond = cond | F.col(code).startswith(p)
        flags[name] = cond
    return ever_flags(df, by, flags)
