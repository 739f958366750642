"""Report tables: attrition, missingness, spacing, audits, counts and stratified summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardline.functions.scalars import truthy
from wardline.operators.quantiles import exact_quantiles

OVERALL = "Overall"


def unfold(row: DataFrame, keys: Sequence[str], cells: Mapping[str, Mapping[str, Column]], label: str):
    """Turns a wide summary into one row per label: ``{label value: {column: expression}}``."""
    structs = [
        F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in columns.items()])
        for name, columns in cells.items()
    ]
    return row.select(*keys, F.explode(F.array(*structs)).alias("_r")).select(*keys, "_r.*")


def attrition(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """How many rows pass each step in turn and how many it removes, in one pass.

    A condition that is NULL does not pass. Output: ``step_no, step, remaining, removed``.
    """
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("_c0")]
    for i, (_, cond) in enumerate(steps, start=1):
        passed = passed & truthy(cond)
        counts.append(F.count_if(passed).alias(f"_c{i}"))
    wide = df.agg(*counts)
    cells = [
        F.struct(
            F.lit(0).alias("step_no"),
            F.lit("all").alias("step"),
            F.col("_c0").alias("remaining"),
            F.lit(0).cast("long").alias("removed"),
        )
    ] + [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"_c{i}").alias("remaining"),
            (F.col(f"_c{i - 1}") - F.col(f"_c{i}")).alias("removed"),
        )
        for i, (name, _) in enumerate(steps, start=1)
    ]
    return wide.select(F.explode(F.array(*cells)).alias("_r")).select("_r.*")


def missingness(grid: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Missing cells, their share, and present cells per variable of a wide grid."""
    wide = grid.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count(v).alias(f"_{v}") for v in variables]
    )
    return unfold(
        wide,
        [],
        {
            v: {
                "missing": F.col("_all") - F.col(f"_{v}"),
                "missing_share": F.try_divide(F.col("_all") - F.col(f"_{v}"), F.col("_all")),
                "present": F.col(f"_{v}"),
            }
            for v in variables
        },
        "variable",
    )


def missing_cells(cells: DataFrame, variable="variable", value="value") -> DataFrame:
    """The same table from long cells in which missing ones are rows with a NULL value."""
    return cells.groupBy(variable).agg(
        F.count_if(F.col(value).isNull()).alias("missing"),
        F.avg(F.col(value).isNull().cast("int")).alias("missing_share"),
        F.count(value).alias("present"),
    )


def gap_between_observations(
    long: DataFrame, entity: str, variables: Sequence[str], time: str = "time"
) -> DataFrame:
    """Mean follow-up over mean count per variable, among entities with that variable."""
    per_entity = long.groupBy(entity).agg(
        F.max(time).alias("_end"),
        *[
            F.count(F.when(F.col("variable") == v, F.col("value"))).alias(f"_{v}")
            for v in variables
        ],
    )
    have = {v: F.col(f"_{v}") > 0 for v in variables}
    wide = per_entity.agg(
        *[F.avg(F.when(have[v], F.col("_end") + 1)).alias(f"e_{v}") for v in variables],
        *[F.avg(F.when(have[v], F.col(f"_{v}"))).alias(f"n_{v}") for v in variables],
    )
    return unfold(
        wide, [], {v: {"gap": F.try_divide(F.col(f"e_{v}"), F.col(f"n_{v}"))} for v in variables}, "variable"
    ).filter(F.col("gap").isNotNull())


def kind_counts(
    long: DataFrame, entity: str, continuous: Sequence[str], variable="variable", value="value"
) -> DataFrame:
    """Observed cells per entity: all, of continuous variables, of the rest."""
    is_cont = F.col(variable).isin(list(continuous))
    return (
        long.filter(F.col(value).isNotNull())
        .groupBy(entity)
        .agg(
            F.count(F.lit(1)).alias("n_all"),
            F.count_if(is_cont).alias("n_continuous"),
            F.count_if(~is_cont).alias("n_binary"),
        )
    )


def range_audit(long: DataFrame, variable="variable", value="value") -> DataFrame:
    return long.groupBy(variable).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def ever_share(long: DataFrame, entity: str, variables: Sequence[str]) -> DataFrame:
    """Per indicator variable: entities that ever showed it, their share, and entities measured."""
    per_entity = long.groupBy(entity).agg(
        *[F.max(F.when(F.col("variable") == v, F.col("value"))).alias(f"_{v}") for v in variables]
    )
    wide = per_entity.agg(
        *[F.sum(f"_{v}").alias(f"s_{v}") for v in variables],
        *[F.avg(f"_{v}").alias(f"m_{v}") for v in variables],
        *[F.count(f"_{v}").alias(f"n_{v}") for v in variables],
    )
    return unfold(
        wide,
        [],
        {
            v: {
                "ever": F.col(f"s_{v}"),
                "share": F.col(f"m_{v}"),
                "measured": F.col(f"n_{v}"),
            }
            for v in variables
        },
        "variable",
    )


def entities_per_category(
    df: DataFrame, categories: DataFrame, category: str, entity: str, out: str = "entities"
) -> DataFrame:
    """Distinct entities per category, with 0 for listed categories nobody has."""
    counted = df.groupBy(category).agg(F.count_distinct(entity).alias(out))
    return categories.select(category).join(counted, category, "left").withColumn(
        out, F.coalesce(F.col(out), F.lit(0).cast("long"))
    )


def stratified_summary(
    df: DataFrame,
    strata: str,
    categorical: Sequence[str],
    continuous: Sequence[str],
) -> DataFrame:
    """Counts with shares, and medians with quartiles, per stratum and overall.

    Output rows are ``(stratum, variable, level, n, share, median, q1, q3)``: one per level
    of each categorical variable (a missing value is the level ``NA``), and one per
    continuous variable with a NULL level and ``n`` non-missing values. Categorical cells are counted
    per stratum and the overall counts are added up from those. Quartiles interpolate
    linearly between order statistics.
    """
    stratum = F.coalesce(F.col(strata).cast("string"), F.lit("NA")).alias("stratum")
    with_overall = F.explode(F.array(F.col("stratum"), F.lit(OVERALL))).alias("stratum")

    cells = F.array(
        *[
            F.struct(
                F.lit(v).alias("variable"),
                F.coalesce(F.col(v).cast("string"), F.lit("NA")).alias("level"),
            )
            for v in categorical
        ]
    )
    counts = (
        df.select(stratum, F.explode(cells).alias("_c"))
        .groupBy("stratum", "_c.variable", "_c.level")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(with_overall, "variable", "level", "_n")
        .groupBy("stratum", "variable", "level")
        .agg(F.sum("_n").alias("n"))
    )
    sizes = (
        df.select(stratum)
        .groupBy("stratum")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(with_overall, "_n")
        .groupBy("stratum")
        .agg(F.sum("_n").alias("_size"))
    )
    missing = F.lit(None).cast("double")
    table = counts.join(sizes, "stratum").select(
        "stratum",
        "variable",
        "level",
        "n",
        F.try_divide(F.col("n"), F.col("_size")).alias("share"),
        missing.alias("median"),
        missing.alias("q1"),
        missing.alias("q3"),
    )
    if not continuous:
        return table
    values = F.array(
        *[
            F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value"))
            for v in continuous
        ]
    )
    long = (
        df.select(stratum, F.explode(values).alias("_c"))
        .select(with_overall, "_c.*")
        .filter(F.col("value").isNotNull())
    )
    quartiles = exact_quantiles(long, ["stratum", "variable"], "value", [0.25, 0.5, 0.75])
    spread = quartiles.join(sizes, "stratum").select(
        "stratum",
        "variable",
        F.lit(None).cast("string").alias("level"),
        "n",
        F.try_divide(F.col("n"), F.col("_size")).alias("share"),
        F.col("q")[1].alias("median"),
        F.col("q")[0].alias("q1"),
        F.col("q")[2].alias("q3"),
    )
    return table.unionByName(spread)
