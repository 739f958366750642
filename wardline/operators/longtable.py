"""The long table ``(entity, time, variable, value)``: building, de-duplicating, censoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardline.operators.joins import keyed_join


def to_long(df: DataFrame, keys: Sequence, variable: str | Column, value: Column) -> DataFrame:
    """One source as long rows; NULL variables and values are dropped."""
    name = F.lit(variable) if isinstance(variable, str) else variable
    return df.select(
        *keys, name.alias("variable"), value.cast("double").alias("value")
    ).filter(F.col("variable").isNotNull() & F.col("value").isNotNull())


def stack_long(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Several columns of one source as long rows, from a single scan."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("variable"), c.cast("double").alias("value"))
            for name, c in columns.items()
        ]
    )
    return (
        df.select(*keys, F.explode(cells).alias("_cell"))
        .select(*keys, "_cell.*")
        .filter(F.col("value").isNotNull())
    )


def union_long(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def route(
    df: DataFrame, keys: Sequence[str], branches: Sequence[tuple[Column, Mapping[str, Column]]]
) -> DataFrame:
    """Several sources cut out of one table, stacked in one pass over it.

    Each branch is a condition and the columns it gives; a row goes to every branch whose condition is true, with NULL in
    the other branches' columns. Equal to ``union_long`` of one filter per branch, but the
    table is scanned once however many branches there are.
    """
    names = list(dict.fromkeys(n for _, columns in branches for n in columns))
    rows = [
        F.when(condition, F.struct(*[columns.get(n, F.lit(None)).alias(n) for n in names]))
        for condition, columns in branches
    ]
    return df.select(*keys, F.explode(F.array_compact(F.array(*rows))).alias("_r")).select(*keys, "_r.*")


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_long(frames).distinct()


def collapse(df: DataFrame, keys: Sequence[str], how: Mapping[str, Column]) -> DataFrame:
    """One row per key; combined on the map side, so a hot key costs one row per map task."""
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in how.items()])


def dedupe_max(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Largest value per key."""
    return long.groupBy(*keys).agg(F.max(value).alias(value))


def dedupe_mixed(
    long: DataFrame, keys: Sequence[str], continuous: Sequence[str], variable="variable", value="value"
) -> DataFrame:
    """Mean of the duplicates for continuous variables, maximum for the others."""
    return (
        long.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.avg(value).alias("_mean"), F.max(value).alias("_max"))
        .withColumn(
            value,
            F.when(F.col(variable).isin(list(continuous)), F.col("_mean")).otherwise(F.col("_max")),
        )
        .drop("_mean", "_max")
    )


def composite_score(
    long: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str],
    name: str,
    variable="variable",
    value="value",
) -> DataFrame:
    """Sum of the part scores, only at times where every part was scored."""
    return (
        long.filter(F.col(variable).isin(list(parts)))
        .groupBy(*keys)
        .agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == len(parts))
        .select(*keys, F.lit(name).alias(variable), value)
    )


def replace_parts(long, keys, parts, name, variable="variable", value="value") -> DataFrame:
    """The long table with the parts replaced by their composite."""
    score = composite_score(long, keys, parts, name, variable, value)
    rest = long.filter(~F.col(variable).isin(list(parts)))
    return rest.unionByName(score.select(*rest.columns))


def indicators(
    long: DataFrame,
    category: str,
    levels: Mapping[str, Sequence],
    variable="variable",
    value="value",
) -> DataFrame:
    """A category variable as one 0/1 series per named set of levels; other rows are kept."""
    marks = F.array(
        *[
            F.struct(
                F.lit(name).alias("n"),
                F.when(F.col(value).isin(list(members)), F.lit(1.0)).otherwise(F.lit(0.0)).alias("v"),
            )
            for name, members in levels.items()
        ]
    )
    itself = F.array(F.struct(F.col(variable).alias("n"), F.col(value).cast("double").alias("v")))
    is_category = F.coalesce(F.col(variable) == category, F.lit(False))
    kept = [c for c in long.columns if c not in (variable, value)]
    return long.withColumn("_m", F.explode(F.when(is_category, marks).otherwise(itself))).select(
        *kept, F.col("_m.n").alias(variable), F.col("_m.v").alias(value)
    )


def first_event_time(
    long: DataFrame, entity: str, variable_is: str, value_is, time="time", out="event_time"
) -> DataFrame:
    """Earliest time the variable takes the value, per entity."""
    hit = (F.col("variable") == variable_is) & (F.col("value") == value_is)
    return long.filter(hit).groupBy(entity).agg(F.min(time).alias(out))


def censor_at_first(
    long: DataFrame,
    events: DataFrame,
    entity: str,
    event_time: str,
    time: str = "time",
    keep_event_row: bool = False,
    ever: str | None = None,
    spread=None,
) -> DataFrame:
    """Rows before an entity's first event (or up to it); all rows of entities without one.

    With ``ever``, that column being 0 says there was no event; otherwise a NULL time does.
    """
    columns = [entity, event_time] + ([ever] if ever else [])
    joined = keyed_join(long, events.select(*columns), entity, "left", spread)
    early = (
        F.col(time) <= F.col(event_time) if keep_event_row else F.col(time) < F.col(event_time)
    )
    none = (F.col(ever) == 0) if ever else F.col(event_time).isNull()
    extra = [c for c in columns if c != entity and c not in long.columns]
    return joined.filter(none | early).drop(*extra)


def reconcile_events(
    df: DataFrame, first: str, first_time: str, second: str, second_time: str
) -> DataFrame:
    """Two competing end events: the earlier one stands, the other's flag and time are cleared.

    A tie goes to ``first``. The flag of ``second`` is judged against the already updated
    flag of ``first``, and each time is cleared where the other event stands.
    """
    both = (F.col(first) == 1) & (F.col(second) == 1)
    updated = df.withColumn(
        first,
        F.when(both & (F.col(first_time) > F.col(second_time)), F.lit(0)).otherwise(F.col(first)),
    )
    updated = updated.withColumn(
        second,
        F.when(both & (F.col(first_time) <= F.col(second_time)), F.lit(0)).otherwise(F.col(second)),
    )
    none = F.lit(None)
    return updated.withColumn(
        first_time, F.when(F.col(second) == 1, none).otherwise(F.col(first_time))
    ).withColumn(second_time, F.when(F.col(first) == 1, none).otherwise(F.col(second_time)))


def censor_at_end(
    long: DataFrame,
    ends: DataFrame,
    entity: str,
    first: str,
    first_time: str,
    second: str,
    second_time: str,
    time: str = "time",
    first_variable: str = "death",
    spread=None,
) -> DataFrame:
    """Rows up to the entity's end event, and at the first event's own minute only its own row."""
    columns = [first, first_time, second, second_time]
    joined = keyed_join(long, ends.select(entity, *columns), entity, "left", spread)
    t = F.col(time)
    open_ended = (F.col(first) == 0) & (F.col(second) == 0)
    in_time = (
        open_ended
        | ((F.col(first) == 1) & (t <= F.col(first_time)))
        | ((F.col(second) == 1) & (t <= F.col(second_time)))
    )
    simultaneous = (
        (F.col(first) == 1) & (t == F.col(first_time)) & (F.col("variable") != first_variable)
    )
    return joined.filter(in_time).filter(~simultaneous).drop(*columns)
