"""Recoding driven by small configuration: code sets, concept tables, text classes, bins.

Configuration is ordinary Python data, so its size is fixed by whoever writes it and
never by the tables; that is the bound behind every ``broadcast`` in this module.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardline.functions.scalars import contains_any


@dataclass(frozen=True)
class Concept:
    """One source code and what it means.

    ``low``/``high`` limit the raw value (``low`` exclusive; ``high`` inclusive when
    ``high_closed``), and the stored value is ``raw * scale + offset``. ``text`` makes the
    concept match a charted text instead, which then stands for ``constant``.
    """

    code: object
    variable: str
    low: float | None = None
    high: float | None = None
    high_closed: bool = False
    scale: float = 1.0
    offset: float = 0.0
    text: str | None = None
    constant: float | None = None


def map_concepts(
    df: DataFrame,
    concepts: Sequence[Concept],
    code: str,
    value: str,
    text: str | None = None,
    variable_out: str = "variable",
    value_out: str = "value",
) -> DataFrame:
    """Codes to ``(variable, value)``; rows outside a concept's limits are dropped.

    Broadcast joins over the concept table replace a pair of CASE chains: numeric concepts
    by code, charted ones by code and text, each matching a row at most once. The code list
    also filters the scan.
    """
    spark, code_type = df.sparkSession, df.schema[code].dataType
    numeric = [c for c in concepts if c.text is None]
    charted = [c for c in concepts if c.text is not None]
    if len({c.code for c in numeric}) < len(numeric):
        raise ValueError("a code may stand for one numeric concept only")
    number = lambda x: None if x is None else float(x)
    table = spark.createDataFrame(
        [
            (c.code, c.variable, number(c.low), number(c.high), c.high_closed, float(c.scale), float(c.offset))
            for c in numeric
        ],
        T.StructType(
            [
                T.StructField(code, code_type),
                T.StructField("_variable", T.StringType()),
                T.StructField("_low", T.DoubleType()),
                T.StructField("_high", T.DoubleType()),
                T.StructField("_closed", T.BooleanType()),
                T.StructField("_scale", T.DoubleType()),
                T.StructField("_offset", T.DoubleType()),
            ]
        ),
    )
    raw = F.col(value).cast("double")
    in_range = (F.col("_low").isNull() | (raw > F.col("_low"))) & (
        F.col("_high").isNull() | (raw < F.col("_high")) | (F.col("_closed") & (raw == F.col("_high")))
    )
    name = F.col("_variable")
    mapped = F.when(in_range, raw * F.col("_scale") + F.col("_offset"))
    out = df.filter(F.col(code).isin(sorted({c.code for c in concepts})))
    out = out.join(F.broadcast(table), code, "left" if charted else "inner")
    if charted:
        if text is None:
            raise ValueError("charted concepts need the text column")
        signs = spark.createDataFrame(
            [(c.code, c.text, c.variable, number(c.constant)) for c in charted],
            T.StructType(
                [
                    T.StructField(code, code_type),
                    T.StructField(text, T.StringType()),
                    T.StructField("_sign_of", T.StringType()),
                    T.StructField("_sign", T.DoubleType()),
                ]
            ),
        )
        out = out.join(F.broadcast(signs), [code, text], "left")
        name, mapped = F.coalesce("_sign_of", name), F.coalesce("_sign", mapped)
    kept = [c for c in df.columns if c not in (variable_out, value_out)]
    return (
        out.withColumn("_mapped", mapped)
        .filter(F.col("_mapped").isNotNull())
        .select(*kept, name.alias(variable_out), F.col("_mapped").alias(value_out))
    )


def first_match(rules: Sequence[tuple[object, Mapping[str, Sequence]]], default=None) -> Column:
    """Ordered recode over several columns: the first rule with any column in its set wins."""
    out = None
    for result, sets in rules:
        cond = None
        for column, members in sets.items():
            hit = F.col(column).isin(list(members))
            cond = hit if cond is None else cond | hit
        out = F.when(cond, F.lit(result)) if out is None else out.when(cond, F.lit(result))
    return out.otherwise(F.lit(default))


def override(item: Column, items: Sequence, constant, otherwise: Column) -> Column:
    """``constant`` for the listed items, the other column for the rest."""
    return F.when(item.isin(list(items)), F.lit(constant)).otherwise(otherwise)


def text_class(
    df: DataFrame, text: str, classes: Sequence[tuple[str, Sequence[str]]], out: str
) -> DataFrame:
    """Adds the first class, in order, whose literal patterns occur in the lower-cased text.

    NULL where none do. The text is lowered once, in a projection of its own, and plain
    substring searches beat one alternation per class several times over on long texts.
    """
    low = F.col("_low")
    found = None
    for name, patterns in classes:
        cond = contains_any(low, patterns)
        found = F.when(cond, F.lit(name)) if found is None else found.when(cond, F.lit(name))
    return df.withColumn("_low", F.lower(text)).withColumn(out, found).drop("_low")


def diagnosis_flag(item: Column, text: Column, wanted: Mapping[object, str]) -> Column:
    """1 where the item's own LIKE pattern matches the lower-cased text, else 0."""
    out = None
    for code, pattern in wanted.items():
        cond = (item == F.lit(code)) & F.lower(text).like(pattern)
        out = F.when(cond, F.lit(1)) if out is None else out.when(cond, F.lit(1))
    return out.otherwise(F.lit(0))


def fraction_to_percent(x: Column, low: float, high: float = 1.0) -> Column:
    """Fractions become percent; other values stay."""
    return F.when((x >= low) & (x <= high), x * 100.0).otherwise(x)


def charted_percent(x: Column) -> Column:
    """A charted oxygen fraction: 0.20-1 is a fraction, 20-100 a percentage, the rest unusable."""
    return F.when((x >= 0.20) & (x <= 1), x * 100.0).when((x >= 20) & (x <= 100), x)


def percent_from_flow(
    flow: Column, device: Column, devices: Sequence[str], base=21.0, slope=3.0, typo_above=25.0
) -> Column:
    """Estimated percentage ``base + slope * flow`` on the listed devices.

    A flow over ``typo_above`` and up to 100 is a percentage typed into the flow field.
    Estimates over 100 are NULL.
    """
    listed = device.isin(list(devices))
    estimate = F.lit(base) + flow * slope
    return F.when(listed & (flow > typo_above) & (flow <= 100), flow).when(
        listed & (estimate <= 100), estimate
    )


def fraction_from_flow(
    flow: Column,
    device: Column,
    floored: Sequence[int],
    scaled: Sequence[int],
    room_air: Sequence[int],
    base=0.21,
    slope=0.03,
) -> Column:
    """Estimated fraction ``base + slope * flow`` clamped to ``[base, 1]``.

    ``floored`` devices only take part in the lower clamp, ``scaled`` devices in the upper
    clamp and the estimate, and ``room_air`` devices always read ``base``.
    """
    estimate = F.lit(base) + flow * slope
    return (
        F.when(device.isin(list(floored)) & (estimate < base), F.lit(base))
        .when(device.isin(list(scaled)) & (estimate > 1), F.lit(1.0))
        .when(device.isin(list(scaled)), estimate)
        .when(device.isin(list(room_air)), F.lit(base))
    )


def drop_out_of_range(
    df: DataFrame, limits: Mapping[str, tuple[float | None, float | None]], variable: str, value: str
) -> DataFrame:
    """Drops rows of a listed variable whose value lies outside its closed limits."""
    bad = F.lit(False)
    for name, (low, high) in limits.items():
        outside = F.lit(False)
        if low is not None:
            outside = outside | (F.col(value) < low)
        if high is not None:
            outside = outside | (F.col(value) > high)
        bad = bad | ((F.col(variable) == name) & outside)
    return df.filter(~F.coalesce(bad, F.lit(False)))


def bin_left_closed(x: Column, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open bin ``[breaks[i], breaks[i+1])``; NULL outside every bin."""
    if len(labels) != len(breaks) - 1:
        raise ValueError("one label per bin")
    out = None
    for low, high, label in zip(breaks, breaks[1:], labels):
        cond = (x >= low) & (x < high)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def bin_ordinal(x: Column, breaks: Sequence[float]) -> Column:
    """Position of the bin, from 1, so ordered labels sort as numbers."""
    out = None
    for k, (low, high) in enumerate(zip(breaks, breaks[1:]), start=1):
        cond = (x >= low) & (x < high)
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return out


def collapse_category(x: Column, groups: Mapping[str, Iterable], otherwise: str) -> Column:
    """Named groups of category values; NULL and unlisted values become ``otherwise``."""
    out = None
    for label, members in groups.items():
        cond = x.isin(list(members))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def any_present(*columns: Column) -> Column:
    """True where at least one column is not NULL."""
    out = columns[0].isNotNull()
    for c in columns[1:]:
        out = out | c.isNotNull()
    return out


def arterial_or_unknown(specimen: Column, pattern: str = "%art.%") -> Column:
    return specimen.ilike(pattern) | specimen.isNull()


def entered_by_hand(registered_by: Column, system_pattern: str = "%systeem%") -> Column:
    """True only for a named registrar that is not the automatic one."""
    return F.coalesce(~registered_by.ilike(system_pattern), F.lit(False))
