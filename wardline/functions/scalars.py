"""Scalar helpers whose NULL and domain behaviour the studies rely on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def ratio(a: Column, b: Column) -> Column:
    """``a / b``; NULL, not an error, where ``b`` is zero."""
    return F.try_divide(a, b)


def logit(x: Column) -> Column:
    """Log-odds; NULL outside the open interval (0, 1)."""
    return F.ln(F.try_divide(x, F.lit(1.0) - x))


def inv_logit(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def half_even(x: Column, scale: int = 0) -> Column:
    """Rounding to even on ties (2.5 gives 2)."""
    return F.bround(x, scale)


def significant(x: Column, digits: int = 12) -> Column:
    """The nearest value with that many significant digits; 0, NaN and the ends of the range as they are."""
    unit = F.pow(F.lit(10.0), F.lit(float(digits - 1)) - F.floor(F.log10(F.abs(x))).cast("double"))
    return F.when(F.abs(x).between(1e-290, 1e290), F.rint(x * unit) / unit).otherwise(x)


def truthy(cond: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """1 where true, 0 where false or NULL."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def to_int(cond: Column) -> Column:
    """1/0 that keeps NULL as NULL."""
    return cond.cast("int")


def constant_for_null(x: Column, value) -> Column:
    return F.coalesce(x, F.lit(value))


def contains_any(text: Column, patterns: Iterable[str]) -> Column:
    """True where the text holds any of the literal substrings, tried in order."""
    out = None
    for p in dict.fromkeys(patterns):
        hit = text.contains(p)
        out = hit if out is None else out | hit
    return out
