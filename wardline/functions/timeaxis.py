"""Time as a number of minutes, hours or days on an entity's own axis."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MINUTES_PER_DAY = 1440
MS_PER_MINUTE = 60_000


def minute_number(ts: Column | str) -> Column:
    """Whole minutes since 1970-01-01 00:00, read off the wall clock.

    Built from the calendar fields, so a ``timestamp_ntz`` needs no time zone and
    the subtraction of two results counts the minute *boundaries* between them
    (00:00:59 to 00:01:01 is one minute), not elapsed whole minutes.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * MINUTES_PER_DAY + F.hour(ts) * 60 + F.minute(ts)


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """Minute boundaries crossed from ``earlier`` to ``later``."""
    return minute_number(later) - minute_number(earlier)


def minutes_from_ms(at: Column | str, origin: Column | str) -> Column:
    """Fractional minutes between two epoch-millisecond columns."""
    at = F.col(at) if isinstance(at, str) else at
    origin = F.col(origin) if isinstance(origin, str) else origin
    return (at - origin).cast("double") / F.lit(float(MS_PER_MINUTE))


def between(time: Column, after=None, before=None, *, from_=None, to=None) -> Column:
    """Observation window: ``after``/``before`` are exclusive, ``from_``/``to`` inclusive."""
    cond = F.lit(True)
    if after is not None:
        cond = cond & (time > after)
    if from_ is not None:
        cond = cond & (time >= from_)
    if before is not None:
        cond = cond & (time < before)
    if to is not None:
        cond = cond & (time <= to)
    return cond


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(ts)
