"""State over time: look-back, ever-flags, on/off intervals and carry-forward."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from wardline.operators.blocks import Last, RunningSum, along_time


def lookback(
    df: DataFrame, by: Sequence[str], time: str, values: Mapping[str, tuple[str, float | None]], width: float
) -> DataFrame:
    """Last non-NULL value within a look-back: ``{out: (column, minutes or None)}``."""
    return along_time(
        df, by, time, [Last(out, c, within=w) for out, (c, w) in values.items()], width
    )


def locf(df: DataFrame, by: Sequence[str], time: str, columns: Sequence[str], width: float) -> DataFrame:
    """Carries the listed columns forward over NULLs, in time order."""
    order = df.columns
    return along_time(df, by, time, [Last(c, c) for c in columns], width).select(*order)


def on_off_events(
    intervals: DataFrame, keys: Sequence[str], channel: str, start: str, stop: str
) -> DataFrame:
    """Two rows per interval, ``(keys, channel, time, on, off)``; a missing end gives no row."""
    ends = F.array(
        F.struct(F.col(start).alias("time"), F.lit(1).alias("on"), F.lit(0).alias("off")),
        F.struct(F.col(stop).alias("time"), F.lit(0).alias("on"), F.lit(1).alias("off")),
    )
    return (
        intervals.select(*keys, channel, F.explode(ends).alias("_e"))
        .select(*keys, channel, "_e.*")
        .filter(F.col("time").isNotNull())
    )


def interval_state(
    events: DataFrame,
    by: Sequence[str],
    time: str,
    channel: str,
    channels: Sequence,
    width: float,
    out: str = "value",
) -> DataFrame:
    """1 while any channel is on, else 0, at every time a channel switches.

    At one instant a channel nets ``max(on) - max(off)``, so a stop and a new start cancel.
    Per channel the running net is on from 1 up and off from 0 down; a stop whose start lies
    outside the data drives it to -1, so the next start reads as off.
    """
    by = list(by)
    net = []
    for i, name in enumerate(channels):
        mine = F.col(channel) == F.lit(name)
        net.append(
            (F.max(F.when(mine, F.col("on"))) - F.max(F.when(mine, F.col("off")))).alias(f"_net{i}")
        )
    switches = events.groupBy(*by, time).agg(*net)
    running = along_time(
        switches, by, time, [RunningSum(f"_run{i}", f"_net{i}") for i in range(len(channels))], width
    )
    on = F.lit(False)
    for i in range(len(channels)):
        on = on | F.coalesce(F.col(f"_run{i}") >= 1, F.lit(False))
    return running.select(*by, time, F.when(on, F.lit(1)).otherwise(F.lit(0)).alias(out))


def signed_delta_state(
    events: DataFrame,
    by: Sequence[str],
    time: str,
    channel: str,
    channels: Sequence,
    delta: str,
    width: float,
    out: str = "value",
) -> DataFrame:
    """0/1 state from +1/-1 events: the net sign switches a channel, a net of zero keeps it.

    Each channel's last switch is carried forward in time order and the channels are
    combined by maximum. Times before the first switch give no row.
    """
    by = list(by)
    net = [
        F.sum(F.when(F.col(channel) == F.lit(name), F.col(delta))).alias(f"_net{i}")
        for i, name in enumerate(channels)
    ]
    switches = events.groupBy(*by, time).agg(*net)
    to = [
        F.when(F.col(f"_net{i}") > 0, F.lit(1)).when(F.col(f"_net{i}") < 0, F.lit(0)).alias(f"_to{i}")
        for i in range(len(channels))
    ]
    carried = along_time(
        switches.select(*by, time, *to),
        by,
        time,
        [Last(f"_is{i}", f"_to{i}") for i in range(len(channels))],
        width,
    )
    states = [F.col(f"_is{i}") for i in range(len(channels))]
    state = F.greatest(*states) if len(states) > 1 else states[0]
    return carried.select(*by, time, state.alias(out)).filter(F.col(out).isNotNull())


def cumulative_states(
    df: DataFrame, time: str, event: str, events: Sequence[str], width: float, rest: str
) -> DataFrame:
    """How many entities are in each state at every observed time, as long rows.

    ``df`` has one row per entity with the time and name of its end. Entities are counted
    per time first; the running totals then walk those counts in blocks. ``rest`` is the
    state of everyone without an event so far, those whose end is not known included.
    """
    per_time = df.groupBy(time).agg(
        F.count(F.lit(1)).alias("_all"),
        *[
            F.count(F.when(F.col(event) == name, F.lit(1))).alias(f"_n{i}")
            for i, name in enumerate(events)
        ],
    )
    running = along_time(
        per_time.filter(F.col(time).isNotNull()),
        [],
        time,
        [RunningSum(f"_c{i}", f"_n{i}") for i in range(len(events))],
        width,
    )
    left = per_time.agg(F.sum("_all")).scalar()
    for i in range(len(events)):
        left = left - F.col(f"_c{i}")
    cells = [
        F.struct(F.lit(name).alias("state"), F.col(f"_c{i}").alias("n"))
        for i, name in enumerate(events)
    ] + [F.struct(F.lit(rest).alias("state"), left.alias("n"))]
    return running.select(time, F.explode(F.array(*cells)).alias("_s")).select(time, "_s.*")
