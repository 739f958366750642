"""Running values along each entity's time axis, safe for one huge entity.

A window partitioned by entity alone sends a whole entity to one task. Here the axis is
cut into blocks of fixed width, and three bounded steps give the same result:

1. every ``(entity, block)`` is reduced to one summary row (combined on the map side);
2. the summaries of an entity, one row per block it touches, carry state from block to block;
3. rows read their block's carried state and finish inside ``(entity, block)``.

With one row per ``(entity, time)`` - collapse first, see ``longtable.collapse`` - step 3
holds at most ``width / resolution`` rows of any entity and step 2 at most
``range / width``, whatever share of all rows the entity owns. Both bounds come from
the time axis and not from the amount of data.

Rows without time stand first on their entity's axis, as in a window ordered by time, in a block of
their own: unbounded frames of later rows include them, frames of fixed reach do not, and on
such a row itself a frame of fixed reach holds that row alone. Rows without entity share one axis, as in
a window partitioned by entity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

BLOCK = "_block"
# The block of rows without time, before all others.
BEFORE_ALL = -(1 << 63)
# Values that stand for NULL in a key, beside a flag; other types take the text 0.
_STAND_IN = {"string": "", "boolean": "false", "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}
_START = Window.unboundedPreceding
_END = Window.unboundedFollowing


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _alone(time: str, p: str, value: Column) -> Column:
    """What a frame of fixed reach gives: on a row without time, that of its own block."""
    return F.when(F.col(time).isNull(), F.col(p + "lv")).otherwise(value)


@dataclass(frozen=True)
class _Frames:
    """The windows a spec may use: over block summaries, and over rows of one block."""

    before: WindowSpec
    after: WindowSpec
    whole: WindowSpec
    ordered: WindowSpec
    up: WindowSpec
    down: WindowSpec


@dataclass(frozen=True)
class Last:
    """Latest non-NULL value at or before the row's time, optionally only ``within`` of it.

    ``strict`` excludes the row itself. ``time_out`` names a column for the time the value
    came from.
    """

    out: str
    value: object
    within: float | None = None
    strict: bool = False
    time_out: str | None = None

    @property
    def _timed(self):
        return self.within is not None or self.time_out is not None

    def summary(self, time, p):
        known = _col(self.value).isNotNull()
        out = [F.max_by(_col(self.value), F.when(known, F.struct(time))).alias(p + "v")]
        return out + ([F.max(F.when(known, F.col(time))).alias(p + "t")] if self._timed else [])

    def carried(self, p, f):
        parts = "vt" if self._timed else "v"
        return [F.last(p + x, True).over(f.before).alias(p + x) for x in parts]

    def local(self, time, p, f):
        frame = f.up.rowsBetween(_START, -1 if self.strict else 0)
        at = F.when(_col(self.value).isNotNull(), F.col(time))
        out = [F.last(_col(self.value), True).over(frame).alias(p + "lv")]
        return out + ([F.last(at, True).over(frame).alias(p + "lt")] if self._timed else [])

    def result(self, time, p):
        value = F.coalesce(F.col(p + "lv"), F.col(p + "v"))
        if not self._timed:
            return [value.alias(self.out)]
        at = F.coalesce(F.col(p + "lt"), F.col(p + "t"))
        if self.within is not None:
            near = at >= F.col(time) - F.lit(self.within)
            value, at = _alone(time, p, F.when(near, value)), F.when(near, at)
        out = [value.alias(self.out)]
        return out + ([at.alias(self.time_out)] if self.time_out else [])


@dataclass(frozen=True)
class Next:
    """Earliest non-NULL value at or after the row's time, optionally only ``within`` of it."""

    out: str
    value: object
    within: float | None = None
    strict: bool = False
    time_out: str | None = None

    @property
    def _timed(self):
        return self.within is not None or self.time_out is not None

    def summary(self, time, p):
        known = _col(self.value).isNotNull()
        out = [F.min_by(_col(self.value), F.when(known, F.struct(time))).alias(p + "v")]
        return out + ([F.min(F.when(known, F.col(time))).alias(p + "t")] if self._timed else [])

    def carried(self, p, f):
        parts = "vt" if self._timed else "v"
        return [F.last(p + x, True).over(f.after).alias(p + x) for x in parts]

    def local(self, time, p, f):
        frame = f.down.rowsBetween(_START, -1 if self.strict else 0)
        at = F.when(_col(self.value).isNotNull(), F.col(time))
        out = [F.last(_col(self.value), True).over(frame).alias(p + "lv")]
        return out + ([F.last(at, True).over(frame).alias(p + "lt")] if self._timed else [])

    def result(self, time, p):
        value = F.coalesce(F.col(p + "lv"), F.col(p + "v"))
        if not self._timed:
            return [value.alias(self.out)]
        at = F.coalesce(F.col(p + "lt"), F.col(p + "t"))
        if self.within is not None:
            near = at <= F.col(time) + F.lit(self.within)
            value, at = _alone(time, p, F.when(near, value)), F.when(near, at)
        out = [value.alias(self.out)]
        return out + ([at.alias(self.time_out)] if self.time_out else [])


@dataclass(frozen=True)
class RunningMax:
    """Largest value at or before the row's time."""

    out: str
    value: object

    def summary(self, time, p):
        return [F.max(_col(self.value)).alias(p + "v")]

    def carried(self, p, f):
        return [F.max(p + "v").over(f.before).alias(p + "v")]

    def local(self, time, p, f):
        return [F.max(_col(self.value)).over(f.up.rowsBetween(_START, 0)).alias(p + "lv")]

    def result(self, time, p):
        return [F.greatest(F.col(p + "lv"), F.col(p + "v")).alias(self.out)]


@dataclass(frozen=True)
class EarlierBits:
    """Bits set in a whole number on any row before the row's time; 0 where there is none."""

    out: str
    value: object

    def summary(self, time, p):
        return [F.bit_or(_col(self.value)).alias(p + "v")]

    def carried(self, p, f):
        return [F.bit_or(F.col(p + "v")).over(f.before).alias(p + "v")]

    def local(self, time, p, f):
        return [F.bit_or(_col(self.value)).over(f.up.rowsBetween(_START, -1)).alias(p + "lv")]

    def result(self, time, p):
        none = F.lit(0).cast("long")
        return [F.coalesce(F.col(p + "lv"), none).bitwiseOR(F.coalesce(F.col(p + "v"), none)).alias(self.out)]


@dataclass(frozen=True)
class RunningSum:
    """Sum of the values at or before the row's time; NULL until there is one."""

    out: str
    value: object

    def summary(self, time, p):
        return [F.sum(_col(self.value)).alias(p + "v")]

    def carried(self, p, f):
        return [F.sum(p + "v").over(f.before).alias(p + "v")]

    def local(self, time, p, f):
        return [F.sum(_col(self.value)).over(f.up.rowsBetween(_START, 0)).alias(p + "lv")]

    def result(self, time, p):
        here, before = F.col(p + "lv"), F.col(p + "v")
        return [
            F.when(here.isNotNull() & before.isNotNull(), here + before)
            .otherwise(F.coalesce(here, before))
            .alias(self.out)
        ]


@dataclass(frozen=True)
class EverBy:
    """Running maximum of a 0/1 flag over everything up to ``slack`` after the row's time.

    Read off two numbers per entity, the first time the flag is 1 and the first time it is
    known, so a frame that reaches into later rows needs no sort at all.
    """

    out: str
    flag: object
    slack: float = 0

    def summary(self, time, p):
        flag = _col(self.flag)
        return [
            F.min(F.when(flag == 1, F.col(time))).alias(p + "on"),
            F.min(F.when(flag.isNotNull(), F.col(time))).alias(p + "known"),
            F.max(F.when(F.col(time).isNull(), (flag == 1).cast("int"))).alias(p + "first"),
        ]

    def carried(self, p, f):
        known = [F.min(p + x).over(f.whole).alias(p + x) for x in ("on", "known")]
        return known + [F.max(p + "first").over(f.whole).alias(p + "first")]

    def local(self, time, p, f):
        return []

    def result(self, time, p):
        limit, first = F.col(time) + F.lit(self.slack), F.col(p + "first")
        return [
            F.when((F.col(p + "on") <= limit) | (first == 1), F.lit(1))
            .when((F.col(p + "known") <= limit) | (first == 0), F.lit(0))
            .alias(self.out)
        ]


@dataclass(frozen=True)
class Whole:
    """Maximum, minimum or sum over the entity's whole axis."""

    out: str
    value: object
    how: str = "max"

    def summary(self, time, p):
        return [getattr(F, self.how)(_col(self.value)).alias(p + "v")]

    def carried(self, p, f):
        return [getattr(F, self.how)(F.col(p + "v")).over(f.whole).alias(p + "v")]

    def local(self, time, p, f):
        return []

    def result(self, time, p):
        return [F.col(p + "v").alias(self.out)]


@dataclass(frozen=True)
class FirstRow:
    """The value on the entity's earliest row, NULL included."""

    out: str
    value: object

    def summary(self, time, p):
        return [F.min_by(_col(self.value), F.struct(time)).alias(p + "v")]

    def carried(self, p, f):
        return [F.first(p + "v").over(f.ordered.rowsBetween(_START, _END)).alias(p + "v")]

    def local(self, time, p, f):
        return []

    def result(self, time, p):
        return [F.col(p + "v").alias(self.out)]


def along_time(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    specs: Sequence,
    width: float | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Adds one column (or two) per spec; see the module docstring for the method.

    ``df`` holds at most one row per ``(by, time)``, and ``width`` is in the unit of ``time``;
    rows with an unknown entity or time come back with what a window gives them. All specs share the same shuffle and the same summaries. With no
    ``by`` the whole frame is one axis. ``block`` replaces the equal widths by any integer
    column that never decreases with ``time``.

    ``df`` is read by two passes, summaries and rows. They share its last exchange as long as
    both need the same columns and rows of it. Where the caller goes on to drop columns or
    filter the result, Catalyst carries that into the rows pass alone and the source is read
    twice: write a costly ``df`` first (``sources.tables.materialise``).
    """
    if block is None:
        block = F.floor(F.col(time) / F.lit(width))
    # Keys without NULL: the join below then needs no filter that its row side alone would get,
    # so both sides share one exchange, and rows without entity or time meet their summaries too.
    known = {BLOCK: F.coalesce(block.cast("long"), F.lit(BEFORE_ALL))}
    for i, name in enumerate(by):
        field = df.schema[name]
        if field.nullable:
            known[f"_by{i}"] = F.coalesce(F.col(name), F.lit(_STAND_IN.get(field.dataType.typeName(), "0")).cast(field.dataType))
            known[f"_no{i}"] = F.col(name).isNull()
        else:
            known[f"_by{i}"] = F.col(name)
    rows = df.withColumns(known)
    by = [k for k in known if k != BLOCK]
    keys = by + [BLOCK]
    tags = [(f"_s{i}", s) for i, s in enumerate(specs)]
    entity = Window.partitionBy(*by)
    within_block = Window.partitionBy(*keys)
    f = _Frames(
        before=entity.orderBy(BLOCK).rowsBetween(_START, -1),
        after=entity.orderBy(F.col(BLOCK).desc()).rowsBetween(_START, -1),
        whole=entity.rowsBetween(_START, _END),
        ordered=entity.orderBy(BLOCK),
        up=within_block.orderBy(time),
        down=within_block.orderBy(F.col(time).desc()),
    )
    summaries = rows.groupBy(*keys).agg(*[c for p, s in tags for c in s.summary(time, p)])
    carried = summaries.select(*keys, *[c for p, s in tags for c in s.carried(p, f)])
    finished = rows.join(carried, keys).select(
        "*", *[c for p, s in tags for c in s.local(time, p, f)]
    )
    replaced = {name for _, s in tags for name in (s.out, getattr(s, "time_out", None))}
    kept = [c for c in df.columns if c not in replaced]
    return finished.select(*kept, *[c for p, s in tags for c in s.result(time, p)])
