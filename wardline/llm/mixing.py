"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.llm.common import WORD, ROW_KEY, ranked, same_row, with_row_key
from wardline.sources.tables import materialise

# Steps of the random offset; a small power of two keeps sums with it exact.
OFFSETS = 1 << 20


def word_count(text: str = "text") -> Column:
    """Words of a text, 0 for a null one."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``(source, source_size)`` with ``target``: the size each source should have in the mix.

    Sources stand in code point order, null last, and take the weights in turn. Together they get
    ``share`` times all sizes. None gets over ``most`` times its own size; what it cannot take goes to
    the others by weight, until none is above. That is one water level: a source gets its weight times
    the level, or its limit. Levels are tried with 0, 1, 2... sources at their limits, in
    the order in which they reach them, and the highest is the right one. The one window without a
    key holds one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    wide = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.get(wide, turn)).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("limit").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = F.sum("source_size").over(everything) * F.lit(float(share))
    level = weighed.withColumn("_level", (whole - full) / open_weight)
    return level.select(
        "source",
        "source_size",
        F.least("limit", F.col("weight") * F.max("_level").over(everything)).alias("target"),
    )


def offset(source: Column, seed: int) -> Column:
    """One offset in [0, 1) per source, from the seed and the source's name alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("double") / F.lit(float(OFFSETS))


def copies(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """How often the mix takes each document.

    ``docs`` has ``doc_id``, ``source``, ``size`` and the columns to ``carry``. A document's expected copies are
    its source's target over its source's size. Along each source's documents, ordered by size so that
    any stretch has short and long ones in proportion, the expected copies are summed up,
    the source's offset is added, and a document is emitted once for each whole number its stretch
    crosses. So no document gets more than the rate rounded up, and a source's words miss its target
    by less than about its longest document. Reruns agree: order and offset depend on the rows alone.

    Returns the columns with ``source_size``, ``target``, ``copies``. A null source is a source; null ids
    come first among equal sizes; equal rows may trade places; a source without words takes nothing;
    an empty table gives no rows. The sums along a source run over tasks (see ``ranked``).
    """
    # Sampled, sorted and summed below: words are counted once, not in each of the three.
    narrow = materialise(docs.select("doc_id", "source", "size", *carry), "sizes")
    mixed = narrow.withColumn("_mix", F.md5(F.col("doc_id").cast("string")))
    order = ranked(mixed, ["source"], ["size", "_mix", "doc_id"], "_rank")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = materialise(targets(sizes, weights, share, most), "targets").withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.floor(F.col("_rank") * F.col("_rate") + F.col("_u"))
    stop = F.floor((F.col("_rank") + 1) * F.col("_rate") + F.col("_u"))
    joined = order.join(aims, order["source"].eqNullSafe(aims["_source"]))
    return (
        joined.withColumn("_rate", rate)
        .withColumn("_u", offset(F.col("source"), seed))
        .withColumn("copies", (stop - start).cast("long"))
        .drop("_rank", "_mix", "_source", "_rate", "_u")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed documents: the rows of ``docs``, each as often as ``copies`` says, with all their columns.

    Null texts and texts without words have size 0 and are taken at their source's rate too. Rows that
    agree in id, text and source share their copies, as evenly as whole numbers allow.
    """
    keyed = with_row_key(docs, doc_id, text).withColumn("_row_source", F.col(source))
    key = [*ROW_KEY, "_row_source"]
    slim = keyed.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), *ROW_KEY
    )
    counted = copies(slim, carry=ROW_KEY, **options).withColumnRenamed("source", "_row_source")
    total = materialise(
        counted.groupBy(*key).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")), "copies"
    )

    def matched(some: DataFrame) -> DataFrame:
        match = same_row(keyed, some) & keyed["_row_source"].eqNullSafe(some["_row_source"])
        return keyed.join(some, match).drop(*[some[c] for c in key])

    taken = matched(total.filter("_rows = 1 and _copies > 0")).withColumn("_take", F.col("_copies"))
    repeated = total.filter("_rows > 1 and _copies > 0")
    if not repeated.isEmpty():
        numbered = ranked(matched(repeated), key, [], "_nth")
        upto = F.floor((F.col("_nth") + 1) * F.col("_copies") / F.col("_rows"))
        before = F.floor(F.col("_nth") * F.col("_copies") / F.col("_rows"))
        taken = taken.unionByName(numbered.withColumn("_take", upto - before).drop("_nth").filter("_take > 0"))
    return taken.select(
        *docs.columns, F.explode(F.array_repeat(F.lit(0), F.col("_take").cast("int"))).alias("_copy")
    ).drop("_copy")
