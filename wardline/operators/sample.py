"""Seeded entity samples and dense entity numbers."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window, functions as F


def sample_entities(df: DataFrame, entity: str, size: int, seed: int) -> DataFrame:
    """A fixed-size random set of entities that does not depend on row order or partitions.

    Entities are ordered by a hash of seed and id; each task keeps its first ``size``.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(entity).cast("string")))
    return df.select(entity).distinct().orderBy(key, entity).limit(size)


def dense_index(
    df: DataFrame, entity: str, out: str = "id", bucket: Column | None = None, buckets: int = 1024
) -> DataFrame:
    """Numbers the distinct entities 1..K in id order without one task seeing them all.

    Ids are cut into ``buckets`` ordered ranges of about equally many distinct ids, whose borders come from a
    sketch of fixed size, however the ids are spread; only those borders reach the driver. Buckets are
    counted, the counts accumulated, and ids ranked inside their bucket. Ids that are not numbers need
    ``bucket``, a column that never decreases with the id and takes few values. An unknown id comes first.
    """
    ids = df.select(entity).distinct()
    if bucket is None:
        shares = [k / buckets for k in range(1, buckets)]
        borders = ids.agg(F.percentile_approx(entity, shares, 10 * buckets).alias("b")).first().b
        bucket = _range_number(F.col(entity), sorted(set(borders or [])))
    ids = ids.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ids.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(ids["_bucket"]).orderBy(entity)
    return ids.join(offsets, ids["_bucket"].eqNullSafe(offsets["_bucket"])).select(
        entity, (F.col("_offset") + F.row_number().over(inside)).alias(out)
    )


def _range_number(value: Column, borders: list) -> Column:
    """How many of the sorted ``borders`` are at or below ``value``; NULL for NULL. Looked up in two steps."""
    step = 32
    held = [F.lit(b) for b in borders]

    def upto(some):
        return F.size(F.filter(some, lambda b: b <= value))

    if not held:
        return F.when(value.isNotNull(), F.lit(0))
    coarse = upto(F.array(*held[step - 1 :: step])) * step if len(held) >= step else F.lit(0)
    return F.when(value.isNotNull(), coarse + upto(F.slice(F.array(*held), coarse + 1, F.lit(step - 1))))
