"""Shared pieces: the words of a text, arrow streams, row keys and ranks over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from wardline.session import ship_package
from wardline.sources.tables import materialise

# A word is a run of anything but the six ASCII space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Texts are worked on in blocks of about this many characters, so a task's memory stays bounded.
BLOCK_CHARS = 1 << 17


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def arrow_map(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with the package on the executors' path."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def fields(df: DataFrame, without: Sequence[str] = ()) -> str:
    """The schema of a frame as text, for the output of an Arrow function."""
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in without
    )


def append(batch: pa.RecordBatch, drop: Sequence[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch without some columns and with new ones at its end."""
    kept = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in kept] + list(new.values()), names=kept + list(new)
    )


def text_key(text: str = "text") -> list[Column]:
    """Two columns that tell texts apart: 96 hash bits and the length; null is not the empty text."""
    raw = F.col(text)
    return [
        F.xxhash64(F.coalesce(raw, F.lit("")), raw.isNull()).alias("_text_hash"),
        (F.crc32(F.coalesce(raw, F.lit(""))) * F.lit(1 << 31) + F.coalesce(F.octet_length(raw), F.lit(-1))).alias(
            "_text_sum"
        ),
    ]


ROW_KEY = ["_row_id", "_text_hash", "_text_sum"]


def with_row_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds ``ROW_KEY``: rows that agree in it have the same id and the same text."""
    return docs.select("*", F.col(doc_id).alias("_row_id"), *text_key(text))


# Rows agree in these exactly where they agree in ROW_KEY; none of them is null.
PLAIN_KEY = ["_row_none", "_row_text", "_text_hash", "_text_sum"]


def with_plain_key(df: DataFrame) -> DataFrame:
    """Adds to a frame with ``ROW_KEY`` what ``PLAIN_KEY`` needs, for joins that know no null-safe keys."""
    return df.withColumn("_row_none", F.col("_row_id").isNull()).withColumn(
        "_row_text", F.coalesce(F.col("_row_id").cast("string"), F.lit(""))
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Equal row keys; a null id equals a null id."""
    return (
        left["_row_id"].eqNullSafe(right["_row_id"])
        & (left["_text_hash"] == right["_text_hash"])
        & (left["_text_sum"] == right["_text_sum"])
    )


def ranked(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Numbers the rows of each group from 0 in the given order, however large a group is.

    Rows are dealt out by ranges of (groups, order), so a group lies in as many tasks as it needs;
    each task numbers its own rows and the tasks' counts per group are summed up before it. Rows
    that tie in every ``order`` column are numbered in any order; a position taken from the input
    tells them apart, so that even equal rows spread over tasks. Pass narrow rows: all columns
    of ``df`` are sorted. The sorted rows are written, because their numbers belong to one run.
    """
    key = [*groups, *order, "_tie"]
    spread = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = (
        spread.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .drop("_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = materialise(placed, f"ranked-{name}")
    counts = placed.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        F.col("_part").alias("_b_part"),
        *[F.col(g).alias(f"_b_{g}") for g in groups],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    match = placed["_part"] == base["_b_part"]
    for g in groups:
        match = match & placed[g].eqNullSafe(base[f"_b_{g}"])
    return placed.join(base, match).select(
        *[c for c in df.columns], (F.col("_at") + F.col("_shift")).alias(name)
    )


def small_rows(df: DataFrame, most: int) -> list:
    """Rows of a table that must not pass ``most`` rows; raises where it does."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"expected at most {most} rows of {df.columns}")
    return rows


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(schema))
