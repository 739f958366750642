"""Token ids as ORC files in the order of document ids."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardline.llm.common import arrow_map
from wardline.llm.encoding import encoder
from wardline.sources.tables import shared_folder

SCHEMA = "doc_id bigint, part int, before bigint, n_tokens bigint, ids array<int>"


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = 64 << 20,
    stride: int = 10_000,
) -> None:
    """Encodes documents and writes ``folder/tokens`` and ``folder/parts``, both ORC.

    Texts are dealt out by ranges of the id and sorted, so files, and stripes in them, hold
    ascending ranges of ids; null ids come first, rows with one id in any order. A row has the document's ids as integers, which ORC
    stores in run-length encoding, with ``end_id`` at their end, the number of the file and the ids before
    it in that file. The writer keeps a row index every ``stride`` rows and a Bloom filter on the document id.
    ``parts`` has one row per file: its ids, documents and the ids of all files before it. A null text is
    empty and has the end id alone; an empty table gives files without rows.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spread = narrow.withColumn("_tie", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")

    def run(batches):
        coder, part, before = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=np.int32)

        def rows(keys, n, ids, start):
            stops = np.cumsum(n)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]).astype(np.int32)), pa.array(ids))
            numbers = [np.full(len(n), part, dtype=np.int32), start + stops - n, n]
            return pa.RecordBatch.from_arrays([keys, *map(pa.array, numbers), lists], names=names)

        for batch in batches:
            # Ids of a row whose text goes on in the next part wait for it.
            waiting, row = [], -1
            for owners, n, ids in coder.encode(batch.column("text")):
                if row >= 0 and owners[0] != row:
                    whole = np.concatenate([*waiting, end])
                    yield rows(batch.column("doc_id").slice(row, 1), np.array([len(whole)]), whole, before)
                    before += len(whole)
                    waiting, row = [], -1
                if len(owners) == 1:
                    waiting.append(ids)
                    row = int(owners[0])
                    continue
                # The end id goes in after each row's ids.
                held = np.insert(ids, np.cumsum(n), end_id).astype(np.int32)
                yield rows(batch.column("doc_id").slice(int(owners[0]), len(owners)), n + 1, held, before)
                before += len(held)
            if row >= 0:
                whole = np.concatenate([*waiting, end])
                yield rows(batch.column("doc_id").slice(row, 1), np.array([len(whole)]), whole, before)
                before += len(whole)

    writer = arrow_map(ordered, run, SCHEMA).write.mode("errorifexists")
    writer.option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", stride).option(
        "orc.create.index", "true"
    ).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(f"{folder}/tokens")
    spark = docs.sparkSession
    rows = spark.read.schema(SCHEMA).orc(f"{folder}/tokens")
    parts = rows.groupBy("part").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.count(F.lit(1)).alias("documents"),
        F.min("doc_id").alias("first_id"),
        F.max("doc_id").alias("last_id"),
    )
    # One row per file: the only window without a key.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).coalesce(1).write.orc(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str, where=None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``; ``start`` is the number of ids of all documents before.

    A condition on ``doc_id`` in ``where`` reaches the files' statistics and Bloom filters, so stripes that
    cannot hold such ids are skipped; the rest are read in parallel, stripe by stripe.
    """
    rows = spark.read.schema(SCHEMA).orc(f"{folder}/tokens")
    rows = rows.filter(where) if where is not None else rows
    parts = spark.read.schema("part int, base bigint").orc(f"{folder}/parts").withColumnRenamed("part", "_part")
    return rows.join(parts, rows["part"] == parts["_part"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def with_ids_crc32(rows: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of ``ids``: the unsigned CRC-32 of the ids as little-endian 32-bit integers."""

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            at = ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])]
            kept = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(sums, pa.int64())], names=kept + ["ids_crc32"]
            )

    return arrow_map(rows, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(spark: SparkSession) -> str:
    """A new folder in the place all executors share."""
    return f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex[:12]}"
