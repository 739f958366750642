"""Line dedup with levelled sorted runs of line hashes, by DataFrame functions alone."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardline.llm.common import PLAIN_KEY, ROW_KEY, with_plain_key, with_row_key
from wardline.operators.joins import keyed_join
from wardline.sources.tables import materialise, shared_folder

SPACE = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line without ASCII space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, CAPITALS, CAPITALS.lower()))


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, doc_id: str, text: str, least_chars: int) -> DataFrame:
    """``ROW_KEY``, ``_row``, ``at`` (from 0), ``h1``, ``h2`` of every line whose key has ``least_chars`` code points.

    ``h1`` and ``h2`` are 128 hash bits of the key. ``_row`` tells repeated rows apart while documents are counted; it belongs
    to one run, so write the result before using it twice.
    """
    keyed = with_row_key(docs, doc_id, text).select(*ROW_KEY, F.col(text).alias("text"))
    keyed = keyed.withColumn("_row", F.monotonically_increasing_id())
    lines = keyed.select(*ROW_KEY, "_row", F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
    keys = lines.filter(F.char_length(F.btrim("line", F.lit(SPACE))) >= least_chars).withColumn("key", line_key(F.col("line")))
    return keys.select(*ROW_KEY, "_row", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Line hashes seen so far, as levels of sorted runs.

    A run is a table of distinct hashes with the documents that had the line when it was first met (``docs``) and the largest
    of their ids (``owner``), bucketed and sorted by hash. Runs are disjoint. ``add`` merges a batch
    against them without moving them: lines that no run holds become a new run of level 0, the others are noted among
    the repeats. When a level has ``fan`` runs they are compacted into one run of the next level, so a
    line is rewritten as often as there are levels and a batch meets few runs.
    """

    def __init__(self, spark: SparkSession, fan: int = 2, buckets: int | None = None):
        self.spark, self.fan = spark, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.repeats: list[DataFrame] = []

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex[:16]}"
        dealt = run.select(*HASH, "docs", "owner").repartition(self.buckets, *HASH).sortWithinPartitions(*HASH)
        writer = dealt.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
        writer.option("path", f"{shared_folder(self.spark)}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan:
            old, self.levels[level] = self.levels[level], []
            self._write(self._union(old), level + 1)
            for x in old:
                self.spark.sql(f"DROP TABLE {x}")

    def _union(self, names: Sequence[str]) -> DataFrame:
        out = self.spark.table(names[0])
        for name in names[1:]:
            out = out.unionByName(self.spark.table(name))
        return out

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def fresh(self, entries: DataFrame) -> DataFrame:
        """The entries whose hashes no run holds: one merge anti-join per run."""
        for name in self.runs():
            entries = entries.join(self.spark.table(name).select(*HASH).hint("merge"), HASH, "left_anti")
        return entries

    def again(self, entries: DataFrame) -> DataFrame:
        """The entries whose hashes some run holds; runs are disjoint, so each is met once."""
        met = [entries.join(self.spark.table(n).select(*HASH).hint("merge"), HASH, "left_semi") for n in self.runs()]
        out = met[0]
        for more in met[1:]:
            out = out.unionByName(more)
        return out

    def add(self, lines: DataFrame) -> None:
        """Takes a batch of ``line_hashes`` in."""
        once = lines.select(*HASH, "_row_id", "_row").distinct()
        entries = once.groupBy(*HASH).agg(F.count(F.lit(1)).alias("docs"), F.max("_row_id").alias("owner"))
        entries = materialise(entries, "line-entries")
        if self.runs():
            self.repeats.append(materialise(self.again(entries), "line-repeats"))
        self._write(self.fresh(entries), 0)

    def common(self, least_docs: int) -> DataFrame:
        """``h1, h2, owner`` of the lines in at least ``least_docs`` documents."""
        first = self._union(self.runs())
        if not self.repeats:
            return first.filter(F.col("docs") >= least_docs).select(*HASH, "owner")
        later = self.repeats[0]
        for more in self.repeats[1:]:
            later = later.unionByName(more)
        later = later.groupBy(*HASH).agg(F.sum("docs").alias("more"), F.max("owner").alias("later_owner"))
        both = keyed_join(first, materialise(later, "line-repeats"), HASH, "left", bounded=True)
        return both.filter(F.col("docs") + F.coalesce("more", F.lit(0)) >= least_docs).select(
            *HASH, F.greatest("owner", "later_owner").alias("owner")
        )

    def close(self) -> None:
        for name in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dropped_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 40, least_docs: int = 5,
    batches: int = 4, fan: int = 2,
) -> DataFrame:
    """``ROW_KEY`` and ``dropped`` (positions of lines, from 0) of the documents that lose lines; see ``dedup_lines``."""
    spark = docs.sparkSession
    lines = line_hashes(docs, doc_id, text, least_chars)
    lines = lines.withColumn("batch", F.pmod(F.xxhash64(*ROW_KEY), F.lit(batches)).cast("int"))
    lines = materialise(lines, "lines", partition_by=["batch"])
    runs = LineRuns(spark, fan)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch))
    common = materialise(runs.common(least_docs), "common-lines")
    runs.close()
    met = keyed_join(lines.select(*ROW_KEY, "at", *HASH), common, HASH)
    lost = met.filter(~F.col("_row_id").eqNullSafe(F.col("owner")))
    return materialise(lost.groupBy(*ROW_KEY).agg(F.collect_set("at").alias("dropped")), "dropped-lines")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    Texts are split at line feeds. A line's key is the line without ASCII space at its ends, A-Z lower-cased. A
    key of at least ``least_chars`` (40) code points that is in at least ``least_docs`` (5) documents loses all its lines but
    those in the largest id that holds it. The other lines stay in order, joined by line feeds.

    The rows are taken in ``batches``, each merged against the ``LineRuns`` of those before. Documents are joined to their
    dropped positions only, by broadcast where these are small and by shuffle otherwise; no line travels.
    Lines are told apart by 128 hash bits. Null and empty texts have one empty line. Every row is a
    document, also a repeated one; a key twice in one document counts once. A null id is the least;
    rows that share the largest id all keep the line, as do rows without id where no holder has one. Very long
    texts stay in one row. An empty table gives no rows. Columns of these names are replaced.
    """
    lost = with_plain_key(dropped_lines(docs, doc_id, text, **options)).select(*PLAIN_KEY, "dropped")
    new = ("n_lines", "n_dropped", "kept_text")
    kept = [c for c in docs.columns if c not in new]
    # The array of lines is built below the join, so the functions above it read it and never split again.
    split = with_plain_key(with_row_key(docs, doc_id, text)).select(*kept, *PLAIN_KEY, lines_of(F.col(text)).alias("_lines"))
    joined = keyed_join(split, lost.withColumnRenamed("dropped", "_dropped"), PLAIN_KEY, "left", spread=["_row_text"])
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    left = F.when(F.col("_dropped").isNull(), F.col("_lines")).otherwise(
        F.transform(places, lambda i: F.get(F.col("_lines"), i))
    )
    return joined.select(
        *kept,
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(left, "\n").alias("kept_text"),
    )
