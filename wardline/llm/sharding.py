"""Balanced label propagation: linked documents share a shard, shards stay even."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.llm.common import ranked, small_rows, text_key
from wardline.sources.tables import materialise

ROUNDS = 12
# Bytes a document costs besides its text.
OVERHEAD = 16


def _by_shard(values: list, shard: Column) -> Column:
    """The entry of a short list (one per shard) that a shard column points at."""
    return F.get(F.array(*[F.lit(v) for v in values]), shard)


def _propagate(cells: DataFrame, single: list[int], shards: int, rounds: int) -> DataFrame:
    """Moves cells of linked groups towards their groups' shards, under quotas.

    A cell is the part of a group that began in one shard. In a round each cell asks for the shard
    that holds most of its group and has room, or for the roomiest where none of its group's has. A shard's room is its even share of all documents less
    the linked ones it holds; where more ask than fit, a cell is let in when a hash of it falls
    below room over demand. Unlinked documents do not count: they cut no link wherever they go.
    Only lists with one number per shard reach the driver. A window holds one group's cells, of
    which there are at most as many as shards.
    """
    total = cells.agg(F.sum("n")).first()[0] or 0
    even = (total + sum(single)) // shards
    for turn in range(rounds):
        load = dict.fromkeys(range(shards), 0)
        load.update({r["shard"]: r["n"] for r in small_rows(cells.groupBy("shard").agg(F.sum("n").alias("n")), shards)})
        room = [max(0, even - load[s]) for s in range(shards)]
        held = cells.withColumn("_held", F.sum("n").over(Window.partitionBy("group", "group_sum", "shard")))
        here = F.struct("_held", F.xxhash64("group", "shard").alias("_tie"), "shard")
        roomy = F.when(_by_shard(room, F.col("shard")) > 0, here)
        group = Window.partitionBy("group", "group_sum")
        widest = max(range(shards), key=lambda s: room[s])
        stuck = F.col("_best").isNull() & (F.min("shard").over(group) < F.max("shard").over(group))
        size = F.sum("n").over(group)
        # A larger part moves to a smaller one only where the whole group then has room.
        gains = (F.col("_best") > here) | (_by_shard(room, F.col("_best.shard")) >= size - F.col("_best._held"))
        asked = held.withColumn("_best", F.max(roomy).over(group)).withColumn(
            "_want",
            F.when(gains & (F.col("_best.shard") != F.col("shard")), F.col("_best.shard")).when(
                stuck & (size <= room[widest]), F.lit(widest)
            ),
        )
        asked = materialise(asked.select(*cells.columns, "_want"), "asked")
        wanted = small_rows(
            asked.filter("_want is not null").groupBy("_want").agg(F.sum("n").alias("n")), shards
        )
        if not wanted:
            break
        odds = [0.0] * shards
        for r in wanted:
            odds[r["_want"]] = min(1.0, room[r["_want"]] / r["n"])
        draw = F.pmod(F.xxhash64("group", "group_sum", "start", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
        moves = F.col("_want").isNotNull() & (draw < _by_shard(odds, F.col("_want")))
        cells = asked.withColumn("shard", F.when(moves, F.col("_want")).otherwise(F.col("shard"))).drop("_want")
    return cells


def shard_documents(
    docs: DataFrame, shards: int = 40, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, linked``.

    Documents with equal texts are linked. All begin in a shard drawn by hash; linked ones move as
    ``_propagate`` says. The law is ``rows``: shards' counts differ by one at most. What a shard holds
    beyond its share, unlinked documents first, then goes to shards below theirs, in one run of
    ranks, so a group that must be cut is cut in few places. ``slot`` numbers a shard's documents from 0.

    ``size`` is the text's UTF-8 bytes plus 16. A null text has no bytes, the checksum 0 and no link; empty
    texts are equal texts. Null ids and repeated rows are documents of their own. A group larger
    than a shard, be it a third of all rows, stays in pieces of its starting shards. Fewer documents than
    shards leave shards empty; an empty table gives no rows. Other columns are not read.
    """
    raw = F.col(text)
    keys = docs.select(F.col(doc_id).alias("doc_id"), raw.alias("text"), *text_key(text))
    base = materialise(
        keys.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
            F.when(F.col("text").isNotNull(), F.col("_text_hash")).alias("group"),
            F.col("_text_sum").alias("group_sum"),
            F.pmod(F.xxhash64("doc_id", "_text_hash"), F.lit(shards)).cast("int").alias("start"),
        ),
        "shard-base",
    )
    parts = base.filter("group is not null").groupBy("group", "group_sum", "start").agg(F.count(F.lit(1)).alias("n"))
    group_size = F.sum("n").over(Window.partitionBy("group", "group_sum"))
    cells = materialise(
        parts.withColumn("_all", group_size).filter("_all > 1").drop("_all").withColumn("shard", F.col("start")), "cells"
    )
    counts = [0] * shards
    for r in small_rows(base.groupBy("start").agg(F.count(F.lit(1)).alias("n")), shards):
        counts[r["start"]] = r["n"]
    total = sum(counts)
    for r in small_rows(cells.groupBy("start").agg(F.sum("n").alias("n")), shards):
        counts[r["start"]] -= r["n"]
    final = _propagate(cells, counts, shards, rounds).select(
        F.col("group").alias("_g"), F.col("group_sum").alias("_gs"), F.col("start").alias("_st"), F.col("shard").alias("_to")
    )
    match = (base["group"] == final["_g"]) & (base["group_sum"] == final["_gs"]) & (base["start"] == final["_st"])
    labelled = base.join(final, match, "left").select(
        "doc_id", "size", "text_crc32", "group", F.col("_to").isNull().alias("_single"),
        F.coalesce("_to", "start").alias("_label"),
    )
    order = ranked(labelled, ["_label"], ["_single", "group", "doc_id"], "_rank")
    held = [0] * shards
    for r in small_rows(order.groupBy("_label").agg(F.count(F.lit(1)).alias("n")), shards):
        held[r["_label"]] = r["n"]
    share = [total // shards + (s < total % shards) for s in range(shards)]
    # Which shards take one document more is free: those that hold most do.
    for s, k in zip(sorted(range(shards), key=lambda s: -held[s]), sorted(share, reverse=True)):
        share[s] = k
    kept = [min(h, k) for h, k in zip(held, share)]
    over_before = [sum(held[i] - kept[i] for i in range(s)) for s in range(shards)]
    room_before = [sum(share[i] - kept[i] for i in range(s)) for s in range(shards)]
    spare = F.col("_rank") - _by_shard(kept, F.col("_label"))
    run = spare + _by_shard(over_before, F.col("_label"))
    # The last shard whose vacancies begin at or before this place in the run and has any.
    target = F.lit(0)
    for s in range(shards):
        if share[s] > kept[s]:
            target = F.when(run >= room_before[s], F.lit(s)).otherwise(target)
    placed = order.withColumn("shard", F.when(spare < 0, F.col("_label")).otherwise(target).cast("int"))
    slot = F.when(spare < 0, F.col("_rank")).otherwise(
        _by_shard(kept, F.col("shard")) + run - _by_shard(room_before, F.col("shard"))
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        (~F.col("_single")).alias("linked"),
    )
