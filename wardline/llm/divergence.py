"""How far each source's words lie from its peers' and from its language's, by Gustavson row accumulation."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from wardline.llm.common import arrow_map
from wardline.operators.joins import keyed_join
from wardline.sources.tables import materialise

# Shares are whole numbers of this many parts.
PARTS = 1_000_000_000
# A text is read in pieces of about this many bytes, cut between terms.
PIECE = 1 << 20
# Counts are handed on after this many bytes of text, or this many different terms.
HELD_BYTES, HELD_TERMS = 16 << 20, 300_000
# Postings of one block of the term-major index, and cells that numpy works on at once.
BLOCK_POSTINGS, CELLS = 1 << 18, 1 << 20

# ASCII letters in small form, everything else of ASCII as a space; other bytes stay.
_FOLD = bytes((b | 32 if 65 <= b <= 90 else b) if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def term_pieces(raw: bytes):
    """The terms of a text as lists of bytes: runs of letters and of non-ASCII characters, A-Z lower-cased.

    In UTF-8 every byte of a non-ASCII character is above 127, so the runs can be cut out of the bytes.
    """
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _counted(batches):
    held, seen, size = {}, {}, 0

    def rows():
        for (lang, source), terms in held.items():
            docs = seen[lang, source]
            names = list(terms)
            for k in range(0, len(names), 50_000):
                part = names[k : k + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array([source] * len(part), pa.string()),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([terms[t] for t in part], pa.int64()),
                        pa.array([docs[t] for t in part], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
        held.clear()
        seen.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, value in zip(langs, sources, texts):
            raw = value.as_py() or b""
            group = held.setdefault((lang, source), Counter())
            distinct = set()
            for terms in term_pieces(raw):
                group.update(terms)
                distinct.update(terms)
            seen.setdefault((lang, source), Counter()).update(distinct)
            size += len(raw)
            if size > HELD_BYTES or sum(map(len, held.values())) > HELD_TERMS:
                yield from rows()
                size = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of every term, summed up in the tasks first."""
    found = arrow_map(docs, _counted, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * (count + 1) / size), exact for any 64-bit counts."""
    if len(counts) and int(counts.max()) >= (1 << 62) // PARTS:
        wide = (counts.astype(object) + 1) * PARTS // np.broadcast_to(size, counts.shape).astype(object)
        return wide.astype(np.int64) + 1
    return (counts + 1) * PARTS // size + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def accumulate(starts: np.ndarray, peers: np.ndarray, counts: np.ndarray, sizes: np.ndarray):
    """Rows of the table of summed distances over the terms of one block, one dense row per group.

    ``starts`` has the borders of the terms in ``peers`` and ``counts`` (the term-major index), ``sizes`` each
    group's occurrences plus the number of kept terms. For each group, every term is first taken as if no peer had it
    (by the group's distinct shares), then as if only the peer had it (by the peer's distinct shares), and the
    terms that both have are scattered from the index into the accumulator with what corrects the two baselines.
    Sums may wrap around in between; the results fit.
    """
    groups, terms = len(sizes), len(starts) - 1
    zero = shares(np.zeros(groups, dtype=np.int64), sizes)
    share = shares(counts, sizes[peers])
    lengths = np.diff(starts)
    term = np.repeat(np.arange(terms), lengths)
    order = np.argsort(peers, kind="stable")
    border = np.searchsorted(peers[order], np.arange(groups + 1))
    levels = [np.unique(share[order[border[g] : border[g + 1]]], return_counts=True) for g in range(groups)]
    level = np.concatenate([u for u, _ in levels])
    times = np.concatenate([n for _, n in levels])
    owner = np.repeat(np.arange(groups), [len(u) for u, _ in levels])
    for g in range(groups):
        mine = order[border[g] : border[g + 1]]
        row = (terms - len(mine)) * distance(zero[g], zero)
        own, often = levels[g]
        step = max(1, CELLS // groups)
        for k in range(0, len(own), step):
            row += (distance(own[k : k + step, None], zero) * often[k : k + step, None]).sum(axis=0)
        np.add.at(row, owner, times * (distance(zero[g], level) - distance(zero[g], zero[owner])))
        ends = np.cumsum(lengths[term[mine]])
        at = 0
        while at < len(mine):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, side="right")))
            part = mine[at:stop]
            many = lengths[term[part]]
            shift = np.repeat(starts[term[part]] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
            posting = shift + np.arange(int(many.sum()))
            p, q, peer = np.repeat(share[part], many), share[posting], peers[posting]
            both = distance(p, q) - distance(p, zero[peer]) - distance(zero[g], q) + distance(zero[g], zero[peer])
            np.add.at(row, peer, both)
            at = stop
        yield row


def _block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    marks = table.filter(pc.is_null(table["counts"]))
    terms = table.filter(pc.is_valid(table["counts"]))
    ids = pc.list_flatten(marks["peers"]).to_numpy()
    sizes = np.empty(len(ids), dtype=np.int64)
    sizes[ids] = marks["size"].to_numpy()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(terms["peers"]).to_numpy())]).astype(np.int64)
    peers = pc.list_flatten(terms["peers"]).to_numpy().astype(np.int64)
    counts = pc.list_flatten(terms["counts"]).to_numpy().astype(np.int64)
    rows = list(accumulate(starts, peers, counts, sizes)) if len(starts) > 1 else [np.zeros(len(ids), dtype=np.int64)] * len(ids)
    number = np.arange(len(ids), dtype=np.int32)
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * (len(ids) * len(ids)), pa.string()),
            "group": np.repeat(number, len(ids)),
            "peer": np.tile(number, len(ids)),
            "part": np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64),
        }
    )


def _share(count, size):
    """``shares`` as a column."""
    return F.expr(f"cast({PARTS} as decimal(10,0)) * cast({count} + 1 as decimal(20,0)) div cast({size} as decimal(20,0))") + 1


def _distance(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def divergence(docs: DataFrame, least_docs: int = 3, most_terms: int = 200) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each source of a language differs from its peers and from it.

    A term is kept in a language where at least ``least_docs`` of its documents have it. Group counts of kept terms, one
    added to each, become whole shares p of ``PARTS``; the distance of two shares is floor((p - q)^2 / q). Part
    ``pair``: the distance from every other source of the language, summed over all kept terms, also those
    neither has. Part ``term``: the terms whose share in the source is above that in the language, the
    ``most_terms`` most distant. Ranks go by value downwards, then by the item's UTF-8 bytes.

    The term-major index has one row per kept term with its sources and counts, at most one entry per
    source. Its terms are dealt to blocks of about ``BLOCK_POSTINGS`` postings; a task holds one block and one dense row per
    source, and hands on sums of pairs of sources and never pairs of postings. The result has a row for each pair of
    sources of a language, so their number is taken to be small enough for that.

    Null texts, languages and sources are read as empty; a row is a document, also a repeated one. Groups
    without kept terms come with the shares of zero counts, and with the value 0 in a language that keeps none. Very
    long texts are read in pieces. An empty table gives no rows. Other columns are not read.
    """
    slim = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialise(slim.select("lang", "source").distinct().withColumn("id", number), "audit-groups")
    counts = keyed_join(materialise(term_counts(slim), "audit-counts"), groups, ["lang", "source"])
    index = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("id", "n")).alias("postings")
    )
    index = materialise(index.filter(F.col("docs") >= least_docs).drop("docs"), "audit-index")
    postings = index.select("lang", "term", "total", F.explode("postings").alias("p")).select("lang", "term", "total", "p.*")

    per_lang = index.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_n"), F.sum(F.size("postings")).alias("cells")
    )
    per_group = postings.groupBy("lang", "id").agg(F.sum("n").alias("group_n"))
    sized = materialise(
        groups.join(per_lang, "lang", "left")
        .join(per_group, ["lang", "id"], "left")
        .select(
            "lang", "source", "id",
            (F.coalesce("group_n", F.lit(0)) + F.coalesce("kept", F.lit(0))).alias("size"),
            (F.col("lang_n") + F.col("kept")).alias("lang_size"),
            F.ceil(F.coalesce("cells", F.lit(0)) / BLOCK_POSTINGS).cast("int").alias("blocks"),
        ),
        "audit-sizes",
    )

    near = keyed_join(postings, sized.select("lang", "id", "source", "size", "lang_size"), ["lang", "id"])
    near = near.withColumn("p", _share("n", "size")).withColumn("q", _share("total", "lang_size")).filter("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (
        near.select("lang", "source", F.col("term").alias("item"), _distance("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= most_terms)
    )

    blocks = F.greatest(F.col("blocks"), F.lit(1))
    marks = sized.select(
        "lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.array("id").alias("peers"),
        F.lit(None).cast("array<bigint>").alias("counts"), "size",
    )
    dealt = keyed_join(index, sized.select("lang", "blocks").distinct(), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), F.col("postings.id").alias("peers"),
        F.col("postings.n").alias("counts"), F.lit(None).cast("bigint").alias("size"),
    )
    sums = (
        marks.unionByName(dealt)
        .groupBy("lang", "block")
        .applyInArrow(_block, "lang string, group int, peer int, part bigint")
        .filter("group <> peer")
        .groupBy("lang", "group", "peer")
        .agg(F.sum("part").alias("value"))
    )
    names = sized.select("lang", F.col("id").alias("group"), "source")
    peers = sized.select("lang", F.col("id").alias("peer"), F.col("source").alias("item"))
    pairs = (
        keyed_join(keyed_join(sums, names, ["lang", "group"]), peers, ["lang", "peer"])
        .select("lang", "source", "item", "value")
        .withColumn("rank", F.row_number().over(order))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
    )
