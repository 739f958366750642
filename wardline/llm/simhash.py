"""Near-duplicates by SimHash: Golay keys find fingerprints a few bits apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardline.llm import golay
from wardline.llm.common import (
    PLAIN_KEY,
    ROW_KEY,
    append,
    arrow_map,
    fields,
    with_plain_key,
    with_row_key,
)
from wardline.llm.components import components
from wardline.operators.joins import keyed_join
from wardline.sources.tables import materialise

# Position and width of the three segments of a fingerprint; each fits a 23-bit code.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Fingerprints of one key that are compared pair by pair; larger keys go through midpoints.
PAIRED = 48
HASH_BLOCK = 1 << 15


def plain_words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def shingle_hashes(parts: list[bytes], words: int, seed: int = 42):
    """XXH64 of each run of ``words`` words joined by one space, big-endian, in blocks.

    Fewer words are one shingle; no word gives none.
    """
    if not parts:
        return
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_digest
    for k in range(0, n, HASH_BLOCK):
        found = [digest(joined[a:b], seed) for a, b in zip(starts[k : k + HASH_BLOCK], stops[k : k + HASH_BLOCK])]
        yield np.frombuffer(b"".join(found), dtype=">u8")


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    A-Z are lower-cased, words are runs of anything but ASCII space, a shingle is hashed with XXH64
    over its words joined by one space. A text of fewer words is one shingle. A bit is set where
    over half the hashes have it.
    """
    n, counts = 0, np.zeros(64, dtype=np.int64)
    for hashes in shingle_hashes(plain_words(text), words, seed):
        n += len(hashes)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n).view(">u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """The frame without its text and with ``fingerprint``, a bigint of the 64 bits.

    Any other column passes through; null and empty texts have the fingerprint 0.
    """

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py(), words, seed) for t in batch.column(text)]
            signed = pa.array(np.array(prints, dtype=np.uint64).view(np.int64), pa.int64())
            yield append(batch, [text], {"fingerprint": signed})

    kept = docs.drop("fingerprint")
    schema = ", ".join(x for x in (fields(kept, [text]), "fingerprint bigint") if x)
    return arrow_map(kept, run, schema)


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, with the position of the fingerprint each belongs to.

    Two wrong bits leave one of three segments untouched. For each segment taken whole, the codewords
    near the next one complete a key, so fingerprints at most two bits apart share a key.
    """
    raw = prints.astype(np.uint64)
    parts = [(raw >> np.uint64(at)) & np.uint64((1 << width) - 1) for at, width in SEGMENTS]
    keys, owners = [], []
    for i, whole in enumerate(parts):
        j = (i + 1) % len(parts)
        near = golay.nearby(parts[j], SEGMENTS[j][1])
        head = (np.int64(i) << 34) | (whole.astype(np.int64) << 12)
        row, column = np.nonzero(near >= 0)
        keys.append(head[row] | near[row, column])
        owners.append(row)
    return np.concatenate(keys), np.concatenate(owners)


def _key_rows(batches):
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 8192):
            block = prints[at : at + 8192]
            keys, owners = golay_keys(block.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(block[owners])], names=["key", "fingerprint"])


def _midpoint_rows(batches):
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(prints), 8192):
            block = prints[at : at + 8192]
            middle = (block[:, None] ^ flips).reshape(-1).view(np.int64)
            owner = np.repeat(block.view(np.int64), len(flips))
            yield pa.RecordBatch.from_arrays([pa.array(middle), pa.array(owner)], names=["middle", "fingerprint"])


def links(prints: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that join distinct fingerprints at most two bits apart.

    ``prints`` has distinct ``fingerprint``. Each gives about sixteen keys. Fingerprints of a key with up to
    ``PAIRED`` of them are compared pair by pair inside the row that holds them. Those of a larger
    key name the strings at most one bit away from them; two share one exactly when they
    are at most two bits apart, and each is linked to the least that names it. So no key is capped,
    no pair is lost, and a key's work grows with its size and not with the square.
    The edges need not hold every pair: they join the same fingerprints.
    """
    keys = materialise(arrow_map(prints.select("fingerprint"), _key_rows, "key bigint, fingerprint bigint"), "keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = materialise(keys.join(shared, "key"), "shared-keys")
    lists = held.filter(F.col("n") <= PAIRED).groupBy("key").agg(F.sort_array(F.collect_list("fingerprint")).alias("l"))
    pairs = lists.select(
        F.explode(
            F.expr(
                """flatten(transform(sequence(1, size(l) - 1), i -> transform(
                     filter(slice(l, i + 1, size(l)), y -> bit_count(y ^ l[i - 1]) <= 2),
                     y -> named_struct('a', y, 'b', l[i - 1]))))"""
            )
        ).alias("p")
    ).select("p.a", "p.b")
    crowded = held.filter(F.col("n") > PAIRED).select("fingerprint").distinct()
    middle = arrow_map(crowded, _midpoint_rows, "middle bigint, fingerprint bigint")
    if held.filter(F.col("n") > PAIRED).isEmpty():
        return pairs.distinct()
    middle = materialise(middle, "midpoints")
    least = middle.groupBy("middle").agg(F.min("fingerprint").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    through = middle.join(least.select("middle", "b"), "middle").select(F.col("fingerprint").alias("a"), "b")
    return pairs.union(through.filter("a <> b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """One row per document: ``ROW_KEY``, ``fingerprint`` (bigint), ``root`` and ``component_id``.

    ``component_id`` is the least id reachable over fingerprints at most two bits apart, the
    document's own included; null where no document of the component has an id. ``root`` is the least fingerprint
    of the component and never null. Equal fingerprints meet
    first, so copies never form pairs. Repeated rows each come back; null and empty texts
    link like any other with the fingerprint 0; an empty table gives no rows. Other columns
    are neither read nor returned, so their names cannot clash.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = with_row_key(slim).drop("doc_id")
    prints = materialise(with_fingerprint(keyed, "text", words), "fingerprints")
    distinct = materialise(prints.groupBy("fingerprint").agg(F.min("_row_id").alias("first_id")), "distinct")
    roots = components(links(distinct))
    joined = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    named = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = materialise(joined.join(named, "root").select("fingerprint", "root", "component_id"), "classes")
    return prints.join(classes, "fingerprint").select(*ROW_KEY, "fingerprint", "root", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """One document of each component of ``near_duplicates``, with all its columns.

    The one with the least id stays, of equal ids that with the least text hash; a component without ids keeps its
    least hash. Rows that agree in id and text are one document, of which one row stays. Null and empty
    texts and such without words are one component. An empty table stays empty.
    """
    found = near_duplicates(docs, doc_id, text, words).groupBy("root", *ROW_KEY).agg(F.count(F.lit(1)).alias("_rows"))
    found = materialise(found.transform(with_plain_key), "copies")
    first = found.groupBy("root").agg(F.min(F.struct("_row_none", *ROW_KEY)).alias("first"))
    ranked = keyed_join(found, materialise(first, "first-copies"), "root", spread=["_text_hash"])
    kept = F.struct("_row_none", *ROW_KEY) == F.col("first")
    # Those that go are joined to the documents, as they are few beside those that stay.
    lost = materialise(ranked.filter(~F.coalesce(kept, F.lit(False))).select(*PLAIN_KEY), "lost-copies")
    keyed = with_plain_key(with_row_key(docs, doc_id, text))
    out = keyed_join(keyed, lost, PLAIN_KEY, "left_anti", spread=["_text_hash"])
    again = found.filter("_rows > 1").select(*PLAIN_KEY)
    if not again.isEmpty():
        again = materialise(again, "repeated-copies")
        single = keyed_join(out, again, PLAIN_KEY, "left_anti", spread=["_text_hash"])
        out = single.union(keyed_join(out, again, PLAIN_KEY, "left_semi", spread=["_text_hash"]).dropDuplicates(PLAIN_KEY))
    return out.select(*docs.columns)


def hex_digits(column: str = "fingerprint"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
