"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import (
    BLOCK_CHARS,
    append,
    arrow_map,
    fields,
    small_rows,
)
from wardline.sources.tables import materialise

BUCKET_BITS = 15
LENGTHS = (1, 2, 3)
SMOOTHING = 0.1
UNKNOWN = "und"
# A model may have this many languages; the matrix that is broadcast has as many columns.
MOST_LANGUAGES = 256
# Numbers that a product of counts and log probabilities holds at once.
PRODUCT_CELLS = 1 << 21
_PRIMES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def blocks(text: str):
    """A text in blocks that end at a character that is no letter, where there is one."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + BLOCK_CHARS)
        if stop < len(text):
            back = stop
            while back > at and text[back - 1].isalpha():
                back -= 1
            stop = back if back > at else stop
        yield text[at:stop]
        at = stop


def slices(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Texts, long ones in blocks, in slices of about ``BLOCK_CHARS``, each with the rows that its strings belong to."""
    owners, strings, held = [], [], 0
    for row, text in enumerate(texts):
        for block in blocks((text.as_py() if isinstance(text, pa.Scalar) else text) or ""):
            if strings and held + len(block) > BLOCK_CHARS:
                yield np.array(owners), strings
                owners, strings, held = [], [], 0
            owners.append(row)
            strings.append(block)
            held += len(block)
    if strings:
        yield np.array(owners), strings


def grams(strings: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(row, bucket)`` of the n-grams of all strings' words, lower-cased and with a blank at either end.

    The strings are laid out in one array with a blank between. Runs of other characters are one blank; n-grams
    that reach into two words are left out, so none reaches into two strings, and a text may be cut between words.
    """
    low = [s.lower() for s in strings]
    # The blank before a string counts as the string's: n-grams that begin with it hold the string's first letter.
    owner = np.repeat(np.arange(len(low)), np.fromiter((len(s) + 1 for s in low), dtype=np.int64, count=len(low)))
    code = np.frombuffer(f" {' '.join(low)} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = letters()[code]
    code = np.where(letter, code, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    at = np.flatnonzero(keep)
    code, letter = code[at], letter[at]
    rows, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    mixed = np.zeros(len(code), dtype=np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        if n > len(code):
            break
        mixed = mixed[: len(code) - n + 1] * np.uint32(_PRIMES[0]) + code[n - 1 :] * np.uint32(_PRIMES[1]) + np.uint32(n)
        if n not in LENGTHS:
            continue
        # Blanks only at the ends, and no n-gram of blanks alone.
        size = len(code) - n + 1
        whole = letter[:size] | letter[n - 1 :] if n < 3 else np.ones(size, dtype=bool)
        for k in range(1, n - 1):
            whole = whole & letter[k : k + size]
        taken = np.flatnonzero(whole)
        hashed = mixed[taken] * np.uint32(_PRIMES[2])
        hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(_PRIMES[3]) >> np.uint32(32 - BUCKET_BITS)
        rows.append(owner[at[taken]])
        found.append(hashed.astype(np.int64))
    return np.concatenate(rows), np.concatenate(found)


def buckets(text: str) -> np.ndarray:
    """Buckets of the n-grams of one block."""
    return grams([text])[1]


def count_matrix(strings: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse matrix of n-gram counts, as ``(row, bucket, count)`` of its cells in order of row and bucket."""
    row, bucket = grams(strings)
    cells = row << BUCKET_BITS | bucket
    # Cells half as wide sort faster, and the rows of a slice fit: it has no empty strings.
    cells = np.sort(cells.astype(np.uint32) if len(strings) <= 1 << 32 - BUCKET_BITS else cells)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(cells)), dtype=bool), cells[1:] != cells[:-1]]))
    held = cells[first].astype(np.int64)
    return held >> BUCKET_BITS, held & (1 << BUCKET_BITS) - 1, np.diff(first, append=len(cells))


@dataclass(frozen=True)
class Model:
    """Languages, their log priors and the matrix of log probabilities (bucket by language)."""

    languages: tuple[str, ...]
    prior: np.ndarray
    matrix: np.ndarray

    def predict_all(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Each text's likeliest language and its probability; ``und`` and 0 without a letter or a language.

        A slice of texts is one sparse count matrix, which is multiplied by the log probabilities in pieces of at most
        ``PRODUCT_CELLS`` numbers.
        """
        total, seen = np.tile(self.prior, (len(texts), 1)), np.zeros(len(texts), dtype=bool)
        if not self.languages or not len(texts):
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        step = PRODUCT_CELLS // len(self.languages)
        for owners, strings in slices(texts):
            row, bucket, n = count_matrix(strings)
            for k in range(0, len(row), step):
                mine = row[k : k + step]
                first = np.flatnonzero(np.diff(mine, prepend=-1))
                product = self.matrix[bucket[k : k + step]] * n[k : k + step, None].astype(np.float64)
                owner = owners[mine[first]]
                np.add.at(total, owner, np.add.reduceat(product, first, axis=0))
                seen[owner] = True
        best = total.argmax(axis=1)
        share = 1.0 / np.exp(total - total[np.arange(len(total)), best][:, None]).sum(axis=1)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen)], np.where(seen, share, 0.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and probability of one text."""
        found, score = self.predict_all([text])
        return found[0], float(score[0])


def counts(labelled: DataFrame) -> DataFrame:
    """``(lang, bucket, n)`` over all of ``(text, lang)``; bucket -1 counts documents.

    A task adds its rows up in one array per language and emits what is not zero; the sums over
    tasks are an ordinary aggregate.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                row = sums.setdefault(lang, np.zeros((1 << BUCKET_BITS) + 1, dtype=np.int64))
                if len(sums) > MOST_LANGUAGES:
                    raise ValueError(f"over {MOST_LANGUAGES} languages")
                texts = batch.column("text").filter(pc.equal(batch.column("lang"), lang))
                row[-1] += len(texts)
                for _, strings in slices(texts):
                    row[:-1] += np.bincount(grams(strings)[1], minlength=1 << BUCKET_BITS)
        for lang, row in sums.items():
            at = np.flatnonzero(row)
            where = np.where(at == len(row) - 1, -1, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(where), pa.array(row[at])],
                names=["lang", "bucket", "n"],
            )

    known = labelled.filter("text is not null and lang is not null").select("text", "lang")
    return arrow_map(known, run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame) -> Model:
    """The model of ``(text, lang)``; rows with a null in either are left out.

    Every such row is counted. What reaches the driver is one count per bucket and language, at most
    ``MOST_LANGUAGES`` times the buckets.
    """
    table = materialise(counts(labelled), "language-counts")
    seen = small_rows(table.filter("bucket = -1").select("lang", "n"), MOST_LANGUAGES)
    seen.sort(key=lambda r: r["lang"])
    languages = tuple(r["lang"] for r in seen)
    at = {lang: k for k, lang in enumerate(languages)}
    sums = np.full((1 << BUCKET_BITS, len(languages)), SMOOTHING)
    cells = table.filter("bucket >= 0").toPandas()
    sums[cells["bucket"].to_numpy(), cells["lang"].map(at).to_numpy(dtype=np.int64)] += cells["n"].to_numpy()
    documents = np.array([r["n"] for r in seen], dtype=np.float64)
    return Model(
        languages,
        np.log(documents / documents.sum()) if languages else np.zeros(0),
        (np.log(sums) - np.log(sums.sum(axis=0))).astype(np.float32),
    )


def with_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The frame without its text and with ``lang_pred`` and ``score``.

    The model is broadcast once. Only the text is an input. A null text, or one without a letter, is ``und`` with the score 0; so
    is every text where nothing could be learned. Ties go to the language that comes first by name.
    Other columns pass through, but for ones named like the results, which are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        held = shared.value
        for batch in batches:
            found, score = held.predict_all(batch.column(text))
            yield append(batch, [text], {"lang_pred": pa.array(found, pa.string()), "score": pa.array(score, pa.float64())})

    kept = docs.drop("lang_pred", "score")
    schema = ", ".join(x for x in (fields(kept, [text]), "lang_pred string, score double") if x)
    return arrow_map(kept, run, schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: CRC-32 of its id as text leaves 2 by 4. A null id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, learned from those not held out."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), held_out(doc_id).alias("held_out")
    )
    model = fit(rows.filter("not held_out").select("text", "lang"))
    return with_language(rows.select("doc_id", "held_out", "text"), model)


def keep_identified(docs: DataFrame, least: float = 0.5, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language is known: neither ``und`` nor scored under ``least``.

    All columns stay as they are; rows are judged by their text alone, in the order they come.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = fit(rows.filter(~held_out("_id")).select("text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        held = shared.value
        for batch in batches:
            found, score = held.predict_all(batch.column(text))
            yield batch.filter(pa.array((np.array(found, dtype=object) != UNKNOWN) & (score >= least)))

    return arrow_map(docs, run, fields(docs))
