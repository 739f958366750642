"""Spelling variants of a corpus' words, met by PartEnum signatures of their letters."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import arrow_map
from wardline.operators.joins import keyed_join
from wardline.sources.tables import materialise

# Letters by how common they are, dealt to the parts in turn; letters beyond a-z by code point.
LETTERS = "etaoinshrdlcumwfgypbvkjxqz"
BEYOND = (0xC0, 0xFF)
PARTS = 6
# The words of a bucket with more of them meet by what is left without one letter.
CROWDED = 1024
DAMAGE = 97
# A text is read in pieces of about this many characters, cut between words; counts are handed on at this many words.
PIECE, HELD = 1 << 20, 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]{5,}")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")


def damaged(run: str, seed: int) -> str:
    """The run, without one letter where its checksum says so. ``seed`` is the checksum of what stands before it."""
    h = zlib.crc32(run.encode(), seed)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def pieces(text: str):
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _counted(batches):
    held = Counter()

    def rows():
        names = list(held)
        for k in range(0, len(names), 50_000):
            part = names[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"]
            )
        held.clear()

    for batch in batches:
        for number, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            seed = zlib.crc32(f"{'' if number is None else number}:".encode())
            for piece in pieces(value.as_py() or ""):
                for run, n in Counter(_RUN.findall(piece)).items():
                    word = damaged(run.encode().lower().decode(), seed)
                    if len(word) >= 5:
                        held[word] += n
                if len(held) > HELD:
                    yield from rows()
    yield from rows()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 3) -> DataFrame:
    """``(word, n)`` of the words of at least five letters found at least ``least`` times."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = arrow_map(slim, _counted, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def part_letters(part: int) -> str:
    beyond = "".join(chr(c) for c in range(BEYOND[0], BEYOND[1] + 1) if c % PARTS == part)
    return LETTERS[part::PARTS] + beyond


def signatures(words: DataFrame) -> DataFrame:
    """``(signature, word, n)``, one row for each two parts of the alphabet left out.

    A word's letters are a vector with a one for the k-th occurrence of each letter. One letter put in or taken out
    changes one place of it and one replaced changes two, so near words differ in at most two parts of the alphabet and agree
    in all others for some choice of two. A signature is that choice with the letters of the other
    parts. They stand in the word's order, which one edit of other letters does not change; so
    near words still share one, and anagrams no longer do.
    """
    kept = [
        F.xxhash64(F.lit(f"{i}{j}"), F.translate("word", part_letters(i) + part_letters(j), ""))
        for i, j in combinations(range(PARTS), 2)
    ]
    return words.select(F.explode(F.array(*kept)).alias("signature"), "word", "n")


IN_BUCKET = """
    flatten(transform(sequence(1, size(l) - 1), i -> transform(
      filter(slice(l, i + 1, size(l)), y -> levenshtein(y.word, l[i - 1].word, 1) = 1),
      y -> named_struct('a', l[i - 1].word, 'a_n', l[i - 1].n, 'b', y.word, 'b_n', y.n))))
"""
SWAPPED = """
    flatten(transform(sequence(1, size(l) - 1), i -> transform(
      slice(l, i + 1, size(l)), y -> named_struct('x', l[i - 1], 'y', y))))
"""


def _cut_pairs(words: DataFrame) -> DataFrame:
    """``near_pairs`` by what is left of a word without one letter, for words of crowded buckets.

    A shorter word equals the longer one's rest, and words with a replaced letter have the same rest at the same
    place, where no more words meet than there are letters. Rows are three numbers, so the work grows with
    the words' letters and not with their pairs.
    """
    rest = F.transform(
        F.sequence(F.lit(1), F.char_length("word")),
        lambda k: F.xxhash64(
            F.concat(F.substring(F.col("word"), F.lit(1), k - 1), F.substring(F.col("word"), k + 1, F.char_length("word")))
        ),
    )
    named = words.select(F.xxhash64("word").alias("id"), "word", "n")
    rests = materialise(named.select("id", F.posexplode(rest).alias("place", "rest")), "spelling-rests")
    put_in = rests.select(F.col("id").alias("x"), "rest").join(named.select(F.col("id").alias("y")), F.col("rest") == F.col("y"))
    met = rests.groupBy("place", "rest").agg(F.collect_list("id").alias("l")).filter(F.size("l") > 1)
    replaced = met.select(F.explode(F.expr(SWAPPED)).alias("p")).select("p.*")
    ids = put_in.select("x", "y").unionByName(replaced).distinct()
    both = ids.join(named.selectExpr("id AS x", "word AS x_word", "n AS x_n"), "x").join(
        named.selectExpr("id AS y", "word AS y_word", "n AS y_n"), "y"
    )
    x, y = (F.struct(F.col(f"{c}_word").alias("word"), F.col(f"{c}_n").alias("n")) for c in "xy")
    sure = both.filter(F.levenshtein("x_word", "y_word", 1) == 1)
    return sure.select(F.least(x, y).alias("p"), F.greatest(x, y).alias("q")).selectExpr(
        "p.word AS a", "p.n AS a_n", "q.word AS b", "q.n AS b_n"
    )


def near_pairs(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(a, a_n, b, b_n)``: every two words one inserted, deleted or replaced code point apart, once.

    The words of a bucket (a signature) are compared with each other by edit distance in the row that holds
    them, as long as it has up to ``crowded`` of them. Those of larger buckets meet by ``_cut_pairs``, which is exact
    too. Words that differ in one part meet in several buckets; a pair is returned once.
    """
    rows = signatures(words)
    sizes = rows.groupBy("signature").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > crowded)
    sizes = materialise(sizes.select("signature"), "spelling-crowded")
    few = keyed_join(rows, sizes, "signature", "left_anti", spread=["word"])
    buckets = few.groupBy("signature").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("l"))
    pairs = buckets.filter(F.size("l") > 1).select(F.explode(F.expr(IN_BUCKET)).alias("p")).select("p.*")
    if not sizes.isEmpty():
        many = keyed_join(rows, sizes, "signature", "left_semi", spread=["word"]).select("word", "n").distinct()
        pairs = pairs.unionByName(_cut_pairs(materialise(many, "spelling-many")))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form: the last form of the chain.

    A form has at least twice its word's occurrences, so chains have no cycle and are short; each round
    doubles how far every word sees and is written.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = keyed_join(now, step, "root", "left", spread=["word"])
        after = materialise(
            far.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 3, ratio: int = 2
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the corpus.

    Words are runs of a-z and U+00C0 to U+00FF, A-Z lower-cased, of five letters or more after the contract's
    damage (a letter less where 97 divides the checksum of id and run), found ``least`` times or more. Near words
    are one inserted, deleted or replaced code point apart. The form is the most frequent near word, of equally
    frequent ones the first in code point order, if it is at least ``ratio`` times as frequent; the root is the
    last form of forms. Null texts have no words; a null id counts as an empty one; repeated rows count
    each; very long texts are read in pieces; an empty table gives no rows. Other columns are not read.
    """
    words = materialise(word_counts(docs, doc_id, text, least), "spelling-words")
    pairs = materialise(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.struct(-F.col("b_n"), "b").alias("near")).unionAll(
        pairs.select(F.col("b").alias("word"), F.struct(-F.col("a_n"), "a").alias("near"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"))
    best = best.select("word", "n_near", F.col("near.b").alias("best"), (-F.col("near.col1")).alias("best_n"))
    met = keyed_join(words, materialise(best, "spelling-near"), "word", "left", bounded=True)
    fits = F.col("best_n") >= F.col("n") * ratio
    formed = materialise(
        met.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(formed.filter(F.col("form").isNotNull()))
    out = keyed_join(formed, last, "word", "left", bounded=True)
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
