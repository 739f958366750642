"""Benchmark decontamination: windows of templates find re-parameterised questions too."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardline.llm.arrow_words import Growing, Vocabulary, slices, split_words
from wardline.llm.common import ROW_KEY, arrow_map, same_row, with_row_key
from wardline.sources.tables import materialise

WINDOW = 8
# Words of a passage that must agree, or all but two of a shorter item.
LEAST_WORDS = 13
# Share of a window's tokens that must be plain words, not placeholders.
PLAIN_SHARE = 0.6
BITMAP_BITS = 23
# Added to the length of exact windows in their hash.
EXACT = 1 << 16

# Words that count as numbers and as units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg gram grams kilogram kilograms "
    "pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute "
    "minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros "
    "percent degree degrees mph kmh watt watts volt volts joule joules newton newtons meter meters metre metres"
).split()
NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?")
QUANTITY = re.compile(r"[$€£]?\d[\d.,]*(?:[a-z]{1,3}|%|°[cf]?)?")
EDGE = re.compile(r"^[^\w$€£+-]+|[^\w%°]+$")
MARKS = "!\"#&'()*,./:;<=>?@[\\]^_`{|}~-«»“”‘’„…¿¡–—"
SENTENCE_END = r"[.!?…][\"')\]”’»]*$"
LINE_END = "\x00"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _code(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 42)


NUM, QTY, UNIT, NAME = (_code(f"<{k}>") for k in ("number", "quantity", "unit", "name"))


def core(word: str) -> str:
    return EDGE.sub("", word).lower()


def exact(core: str) -> int:
    """The code of a word itself: case and marks make no difference, but a value keeps its marks."""
    return _code((core if placeholder(core) else "".join(c for c in core if c.isalnum()) or core).casefold())


_NUMBERS, _UNITS = frozenset(NUMBER_WORDS), frozenset(UNIT_WORDS)


def placeholder(core: str) -> int:
    """The code of the placeholder a word's core stands for; 0 for a plain word."""
    if core in _NUMBERS:
        return NUM
    if core in _UNITS:
        return UNIT
    if core.isalpha():
        return 0
    return NUM if NUMBER.fullmatch(core) else QTY if QUANTITY.fullmatch(core) else 0


class Lexicon:
    """What each word stands for, remembered within bounds.

    ``code`` hashes the word's core, or its placeholder, and ``same`` the word itself; ``kind`` has a column each for placeholders, words with a
    capital first letter, words in capitals throughout, ends of sentences and words without a letter or digit.
    """

    def __init__(self):
        self.cores = Vocabulary(self._learn_cores, self._forget_cores)
        self.words = Vocabulary(self._learn, self._forget)
        self._forget_cores()
        self._forget()

    def _forget_cores(self) -> None:
        self.core_code, self.core_same, self.core_slot = Growing(np.uint64), Growing(np.uint64), Growing(bool)

    def _forget(self) -> None:
        self.code, self.same = Growing(np.uint64), Growing(np.uint64)
        self.kind = [Growing(bool) for _ in range(5)]

    def _learn_cores(self, cores: pa.Array) -> None:
        codes, slots = [], []
        for core in cores.to_pylist():
            code = placeholder(core)
            codes.append(code or _code(core))
            slots.append(code != 0)
        self.core_code.extend(np.array(codes, dtype=np.uint64))
        self.core_same.extend(np.array([exact(core) for core in cores.to_pylist()], dtype=np.uint64))
        self.core_slot.extend(slots)

    def _learn(self, words: pa.Array) -> None:
        bare = pc.utf8_trim(words, MARKS)
        simple = pc.utf8_is_alpha(bare)
        cores = pc.utf8_lower(bare)
        if not pc.all(simple).as_py():
            others = [core(w) for w in words.filter(pc.invert(simple)).to_pylist()]
            cores = pc.replace_with_mask(cores, pc.invert(simple), pa.array(others, pa.string()))
        number = self.cores.numbers(cores)
        slot = self.core_slot.values[number]
        first = pc.utf8_slice_codeunits(pc.utf8_ltrim(words, MARKS), 0, 1)
        kinds = (
            slot,
            ~slot & _flags(pc.utf8_is_upper(first)),
            _flags(pc.utf8_is_upper(words)),
            _flags(pc.or_(pc.match_substring_regex(words, SENTENCE_END), pc.equal(words, LINE_END))),
            ~_flags(pc.match_substring_regex(cores, r"[\pL\pN]")),
        )
        self.code.extend(self.core_code.values[number])
        self.same.extend(self.core_same.values[number])
        for held, new in zip(self.kind, kinds):
            held.extend(new)


def _flags(values: pa.Array) -> np.ndarray:
    return pc.fill_null(values, False).to_numpy(zero_copy_only=False)


@lru_cache(maxsize=1)
def lexicon() -> Lexicon:
    return Lexicon()


@dataclass
class Tokens:
    """Tokens of a slice of texts: their row, place in the row's text, code, code of the word itself, placeholder flag and word."""

    row: np.ndarray
    place: np.ndarray
    code: np.ndarray
    same: np.ndarray
    slot: np.ndarray
    at: np.ndarray
    words: pa.Array

    def word(self, k: int, before: Tokens | None) -> str:
        """The word of token ``k`` counted from the carried ones on."""
        held = len(before.row) if before else 0
        return before.words[int(before.at[k])].as_py() if k < held else self.words[int(self.at[k - held])].as_py()


def read_tokens(texts: pa.Array) -> Iterator[Tokens]:
    """Tokens of a column of texts, in slices; a long text comes in several.

    A capitalised word is a name unless it begins a sentence, a line or a text, or stands in a run of words in
    capitals.
    """
    book = lexicon()
    last, tokens, ended = -1, 0, True
    for part in slices(texts):
        spaced = pc.replace_substring_regex(part.texts, "[\t\v\f\r]", " ")
        words, at = split_words(pc.replace_substring(spaced, "\n", f" {LINE_END} "))
        number = book.words.numbers(words)
        slot, capital, loud, ends, no_token = (k.values[number] for k in book.kind)
        begins = np.concatenate([[True], ends[:-1]])
        begins[at[:-1]] = True
        goes_on = int(part.owners[0]) == last
        if goes_on:
            begins[0] = ended
        beside = np.concatenate([[False], loud[:-1]]) | np.concatenate([loud[1:], [False]])
        name = capital & ~begins & ~(loud & beside)
        kept = np.flatnonzero(~no_token)
        row = np.repeat(part.owners, at[1:] - at[:-1])[kept]
        upto = np.concatenate([[0], np.cumsum(~no_token)])
        place = np.arange(len(kept)) - np.repeat(upto[at[:-1]], upto[at[1:]] - upto[at[:-1]])
        if goes_on:
            place = place + tokens
        last, tokens, ended = int(part.owners[-1]), int(place[-1]) + 1 if len(place) else (tokens if goes_on else 0), bool(ends[-1])
        code = np.where(name, np.uint64(NAME), book.code.values[number])[kept]
        yield Tokens(row, place, code, book.same.values[number][kept], (slot | name)[kept], kept, words)


def _passes(hashes: np.ndarray, bitmap: np.ndarray | None) -> np.ndarray:
    if bitmap is None:
        return np.ones(len(hashes), dtype=bool)
    place = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _hashes(code: np.ndarray, first: int, n: int, length: int) -> np.ndarray:
    """Of the windows from ``first`` to before ``n``; ``EXACT`` in the length sets exact ones apart."""
    value = np.zeros(n - first, dtype=np.uint64)
    for k in range(length % EXACT):
        value *= _BASE
        value += code[first + k : n + k]
    value = (value ^ (value >> np.uint64(29))) * _MIX + np.uint64(length)
    return value ^ (value >> np.uint64(32))


def windows(texts: pa.Array, lengths: tuple[int, ...], bitmap: np.ndarray | None = None, also_exact: bool = False):
    """``(row, length, position, hash, slot values, their places)`` of template windows, of whole texts.

    Numbers, quantities, units and capitalised words inside sentences become typed placeholders; the
    rest is lower-cased and freed of marks at its ends. Template windows with too few plain words are left out.
    Exact windows, given on demand, hold the words themselves, without case and marks, and have no slots. With a
    bitmap all that it excludes are left out.
    """
    before: Tokens | None = None
    for now in read_tokens(texts):
        if before is not None and len(now.row) and before.row[-1] != now.row[0]:
            before = None
        held = len(before.row) if before else 0
        row, place, code, same, slot = (
            np.concatenate([getattr(before, f), getattr(now, f)]) if held else getattr(now, f)
            for f in ("row", "place", "code", "same", "slot")
        )
        plain = np.concatenate([[0], np.cumsum(~slot)])
        for length in lengths:
            # Windows that lie in what was carried over have been seen.
            first = max(0, held - length + 1)
            n = len(code) - length + 1
            if n <= first:
                continue
            whole = row[first:n] == row[first + length - 1 : n + length - 1]
            value = _hashes(code, first, n, length)
            wanted = plain[first + length : n + length] - plain[first:n] >= PLAIN_SHARE * length
            wanted &= whole
            wanted &= _passes(value, bitmap)
            for k in np.flatnonzero(wanted):
                at = first + int(k)
                places = np.flatnonzero(slot[at : at + length]).tolist()
                slots = [core(now.word(at + i, before)) for i in places]
                yield int(row[at]), length, int(place[at]), int(value[k : k + 1].view(np.int64)[0]), slots, places
            if not also_exact:
                continue
            value = _hashes(same, first, n, length + EXACT)
            for k in np.flatnonzero(whole & _passes(value, bitmap)):
                at = first + int(k)
                yield int(row[at]), length, int(place[at]), int(value[k : k + 1].view(np.int64)[0]), [], []
        keep = min(len(code), max(lengths) - 1)
        if keep:
            carried = [now.word(len(code) - keep + i, before) for i in range(keep)]
            before = Tokens(row[-keep:], place[-keep:], code[-keep:], same[-keep:], slot[-keep:], np.arange(keep), pa.array(carried, pa.string()))
        else:
            before = None


WINDOW_COLUMNS = "length int, position bigint, hash bigint, slots array<string>, places array<int>"


def _window_rows(carried: list[str], lengths: tuple[int, ...], bitmap):
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())]
    names = [c.split()[0] for c in WINDOW_COLUMNS.split(", ")]

    def run(batches):
        bits = None if bitmap is None else np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            owners, rows = [], []

            def flush():
                taken = batch.select(carried).take(pa.array(owners, pa.int64()))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                return pa.RecordBatch.from_arrays(list(taken.columns) + columns, names=carried + names)

            for owner, *found in windows(batch.column("text"), lengths, bits, also_exact=True):
                owners.append(owner)
                rows.append(found)
                if len(rows) >= 50_000:
                    yield flush()
                    owners, rows = [], []
            if rows:
                yield flush()

    return run


def _with_tokens(batches):
    for batch in batches:
        counts = np.zeros(batch.num_rows, dtype=np.int32)
        for tokens in read_tokens(batch.column("text")):
            np.add.at(counts, tokens.row, 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts)], names=["item_id", "text", "tokens"])


def steady_stretch(found: list[dict]) -> tuple[int, int, int]:
    """The longest stretch of a passage's windows in which each slot value of the item stands for one value.

    ``(windows, first position, changed slot values)``. Windows come as ``position`` and ``found`` slots, each with
    ``was`` and ``now``; of equally long stretches the one with the fewest changed values counts, then the first. A window
    that names two values for one by itself belongs to no stretch; one that was met both as template and as
    it stands has its slots from the template.
    """
    at: dict[int, set[tuple[str, str]]] = {}
    for window in found:
        at.setdefault(window["position"], set()).update((s["was"], s["now"]) for s in window["found"])
    places = sorted(at)
    held: dict[str, Counter] = {}
    best = (0, 0, 0)
    low = 0
    odd = 0
    for high, place in enumerate(places):
        for was, now in at[place]:
            values = held.setdefault(was, Counter())
            values[now] += 1
            odd += len(values) == 2 and values[now] == 1
        while odd:
            for was, now in at[places[low]]:
                values = held[was]
                values[now] -= 1
                if not values[now]:
                    del values[now]
                    odd -= len(values) == 1
            low += 1
        if low <= high:
            changed = len({pair for p in places[low : high + 1] for pair in at[p] if pair[0] != pair[1]})
            best = max(best, (high + 1 - low, -changed, -places[low]))
    windows, changed, start = best
    return windows, -start, -changed


def _stretch_rows(batches):
    """Rows of passages that are consistent in a stretch of enough words only."""
    names = [*ROW_KEY, "item_id", "matched_words", "start_word", "changed_slots"]
    for batch in batches:
        owners, rows = [], []
        columns = (batch.column("_found").to_pylist(), batch.column("length").to_pylist(), batch.column("_least").to_pylist())
        for i, (found, length, least) in enumerate(zip(*columns)):
            count, start, changed = steady_stretch(found)
            if count and count + length - 1 >= least:
                owners.append(i)
                rows.append((count + length - 1, start, changed))
        if rows:
            kept = batch.select([*ROW_KEY, "item_id"]).take(pa.array(owners, pa.int64()))
            kinds = [pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=names)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Documents that hold a benchmark passage: one row per document and item.

    ``ROW_KEY, item_id, matched_words, start_word, changed_slots``. Windows of equal templates, and such of
    equal words whatever their case, marks and placeholders, are met by a hash join. A passage is a set of windows at one distance between document and item;
    it counts when it spans ``least_words`` tokens, or all but two of a shorter item,
    and when each slot value of the item stands for one value in the document throughout. Where it does not,
    the longest stretch of the passage in which it does is judged in the same way (``steady_stretch``).
    ``changed_slots`` is 0 for a plain copy and counts the slot values that differ otherwise.

    Before the join a bitmap of 2**23 bits, whatever the benchmark's size, drops windows that no item
    has. Items shorter than a window are searched whole; those with under five tokens are not, and those made of
    placeholders for the most part as they stand only. Null and empty texts hold nothing and match nothing; rows that agree in id and text
    give one row; an item repeated under one id counts once; empty tables give no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    items = materialise(arrow_map(items, _with_tokens, "item_id bigint, text string, tokens int"), "items")
    short = items.filter((F.col("tokens") < window) & (F.col("tokens") >= 5)).select("tokens").distinct()
    lengths = tuple(sorted({window, *(r["tokens"] for r in short.collect())}))  # at most ``window`` numbers
    schema = f"item_id bigint, tokens int, {WINDOW_COLUMNS}"
    sought = arrow_map(items, _window_rows(["item_id", "tokens"], lengths, None), schema)
    whole = (F.col("length") == window) | (F.col("length") == F.col("tokens"))
    sought = materialise(
        sought.filter(whole).select(
            F.col("item_id"),
            F.col("tokens"),
            F.col("length"),
            F.col("hash"),
            F.col("position").alias("item_position"),
            F.col("slots").alias("item_slots"),
        ),
        "item-windows",
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
    places = sought.select(F.shiftrightunsigned("hash", 64 - BITMAP_BITS).alias("p")).distinct().toPandas()["p"].to_numpy()
    np.bitwise_or.at(bitmap, places >> 3, (1 << (places & 7)).astype(np.uint8))
    shared = spark.sparkContext.broadcast(bitmap.tobytes())

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = with_row_key(slim).drop("doc_id")
    row = "_row_id bigint, _text_hash bigint, _text_sum bigint"
    found = arrow_map(keyed, _window_rows(ROW_KEY, lengths, shared), f"{row}, {WINDOW_COLUMNS}").distinct()
    met = found.join(sought, ["hash", "length"])
    slots = F.arrays_zip(
        F.transform("places", lambda p: p + F.col("item_position")).alias("place"),
        F.col("item_slots").alias("was"),
        F.col("slots").alias("now"),
    )
    passages = met.groupBy(
        *ROW_KEY, "item_id", "tokens", "length", (F.col("position") - F.col("item_position")).alias("_distance")
    ).agg(
        F.countDistinct("position").alias("_windows"),
        F.min("position").alias("start_word"),
        F.collect_set(F.struct("position", slots.alias("found"))).alias("_found"),
    )
    # At most one entry per window of the item.
    every = F.flatten(F.col("_found.found"))
    pairs = F.array_distinct(F.transform(every, lambda s: F.struct(s["was"].alias("was"), s["now"].alias("now"))))
    judged = passages.withColumn("_pairs", pairs).select(
        *ROW_KEY,
        "item_id",
        (F.col("_windows") + F.col("length") - 1).cast("int").alias("matched_words"),
        "start_word",
        F.size(F.filter("_pairs", lambda s: s["was"] != s["now"])).alias("changed_slots"),
        (F.size("_pairs") == F.size(F.array_distinct(F.transform("_pairs", lambda s: s["was"])))).alias("_steady"),
        F.least(F.lit(least_words), F.greatest(F.col("tokens") - 2, F.col("length"))).alias("_least"),
        "length",
        "_found",
    ).filter("matched_words >= _least")
    judged = materialise(judged.withColumn("_found", F.when(~F.col("_steady"), F.col("_found"))), "passages")
    outcome = [*ROW_KEY, "item_id", "matched_words", "start_word", "changed_slots"]
    pieces = arrow_map(
        judged.filter("not _steady").select(*ROW_KEY, "item_id", "length", "_least", "_found"),
        _stretch_rows,
        f"{row}, item_id bigint, matched_words int, start_word bigint, changed_slots int",
    )
    hits = judged.filter("_steady").select(*outcome).unionByName(pieces)
    best = F.max(F.struct("matched_words", (-F.col("changed_slots")).alias("c"), (-F.col("start_word")).alias("s")))
    return hits.groupBy(*ROW_KEY, "item_id").agg(best.alias("b")).select(
        *ROW_KEY,
        "item_id",
        F.col("b.matched_words").alias("matched_words"),
        (-F.col("b.s")).alias("start_word"),
        (-F.col("b.c")).alias("changed_slots"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a benchmark passage, all their columns as they were."""
    hits = materialise(contaminated(docs, benchmark, doc_id=doc_id, text=text).select(*ROW_KEY).distinct(), "hits")
    keyed = with_row_key(docs, doc_id, text)
    return keyed.join(hits, same_row(keyed, hits), "left_anti").select(*docs.columns)
