"""Licence notices found by conditional compression and confirmed word by word."""

from __future__ import annotations

import re
from bisect import bisect, insort
from collections import Counter
from collections.abc import Mapping, Sequence
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import ROW_KEY, arrow_map, with_row_key
from wardline.llm.license_notices import CUES, NOTICES, TELLING

LEVEL = 9
# Share of a notice's words that may differ; none of them may be one that tells licences apart.
MOST_DIFFERENT = 0.1
# Bytes of a block; longer ones are compressed and compared in stretches that overlap by a half.
STRETCH = 4096
# A word goes on after a hyphen at the end of a line, past the marks of a comment.
WORDS = re.compile(r"[A-Za-z0-9]+(?:(?:\.|-(?:\n[\s*#/]*)?)[A-Za-z0-9]+)*")
BREAK = re.compile(r"\n[\s*#/]*")
PARTS = re.compile(r"[.\-]")
# The number of a list item: at the start of a line or after a mark, but not the version of a licence.
ITEM_NUMBER = re.compile(r"(?<!version)(?<!Version)(?<!\bv)(?:\A|\n|[:;.,]\s)[\s*#/]*\(?(\d{1,2}[.)])(?=\s)")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+(?=[A-Z])")


def words_at(text: str) -> tuple[list[str], list[int]]:
    """Lower-cased words without the numbers of list items, and where each starts."""
    numbers = {m.start(1) for m in ITEM_NUMBER.finditer(text)}
    found = [(BREAK.sub("", m.group()).lower(), m.start()) for m in WORDS.finditer(text) if m.start() not in numbers]
    return [w for w, _ in found], [at for _, at in found]


@lru_cache(maxsize=1 << 16)
def tells_apart(word: str) -> bool:
    """Whether a licence becomes another one with this word: it has a digit, or a part that names a licence or a term."""
    return any(c.isdigit() for c in word) or any(part in TELLING for part in PARTS.split(word))


@lru_cache(maxsize=4)
def _templates(notices: tuple[tuple[str, tuple[str, ...]], ...]):
    """Per notice: licence, words, their numbers, and a compressor that has the words as raw dictionary."""
    out = []
    for name, texts in notices:
        for text in texts:
            words = words_at(text)[0]
            raw = " ".join(words).encode()
            book = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            book.precompute_compress(level=LEVEL)
            out.append((name, words, Counter(words), zstandard.ZstdCompressor(level=LEVEL, dict_data=book)))
    return out


@lru_cache(maxsize=4)
def _reach(notices: tuple[tuple[str, tuple[str, ...]], ...]) -> int:
    """Characters that a notice runs at most without a cue, twice over for indents and marks of comments."""
    most = 0
    for _, texts in notices:
        for text in texts:
            low = text.lower()
            at = [0, *sorted(m.start() for cue in CUES for m in re.finditer(cue, low)), len(low)]
            most = max(most, *(b - a for a, b in zip(at, at[1:])))
    return 2 * most


def _has_cue(low: str) -> bool:
    return any(cue in low for cue in CUES)


def blocks(text: str, reach: int) -> list[tuple[int, str]]:
    """Candidate blocks ``(start, block)`` of a text.

    Each line with a cue, each of its sentences with one where it has several, and, for notices broken into lines, the
    lines around cues: lines with cues no more than ``reach`` characters apart share a block, which takes in the lines
    that are within ``reach`` before its first and after its last.
    """
    if not _has_cue(text.lower()):
        return []
    lines = text.split("\n")
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(line) + 1)
    marked = [i for i, line in enumerate(lines) if _has_cue(line.lower())]
    out = []
    runs: list[list[int]] = []
    for i in marked:
        out.append((starts[i], lines[i]))
        cuts = [0, *(m.end() for m in SENTENCE_END.finditer(lines[i])), len(lines[i])]
        if len(cuts) > 2:
            out += [(starts[i] + a, lines[i][a:b]) for a, b in zip(cuts, cuts[1:]) if _has_cue(lines[i][a:b].lower())]
        if runs and starts[i] - starts[runs[-1][1] + 1] <= reach:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    for first, last in runs:
        begin, end = starts[first], starts[last + 1]
        while first > 0 and begin - starts[first - 1] <= reach:
            first -= 1
        while last + 1 < len(lines) and starts[last + 2] - end <= reach:
            last += 1
        if last > first:
            out.append((starts[first], "\n".join(lines[first : last + 1])))
    return out


def stretches(words: list[str]) -> list[tuple[int, list[str]]]:
    """A block's words whole, or in stretches that overlap by a half where it is long, each with its first word's place."""
    out, at = [], 0
    while True:
        stop, size = at, 0
        while stop < len(words) and (size < STRETCH or stop == at):
            size += len(words[stop]) + 1
            stop += 1
        out.append((at, words[at:stop]))
        if stop >= len(words):
            return out
        at = max(at + 1, (at + stop) // 2)


def differences(block: Sequence[str], notice: Sequence[str]) -> tuple[int, int, int, bool]:
    """Where a notice stands in a block, ``start`` to ``stop``, and how many words turn one into the other there.

    Words of the block before the notice's first word or after its last are no differences. The last value says whether a
    word that tells licences apart is among them.
    """
    spare = max(1, int(MOST_DIFFERENT * len(notice)))
    match = SequenceMatcher(None, block, notice, autojunk=False).find_longest_match()
    if not match.size:
        return 0, 0, len(notice), True
    low = max(0, match.a - match.b - spare)
    there = block[low : match.a - match.b + len(notice) + spare]
    steps = SequenceMatcher(None, there, notice, autojunk=False).get_opcodes()
    count, telling = 0, False
    start, stop = low, low + len(there)
    for k, (tag, a, b, c, d) in enumerate(steps):
        if tag == "equal":
            continue
        if k == 0:
            a = max(a, b - (d - c))
            start = low + a
        if k == len(steps) - 1:
            b = min(b, a + (d - c))
            stop = low + b
        count += max(b - a, d - c)
        telling |= any(map(tells_apart, there[a:b])) or any(map(tells_apart, notice[c:d]))
    return start, stop, count, telling


def confirmed(words: Sequence[str], counted: Counter, notice: Sequence[str], needed: Counter) -> tuple[int, int, int] | None:
    """``(start, stop, differences)`` of a notice in words, None where it differs too much.

    Every word that the block lacks is a difference, so most notices are ruled out by counts alone.
    """
    most = int(MOST_DIFFERENT * len(notice))
    lacking = needed - counted
    if lacking.total() > most or any(map(tells_apart, lacking)):
        return None
    start, stop, count, telling = differences(words, notice)
    return None if telling or count > most else (start, stop, count)


def _claim(spans: list[tuple[int, int]], start: int, stop: int) -> bool:
    """Adds a span to sorted ones that do not overlap, unless it overlaps one of them."""
    k = bisect(spans, (start, stop))
    if (k and spans[k - 1][1] > start) or (k < len(spans) and spans[k][0] < stop):
        return False
    insort(spans, (start, stop))
    return True


def scan(text: str | None, notices: Mapping[str, Sequence[str]] = NOTICES) -> list[tuple]:
    """Licences of a text: ``(first_line, last_line, license, reduction, differences)``, in order.

    Every candidate block is compressed alone and with each notice as raw dictionary; ``reduction`` is the share
    of bytes the dictionary saves. All notices that save any are compared with the block word by word, those that save
    most first, and stand when few enough words differ, none of which tells licences apart. Of notices that
    overlap the longest stands, then the one with the fewest differences, then the one that saves most. Lines are
    those of the notice itself. A licence is listed once for overlapping lines.
    """
    text = text or ""
    known = tuple((k, tuple(v)) for k, v in notices.items())
    templates = _templates(known)
    plain = zstandard.ZstdCompressor(level=LEVEL)
    held = []
    for place, block in blocks(text, _reach(known)):
        every, at = words_at(block)
        for begin, words in stretches(every):
            if not words:
                continue
            raw = " ".join(words).encode()
            alone = len(plain.compress(raw))
            counted = Counter(words)
            saved = [(1 - len(t[3].compress(raw)) / alone, -k) for k, t in enumerate(templates)]
            for reduction, k in sorted(saved, reverse=True):
                if reduction <= 0:
                    break
                name, notice, needed, _ = templates[-k]
                found = confirmed(words, counted, notice, needed)
                if found:
                    start, stop, count = found
                    first, last = begin + start, begin + stop - 1
                    span = place + at[first], place + at[last] + len(every[last])
                    held.append((-len(notice), count, -round(reduction, 6), *span, name))
    line_starts = [0, *(m.end() for m in re.finditer("\n", text))] if held else []
    taken: list[tuple[int, int]] = []
    lines_of: dict[str, list[tuple[int, int]]] = {}
    out = []
    for _, count, reduction, start, stop, name in sorted(held):
        if _claim(taken, start, stop):
            first, last = bisect(line_starts, start) - 1, bisect(line_starts, stop - 1) - 1
            if _claim(lines_of.setdefault(name, []), first, last + 1):
                out.append((first, last, name, -reduction, count))
    return sorted(out)


HITS = "first_line int, last_line int, license string, reduction double, differences int"


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: Mapping[str, Sequence[str]] = NOTICES) -> DataFrame:
    """One row per document and licence notice found: ``ROW_KEY`` and ``HITS``.

    Lines are numbered from 0. Null and empty texts hold none; repeated rows each give theirs; an empty table
    gives no rows; other columns are not read. The work is one pass without a shuffle; the
    notices are configuration of a few kilobytes.
    """
    held = {k: tuple(v) for k, v in notices.items()}
    keyed = with_row_key(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).drop("doc_id")

    def run(batches):
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32()]
        names = [c.split()[0] for c in HITS.split(", ")]
        for batch in batches:
            owners, rows = [], []
            for i, value in enumerate(batch.column("text")):
                for row in scan(value.as_py(), held):
                    owners.append(i)
                    rows.append(row)
            if rows:
                key = batch.select(ROW_KEY).take(pa.array(owners, pa.int64()))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(list(key.columns) + columns, names=ROW_KEY + names)

    return arrow_map(keyed, run, f"_row_id bigint, _text_hash bigint, _text_sum bigint, {HITS}")
