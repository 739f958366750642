"""Quality rules from word counts and from how well a text compresses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from wardline.llm.common import append, arrow_map, fields

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEVEL = 3

BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
RATIOS = "ratio double, chunk_ratio double"


@dataclass(frozen=True)
class Bands:
    """Least and most compressed bytes per byte, by the length of a text in bytes and by its kind.

    ``whole`` has rows (bytes below which it holds, least, least of wide scripts, least of marked texts, most); the last
    holds for longer texts.
    Texts with ``wide`` bytes per code point or more, as in Cyrillic or Greek letters, share the lead bytes of their letters
    and compress further. Texts are marked where ``marks`` or more of the code points in words are ``SYMBOLS``: signs
    after words or between cells lower their ratio, so these must reach the ratios of plain prose. Long texts share more with themselves, so the band sinks with the length. Texts of two whole
    chunks or more are also cut in chunks of ``chunk`` bytes, and the median chunk, which length does not
    change, has a band of its own. Least ratios are about those that 99 % of licences, package
    descriptions, manuals and message catalogues in many languages reach, which are more formulaic than prose.
    """

    whole: Sequence[tuple[float, float, float, float, float]] = field(
        default=(
            (256, 0.50, 0.42, 0.56, 1.20),
            (512, 0.48, 0.42, 0.54, 0.90),
            (768, 0.45, 0.40, 0.52, 0.85),
            (1024, 0.44, 0.36, 0.495, 0.80),
            (1536, 0.38, 0.32, 0.485, 0.75),
            (2048, 0.38, 0.32, 0.47, 0.72),
            (3072, 0.32, 0.29, 0.455, 0.72),
            (4096, 0.32, 0.20, 0.445, 0.70),
            (8192, 0.30, 0.20, 0.427, 0.70),
            (16384, 0.26, 0.19, 0.405, 0.70),
            (65536, 0.18, 0.16, 0.38, 0.70),
            (float("inf"), 0.0, 0.0, 0.0, 0.70),
        )
    )
    wide: float = 1.3
    marks: float = 0.1
    chunk: int = 4096
    chunk_least: float = 0.24
    chunk_least_wide: float = 0.22
    chunk_least_marked: float = 0.436
    chunk_most: float = 0.70

    def keeps(self, size: int, points: int, in_words: int, symbols: int, ratio: float, chunk_ratio: float | None) -> bool:
        """The verdict for a text of ``size`` bytes and ``points`` code points, of which ``in_words`` and ``symbols``."""
        kind = 2 if symbols >= self.marks * in_words else 1 if size >= self.wide * points else 0
        *least, most = next(row[1:] for row in self.whole if size < row[0])
        if not least[kind] <= ratio <= most:
            return False
        chunk_least = (self.chunk_least, self.chunk_least_wide, self.chunk_least_marked)[kind]
        return chunk_ratio is None or chunk_least <= chunk_ratio <= self.chunk_most


def repeated_words(words: list[str], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    at = code[:n].copy()
    for k in range(1, width):
        # Pairs (window so far, next word) are numbered anew each time, so nothing overflows.
        _, at = np.unique(at * np.int64(len(number)) + code[k : k + n], return_inverse=True)
    again = np.bincount(at)[at] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(width):
        covered[k : k + n] |= again
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """``BASE`` of one text, all 0 for a null one."""
    text = text or ""
    raw = text.encode()
    # Splitting bytes knows the six ASCII spaces only; equal words have equal bytes.
    words = raw.split()
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        repeated_lines(text),
        repeated_words(words),
    )


def ratios(raw: bytes, chunk: int, press: zstandard.ZstdCompressor) -> tuple[float, float | None]:
    """Compressed bytes per byte of a whole text, and of its median whole chunk where it has two."""
    if not raw:
        return 0.0, None
    parts = [
        len(press.compress(raw[at : at + chunk])) / chunk for at in range(0, len(raw) - chunk + 1, chunk)
    ]
    return len(press.compress(raw)) / len(raw), float(np.median(parts)) if len(parts) > 1 else None


def with_quality(docs: DataFrame, text: str = "text", bands: Bands | None = None) -> DataFrame:
    """The frame without its text and with ``BASE``, ``RATIOS``, ``base_failed`` and ``kept``.

    ``base_failed``: under 50 words, or over half the words repeated. ``kept``: not that, and the
    ratios within their bands; too small a ratio is repetition or filler, too large a one noise. A
    null or empty text has zeros throughout and fails. Ratios are of UTF-8 bytes at level 3, a frame each; ``chunk_ratio`` is
    null where a text has fewer than two whole chunks. Other columns pass through, but for ones named like the
    results, which are replaced.
    """
    bands = bands or Bands()
    names = [p.split()[0] for p in f"{BASE}, {RATIOS}, base_failed boolean, kept boolean".split(", ")]

    def run(batches):
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = []
            for value in batch.column(text):
                got = value.as_py() or ""
                base = measures(got)
                raw = got.encode()
                ratio, chunk_ratio = ratios(raw, bands.chunk, press)
                failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
                within = not failed and bands.keeps(len(raw), len(got), base[1], base[2], ratio, chunk_ratio)
                rows.append((*base, ratio, chunk_ratio, failed, within))
            kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
            columns = list(zip(*rows)) or [()] * len(names)
            yield append(batch, [text], {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    kept = docs.drop(*names)
    schema = ", ".join(
        x for x in (fields(kept, [text]), f"{BASE}, {RATIOS}, base_failed boolean, kept boolean") if x
    )
    return arrow_map(kept, run, schema)
