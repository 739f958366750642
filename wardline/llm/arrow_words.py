"""Words of many texts at once: Arrow splits them and numbers the distinct ones.

Python then sees each distinct word of a few megabytes of text once, and only if it is new; the rest is
NumPy over word numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 6 << 20
KNOWN_WORDS = 300_000
# Besides white space, characters that some pattern engines take for it.
DOUBTFUL = "\x1c\x1d\x1e\x1f\x85\u180e\u200b\ufeff"


def ends_unsafe(word: str) -> bool:
    return word[-1].isspace() or word[-1] in DOUBTFUL


@dataclass
class Slice:
    """Texts, or blocks of a long one; ``owners`` are their rows, in order."""

    owners: np.ndarray
    texts: pa.Array


def _blocks(text: str, size: int) -> Iterator[str]:
    """A long text cut before single blanks that follow a visible character."""
    at = 0
    while at < len(text):
        stop = text.find(" ", at + size)
        while stop > 0 and ends_unsafe(text[stop - 1]):
            stop = text.find(" ", stop + 1)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop]
        at = stop


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """A column of texts in slices of about ``size`` bytes, nulls as empty; a longer text in blocks of its own."""
    texts = pc.fill_null(texts, "")
    length = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(texts):
        if length[at] > size:
            for block in _blocks(texts[at].as_py(), size):
                yield Slice(np.array([at]), pa.array([block], pa.string()))
            at += 1
            continue
        stop, held = at, 0
        while stop < len(texts) and length[stop] <= size and (held + length[stop] <= size or stop == at):
            held += length[stop]
            stop += 1
        yield Slice(np.arange(at, stop), texts.slice(at, stop - at))
        # What the last slice used goes back, so that a worker's memory is one slice's.
        pa.default_memory_pool().release_unused()
        at = stop


class Vocabulary:
    """Numbers for strings, within bounds.

    ``learn`` is called with the new ones, an Arrow array, which get the next numbers; ``forget`` when all are
    dropped, because there are more than ``most``.
    """

    def __init__(self, learn: Callable[[pa.Array], None], forget: Callable[[], None], most: int = KNOWN_WORDS):
        self._learn, self._forget, self._most = learn, forget, most
        self.words = pa.array([], pa.string())

    def numbers(self, words: pa.Array) -> np.ndarray:
        coded = words.dictionary_encode()
        if len(self.words) > self._most:
            self.words = pa.array([], pa.string())
            self._forget()
        found = pc.index_in(coded.dictionary, value_set=self.words)
        new = found.is_null().to_numpy(zero_copy_only=False)
        number = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if new.any():
            fresh = coded.dictionary.filter(pa.array(new))
            self._learn(fresh)
            number[new] = len(self.words) + np.arange(len(fresh))
            self.words = pa.concat_arrays([self.words, fresh])
        return number[coded.indices.to_numpy(zero_copy_only=False)]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What stands between blanks, one text after another, and where each text's words begin."""
    lists = pc.split_pattern(texts, " ")
    at = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), at - at[0]


class Growing:
    """A NumPy array that grows at its end."""

    def __init__(self, dtype):
        self._held, self.size = np.zeros(1024, dtype=dtype), 0

    def extend(self, values) -> None:
        values = np.asarray(values, dtype=self._held.dtype)
        need = self.size + len(values)
        if need > len(self._held):
            grown = np.zeros(max(need, 2 * len(self._held)), dtype=self._held.dtype)
            grown[: self.size] = self._held[: self.size]
            self._held = grown
        self._held[self.size : need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self._held[: self.size]


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` between consecutive ``starts``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def spread(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``first, first + 1, ...`` of each stretch, one stretch after another."""
    stops = np.cumsum(lengths)
    total = int(stops[-1]) if len(stops) else 0
    return np.arange(total) + np.repeat(firsts - (stops - lengths), lengths)
