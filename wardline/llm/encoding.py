"""Tokenizers inside tasks: what stands between blanks is encoded once per distinct string.

Both kinds of tokenizer end a match between a visible character and white space, and at a letter run's
end before a mark, whatever stands around. So a text is cut there, and the pieces' tokens put
together are the text's. Where cutting is not proven safe, the text goes to the library whole; so does every text
of a tokenizer that is not of one of the two kinds (``WORD_KIND``, ``BYTE_KIND``) for which it is.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardline.llm.arrow_words import DOUBTFUL, Growing, Vocabulary, slices, split_words, spread, sums

# Strings a task remembers before it starts afresh, and characters of a batch for the library.
KNOWN_PARTS = 500_000
BATCH_CHARS = 1 << 20
# Letters and then ASCII marks but the apostrophe, which begins contractions.
SIMPLE = r"(?P<letters>[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
# Words after which a text is not cut: those that end in white space or what some engines take for it.
UNSAFE_END = "[\\x01\\x02\\t-\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]$"
# What a byte-level model has for a blank.
BLANK = "\u0120"
# Line ends, as one character each, that a word may begin with.
BREAKS = (("\n\n", "\x02"), ("\n", "\x01"))
# Normalizer, pre-tokenizer and model options of the two kinds of tokenizer that texts may be cut for.
WORD_KIND = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "model": ("BPE", None, None, None, "</w>", False, False),
}
BYTE_KIND = {
    "normalizer": None,
    "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    "model": ("BPE", None, None, None, None, False, False),
}


def kind(library) -> dict:
    """Normalizer, pre-tokenizer and model options of a tokenizer, as its file states them."""
    state = lambda part: part and json.loads(part.__getstate__())
    model = library.model
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback")
    return {
        "normalizer": state(library.normalizer),
        "pre_tokenizer": state(library.pre_tokenizer),
        "model": (type(model).__name__, *[getattr(model, o, None) or (False if o in options[4:] else None) for o in options]),
    }


def may_cut(library, wanted: dict) -> bool:
    """Whether texts may be cut: the tokenizer is of the wanted kind, and its added tokens begin with a mark and hold no white space."""
    added = library.get_added_tokens_decoder().values()
    return kind(library) == wanted and all(
        not t.content[:1].isalnum()
        and not any(c.isspace() or c in DOUBTFUL for c in t.content)
        and not (t.lstrip or t.rstrip or t.single_word or t.normalized)
        for t in added
    )


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Parts:
    """Token ids of strings, as the library gives them, remembered within bounds."""

    def __init__(self, path: str, spaced: bool):
        self.library = tokenizer(path)
        self.spaced = spaced
        self.cut = may_cut(self.library, BYTE_KIND if spaced else WORD_KIND)
        self._known = Vocabulary(self._learn, self._forget, KNOWN_PARTS)
        self._forget()

    def _forget(self) -> None:
        self._ids, self._first, self._length = Growing(np.int32), Growing(np.int64), Growing(np.int64)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def whole_batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, list[list[int]]]]:
        """Rows and their ids, each text encoded by itself, in batches of about equal length; nulls are empty."""
        held, rows, size = [], [], 0
        for row, text in enumerate(texts):
            held.append(text.as_py() or "")
            rows.append(row)
            size += len(held[-1])
            if size >= BATCH_CHARS or row == len(texts) - 1:
                yield np.array(rows), [e.ids for e in self.library.encode_batch_fast(held, add_special_tokens=False)]
                held, rows, size = [], [], 0

    def _encode(self, strings: list[str]) -> list[list[int]]:
        """Ids of strings. ASCII letters, perhaps after a blank, are one match; the library's model codes them at once."""
        out: list = [None] * len(strings)
        code = self.library.model.tokenize
        rest = []
        for k, s in enumerate(strings):
            bare = s[1:] if s[:1] == " " else s
            if bare.isascii() and bare.isalpha() and (self.spaced or bare is s) and (self.spaced or bare.islower()):
                out[k] = [t.id for t in code(s.replace(" ", BLANK))]
            else:
                rest.append(k)
        for k, e in zip(rest, self.library.encode_batch_fast([strings[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def _learn(self, fresh: pa.Array) -> None:
        """Encodes new strings in batches of about equal length."""
        new = fresh.to_pylist()
        at = 0
        while at < len(new):
            stop, size = at, 0
            while stop < len(new) and (size < BATCH_CHARS or stop == at):
                size += len(new[stop])
                stop += 1
            found = self._encode(new[at:stop])
            length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self._first.extend(self._ids.size + np.cumsum(length) - length)
            self._length.extend(length)
            self._ids.extend(np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(length.sum())))
            at = stop

    def stretches(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each string begin, how many they are, and the ids of all."""
        number = self._known.numbers(parts)
        return self._first.values[number], self._length.values[number], self._ids.values


def simple_parts(words: pa.Array, lead: pa.Array | None, lower: bool) -> pa.Array:
    """Two parts of each word, one after the other: its letters and the marks that end it.

    A word of another form is its own first part; the second is then empty. ``lead`` goes before the first part.
    """
    found = pc.extract_regex(words, "^" + SIMPLE)
    plain = found.is_valid()
    letters = pc.struct_field(found, "letters")
    letters = pc.if_else(plain, pc.utf8_lower(letters) if lower else letters, words)
    if lead is not None:
        letters = pc.binary_join_element_wise(lead, letters, "")
    marks = pc.if_else(plain, pc.struct_field(found, "marks"), "")
    n = len(words)
    order = pa.array(np.arange(2 * n).reshape(2, n).T.reshape(-1))
    return pa.concat_arrays([letters.cast(pa.string()), marks.cast(pa.string())]).take(order)


class Encoder:
    """Token ids of whole texts for a tokenizer that drops white space and lower-cases."""

    def __init__(self, path: str):
        self.parts = Parts(path, False)
        self.words = Vocabulary(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.first, self.length = Growing(np.int32), Growing(np.int64), Growing(np.int64)

    def _learn(self, words: pa.Array) -> None:
        first, length, ids = self.parts.stretches(simple_parts(words, None, True))
        own = length.reshape(-1, 2).sum(axis=1)
        self.first.extend(self.ids.size + np.cumsum(own) - own)
        self.length.extend(own)
        self.ids.extend(ids[spread(first, length)])

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(rows, number of ids, ids one row after another)``; a long text comes in several parts, in order."""
        if not self.parts.cut:
            for rows, found in self.parts.whole_batches(texts):
                length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
                yield rows, length, np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(length.sum()))
            return
        for part in slices(texts):
            words, at = split_words(pc.replace_substring(part.texts, "\n", " "))
            number = self.words.numbers(words)
            length = self.length.values[number]
            ids = self.ids.values[spread(self.first.values[number], length)]
            yield part.owners, sums(length, at), ids


class Counter:
    """Token counts of whole texts for a byte-level tokenizer.

    A text is cut before a blank, a line end or two of these that follow a visible character. Texts
    with any other white space before a cut, or characters on which pattern engines differ, go to
    the library whole.
    """

    def __init__(self, path: str):
        self.parts = Parts(path, True)
        self.words = Vocabulary(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.size, self.unsafe = Growing(np.int64), Growing(bool)

    def _sizes(self, words: pa.Array, blank: bool) -> np.ndarray:
        """Tokens of each word, with the blank or the line ends it follows."""
        head = pc.utf8_slice_codeunits(words, 0, 1)
        lead = pa.array([" " if blank else ""] * len(words), pa.string())
        bare = words
        for real, sign in BREAKS:
            here = pc.equal(head, sign)
            lead = pc.if_else(here, real, lead)
            bare = pc.if_else(here, pc.utf8_slice_codeunits(bare, 1), bare)
        _, length, _ = self.parts.stretches(simple_parts(bare, lead, False))
        return length.reshape(-1, 2).sum(axis=1)

    def _learn(self, words: pa.Array) -> None:
        self.size.extend(self._sizes(words, True))
        bad = pc.or_(pc.equal(words, ""), pc.match_substring_regex(words, UNSAFE_END))
        self.unsafe.extend(bad.to_numpy(zero_copy_only=False))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        total = np.zeros(len(texts), dtype=np.int64)
        if not self.parts.cut:
            for rows, found in self.parts.whole_batches(texts):
                total[rows] = [len(f) for f in found]
            return total
        for part in slices(texts):
            signed = part.texts
            odd = pc.match_substring_regex(signed, "[\x01\x02]").to_numpy(zero_copy_only=False)
            for real, sign in BREAKS:
                signed = pc.replace_substring(signed, real, f" {sign}")
            words, at = split_words(signed)
            number = self.words.numbers(words)
            size, unsafe = self.size.values[number], self.unsafe.values[number].astype(np.int64)
            first, last = at[:-1], at[1:] - 1
            # No cut follows a text's last word; its first word follows no blank, and an empty one is no word.
            unsafe[last] = 0
            heads = words.take(pa.array(first))
            unsafe[first[pc.equal(heads, "").to_numpy(zero_copy_only=False)]] = 0
            size[first] = self._sizes(heads, False)
            counts = sums(size, at)
            for k in np.flatnonzero(odd | (sums(unsafe, at) > 0)):
                counts[k] = len(self.parts.whole(part.texts[int(k)].as_py()))
            np.add.at(total, part.owners, counts)
        return total


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)
