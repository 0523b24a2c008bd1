"""Words of whole texts, found and hashed for many texts at once with numpy.

All functions work on the UTF-8 bytes of an Arrow column. Classes of word characters are tables over bytes, which is
exact because the contracts either name ASCII characters only or take every non-ASCII character as part of a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
#: Odd, so that it has an inverse modulo 2**64.
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + _STEP
        x = (x ^ (x >> np.uint64(30))) * _MIX_1
        x = (x ^ (x >> np.uint64(27))) * _MIX_2
        return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(256, dtype=np.uint64) + np.uint64(0xA0761D6478BD642F))

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

#: Everything but space, tab, line feed, vertical tab, form feed and carriage return.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Digits, letters and all non-ASCII characters; upper-case letters count once they are lowered.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = True
ALPHANUMERIC[0x41:0x5B] = True
ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True

@dataclass
class Texts:
    """The bytes of consecutive texts: text i is data[offsets[i]:offsets[i + 1]]; a null text is empty."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def powers(self) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse modulo 2**64, 0 to the number of bytes; they go when the texts go."""
        out = []
        for base in (_BASE, _INVERSE):
            steps = np.full(len(self.data) + 1, base, dtype=np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, out=steps))
        return out[0], out[1]


@dataclass
class Words:
    """Words of some texts in order: bytes start:end, the text's number, and a 64-bit hash of the lowered bytes."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    #: Of each text: its number of words, and the place of its first word.
    count: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    if len(offsets) == 0:
        offsets = np.zeros(1, dtype=np.int64)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, last row + 1, texts) of runs of whole texts with about ``size`` bytes; a longer text comes alone."""
    whole = texts_of(column)
    low = 0
    while low < len(whole):
        high = int(np.searchsorted(whole.offsets, whole.offsets[low] + size, side="right")) - 1
        high = min(max(high, low + 1), len(whole))
        part = whole.offsets[low : high + 1]
        yield low, high, Texts(whole.data[part[0] : part[-1]], part - part[0])
        low = high


def find_words(texts: Texts, members: np.ndarray, lower: bool = True, hashes: bool = True) -> Words:
    """Maximal runs of member bytes within each text."""
    data, offsets = texts.data, texts.offsets
    n = len(data)
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    inside = members[data]
    before = np.empty(n, dtype=bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
        before[filled] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets)
    found = range_hashes(texts, start, end, lower) if hashes else np.zeros(0, dtype=np.uint64)
    return Words(start, end, text, found, np.diff(first), first[:-1])


def range_hashes(texts: Texts, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each byte range, from prefix sums of a polynomial modulo 2**64."""
    n = len(texts.data)
    up, down = texts.powers
    sums = np.zeros(n + 1, dtype=np.uint64)
    codes = _BYTE_CODES[LOWER_ASCII] if lower else _BYTE_CODES
    np.cumsum(codes[texts.data] * up[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def hash_word(word: str) -> int:
    """The hash that find_words gives to one word; for tests and lookups."""
    found = find_words(texts_of(pa.array([word])), np.ones(256, dtype=bool))
    return int(found.hash[0])


def code_points(texts: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number of code points in the byte ranges."""
    heads = np.zeros(len(texts.data) + 1, dtype=np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=heads[1:])
    return heads[end] - heads[start]


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of n words that lies in one text, and the place of its first word."""
    size = len(words.hash)
    if size < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(words.text[: size - n + 1] == words.text[n - 1 :])
    mixed = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        mixed = mix(mixed + words.hash[at + k])
    return mixed, at


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... start + length - 1 of each pair, in one array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)
