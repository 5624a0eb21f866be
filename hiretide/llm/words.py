"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow batch, no per-word Python.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Words and word n-grams are known by 64-bit
hashes: a seeded random value per byte and place in the word (``PLACES`` of them, beyond these mixed with how
often they have been passed), summed, mixed. Values of places have nothing to do with each other, so no
arrangement of letters makes sums meet, as it does where a place is a factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PLACES = 64
_SEED = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _SEED.integers(0, 2**64, (PLACES, 256), dtype=np.uint64)
_LOWER = _BYTE.copy()
_LOWER[:, 65:91] = _BYTE[:, 97:123]
_BYTE, _LOWER = _BYTE.ravel(), _LOWER.ravel()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """``data``: the bytes of all texts; ``ends[i]:ends[i + 1]``: those of text i.
    Words ``first[i]:first[i + 1]`` are those of text i; ``start`` and ``stop`` their bytes."""

    data: np.ndarray
    ends: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the place of each text in them; null is the empty text."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def split_words(column: pa.Array) -> Words:
    data, ends = text_bytes(column)
    word = ~_SPACE[data]
    before = np.empty_like(word)  # whether a word goes on from the byte before, in the same text
    before[1:] = word[:-1]
    inner = ends[:-1][ends[:-1] < len(data)]
    before[inner] = False
    start = np.flatnonzero(word & ~before)
    after = np.zeros_like(word)
    after[:-1] = word[1:]
    after[ends[1:][ends[1:] > 0] - 1] = False
    stop = np.flatnonzero(word & ~after) + 1
    return Words(data, ends, start, stop, np.searchsorted(start, ends))


def blocks(w: Words, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of words that have about ``most`` bytes together, or one word: bounded extra memory for
    what is worked out by byte."""
    ends = np.cumsum(w.stop - w.start)
    a = 0
    while a < len(ends):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield a, b
        a = b


def word_hashes(w: Words, lower: bool) -> np.ndarray:
    """One hash per word; with ``lower``, A-Z count as a-z."""
    out = np.empty(len(w.start), np.uint64)
    table = _LOWER if lower else _BYTE
    for a, b in blocks(w):
        start, size = w.start[a:b], w.stop[a:b] - w.start[a:b]
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        code = w.data[place + np.repeat(start, size)].astype(np.int64)
        code += (place & (PLACES - 1)) << 8
        values = table[code]
        far = np.flatnonzero(place >= PLACES)  # no other value changes
        if len(far):
            values[far] = mix(values[far] + (place[far] // PLACES).astype(np.uint64) * _STEP)
        out[a:b] = mix(np.add.reduceat(values, at))
    return out


def gram_hashes(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows, and the text of each: ``(grams, owner)``, in order of place."""
    counts = np.diff(first)
    windows = np.maximum(counts - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), windows)
    at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    at += np.repeat(first[:-1], windows)
    grams = np.zeros(len(at), np.uint64)
    for k in range(n):
        grams = (grams ^ hashes[at + k]) * _STEP
        grams ^= grams >> np.uint64(29)
    return mix(grams), owner


def shingle_sets(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles by text, ascending: ``(shingles, bounds)``. A text with fewer words
    has one shingle, all its words; one without words has none."""
    grams, owner = gram_hashes(hashes, first, n)
    counts = np.diff(first)
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            value = np.full(len(short), k, np.uint64)
            for i in range(k):
                value = (value ^ hashes[first[short] + i]) * _STEP
                value ^= value >> np.uint64(29)
            grams, owner = np.concatenate([grams, mix(value)]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.searchsorted(owner[new], np.arange(len(counts) + 1))
