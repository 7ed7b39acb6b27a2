"""Words of an Arrow text column as 64-bit hashes, without making Python strings.

A batch of texts is one array of bytes.  Its words are found by array comparisons, and a
word's hash is a difference of two running sums, so the cost does not depend on the number of
words.  Texts are taken in groups of about ``GROUP_BYTES``, which bounds memory; a single
longer text is a group of its own and is still taken whole.  Null texts are empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 2 << 20
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEPS = {"n": 0}
_LIBC = ctypes.CDLL(None)
_LIBC = _LIBC if hasattr(_LIBC, "malloc_trim") else None


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(_MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(31)
    return x


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(_BASE))


def _letters(lower: bool) -> np.ndarray:
    table = numbers(256, 1)
    if lower:
        table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    return table


BLANKS = np.zeros(256, bool)  # what separates words: a space and the controls 9 to 13
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)  # everything in ASCII but letters and digits
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER, EXACT = _letters(True), _letters(False)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse; kept, and enlarged when needed."""
    if _STEPS["n"] < n + 1:
        size = max(n + 1, GROUP_BYTES)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _STEPS[name] = np.multiply.accumulate(table)
        _STEPS["n"] = size
    return _STEPS["up"], _STEPS["down"]


@dataclass
class Words:
    """Word ``w`` is ``data[start[w]:end[w]]``; text ``t`` has the words ``first[t]`` up to
    ``first[t + 1]`` and the bytes ``offset[t]`` up to ``offset[t + 1]``."""

    data: np.ndarray
    offset: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    _sums: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offset) - 1

    def hash_spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _powers(len(self.data))[1]
        return mix((self._sums[end] - self._sums[start]) * down[start])

    def hashes(self) -> np.ndarray:
        return self.hash_spans(self.start, self.end)


def give_back() -> None:
    """Return memory that earlier batches have freed; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its texts; null is empty."""
    give_back()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offset = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offset[0] : offset[-1]], offset - offset[0]


def groups(offset: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that cover all of them, of about ``size`` bytes each."""
    first, n = 0, len(offset) - 1
    while first < n:
        last = int(np.searchsorted(offset, offset[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def find_words(
    data: np.ndarray,
    offset: np.ndarray,
    separators: np.ndarray,
    letters: np.ndarray | None,
    more: np.ndarray | None = None,
) -> Words:
    """The words of texts that lie one after the other.  Without ``letters``, no hashes.
    ``more`` marks further bytes that separate."""
    inside = ~separators[data]
    if more is not None:
        inside &= ~more
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    filled = offset[:-1][offset[1:] > offset[:-1]]  # where texts with any byte begin
    before[filled] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[filled[1:] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(0 if letters is None else len(data) + 1, np.uint64)
    if letters is not None:
        np.cumsum(letters[data] * _powers(len(data))[0][: len(data)], out=sums[1:])
    return Words(data, offset, start, end, np.searchsorted(start, offset), sums)


def word_groups(
    column: pa.Array | pa.ChunkedArray, separators: np.ndarray = BLANKS, letters: np.ndarray | None = LOWER
) -> Iterator[tuple[int, Words]]:
    """``(first text, words)`` for groups of texts that follow each other."""
    data, offset = text_bytes(column)
    for a, b in groups(offset):
        part = data[offset[a] : offset[b]]
        yield a, find_words(part, offset[a : b + 1] - offset[a], separators, letters)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width`` words from each place on, and the offsets of the texts in
    them.  A text with fewer words has one shingle, its whole sequence; one without words has
    none.  Shingles of different numbers of words never meet."""
    n = np.diff(first)
    short = (n > 0) & (n < width)
    counts = np.where(short, 1, np.maximum(n - width + 1, 0))
    offset = np.concatenate(([0], np.cumsum(counts)))
    factors = numbers(width, 2) | np.uint64(1)
    if len(words) >= width:
        sums = words[: len(words) - width + 1] * factors[0]
        for j in range(1, width):
            sums += words[j : len(words) - width + 1 + j] * factors[j]
    else:
        sums = np.zeros(0, np.uint64)
    out = np.empty(offset[-1], np.uint64)
    # the places of full shingles are those of their first words
    full = np.flatnonzero(~short & (counts > 0))
    if len(full):
        at = np.repeat(first[full] - offset[full], counts[full])
        where = np.repeat(offset[full], counts[full]) + _within(counts[full])
        out[where] = mix(sums[where + at])
    for t in np.flatnonzero(short):
        part = words[first[t] : first[t + 1]]
        out[offset[t]] = mix(np.array([(part * factors[: len(part)]).sum() + np.uint64(width * 1000 + len(part))]))[0]
    return out, offset


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the counts, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
