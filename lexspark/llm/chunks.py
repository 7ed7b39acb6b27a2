"""Encode texts chunk by chunk, each distinct chunk once per Python worker.

Texts are cut where no token can reach across.  A chunk is known by a 64-bit hash of its bytes
(two different chunks among a billion would share one with a chance of 3 in 100).  What a
worker keeps is bounded: beyond ``max_chunks`` chunks or ``max_tokens`` tokens it starts anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from lexspark.llm.words import EXACT, find_words, groups, mix, text_bytes

MAX_CHUNKS, MAX_TOKENS = 600_000, 8_000_000
BATCH_BYTES = 4 << 20
HEAD = np.uint64(0x2545F4914F6CDD1D)  # tells the first chunk of a text from equal later ones


class ChunkCode:
    """Tokens of chunks; ``encode`` maps a list of chunk strings to their ids, one after the
    other, and the offsets in them."""

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        max_chunks: int = MAX_CHUNKS,
        max_tokens: int = MAX_TOKENS,
        batch_bytes: int = BATCH_BYTES,
    ):
        self.encode = encode
        self.max_chunks, self.max_tokens, self.batch_bytes = max_chunks, max_tokens, batch_bytes
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.rows = np.zeros(0, np.int64)  # of a key, in the order of being learned
        self.ids = np.zeros(0, np.uint32)
        self.offset = np.zeros(1, np.int64)

    def trim(self) -> None:
        """Between batches: start anew if too much is kept."""
        if len(self.keys) > self.max_chunks or len(self.ids) > self.max_tokens:
            self._forget()

    def learn(self, new: dict[int, str]) -> None:
        """Encode chunks that ``unknown`` found."""
        if not new:
            return
        keys = np.fromiter(new, np.uint64, len(new))
        ids, offset = self.encode(list(new.values()))
        first = len(self.offset) - 1
        self.ids = np.concatenate((self.ids, ids))
        self.offset = np.concatenate((self.offset, self.offset[-1] + offset[1:]))
        every = np.concatenate((self.keys, keys))
        rows = np.concatenate((self.rows, np.arange(first, first + len(keys))))
        order = np.argsort(every, kind="stable")
        self.keys, self.rows = every[order], rows[order]

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        return at, known

    def unknown(self, keys: np.ndarray, text: Callable[[int], str], new: dict[int, str]) -> None:
        """Add to ``new`` the chunks that are not known; ``text(i)`` is the string of chunk ``i``."""
        codes, distinct = pd.factorize(keys)
        _, known = self._find(distinct)
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(keys) - 1, -1, -1)
        for key, i in zip(distinct[~known].tolist(), first[~known].tolist()):
            if key not in new:
                new[key] = text(i)

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        codes, distinct = pd.factorize(keys)
        at, _ = self._find(distinct)
        return self.rows[at][codes]

    def tokens(self, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks ``rows``, and the offsets in them of texts whose chunks begin
        at ``first``."""
        sizes = np.diff(self.offset)[rows]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(ends[-1]) + np.repeat(self.offset[rows] - ends[:-1], sizes)
        return self.ids[places], ends[first]


def encoded_groups(
    column: pa.Array, code: ChunkCode, separators: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, ids, offsets)`` for groups of texts cut at separators, which hold no
    token themselves.  The new chunks of ``batch_bytes`` of text are encoded together."""
    data, offset = text_bytes(column)
    for first, last in groups(offset, code.batch_bytes):
        code.trim()
        found, new = [], {}
        for a, b in groups(offset[first : last + 1]):
            inside = offset[first + a : first + b + 1]
            part = data[inside[0] : inside[-1]]
            words = find_words(part, inside - inside[0], separators, EXACT)
            keys, raw = words.hashes(), part.tobytes()
            code.unknown(keys, lambda i: raw[words.start[i] : words.end[i]].decode("utf-8"), new)
            found.append((first + a, keys, words.first))
        code.learn(new)
        for a, keys, firsts in found:
            yield a, *code.tokens(code.rows_of(keys), firsts)


def _places(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where the bytes of ``mark`` are."""
    found = np.ones(max(0, len(data) - len(mark) + 1), bool)
    for k, byte in enumerate(mark):
        found &= data[k : k + len(found)] == byte
    places = np.zeros(len(data), bool)
    at = np.flatnonzero(found)
    for k in range(len(mark)):
        places[at + k] = True
    return places


def leading_groups(
    column: pa.Array, code: ChunkCode, separators: np.ndarray, lead: str, mark: bytes
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first text, rows, ends, firsts)`` for groups of texts cut before runs of separators, which are some bytes and the
    character ``mark``.

    A chunk is such a run and what follows up to the next one.  The first chunk of a text is
    encoded with ``lead`` before it.  ``rows`` are the chunks' rows in ``code``, ``ends`` their
    byte offsets in their texts, ``firsts`` where the chunks of each text begin.
    """
    data, offset = text_bytes(column)
    for first, last in groups(offset, code.batch_bytes):
        code.trim()
        found, new = [], {}
        for a, b in groups(offset[first : last + 1]):
            inside = offset[first + a : first + b + 1]
            part = data[inside[0] : inside[-1]]
            inside = inside - inside[0]
            words = find_words(part, inside, separators, EXACT, _places(part, mark))
            # chunks end where words end, a text's last one at the end of the text
            n = np.diff(words.first)
            words.end[words.first[1:][n > 0] - 1] = inside[1:][n > 0]
            blank = (n == 0) & (np.diff(inside) > 0)  # only separators: one chunk
            ends = np.sort(np.concatenate((words.end, inside[1:][blank])))
            firsts = np.append(np.searchsorted(ends, inside[:-1], "right"), len(ends))
            opening = firsts[:-1][np.diff(firsts) > 0]
            starts = np.zeros(len(ends), np.int64)
            starts[1:] = ends[:-1]
            is_first = np.zeros(len(ends), bool)
            is_first[opening] = True
            keys, raw = words.hash_spans(starts, ends), part.tobytes()
            keys[is_first] = mix(keys[is_first] ^ HEAD)
            code.unknown(
                keys, lambda i: lead * bool(is_first[i]) + raw[starts[i] : ends[i]].decode("utf-8"), new
            )
            found.append((first + a, keys, ends - np.repeat(inside[:-1], np.diff(firsts)), firsts))
        code.learn(new)
        for a, keys, ends, firsts in found:
            yield a, code.rows_of(keys), ends, firsts
