"""Fill-in-the-middle forms of texts, cut by a learned index over the boundaries of their units.

A text of n units is cut after two of them into prefix, middle and suffix, and written as it is
(``plain``), as prefix, suffix, middle (``psm``) or as suffix, prefix, middle (``spm``), each part
behind a marker.  Keyed digests of the id decide the cuts and the form, so a row gets the same ones
in every run and on every machine.

A cut is a rank among unit boundaries and has to become a byte offset.  The boundaries of a group of
texts are one rising sequence of offsets.  ``RankIndex`` covers it by straight lines, each as
long as all its boundaries lie within ``tolerance`` bytes of it: a rank's line gives a prediction, and
the residual stored for the rank, one byte each, makes it exact.  A text in one alphabet takes
a few lines, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.shipping import ship
from lexspark.llm.words import BLANKS, groups, text_bytes

MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
UNITS = ("characters", "words", "lines")
TOLERANCE = 126
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


# ---------------------------------------------------------------- learned index


@dataclass
class RankIndex:
    """Rising integers by rank: line ``s`` serves the ranks from ``first[s]`` on and predicts
    ``base[s] + slope[s] * (rank - first[s])``, rounded; ``residual`` is what is missing."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, values: np.ndarray, tolerance: int = TOLERANCE, window: int = 512) -> RankIndex:
        """Lines from left to right, each through its first value and as long as one slope keeps
        all its values within ``tolerance``.  The slopes that do so form an interval, which
        narrows with every value; it is followed by running maxima and minima over windows that
        double, so the work is in proportion to the number of values."""
        first, slopes, n, start = [], [], len(values), 0
        while start < n:
            least, most, end, size = -np.inf, np.inf, start + 1, window
            while end < n:
                stop = min(end + size, n)
                run = np.arange(end - start, stop - start, dtype=np.float64)
                rise = (values[end:stop] - values[start]).astype(np.float64)
                low = np.maximum(np.maximum.accumulate((rise - tolerance) / run), least)
                high = np.minimum(np.minimum.accumulate((rise + tolerance) / run), most)
                bad = int(np.argmax(low > high)) if low[-1] > high[-1] else stop - end
                if bad:
                    least, most = low[bad - 1], high[bad - 1]
                end += bad
                if end < stop:
                    break
                size *= 2
            first.append(start)
            slopes.append((least + most) / 2 if end > start + 1 else 0.0)
            start = end
        first = np.array(first, np.int64)
        index = cls(first, values[first].astype(np.int64), np.array(slopes), np.zeros(n, np.int8))
        missing = values - index._predict(np.arange(n))
        return cls(index.first, index.base, index.slope, missing.astype(np.min_scalar_type(-tolerance - 2)))

    def _predict(self, ranks: np.ndarray) -> np.ndarray:
        line = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[line] + np.rint(self.slope[line] * (ranks - self.first[line])).astype(np.int64)

    def at(self, ranks: np.ndarray) -> np.ndarray:
        """The values at these ranks, exactly."""
        return self._predict(ranks) + self.residual[ranks]


# ---------------------------------------------------------------- cutting


def unit_starts(data: np.ndarray, offset: np.ndarray, unit: str) -> np.ndarray:
    """Marks the bytes at which units begin; the first byte of a text always does."""
    if unit == "characters":
        return (data & 0xC0) != 0x80
    before = np.zeros(len(data), bool)
    if unit == "words":
        blank = BLANKS[data]
        before[1:] = blank[:-1] & ~blank[1:]
    else:
        before[1:] = data[:-1] == 0x0A
    before[offset[:-1][offset[1:] > offset[:-1]]] = True
    return before


def _holding(raw: bytes, offset: np.ndarray, markers: tuple[bytes, ...]) -> np.ndarray:
    """Which texts hold a marker."""
    found = np.zeros(len(offset) - 1, bool)
    spans = np.array([m.span() for m in re.finditer(b"(?=(" + b"|".join(map(re.escape, markers)) + b"))", raw)], np.int64)
    at = spans[:, 0] if len(spans) else np.zeros(0, np.int64)
    text = np.searchsorted(offset, at, "right") - 1
    for place, t in zip(at.tolist(), text.tolist()):
        inside = raw[place : offset[t + 1]]
        found[t] |= inside.startswith(markers)
    return found


def form_batches(
    batches: Iterator[pa.RecordBatch], unit: str, markers: tuple[str, ...], plain_from: int, spm_below: int
) -> Iterator[pa.RecordBatch]:
    """Batches of ``(doc_id, text, h1, h2, h3, h4)`` as the columns of ``fill_middle``."""
    p, s, m = marks = tuple(x.encode("utf-8") for x in markers)
    for batch in batches:
        data, offset = text_bytes(batch.column(1))
        h = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(2, 6)]
        for a, b in groups(offset):
            part, inside = data[offset[a] : offset[b]], offset[a : b + 1] - offset[a]
            raw = part.tobytes()
            starts = unit_starts(part, inside, unit)
            places = np.append(np.flatnonzero(starts), len(part))
            index = RankIndex.fit(places)
            before = np.searchsorted(places, inside)  # rank of each text's first boundary
            n = np.diff(before)
            one, two = h[0][a:b] % (n + 1), h[1][a:b] % (n + 1)
            least, most = np.minimum(one, two), np.maximum(one, two)
            plain = (n == 0) | _holding(raw, inside, marks) | (h[2][a:b] % 100 >= plain_from)
            spm = ~plain & (h[3][a:b] % 100 < spm_below)
            cut = index.at(before[:-1] + least), index.at(before[:-1] + most)
            output = []
            for t, (x, i, j, y) in enumerate(zip(inside[:-1].tolist(), *(c.tolist() for c in cut), inside[1:].tolist())):
                if plain[t]:
                    output.append(raw[x:y])
                elif spm[t]:
                    output.append(b"".join((s, raw[j:y], p, raw[x:i], m, raw[i:j])))
                else:
                    output.append(b"".join((p, raw[x:i], s, raw[j:y], m, raw[i:j])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array(n, pa.int64()),
                    pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm"))),
                    pa.array(least, pa.int64(), mask=plain),
                    pa.array(most - least, pa.int64(), mask=plain),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def _check(markers: tuple[str, ...]) -> None:
    """A marker must not begin where one, or a text without any, has not ended."""
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different markers are needed")
    for a, b in product(markers, repeat=2):
        if (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))):
            raise ValueError(f"markers {a!r} and {b!r} can overlap")


def _numbers(key: Column) -> list[Column]:
    """The first four 32-bit numbers of the key's SHA-256."""
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_middle(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    *,
    seed: str = "1",
    unit: str = "characters",
    markers: tuple[str, str, str] = MARKERS,
    plain_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for each row of ``docs``: the number
    of units, the form, how many units prefix and middle have (null if plain) and the text
    in its form.

    h1 to h4 are the first four 32-bit numbers of the SHA-256 of ``seed:id``.  The cuts lie after
    ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units; a text is plain if ``h3 % 100`` is among the last
    ``plain_percent``, otherwise spm if ``h4 % 100`` is below ``spm_percent``.  Units are characters
    (code points), words (with the white space behind them) or lines.

    Null and empty texts are plain and empty, and so is every text that holds a marker as it
    stands.  A null id counts as an empty one; rows that repeat an id get the same numbers, each
    for its own text.  Whole texts are taken whatever their length; an empty table gives an
    empty table; other columns are ignored.
    """
    _check(markers)
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    ship(docs.sparkSession)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *_numbers(key))
    return rows.mapInArrow(
        lambda batches: form_batches(batches, unit, markers, 100 - plain_percent, spm_percent), _SCHEMA
    )


# ---------------------------------------------------------------- the way back


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``fill_middle`` was given, from its output and form.  No part holds a marker, and
    markers don't overlap, so the first place of each is the one that was written."""
    p, s, m = markers

    def between(start: Column, until: Column) -> Column:
        return F.substring(output, start, until - start)

    def behind(marker: str) -> Column:
        return F.locate(marker, output) + F.lit(len(marker))

    end = F.length(output) + 1
    middle = between(behind(m), end)
    psm = F.concat(between(behind(p), F.locate(s, output)), middle, between(behind(s), F.locate(m, output)))
    spm = F.concat(between(behind(p), F.locate(m, output)), middle, between(behind(s), F.locate(p, output)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
