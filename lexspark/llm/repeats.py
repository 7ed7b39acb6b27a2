"""Removal of repeated paragraphs by hashing, with the offsets of what stays.

A text is cut into sentences: at line breaks, and after words that end in ``. ! ? : ;`` or
an ideographic full stop.  From each sentence on, the shortest run of whole sentences that has
``min_words`` words or more is a unit, so a repeated passage is found wherever it lies in a line
or a paragraph, and short phrases that are common by nature are no units.  With ``"lines"`` among
the kinds, each line and each paragraph (lines up to a blank one) is a unit of its own as well,
whatever its number of words.  With ``"pieces"``, units also begin and end where the words
themselves say, so a passage is found that has no sentence marks or lies inside a line or sentence:
a cut is made between two words whose joint hash is the least in a window of ``WINDOW`` places,
and from each cut on, the shortest run of ``min_words`` words or more up to a cut is a unit, of
``min_words + WINDOW - 1`` at most.  For these, each character of a script without blanks (Chinese,
Japanese, Thai, Lao) counts as half a word.  Units are normalised (A-Z lower-cased, white space ignored) and
hashed to 64 bits; any one of them equals one of 10**12 others by chance with a probability of 5 in
10**8.

Digests are grouped globally.  The occurrence in the document of the smallest id stays, in it the
first one; the words of all others are removed.  With pieces, occurrences in that document that
overlap the first one stay too, so a run of one word does not cut itself short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.shipping import ship
from lexspark.llm.words import Words, mix, word_groups
from lexspark.operators.skew import join_per_key
from lexspark.session import stage

MIN_WORDS = 12
SENTENCES = ("sentences",)
ALL_KINDS = ("sentences", "lines", "pieces")
WINDOW = 8
FIRST, SHORT = 1, 2
_WIDE = np.zeros(256, np.int64)
_WIDE[0xE0:0xF5] = 1  # first bytes of characters that scripts without blanks use
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:;")] = True
_FACTOR = 0xD1342543DE82EF95
_FACTOR_INVERSE = pow(_FACTOR, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def sentence_ends(words: Words) -> np.ndarray:
    """Marks the words that end a sentence; the last word of a text always does."""
    data, end = words.data, words.end
    last = data[end - 1]
    marks = _ENDS[last]
    wide = np.flatnonzero((last == 0x82) & (end - words.start >= 3))
    marks[wide] |= (data[end[wide] - 3] == 0xE3) & (data[end[wide] - 2] == 0x80)
    # a line break between a word and the next
    breaks = np.concatenate(([0], np.cumsum((data == 0x0A) | (data == 0x0D))))
    if len(end):
        marks[:-1] |= breaks[words.start[1:]] > breaks[end[:-1]]
    marks[words.first[1:][np.diff(words.first) > 0] - 1] = True
    return marks


def _runs(words: Words, ends: np.ndarray, least: int, upto: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, end word)``: from each end on, the shortest run of ``least`` words or more
    that stops at an end of the same text.  ``upto`` has the running sums of other lengths."""
    starts = np.concatenate(([0], ends[:-1]))
    upto = np.arange(len(words.end) + 1) if upto is None else upto
    until = np.searchsorted(upto[ends], upto[starts] + least)
    fits = until < len(ends)
    until[~fits] = 0
    stop = ends[until]
    text = np.searchsorted(words.first, starts, "right") - 1
    fits &= stop <= words.first[text + 1]
    return starts[fits], stop[fits]


def _split(words: Words) -> tuple[Words, np.ndarray]:
    """Words with each character of a script without blanks as one of its own, and which of them
    are such characters.  Thai and Lao vowel signs and tone marks stay with their letter."""
    data, n = words.data, len(words.data)
    lone = (data >= 0xE3) & (data <= 0xE9)
    if not lone.any() and not (data == 0xE0).any() and not (data >= 0xEF).any():
        return words, np.zeros(len(words.end), bool)
    second, third = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    second[:-1], third[:-2] = data[1:], data[2:]
    thai = (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    odd = second % 2 == 1
    sign = thai & ((~odd & ((third == 0xB1) | ((third >= 0xB4) & (third <= 0xBC)))) | (odd & (third >= 0x87) & (third <= 0x8E)))
    lone |= thai | ((data == 0xEF) & (second >= 0xBC) & (second <= 0xBD)) | ((data == 0xF0) & (second >= 0xA0) & (second <= 0xB3))
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    alone, joins = lone[chars], sign[chars]
    new = alone & ~joins
    new[1:] |= alone[:-1] & ~joins[1:]
    word = np.searchsorted(words.start, chars, "right") - 1
    new &= (word >= 0) & (chars < words.end[np.maximum(word, 0)])
    start = np.union1d(words.start, chars[new])
    end = np.minimum(np.append(start[1:], n), words.end[np.searchsorted(words.start, start, "right") - 1])
    return Words(data, words.offset, start, end, np.searchsorted(start, words.offset), words._sums), lone[start]


def _over_window(values: np.ndarray, pick, window: int) -> np.ndarray:
    """The least or greatest of each ``window`` values that follow each other."""
    out = values[: len(values) - window + 1].copy()
    for j in range(1, window):
        pick(out, values[j : len(values) - window + 1 + j], out=out)
    return out


def _piece_ends(words: Words, hashes: np.ndarray) -> np.ndarray:
    """The ends of what the words themselves cut.  Windows lie within one text, so a run of words
    is cut alike wherever it stands, but for ``WINDOW`` places at its ends."""
    last = np.zeros(len(hashes), bool)
    last[words.first[1:][np.diff(words.first) > 0] - 1] = True
    joint = np.zeros(len(hashes), np.uint64)
    joint[:-1] = mix(hashes[:-1] * np.uint64(3) + mix(hashes[1:])) | np.uint64(1)
    if len(hashes) >= WINDOW:
        least = _over_window(joint, np.minimum, WINDOW)
        crossed = np.concatenate(([0], np.cumsum(last)))
        least[crossed[WINDOW:] > crossed[:-WINDOW]] = 0
        none = np.zeros(WINDOW - 1, np.uint64)
        last |= _over_window(np.concatenate((none, least, none)), np.maximum, WINDOW) == joint
    return np.flatnonzero(last) + 1


def _blocks(words: Words, breaks: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, end word)`` of what lies between so many line breaks or more: 1 for lines,
    2 for paragraphs.  A carriage return before a line feed is no break of its own."""
    data = words.data
    marks = data == 0x0A
    marks[:-1] |= (data[:-1] == 0x0D) & (data[1:] != 0x0A)
    marks[-1:] |= data[-1:] == 0x0D
    before = np.concatenate(([0], np.cumsum(marks)))
    last = np.zeros(len(words.end), bool)
    last[:-1] = before[words.start[1:]] - before[words.end[:-1]] >= breaks
    last[words.first[1:][np.diff(words.first) > 0] - 1] = True
    ends = np.flatnonzero(last) + 1
    return np.concatenate(([0], ends[:-1])), ends


def _digests(words: Words, starts: np.ndarray, stop: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_FACTOR, len(hashes)), out=sums[1:])
    return mix((sums[stop] - sums[starts]) * _powers(_FACTOR_INVERSE, len(hashes) + 1)[starts])


def units(
    words: Words, min_words: int, kinds: tuple[str, ...] = SENTENCES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, end, digest)`` of the units, each span of bytes of the group once.  Lines
    and paragraphs may be of any size."""
    none = np.zeros(0, np.int64)
    if not len(words.end):
        return none, none, none, np.zeros(0, np.uint64)
    spans = []
    if "sentences" in kinds:
        spans.append(_runs(words, np.flatnonzero(sentence_ends(words)) + 1, min_words))
    if "lines" in kinds:
        spans += [_blocks(words, 1), _blocks(words, 2)]
    found = [(words, *(np.concatenate(x) for x in zip(*spans)), words.hashes())] if spans else []
    if "pieces" in kinds:
        split, lone = _split(words)
        hashes = split.hashes()
        upto = np.concatenate(([0], np.cumsum(2 - lone)))
        found.append((split, *_runs(split, _piece_ends(split, hashes), 2 * min_words, upto), hashes))
    start = np.concatenate([w.start[a] if len(a) else none for w, a, _, _ in found])
    end = np.concatenate([w.end[b - 1] if len(b) else none for w, _, b, _ in found])
    digest = np.concatenate([_digests(*f) for f in found])
    # a span that is two units at once has one digest, unless characters count in one of them
    order = np.lexsort((digest, end, start))
    start, end, digest = start[order], end[order], digest[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) > 0) | (np.diff(end) > 0) | (digest[1:] != digest[:-1])
    text = np.searchsorted(words.offset, start[new], "right") - 1
    return text, start[new], end[new], digest[new]


def unit_batches(
    batches: Iterator[pa.RecordBatch], min_words: int, kinds: tuple[str, ...] = SENTENCES, line_words: int = 1
) -> Iterator[pa.RecordBatch]:
    """Batches of ``(id columns ..., text)`` as ``(id columns ..., start, end, digest, mark)``: byte offsets of
    units of ``line_words`` words or more, and a sum of ``FIRST`` if a unit is the first of its digest
    in its text or, with pieces, overlaps the first, and ``SHORT`` if it has fewer than ``min_words`` words."""
    for batch in batches:
        for at, words in word_groups(batch.column(batch.num_columns - 1)):
            text, start, end, digest = units(words, min_words, kinds)
            # a character of a script without blanks counts as half a word
            wide = np.concatenate(([0], np.cumsum(_WIDE[words.data])))
            size = np.searchsorted(words.start, end) - np.searchsorted(words.start, start)
            size = np.maximum(size, (wide[end] - wide[start]) // 2)
            large = size >= line_words
            text, start, end, digest, size = (v[large] for v in (text, start, end, digest, size))
            base = words.offset[text]
            order = np.lexsort((start, digest, text))
            repeated = np.zeros(len(text), bool)
            if len(order):
                a, b = order[1:], order[:-1]
                repeated[a] = (text[a] == text[b]) & (digest[a] == digest[b])
            if "pieces" in kinds and len(order):
                firsts = np.flatnonzero(~repeated[order])
                own = order[firsts[np.cumsum(~repeated[order]) - 1]]
                repeated[order] &= start[order] >= end[own]
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    *(c.slice(at, words.texts).take(rows) for c in batch.columns[:-1]),
                    pa.array(start - base, pa.int64()),
                    pa.array(end - base, pa.int64()),
                    pa.array(digest.view(np.int64)),
                    pa.array(np.where(repeated, 0, FIRST) + np.where(size < min_words, SHORT, 0), pa.int8()),
                ],
                names=[*batch.schema.names[:-1], "start", "end", "digest", "mark"],
            )


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``(doc_id, text, spans)``: texts without their spans, and the character offsets of what
    is cut and what stays."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            texts, cut, kept = [], [], []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                removed, left, at = [], [], 0
                if spans:
                    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                    removed = [(int(chars[s]), int(chars[e])) for s, e in _merged([(x["start"], x["end"]) for x in spans])]
                for start, end in (*removed, (len(text or ""),) * 2):
                    if start > at:
                        left.append((at, start))
                    at = end
                texts.append(text if not removed else "".join(text[s:e] for s, e in left))
                cut.append([{"start": s, "end": e} for s, e in removed])
                kept.append([{"start": s, "end": e} for s, e in left])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.string()), pa.array(cut, span), pa.array(kept, span)],
                names=["doc_id", "text", "removed", "kept"],
            )


def _repeated_ids(rows: DataFrame) -> DataFrame:
    """The ids that several rows have."""
    return rows.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    *,
    min_words: int = MIN_WORDS,
    kinds: tuple[str, ...] = SENTENCES,
    line_words: int = 1,
    short_docs: int = 1,
) -> DataFrame:
    """``(doc_id, text, removed, kept)`` for each row of ``docs``: the text without repeated units,
    and the character offsets, in the original text, of what was removed and of what stays.
    ``kinds`` says what is a unit; ``ALL_KINDS`` is the whole job.

    Short lines repeat by nature in lists, verse and dialogue.  A line or paragraph of fewer than ``line_words``
    words is no unit, and one of fewer than ``min_words`` counts as repeated only if it stands in ``short_docs``
    documents or more; two characters of a script without blanks are as good as a word.

    Null texts stay null and empty ones empty, without spans.  Rows without id are returned as they
    are and are no occurrence.  Rows that repeat an id are one document: what one of them repeats of
    another stays, and each has the offsets of its own text.  An empty table gives an empty
    table; other columns are ignored.

    A digest in a third of all documents is counted before the shuffle and joined in shares.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    repeated = stage(_repeated_ids(rows), "repeated_ids")
    row = ["doc_id"]
    if not repeated.isEmpty():  # only then do offsets need to know the text that they belong to
        row.append("key")
        marked = rows.join(repeated.withColumn("again", F.lit(True)), "doc_id", "left")
        rows = marked.select("doc_id", F.when(F.col("again"), F.xxhash64("text")).otherwise(0).alias("key"), "text")
    schema = ", ".join([*(f"{c} long" for c in row), "start long, end long, digest long, mark byte"])
    found = rows.filter("doc_id is not null").mapInArrow(lambda batches: unit_batches(batches, min_words, kinds, line_words), schema)
    first, short = (F.col("mark").bitwiseAND(bit) > 0 for bit in (FIRST, SHORT))
    sums = [F.min("doc_id").alias("first_doc"), F.count("*").alias("n_rows")]
    counts = F.col("n_rows") > 1
    if short_docs > 1 and line_words < min_words:  # else no unit needs to be in more documents than another
        sums += [F.sum(first.cast("int")).alias("n_docs"), F.max(short.cast("int")).alias("short")]
        counts &= (F.col("short") == 0) | (F.col("n_docs") >= short_docs)
    groups = found.groupBy("digest").agg(*sums)
    shared = stage(groups.filter(counts).select("digest", "first_doc", "n_rows"), "digests")
    later = join_per_key(found, shared, "digest", "n_rows").filter((F.col("doc_id") != F.col("first_doc")) | ~first)
    spans = later.groupBy(*row).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.join(spans, row, "left").select("doc_id", "text", "spans")
    span = "array<struct<start: bigint, end: bigint>>"
    return joined.mapInArrow(cut_batches, f"doc_id long, text string, removed {span}, kept {span}")
