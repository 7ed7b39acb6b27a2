"""Token counts of every prefix of a text, for a sentencepiece BPE model with byte fallback.

The encoding of a prefix of ``i`` characters ends in the one piece ``t`` for which the
encoding of the prefix without ``t`` is known and its last piece keeps apart from ``t``: the model
encodes the two, written together, as these two.  So with the last piece of each shorter prefix at
hand, ``count[i] = count[i - len(t)] + 1``.  A character without a piece counts as its bytes and
never joins a neighbour.

No piece reaches over the beginning of a run of blanks or line breaks (checked when the model is
read), so a text is cut there into chunks, the table is made once per distinct chunk and worker,
and counts of whole prefixes are running sums.  Stored is, for every prefix, by how much its count differs
from that of the prefix before, in a byte; budgets are looked up in the sums of these, without the model.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.chunks import ChunkCode, leading_groups
from lexspark.llm.shipping import ship

SPACE = "▁"
BREAKS = np.zeros(256, bool)
BREAKS[[0x20, 0x0A]] = True
NEVER = float("-inf")
MAX_PAIRS = 1_000_000
LONGEST = 32  # characters of a piece: a character more adds 4 tokens at most and takes away 4 for each of a piece's


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as schema

        with open(path, "rb") as file:
            spec = schema.ModelProto.FromString(file.read())
        rules = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError(f"{path}: not a model of the expected kind")
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == 1}
        if any(p.type in (4, 5) for p in spec.pieces) or not spec.trainer_spec.byte_fallback:
            raise ValueError(f"{path}: not a model of the expected kind")
        for piece in self.scores:
            if "\n" in piece[1:] or SPACE in piece.lstrip(SPACE) or "\n" in piece and len(piece) > 1:
                raise ValueError(f"{path}: the piece {piece!r} reaches over a break")
            if len(piece) > LONGEST:
                raise ValueError(f"{path}: the piece {piece!r} is longer than {LONGEST} characters")
        self.lead = " " if rules.add_dummy_prefix else ""
        self.names = ["", *self.scores]
        self.numbers = {piece: n for n, piece in enumerate(self.names)}
        self.apart: dict[int, bool] = {}  # by number of the left piece (0: none) and of the right one
        self.histories: dict[str, tuple] = {}  # one per piece at most
        self.pieces = ahocorasick.Automaton()
        for piece in self.scores:
            self.pieces.add_word(piece, (self.numbers[piece], len(piece)))
        self.pieces.make_automaton()
        self.code = ChunkCode(self.tables)

    def history(self, piece: str) -> tuple[list[float], list[str], list[str], bool]:
        """How a piece grows out of its characters, the best-scored adjacent pair first and the
        left one of equals: the scores of its merges, its first and its last part before each and
        after all, and whether it comes out as one."""
        known = self.histories.get(piece)
        if known:
            return known
        scores, parts, order = self.scores, list(piece), []
        firsts, lasts = [parts[0]], [parts[-1]]
        while len(parts) > 1:
            found = [scores.get(x + y, NEVER) for x, y in zip(parts, parts[1:])]
            best = max(found)
            if best == NEVER:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            order.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        order.append(NEVER)
        known = self.histories[piece] = order, firsts, lasts, len(parts) == 1
        return known

    def keeps_apart(self, left: int, right: int) -> bool:
        """Whether the model encodes two pieces, written together, as these two; with no left one,
        the right one as itself.  Both grow on their own as long as no pair across the boundary has
        the best score (a pair to the left goes first among equals)."""
        if len(self.apart) > MAX_PAIRS:
            self.apart.clear()
        own, firsts, _, whole = self.history(self.names[right])
        if left and whole:
            other, _, lasts, whole = self.history(self.names[left])
            scores, i, j = self.scores, 0, 0
            while whole:
                across = scores.get(lasts[i] + firsts[j], NEVER)
                if other[i] >= across and other[i] >= own[j]:
                    if other[i] == NEVER:
                        break
                    i += 1
                elif across >= own[j]:
                    whole = False
                else:
                    j += 1
        self.apart[left << 20 | right] = whole
        return whole

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of a chunk."""
        text = text.replace(" ", SPACE)
        apart = self.apart
        lasts, counts = [0] * (len(text) + 1), [0] * (len(text) + 1)
        done = 0  # prefixes up to this one have their last piece
        for end, (piece, size) in self.pieces.iter(text):
            if end < done:
                continue
            while done < end:  # characters without a piece
                counts[done + 1] = counts[done] + len(text[done].encode("utf-8"))
                done += 1
            start = end + 1 - size
            left = lasts[start]
            known = True if start and not left else apart.get(left << 20 | piece)
            if known is None:
                known = self.keeps_apart(left, piece)
            if known:
                done = end + 1
                lasts[done], counts[done] = piece, counts[start] + 1
        for i in range(done, len(text)):
            counts[i + 1] = counts[i] + len(text[i].encode("utf-8"))
        return counts[1:]

    def tables(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.prefix_counts(c) for c in chunks]
        ends = np.concatenate(([0], np.cumsum([len(c) for c in found]))).astype(np.int64)
        return np.fromiter((n for c in found for n in c), np.uint32, int(ends[-1])), ends


_loaded: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]


def table_groups(column: pa.Array, model: PieceModel) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first text, counts, ends, firsts)``: for each chunk the tokens of its text up to its end
    and the byte offset of its end."""
    code = model.code
    for first, rows, ends, firsts in leading_groups(column, code, BREAKS, model.lead, SPACE.encode()):
        own = code.ids[code.offset[rows + 1] - 1].astype(np.int64) if len(rows) else np.zeros(0, np.int64)
        sums = np.concatenate(([0], np.cumsum(own)))
        counts = sums[1:] - np.repeat(sums[firsts[:-1]], np.diff(firsts))
        yield first, counts, ends, firsts


def count_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for batch in batches:
        for first, counts, ends, firsts in table_groups(batch.column(1), model):
            n = len(firsts) - 1
            filled = np.diff(firsts) > 0
            total, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
            total[filled], size[filled] = counts[firsts[1:][filled] - 1], ends[firsts[1:][filled] - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), pa.array(size), pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"]
            )


def step_groups(column: pa.Array, model: PieceModel) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, steps, offsets)`` for groups of texts: for each character, how many tokens more the
    text up to its end has than the text before it."""
    code = model.code
    for first, rows, _, firsts in leading_groups(column, code, BREAKS, model.lead, SPACE.encode()):
        counts, _ = code.tokens(rows, firsts)
        counts = counts.astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(np.diff(code.offset)[rows])))  # of chunks
        steps = np.diff(counts, prepend=0)
        steps[starts[:-1]] = counts[starts[:-1]]
        kept = np.ones(len(steps), bool)
        if model.lead:  # what stands before a text is no part of it
            opening = starts[firsts[:-1][np.diff(firsts) > 0]]
            kept[opening] = False
            steps[opening + 1] = counts[opening + 1]
        before = np.concatenate(([0], np.cumsum(kept)))
        yield first, steps[kept].astype(np.int8), before[starts[firsts]]


def table_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for batch in batches:
        for first, steps, offset in step_groups(batch.column(1), model):
            n = len(offset) - 1
            stored = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offset.astype(np.int64)), pa.py_buffer(steps)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), batch.column(1).slice(first, n), stored.cast(pa.binary())],
                names=["doc_id", "text", "steps"],
            )


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut ``(doc_id, text, steps, budget)``: the longest prefix whose count is in the budget."""
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            out = []
            for text, steps, budget in zip(*(part.column(i).to_pylist() for i in range(1, 4))):
                counts = np.concatenate(([0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)))
                fit = int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0
                out.append(((text or "")[:fit], int(counts[fit])))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([t for t, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())],
                names=["doc_id", "text", "n_tokens"],
            )


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)``: the last entry of each text's table.

    Null and empty texts have 0 bytes and 0 tokens.  Whole texts are counted, whatever their
    length.  Rows with a null or repeated id are counted like any other; an empty table gives an
    empty table; other columns are ignored.
    """
    return _rows(docs, id, text).mapInArrow(
        lambda batches: count_batches(batches, path), "doc_id long, n_bytes long, n_tokens long"
    )


def prefix_tables(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text, steps)``: the tokens of every prefix of a text, as one signed byte per character:
    the sum of the first ``i`` is the count of the first ``i`` characters.  Store it to answer many
    questions.  Rows as in ``token_counts``; null texts stay null and have no steps."""
    return _rows(docs, id, text).mapInArrow(lambda batches: table_batches(batches, path), "doc_id long, text string, steps binary")


def cut_to_budget(tables: DataFrame, budget: int) -> DataFrame:
    """``(doc_id, text, n_tokens)``: the longest prefix of each text that has at most ``budget``
    tokens, cut inside a word if need be, and its tokens.  Nothing is encoded; a null text is cut to an empty one."""
    ship(tables.sparkSession)
    rows = tables.select("doc_id", "text", "steps", F.lit(budget).alias("budget"))
    return rows.mapInArrow(cut_batches, "doc_id long, text string, n_tokens long")
