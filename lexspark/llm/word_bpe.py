"""Byte-pair encoding of a tokenizer file by an index of pair occurrences, and its inverse.

The file's rules: Unicode form NFC, white space to a blank, lower case; pieces by a pattern;
bytes as letters; the last symbol of a piece with an end mark; merges by rank.  Special
strings in a text are their ids.  What is a letter or a number, and its lower case, depends on the version
of Unicode, so chunks with characters beyond ``LATIN`` are normalised and cut by the tokenizers
library's own normaliser and splitter; encoding is done here.

All distinct pieces of a batch are encoded together.  Their symbols lie in one array with links
to the next and the previous symbol of a piece.  The index maps the rank of each adjacent pair to
all its places.  Ranks are taken in ascending order; each merges all its places at once and lists
the pairs that this makes.  As every merge makes pairs of higher rank only (checked when the
file is read), no place is visited twice for a rank.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from lexspark.llm.chunks import ChunkCode, encoded_groups
from lexspark.llm.shipping import ship
from lexspark.llm.words import BLANKS


# up to U+024F all versions of Unicode agree, and nothing is composed
LATIN = "\u024f"
_BEYOND = regex.compile(f"[^\x00-{LATIN}]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary: dict[str, int] = model["vocab"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or not split["invert"]:
            raise ValueError(f"{path}: not a file of the expected kind")
        self.pattern_or_end = regex.compile(split["pattern"]["Regex"] + "|\n")
        replaced = spec["normalizer"]["normalizers"][1]
        self.normalizer = normalizers.Sequence(
            [normalizers.NFC(), normalizers.Replace(Regex(replaced["pattern"]["Regex"]), replaced["content"]), normalizers.Lowercase()]
        )
        self.splitter = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), split["invert"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        letters, end = byte_letters(), model["end_of_word_suffix"]
        self.inner = np.array([vocabulary[c] for c in letters], np.int32)
        self.last = np.array([vocabulary[c + end] for c in letters], np.int32)
        size = max([*vocabulary.values(), *special.values()]) + 1
        self.size = size
        rules = []
        made_at: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            left, right, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if max(made_at.get(left, -1), made_at.get(right, -1)) >= rank:
                raise ValueError(f"{path}: merge {rank} comes before one that it needs")
            rules.append((left, right, made))
            made_at.setdefault(made, rank)
        self.rules = rules
        left, right, _ = np.array(rules, np.int64).T
        self.pair_ranks = np.argsort(left * size + right)
        self.pairs = (left * size + right)[self.pair_ranks]
        names = [b""] * size
        for text, i in (*vocabulary.items(), *special.items()):
            names[i] = text.encode("utf-8")
        self.names = names

    def _listed(self, at: np.ndarray, left: np.ndarray, right: np.ndarray):
        """``(rank, places)`` of the pairs that have a rank."""
        pair = left.astype(np.int64) * self.size + right
        found = np.searchsorted(self.pairs, pair)
        found[found == len(self.pairs)] = 0
        known = np.flatnonzero(self.pairs[found] == pair)
        if not len(known):
            return
        rank, at = self.pair_ranks[found[known]], at[known]
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        bounds = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
        for a, b in zip(bounds, bounds[1:]):
            yield int(rank[a]), at[a:b]

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces, none of them empty, one after the other, and their offsets."""
        if not pieces:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        raw = np.frombuffer("".join(pieces).encode("utf-8"), np.uint8)
        ends = np.cumsum([len(p.encode("utf-8")) for p in pieces])
        n = len(raw)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends[:-1]] = before[0] = -1
        places: dict[int, list[np.ndarray]] = {}
        inner = np.flatnonzero(after >= 0)
        for rank, at in self._listed(inner, symbols[inner], symbols[inner + 1]):
            places[rank] = [at]
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            left, right, made = self.rules[rank]
            found = places.pop(rank)
            i = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            j = after[i]
            good = (symbols[i] == left) & (j >= 0) & (symbols[j] == right)  # others were merged meanwhile
            i, j = i[good], j[good]
            if left == right:
                i, j = _apart(i, j)
            if not len(i):
                continue
            symbols[i], symbols[j] = made, -1
            k = after[j]
            after[i] = k
            follows = k >= 0
            before[k[follows]] = i[follows]
            h = before[i]
            led = h >= 0
            at = np.concatenate((h[led], i[follows]))
            for new, where in self._listed(at, symbols[at], symbols[np.concatenate((i[led], k[follows]))]):
                if new in places:
                    places[new].append(where)
                else:
                    places[new] = [np.unique(where)]
                    heapq.heappush(active, new)
        alive = symbols >= 0
        return symbols[alive].astype(np.uint32), np.concatenate(([0], np.cumsum(alive)[ends - 1]))

    def _pieces(self, chunk: str) -> list[str]:
        """The pieces of a chunk with characters beyond ``LATIN``."""
        pieces: list[str] = []
        for part in self.special_cut.split(chunk):
            if part in self.special:
                pieces.append(part)
            elif part:
                pieces += [p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))]
        return pieces

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks without white space at which texts are cut, and their offsets."""
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        others = [(i, c) for i, c in enumerate(chunks) if not c.isascii() and _BEYOND.search(c)]
        plain = list(chunks)
        for i, _ in others:
            plain[i] = ""
        plain = "\n".join(plain)
        cut = [c if c in self.special else c.lower() for c in self.special_cut.split(plain)]
        parts = [p for c in cut for p in ((c,) if c in self.special else self.pattern_or_end.findall(c))]
        parts.append("\n")
        if others:
            ends = [i for i, p in enumerate(parts) if p == "\n"]
            whole, at = [], 0
            for i, chunk in others:
                whole += parts[at : ends[i]]
                whole += self._pieces(chunk)
                at = ends[i]
            parts = whole + parts[at:]
        known: dict[str, int] = {}
        code = np.array([known.setdefault(p, len(known)) for p in parts])
        distinct = list(known)
        pieces = [p for p in distinct if p != "\n" and p not in self.special]
        ids, offset = self.encode_pieces(pieces)
        # special strings are pieces of one id, an end of a chunk is one without ids
        extra = {p: [self.special[p]] if p in self.special else [] for p in distinct if p == "\n" or p in self.special}
        ids = np.concatenate([ids, *(np.array(v, np.uint32) for v in extra.values())])
        offset = np.concatenate((offset, offset[-1] + np.cumsum([len(v) for v in extra.values()])))
        row = {p: r for r, p in enumerate([*pieces, *extra])}
        rows = np.array([row[p] for p in distinct])[code]
        sizes = np.diff(offset)[rows]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        flat = ids[np.arange(ends[-1]) + np.repeat(offset[rows] - ends[:-1], sizes)]
        closing = np.flatnonzero(rows == row["\n"])
        return flat, np.concatenate(([0], ends[closing])).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The names of the ids with a blank between them: the file has no rule for decoding, so
        byte letters and end marks stay as they are."""
        return b" ".join(map(self.names.__getitem__, ids.tolist()))


def _apart(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of equal symbols, those to merge: in a run of places, every second one."""
    kept, taken = [], set()
    for a, b in zip(i.tolist(), j.tolist()):
        if a not in taken:
            kept.append((a, b))
            taken.add(b)
    pairs = np.array(kept, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


_loaded: dict[str, tuple[WordBpe, ChunkCode]] = {}


def load(path: str) -> tuple[WordBpe, ChunkCode]:
    """The model of a file, kept by the worker."""
    if path not in _loaded:
        model = WordBpe(path)
        _loaded[path] = model, ChunkCode(model.encode_chunks)
    return _loaded[path]


def encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches of ``(id, text)`` as ``(id, ids)``, the ids as little-endian 32-bit numbers."""
    code = load(path)[1]
    for batch in batches:
        for first, ids, offset in encoded_groups(batch.column(1), code, BLANKS):
            n = len(offset) - 1
            data = pa.Array.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer(offset.astype(np.int64) * 4), pa.py_buffer(ids.astype("<u4"))]
            )
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), data.cast(pa.binary())], names=["doc_id", "ids"])


def decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches of ``(id, ids)`` as ``(id, ids, text)``."""
    model = load(path)[0]
    for batch in batches:
        for a in range(0, batch.num_rows, 50):
            part = batch.slice(a, 50)
            texts = [model.decode(np.frombuffer(ids or b"", "<u4")) for ids in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "ids", "decoded"],
            )


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)`` of each row of ``docs``, ``ids`` as binary little-endian 32-bit
    numbers, without added special tokens.

    Null and empty texts have no ids.  Whole texts are encoded whatever their length.  Rows with
    a null or repeated id are encoded like any other; an empty table gives an empty table; other
    columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: encode_batches(batches, path), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)``: the names of the ids, special ones too, joined by blanks."""
    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: decode_batches(batches, path), "doc_id long, ids binary, decoded string"
    )


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``decode`` makes of what ``encode`` makes of ``docs``, by one Python worker per task."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(
        lambda batches: decode_batches(encode_batches(batches, path), path), "doc_id long, ids binary, decoded string"
    )


def digests(decoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of what ``decode`` returns."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
