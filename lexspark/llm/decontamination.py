"""Benchmark passages in documents: item-sized windows, SimHash, multi-index Hamming blocks.

Texts are lower-cased and cut into words of letters and digits.  A window of a document has as many
words as an item, and its weighted set is that of its ``WIDTH``-word shingles, the weight of a
shingle being how often it is there.  Two sets are as similar as the sum of the smaller weights
to the sum of the larger ones.  For an item of fewer words the shingles are the whole item.

1. The items' shingles are marked in a bitmap of ``BITMAP`` bits, whatever their number, which is
   broadcast.  A window that is similar enough has enough marked shingles; moving it to its first
   marked shingle keeps all marked ones, so windows begin at marked shingles only.
2. Each such window gets a SimHash fingerprint.  An item is listed under each of its 8 blocks of
   8 bits with every error of up to 2 bits; a window looks up its own 8 blocks.  So all
   items of the window's size with a fingerprint at most ``RADIUS = 23`` bits away are found.
   (Sets of similarity 0.8 are 10 bits apart on average; more than 23 is a chance of 1 in 10**5.)
3. The pairs found are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.shipping import ship
from lexspark.llm.words import LOWER, NOT_ALNUM, shingle_hashes, word_groups
from lexspark.session import stage

WIDTH = 5
BITMAP = 1 << 24
MOST_SHINGLES = 1 << 18  # of windows that are looked at together
BLOCKS, ERRORS = 8, 2
RADIUS = BLOCKS * (ERRORS + 1) - 1


def fingerprints(hashes: np.ndarray, used: np.ndarray) -> np.ndarray:
    """SimHash of each row of hashes, of those that are used."""
    votes = np.zeros((len(hashes), 64), np.int32)
    for k in range(hashes.shape[1]):
        bits = np.unpackbits(np.ascontiguousarray(hashes[:, k]).view(np.uint8).reshape(-1, 8), axis=1)
        votes += np.where(used[:, k, None], 2 * bits.astype(np.int32) - 1, 0)
    return np.packbits(votes > 0, axis=1).view(np.uint64).ravel()


def _packed(rows: np.ndarray, used: np.ndarray) -> list[bytes]:
    return [np.sort(r[u]).tobytes() for r, u in zip(rows, used)]


def item_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """``(item_id, n, fingerprint, shingles)`` of items with any word."""
    for batch in batches:
        ids, sizes, prints, sets = [], [], [], []
        for at, words in word_groups(batch.column(1), NOT_ALNUM, LOWER):
            hashes = words.hashes()
            for t in range(words.texts):
                own = hashes[words.first[t] : words.first[t + 1]]
                if len(own):
                    shingles, _ = shingle_hashes(own, np.array([0, len(own)]), min(width, len(own)))
                    ids.append(at + t)
                    sizes.append(len(own))
                    prints.append(fingerprints(shingles[None, :], np.ones((1, len(shingles)), bool))[0])
                    sets.append(np.sort(shingles).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(ids, pa.int64())),
                pa.array(sizes, pa.int64()),
                pa.array(np.array(prints, np.uint64).view(np.int64)),
                pa.array(sets, pa.binary()),
            ],
            names=["item_id", "n", "fingerprint", "shingles"],
        )


def bit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap of shingles as ``(place, bits)`` of 64-bit words."""
    for batch in batches:
        hashes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
        bit = hashes >> np.uint64(64 - 24)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((bit >> np.uint64(6)).astype(np.int64)),
                pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64)),
            ],
            names=["place", "bits"],
        )


def window_batches(
    batches: Iterator[pa.RecordBatch], marked: np.ndarray, sizes: list[int], width: int, similarity: tuple[int, int]
) -> Iterator[pa.RecordBatch]:
    """``(doc_id, start, n, fingerprint, shingles)`` of the windows that may be similar to an item
    of ``n`` words."""
    num, den = similarity
    for batch in batches:
        for at, words in word_groups(batch.column(1), NOT_ALNUM, LOWER):
            hashes = words.hashes()
            for w in sorted({min(width, n) for n in sizes}):
                shingles, offset = shingle_hashes(hashes, words.first, w)
                hit = marked[(shingles >> np.uint64(64 - 24)).astype(np.int64)]
                sums = np.concatenate(([0], np.cumsum(hit)))
                starts = np.flatnonzero(hit)
                if not len(starts):
                    continue
                text = np.searchsorted(offset, starts, "right") - 1
                for n in (n for n in sizes if min(width, n) == w):
                    full = n - w + 1
                    stop = np.minimum(starts + full, offset[text + 1])
                    good = (sums[stop] - sums[starts]) * den >= num * full
                    step = max(1, min(5000, MOST_SHINGLES // full))
                    for a in range(0, good.sum(), step):
                        chosen = np.flatnonzero(good)[a : a + step]
                        places = starts[chosen][:, None] + np.arange(full)
                        used = places < stop[chosen][:, None]
                        rows = shingles[np.minimum(places, len(shingles) - 1)]
                        own = text[chosen]
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array(at + own)),
                                pa.array(starts[chosen] - offset[own], pa.int64()),
                                pa.array(np.full(len(chosen), n), pa.int64()),
                                pa.array(fingerprints(rows, used).view(np.int64)),
                                pa.array(_packed(rows, used), pa.binary()),
                            ],
                            names=["doc_id", "start", "n", "fingerprint", "shingles"],
                        )


def _weighted_similarity(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    values, counts = np.unique(np.concatenate((x, y)), return_counts=True)
    own = np.zeros(len(values), np.int64)
    np.add.at(own, np.searchsorted(values, x), 1)
    return float(np.minimum(own, counts - own).sum() / np.maximum(own, counts - own).sum())


def compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_weighted_similarity(a, b) for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(found, pa.float64())], names=["doc_id", "item_id", "start", "n_words", "similarity"]
        )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    *,
    width: int = WIDTH,
    similarity: tuple[int, int] = (4, 5),
) -> DataFrame:
    """``(doc_id, item_id, start_word, n_words, similarity)``: for each document and item of
    ``items(item_id, text)`` that are similar enough somewhere, the best window, the first of equals.

    Null, empty and wordless texts and items match nothing.  Rows without doc_id or item_id are
    reported with a null there.  Rows that repeat an id are one document or item.  Empty tables give an
    empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.lower(F.col(text).cast("string")).alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text"))
    schema = "item_id long, n long, fingerprint long, shingles binary"
    sets = stage(asked.mapInArrow(lambda batches: item_batches(batches, width), schema), "items")
    # 2 ** 18 words of 64 bits at most, and one size per length of an item
    bits = sets.select("shingles").mapInArrow(bit_batches, "place long, bits long")
    bits = bits.groupBy("place").agg(F.bit_or("bits").alias("bits")).collect()
    bitmap = np.zeros(BITMAP // 64, np.int64)
    bitmap[[r.place for r in bits]] = [r.bits for r in bits]
    sizes = sorted(r.n for r in sets.select("n").distinct().collect())
    shared = spark.sparkContext.broadcast(bitmap)

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(shared.value.view(np.uint8), bitorder="little").astype(bool)
        return window_batches(batches, marked, sizes, width, similarity)

    windows = stage(
        rows.mapInArrow(windows_of, "doc_id long, start long, n long, fingerprint long, shingles binary"), "windows"
    )

    def byte_values(number: Column) -> Column:
        return F.array(*(F.shiftrightunsigned(number, 8 * j).bitwiseAND(255) for j in range(BLOCKS)))

    blocks = F.posexplode(byte_values(F.col("fingerprint")))
    masks = F.explode(F.array(*(F.lit(m).cast("long") for m in range(256) if m.bit_count() <= ERRORS)))
    listed = (
        sets.select("item_id", "n", F.col("fingerprint").alias("item_print"), blocks.alias("block", "own"))
        .select("item_id", "n", "item_print", "block", "own", masks.alias("mask"))
        .select("item_id", "n", "item_print", "block", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
    )
    looked = windows.select("*", blocks.alias("block", "value"))
    apart = F.col("fingerprint").bitwiseXOR(F.col("item_print"))
    # a pair that meets in several blocks is taken in the first
    errors = F.transform(byte_values(apart), F.bit_count)
    before = F.exists(F.slice(errors, F.lit(1), F.col("block")), lambda e: e <= ERRORS)
    near = looked.join(listed, ["n", "block", "value"]).filter((F.bit_count(apart) <= RADIUS) & ~before)
    item_sets = sets.select("item_id", F.col("shingles").alias("item_shingles"))
    pairs = near.join(item_sets, near.item_id.eqNullSafe(item_sets.item_id)).select(
        "doc_id", near.item_id, "start", F.col("n").alias("n_words"), "shingles", "item_shingles"
    )
    schema = "doc_id long, item_id long, start long, n_words long, similarity double"
    similar = pairs.mapInArrow(compare_batches, schema).filter(
        F.col("similarity") * similarity[1] >= F.lit(similarity[0]) - 1e-9
    )
    best = F.max_by(
        F.struct(F.col("start").alias("start_word"), "n_words", "similarity"),
        F.struct("similarity", -F.col("start"), -F.col("n_words")),
    )
    return similar.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
