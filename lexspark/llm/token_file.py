"""Token ids in a compact binary form: frequency-ranked numbers in whole bytes, with the
numbers' lengths in a stream of their own.

The form: a table of blocks in ascending order of documents, and a table of ranks.

* ``ranks(rank, id)``: ids by falling frequency in the whole corpus, ties by id.  A stored number
  is a rank, so the most frequent 256 ids take one byte.
* ``blocks(part, block, before, doc_ids, lengths, control, data)``: the documents of a block in
  order, how many ids each has, and their numbers; ``before`` counts the ids of the same part in
  the blocks before.  ``control`` has two bits for each number, four
  numbers to a byte from the lowest bits up: its bytes less one.  ``data`` has the numbers' bytes,
  lowest first.  Control bytes are their own column, so that a reader finds all lengths, by one
  table lookup per four numbers, before it touches the data.

A block holds about ``BLOCK_IDS`` ids; a document is never cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.chunks import ChunkCode, encoded_groups
from lexspark.llm.shipping import ship
from lexspark.llm.words import BLANKS
from lexspark.session import release, stage

BLOCK_IDS = 1 << 17
MOST_IDS = 1 << 22  # a table of ranks goes to the driver and to each worker
#: by control byte: bytes of its four numbers, and of all four
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1
BLOCK_SCHEMA = "part int, block int, before long, doc_ids array<long>, lengths array<long>, control binary, data binary"


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of 32-bit numbers."""
    values = np.ascontiguousarray(values, "<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4) < size[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of control and data bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(size) - size
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)))
    out = raw[start].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(size > k)
        out[longer] |= raw[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class LibraryCode:
    """Ids by the tokenizers library, which is given each distinct chunk once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.code = ChunkCode(self.encode, 2_000_000, 24_000_000, 16 << 20)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [], []
        for a in range(0, len(chunks), 20_000):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks[a : a + 20_000], add_special_tokens=False)]
            sizes.extend(map(len, found))
            parts.append(np.fromiter((i for ids in found for i in ids), np.uint32))
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return ids, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


_loaded: dict[str, LibraryCode] = {}


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """``(doc_id, n, ids)``: the ids with the end id, in this module's form without ranks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if path not in _loaded:
        _loaded[path] = LibraryCode(path)
    code = _loaded[path].code
    for batch in batches:
        for first, ids, offset in encoded_groups(batch.column(1), code, BLANKS):
            n = len(offset) - 1
            packed = []
            for t in range(n):
                own = np.append(ids[offset[t] : offset[t + 1]], np.uint32(end_id)).astype("<u4")
                packed.append(zlib.compress(own.astype("<u2").tobytes() if own.max() < 65536 else own.tobytes(), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, n),
                    pa.array(np.diff(offset) + 1, pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["doc_id", "n", "ids"],
            )


def _ids(packed: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(packed)
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each id occurs in the batches of a task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for n, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.bincount(_ids(packed, n), minlength=len(total))
            own[: len(total)] += total
            total = own
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])


def block_batches(batches: Iterator[pa.RecordBatch], rank_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted documents of one partition."""
    docs, lengths, parts, held, block, before = [], [], [], 0, 0, 0

    def packed() -> pa.RecordBatch:
        control, data = pack(np.concatenate(parts))
        rows = [[part], [block], [before], [docs], [lengths], [control], [data]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        names = ["part", "block", "before", "doc_ids", "lengths", "control", "data"]
        return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)

    for batch in batches:
        for p, doc, n, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            part = p
            docs.append(doc)
            lengths.append(n)
            parts.append(rank_of[_ids(ids, n)])
            held += n
            if held >= BLOCK_IDS:
                yield packed()
                docs, lengths, parts, held, block, before = [], [], [], 0, block + 1, before + held
    if docs:
        yield packed()


def _table(ranks: DataFrame) -> np.ndarray:
    """``id_of[rank]``; as many entries as the vocabulary at most.  One of more than ``MOST_IDS`` is refused."""
    rows = ranks.orderBy("rank").limit(MOST_IDS + 1).collect()
    if len(rows) > MOST_IDS:
        raise ValueError(f"more than {MOST_IDS} different ids")
    return np.array([r.id for r in rows], np.uint32)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int, id: str = "doc_id", text: str = "text"
) -> None:
    """Encode each text, append ``end_id``, and write the two tables to ``path``.

    Null and empty texts are the end id alone.  Documents are written in ascending order of id,
    null ids first, rows of equal id in the order of their ids.  An empty table gives empty tables;
    other columns are ignored.  The texts are encoded once; what is shuffled to order the
    documents is compressed ids.  Ids are counted in the tasks, so the driver sees one row per
    vocabulary entry at most.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    encoded = rows.mapInArrow(
        lambda batches: encode_batches(batches, tokenizer, end_id), "doc_id long, n long, ids binary"
    )
    encoded = stage(encoded, "encoded")
    counts = encoded.select("n", "ids").mapInArrow(count_batches, "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"))
    by_frequency = Window.orderBy(F.col("n").desc(), "id")  # at most the vocabulary
    ranks = counts.select((F.row_number().over(by_frequency) - 1).alias("rank"), "id").coalesce(1)
    ranks.write.mode("overwrite").parquet(f"{path}/ranks")
    id_of = _table(spark.read.parquet(f"{path}/ranks"))
    rank_of = np.zeros(int(id_of.max(initial=0)) + 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of))
    in_order = encoded.repartitionByRange("doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", "ids")
    blocks = in_order.select(F.spark_partition_id().alias("part"), "doc_id", "n", "ids").mapInArrow(
        lambda batches: block_batches(batches, rank_of), BLOCK_SCHEMA
    )
    blocks.write.mode("overwrite").parquet(f"{path}/blocks")
    release(encoded)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of the documents, ``ids`` as little-endian 32-bit
    numbers, ``start`` the number of ids of all documents before."""
    ship(spark)
    id_of = _table(spark.read.parquet(f"{path}/ranks"))
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    parts = stored.groupBy("part").agg(F.max(F.col("before") + total).alias("n"))
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before_part), F.lit(0)).alias("part_start"))
    # one row per part, that is, per partition of the writing shuffle
    with_start = stored.join(F.broadcast(parts), "part").select(
        (F.col("part_start") + F.col("before")).alias("block_start"), "doc_ids", "lengths", "control", "data"
    )
    return with_start.mapInArrow(
        lambda batches: start_batches(batches, id_of), "doc_id long, start long, n_tokens long, ids binary"
    )


def start_batches(batches: Iterator[pa.RecordBatch], id_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The documents of blocks that carry the place of their first id."""
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum(row["lengths"], dtype=np.int64)
            ids = id_of[unpack(row["control"], row["data"], int(ends[-1]))].astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["block_start"] + ends - row["lengths"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array([ids[e - n : e].tobytes() for e, n in zip(ends, row["lengths"])], pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
