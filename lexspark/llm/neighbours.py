"""Nearest neighbours by multi-index hashing over learned binary codes.

Vectors are scaled to length 1.  ``fit`` learns, on a sample of at most ``SAMPLE`` rows, the
principal directions and ``ROTATIONS`` rotations that bring the rotated sample closest to the
corners of a cube (iterative quantisation, each from another start); the signs are the code, 256
bits for 64 dimensions.  It also picks the search radius, below which ``COVER`` of the nearest
neighbours in the sample lie; neighbours in a larger table are nearer.

Every row is indexed.  Codes are split into bytes; each byte is an index of its own.  If two
codes differ in ``r`` bits at most, some byte ``j`` differs in ``errors[j]`` at most, as these,
each plus one, add up to ``r + 1``.  So a query looks up, in each byte's index, the values that
near, and every code within the radius is found; the found are ranked by their true cosine.
Queries that find fewer than ``k`` are asked again with a radius that takes in every row.

Rows and queries are dealt into blocks of a fixed size and every two meet in a task of their
own, which returns ``k`` rows per query at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.shipping import ship
from lexspark.session import stage

SAMPLE = 10_000
ROTATIONS, STEPS, MOST_DIRECTIONS = 4, 30, 64
COVER = 0.985
BLOCK = 4096

_BITS = np.array([v.bit_count() for v in range(256)], np.uint8)
_WITHIN = [np.flatnonzero(_BITS <= e).astype(np.uint8) for e in range(9)]


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors with their largest component between 1/2 and 1, by a power of two: no square
    overflows, and all digits and cosines stay as they are."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def unit_length(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@dataclass
class Coder:
    mean: np.ndarray
    directions: np.ndarray  # (dimensions, bits): principal directions times rotations
    radius: int

    @property
    def bits(self) -> int:
        return self.directions.shape[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        unit = unit_length(vectors)
        return np.packbits((unit - self.mean) @ self.directions > 0, axis=1)


def learn(vectors: np.ndarray, k: int, seed: int = 3) -> Coder:
    """A coder for vectors like the sample's."""
    rng = np.random.default_rng(seed)
    unit = unit_length(vectors)
    mean = unit.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov((unit - mean).T).reshape(unit.shape[1], -1))
    axes = axes[:, ::-1][:, :MOST_DIRECTIONS]
    found = (unit - mean) @ axes
    parts = []
    for _ in range(ROTATIONS):
        rotation = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(STEPS):
            corners = np.sign(found @ rotation)
            left, _, right = np.linalg.svd(corners.T @ found)
            rotation = (left @ right).T
        parts.append(axes @ rotation)
    coder = Coder(mean, np.concatenate(parts, axis=1), 0)
    coder.radius = coder.bits
    if len(unit) > 10 * k:
        codes = coder.codes(vectors)
        apart = []
        for q in rng.choice(len(unit), min(300, len(unit)), replace=False):
            cosines = unit @ unit[q]
            cosines[q] = -2
            apart.append(_BITS[codes[np.argpartition(-cosines, k)[:k]] ^ codes[q]].sum(axis=1))
        coder.radius = int(np.quantile(np.concatenate(apart), COVER))
    return coder


def allowed_errors(radius: int, parts: int) -> list[int]:
    """By the pigeonhole principle one of the parts has no more errors than this; -1: not looked up."""
    base, more = divmod(radius + 1, parts)
    return [min(8, base + (j < more) - 1) for j in range(parts)]


class MultiIndex:
    """Codes, with one index per byte: the rows in order of its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.rows = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.first = [np.concatenate(([0], np.cumsum(np.bincount(codes[:, j], minlength=256)))) for j in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows at most ``radius`` bits away."""
        if radius >= 8 * self.codes.shape[1]:
            return np.arange(len(self.codes))
        found = np.zeros(len(self.codes), bool)
        for j, errors in enumerate(allowed_errors(radius, self.codes.shape[1])):
            if errors >= 0:
                values = code[j] ^ _WITHIN[errors]
                start, size = self.first[j][values], np.diff(self.first[j])[values]
                ends = np.cumsum(size)
                found[self.rows[j][np.arange(ends[-1]) + np.repeat(start - (ends - size), size)]] = True
        rows = np.flatnonzero(found)
        return rows[_BITS[self.codes[rows] ^ code].sum(axis=1) <= radius]


def _matrix(table: pa.Table, column: str, kind) -> np.ndarray:
    values = table.column(column).combine_chunks()
    return np.asarray(values.flatten(), kind).reshape(len(values), -1)


def search_block(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest found of the rows of a block for each query of a block."""
    out: list[list] = [[], [], [], []]
    if rows.num_rows and queries.num_rows:
        ids, vectors = rows.column("vec_id").to_numpy(), scaled(_matrix(rows, "vector", np.float64))
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        index = MultiIndex(codes)
        asked = scaled(_matrix(queries, "vector", np.float64))
        for q, key, code, radius, own in zip(
            *(queries.column(c).to_pylist() for c in ("vec_id", "key", "code", "radius")), asked
        ):
            found = index.within(np.frombuffer(code, np.uint8), radius)
            found = found[ids[found] != q]
            scores = np.einsum("ij,j->i", vectors[found], own) / (norms[found] * np.sqrt(np.einsum("i,i->", own, own)))
            best = np.lexsort((ids[found], -scores))[:k]
            out[0].extend([q] * len(best))
            out[1].extend([key] * len(best))
            out[2].extend(ids[found][best].tolist())
            out[3].extend(scores[best].tolist())
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table({n: pa.array(v, t) for n, v, t in zip(("query_id", "key", "vec_id", "score"), out, kinds)})


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero and has finite components only."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def code_batches(batches: Iterator[pa.RecordBatch], coder: Coder) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            codes = coder.codes(np.asarray(batch.column(1).flatten(), np.float64).reshape(batch.num_rows, -1))
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code], names=["vec_id", "vector", "code"])


def build_index(vectors: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, Coder | None]:
    """The stored index ``(vec_id, vector, code)`` of all usable rows, and its coder.

    Rows with a null id take no part, nor do vectors that are null, zero, hold null or non-finite
    components, or have another length than most.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    schema = "vec_id long, vector array<double>, code binary"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema), None
    rows = rows.filter(F.size("vector") == lengths[0].n)
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(SAMPLE).collect()
    coder = learn(np.array([r.vector for r in sample]), k)
    return stage(rows.mapInArrow(lambda batches: code_batches(batches, coder), schema), "vector_index"), coder


def _search(index: DataFrame, queries: DataFrame, k: int, n_rows: int, n_queries: int) -> DataFrame:
    row_blocks, query_blocks = -(-n_rows // BLOCK), max(1, -(-n_queries // BLOCK))

    def own(blocks: int, name: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias(name)

    def every(blocks: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias(name)

    rows = index.select("*", own(row_blocks, "rb"), every(query_blocks, "qb"))
    asked = queries.select("*", own(query_blocks, "qb"), every(row_blocks, "rb"))
    found = (
        rows.groupBy("rb", "qb")
        .cogroup(asked.groupBy("rb", "qb"))
        .applyInArrow(lambda a, b: search_block(a, b, k), "query_id long, key long, vec_id long, score double")
    )
    nearest = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "key", "rank", "vec_id", "score")


def nearest(index: DataFrame, coder: Coder | None, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries``, which are rows of the
    index, the ``k`` other rows of largest cosine among those within the radius, all if they are
    fewer than ``k`` otherwise; ties by id.

    Rows of an equal id are one row to each other: neither finds the other.  As queries, equal rows are
    one, and rows of an equal id with different vectors are asked, and ranked, each for itself.  An empty
    index gives an empty table.
    """
    spark = index.sparkSession
    if coder is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = stage(queries.withColumn("key", F.xxhash64("vector")).dropDuplicates(["vec_id", "key"]), "asked")
    n_rows, n_queries = index.count(), queries.count()
    first = stage(_search(index, queries.withColumn("radius", F.lit(coder.radius)), k, n_rows, n_queries), "neighbours")
    served = first.groupBy(F.col("query_id").alias("vec_id"), "key").count().filter(F.col("count") == k).drop("count")
    again = stage(queries.join(served, ["vec_id", "key"], "left_anti"), "unserved")
    n_again = again.count()
    if n_again:
        rest = _search(index, again.select(*queries.columns, F.lit(coder.bits).alias("radius")), k, n_rows, n_again)
        kept = first.join(served.withColumnRenamed("vec_id", "query_id"), ["query_id", "key"], "left_semi")
        first = kept.select(rest.columns).unionByName(rest)
    return first.drop("key")
