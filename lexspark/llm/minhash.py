"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature is ``CHUNKS * CHUNK`` symbols of 16 bits, the minima of so many hash functions over
the word shingles of a text.  Two sets of similarity 0.8 differ in a fifth of the symbols on
average.  Signatures at most ``RADIUS = 2 * CHUNKS - 1`` symbols apart agree, by the pigeonhole
principle, in some chunk but for one symbol at most.  So each signature is listed under each
chunk with each one symbol left out, and every pair within the radius meets in a list.  The
chance that a pair of similarity 0.8 is farther apart than the radius is about 2 in 100,000,
and far smaller for any closer pair.

1. Texts with the same set of shingles are one class; only classes go on.
2. Lists with two classes or more are kept; in each, classes within the radius are linked by
   a forest (not by all pairs), which gives clusters of possible links.
3. The full sets of a cluster's texts meet and are linked exactly, again by a forest.
4. Connected components of the exact links, handed to the members of the classes.

No group is held by one task whatever its size: lists and clusters above a fixed size are cut
into blocks, and every two blocks meet in a task of their own.  Every candidate within the radius
is tested unless its two texts are already connected by tested links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.links import block_pairs, components, spread
from lexspark.llm.shipping import ship
from lexspark.llm.words import mix, numbers, shingle_hashes, word_groups
from lexspark.operators.skew import join_per_key
from lexspark.session import release, stage

CHUNKS, CHUNK = 17, 5
SYMBOLS = CHUNKS * CHUNK
RADIUS = 2 * CHUNKS - 1
LIST_BLOCK = 8192  # classes of a list in a block
CLUSTER_BLOCK = 1 << 20  # shingles of a cluster in a block
TASK_ROWS, TASK_SHINGLES = 20_000, 1 << 19  # what a grouped map takes at a time
SMALL = 16  # lists up to this size are compared pair by pair


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    return (batch.slice(a, rows) for a in range(0, batch.num_rows, rows))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    for _, words in word_groups(texts):
        shingles, offset = shingle_hashes(words.hashes(), words.first, width)
        for t in range(words.texts):
            own = np.sort(shingles[offset[t] : offset[t + 1]])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) else own


def signatures(shingles: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """One row of 16-bit symbols per set; sets lie one after the other, none is empty."""
    factor = (numbers(SYMBOLS, 3) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shift = (numbers(SYMBOLS, 4) >> np.uint64(32)).astype(np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(offset) - 1, SYMBOLS), np.uint16)
    if not len(out):
        return out
    for k in range(SYMBOLS):
        least = np.minimum.reduceat(short * factor[k] + shift[k], offset[:-1])
        out[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def profile_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1000)):
        sets = list(shingle_sets(batch.column(1), width))
        n = np.array([len(s) for s in sets], np.int64)
        keys = np.zeros((len(sets), 2), np.uint64)
        for i, own in enumerate(sets):
            if len(own):
                keys[i] = mix(own).sum(), np.bitwise_xor.reduce(own)
        filled = [s for s in sets if len(s)]
        rows = iter(signatures(np.concatenate(filled), np.concatenate(([0], np.cumsum(n[n > 0])))) if filled else [])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n),
                pa.array(keys[:, 0].view(np.int64)),
                pa.array(keys[:, 1].view(np.int64)),
                pa.array([next(rows).tobytes() if size else None for size in n], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
        )


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def entry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of each signature: 56 bits of a hash, then the chunk and the place left out."""
    factors = numbers(SYMBOLS, 6).reshape(CHUNKS, CHUNK) | np.uint64(1)
    for batch in batches:
        for a in range(0, batch.num_rows, 2000):
            part = batch.slice(a, 2000)
            weighted = mix(_symbols(part.column(1)).astype(np.uint64) + np.uint64(1)).reshape(-1, CHUNKS, CHUNK) * factors
            left = weighted.sum(axis=2, keepdims=True) - weighted
            place = np.arange(CHUNKS)[:, None] * 8 + np.arange(CHUNK)[None, :]
            key = (mix(left.ravel()).reshape(left.shape) << np.uint64(8)) | place.astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.ravel().view(np.int64)),
                    pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), SYMBOLS)),
                ],
                names=["key", "id"],
            )


def _group_bounds(*keys: np.ndarray) -> np.ndarray:
    """Where groups of equal keys begin, in sorted rows, with the end added."""
    if not len(keys[0]):
        return np.zeros(1, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.append(np.flatnonzero(new), len(keys[0]))


def _forest(n: int, near, start: int = 0) -> list[tuple[int, np.ndarray]]:
    """Links that connect what ``near(i, others)`` connects: from each reached place, only
    places not reached before are tested."""
    links, left = [], np.arange(n)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = near(at, left)
            if hit.any():
                links.append((at, left[hit]))
                queue.extend(left[hit])
                left = left[~hit]
    return links


def _edges(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    a = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    b = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def link_lists(table: pa.Table) -> pa.Table:
    """Links within the radius inside each ``(key, bi, bj)``.

    A pair of a small list is tested only in the first list that both are in.
    """
    key, bi, bj, ids = (table.column(c).to_numpy() for c in ("key", "bi", "bj", "id"))
    order = np.lexsort((ids, bj, bi, key))
    key, bi, bj, ids = key[order], bi[order], bj[order], ids[order]
    symbols = _symbols(table.column("signature"))[order]
    bounds = _group_bounds(key, bi, bj)
    sizes = np.diff(bounds)
    parts = []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]):
        starts = bounds[:-1][sizes == size]
        for i in range(size):
            for j in range(i + 1, size):
                for at in range(0, len(starts), 20_000):
                    first, second = starts[at : at + 20_000] + i, starts[at : at + 20_000] + j
                    differ = (symbols[first] != symbols[second]).reshape(-1, CHUNKS, CHUNK)
                    errors = differ.sum(axis=2)
                    chunk = (errors <= 1).argmax(axis=1)
                    rows = np.arange(len(first))
                    place = np.where(errors[rows, chunk] == 0, 0, differ[rows, chunk].argmax(axis=1))
                    own = (key[first].view(np.uint64) & np.uint64(255)).astype(np.int64) == chunk * 8 + place
                    good = own & (errors.sum(axis=1) <= RADIUS)
                    parts.append((ids[first[good]], ids[second[good]]))
    for g in np.flatnonzero(sizes > SMALL):
        rows = slice(bounds[g], bounds[g + 1])
        names, own = ids[rows], symbols[rows]
        for at, hits in _forest(len(names), lambda i, left: (own[left] != own[i]).sum(axis=1) <= RADIUS):
            parts.append((np.full(len(hits), names[at]), names[hits]))
    return _edges(parts)


def link_sets(table: pa.Table, width: int, similarity: tuple[int, int]) -> pa.Table:
    """Exact links inside each ``(cluster, bi, bj)``: intersection * den >= union * num."""
    num, den = similarity
    cluster, bi, bj, ids = (table.column(c).to_numpy() for c in ("cluster", "bi", "bj", "doc_id"))
    order = np.lexsort((ids, bj, bi, cluster))
    sets = list(shingle_sets(table.column("text").take(pa.array(order)), width))
    cluster, bi, bj, ids = cluster[order], bi[order], bj[order], ids[order]
    bounds = _group_bounds(cluster, bi, bj)
    parts = []
    for first, last in zip(bounds[:-1], bounds[1:]):
        own, names = sets[first:last], ids[first:last]
        size = np.array([len(s) for s in own])
        values, local = np.unique(np.concatenate(own), return_inverse=True)
        offset = np.concatenate(([0], np.cumsum(size)))
        marked = np.zeros(len(values), bool)

        def near(i: int, left: np.ndarray) -> np.ndarray:
            marked[local[offset[i] : offset[i + 1]]] = True
            fits = (den * np.minimum(size[left], size[i]) >= num * np.maximum(size[left], size[i])) & (size[left] > 0)
            hit = np.zeros(len(left), bool)
            if fits.any():
                near_by = left[fits]
                ends = np.cumsum(size[near_by])
                places = np.arange(ends[-1]) + np.repeat(offset[near_by] - (ends - size[near_by]), size[near_by])
                common = np.add.reduceat(marked[local[places]].astype(np.int64), ends - size[near_by])
                hit[fits] = den * common >= num * (size[near_by] + size[i] - common)
            marked[local[offset[i] : offset[i + 1]]] = False
            return hit

        for at, hits in _forest(len(names), near):
            parts.append((np.full(len(hits), names[at]), names[hits]))
    return _edges(parts)


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, width: int = 5, similarity: tuple[int, int] = (4, 5)
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``.

    Texts are lower-cased in A-Z and cut at blanks; a text's set is that of its ``width``-word
    shingles, or its whole sequence if it is shorter.  Two texts are linked if the similarity of
    their sets is at least ``similarity``, a fraction.  ``component_id`` is the smallest id
    reachable over links, ``kept`` marks that document.

    A null or blank text has an empty set, is linked to nothing and kept.  A row without id is
    linked to nothing, has no component and is kept.  Rows that repeat an id are returned each,
    with the same component.  An empty table gives an empty table; other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"
    profiles = stage(rows.mapInArrow(lambda batches: profile_batches(batches, width), schema), "profiles")

    filled = profiles.filter("n_shingles > 0 and doc_id is not null")
    set_key = F.struct("set_a", "set_b", "n_shingles")
    classes = filled.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("id"), F.count("*").alias("n_rows"), F.min("signature").alias("signature")
    )
    classes = stage(classes, "classes")
    entries = classes.select("id", "signature").mapInArrow(entry_batches, "key long, id long")
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    listed = stage(entries.join(shared, "key"), "lists")
    listed_signatures = listed.join(classes.select("id", "signature"), "id")
    in_blocks = block_pairs(listed_signatures, "key", F.col("id"), F.ceil(F.col("n") / LIST_BLOCK))
    n_tasks = listed.count() // TASK_ROWS + 1
    candidates = (
        spread(in_blocks, ["key", "bi", "bj"], n_tasks)
        .select("__task", "key", "bi", "bj", "id", "signature")
        .groupBy("__task")
        .applyInArrow(lambda table: link_lists(table), "a long, b long")
    )
    clusters = stage(components(candidates).withColumnRenamed("component", "cluster"), "clusters")
    release(listed)

    members = clusters.join(classes.select("id", "n_shingles"), "id")
    weights = members.groupBy("cluster").agg(F.sum("n_shingles").alias("weight"))
    in_cluster = members.select("id", "cluster").join(weights, "cluster")
    texts = rows.join(in_cluster, rows.doc_id == in_cluster.id)
    in_blocks = block_pairs(texts, "cluster", F.col("doc_id"), F.ceil(F.col("weight") / CLUSTER_BLOCK))
    n_tasks = (members.agg(F.sum("n_shingles")).first()[0] or 0) // TASK_SHINGLES + 1
    links = (
        spread(in_blocks, ["cluster", "bi", "bj"], n_tasks)
        .select("__task", "cluster", "bi", "bj", "doc_id", "text")
        .groupBy("__task")
        .applyInArrow(lambda table: link_sets(table, width, similarity), "a long, b long")
    )
    found = components(links)

    per_class = classes.select(set_key.alias("set_key"), "id", "n_rows").join(found, "id", "left")
    per_class = stage(
        per_class.select("set_key", "n_rows", F.coalesce("component", "id").alias("component_id")), "components"
    )
    linked = join_per_key(filled.select("doc_id", "n_shingles", set_key.alias("set_key")), per_class, "set_key", "n_rows")
    alone = profiles.filter("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    both = linked.select(columns).unionByName(alone.select(columns))
    return both.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
