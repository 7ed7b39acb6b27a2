"""How the sources of a language differ in their use of words, each distinct text read once.

Identical texts of a language are one text with a multiplicity per source.  A task
first counts the copies among its own rows, so a text that a third of all rows hold reaches the
shuffle once per task, not once per row.  Behind it, each distinct text is cut into
terms once; its term counts and its presence in a document are added to each of its sources, times
the copies there.

A kept term is in at least ``min_docs`` documents of its language.  Groups, which are the
sources of a language, are compared on all kept terms, but work is only done where a term
occurs: with p for a term that a group has and p0 for one it has not, the divergence of two groups is

    sum over terms of the first   f(p, q0)  +  sum over terms of the second  f(p0, q)
    + sum over terms of both  f(p, q) - f(p, q0) - f(p0, q)
    + f(p0, q0) for each kept term that neither has.

The first two are added up by distinct values of p, not by term; the third joins the groups of each
term.  All of it is integer arithmetic.

Most terms are too rare to be kept, so counts travel packed: a task hands on its counts in one row
per language and bucket of terms, and what reads a bucket adds them up and unpacks the kept terms only.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.shipping import ship
from lexspark.llm.words import groups, text_bytes
from lexspark.operators.skew import join_per_key
from lexspark.session import release, stage

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
KEPT_TEXTS, KEPT_TERMS = 100_000, 400_000  # what a worker keeps before it hands on what it has
BUCKET_DOCS, LEAST_BUCKETS = 500, 1024  # so a bucket has the terms of some hundred documents, however many there are
MERGED_CELLS = 1_000_000  # packed counts of one bucket that are read before they are added up
_SLICE = 20_000
# A-Z to lower case, all other ASCII characters but a-z to a blank
_LETTERS = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

_COPIES = "lang string, source string, digest binary, text string, n long"
_PACKED = "bucket long, lang long, terms binary, groups binary, n binary, n_docs binary"
_KEPT = "lang_key long, group_key long, term string, n long, lang_n long, first boolean"
_PACKED_SCHEMA = pa.schema(
    [("bucket", pa.int64()), ("lang", pa.int64()), *((c, pa.binary()) for c in ("terms", "groups", "n", "n_docs"))]
)


# ---------------------------------------------------------------- copies, terms


def terms_of(text: bytes) -> list[bytes]:
    """The runs of letters and of characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_LETTERS).split()


def copy_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``(lang, source, text)`` as rows of two kinds: a text where the task meets it first,
    and, with a null text, how often it has met it by source."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("digest", pa.binary()), ("text", pa.string()), ("n", pa.int64())])
    met: Counter = Counter()
    seen: set = set()

    def counted() -> Iterator[pa.RecordBatch]:
        rows = list(met.items())
        for a in range(0, len(rows), _SLICE):
            part = rows[a : a + _SLICE]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k, _ in part], pa.string()),
                    pa.array([k[2] for k, _ in part], pa.string()),
                    pa.array([k[1] for k, _ in part], pa.binary()),
                    pa.nulls(len(part), pa.string()),
                    pa.array([n for _, n in part], pa.int64()),
                ],
                schema=schema,
            )
        met.clear()
        seen.clear()

    for batch in batches:
        data, offset = text_bytes(batch.column(2))
        for a, b in groups(offset):
            raw, base = data[offset[a] : offset[b]].tobytes(), offset[a]
            ends = (offset[a : b + 1] - base).tolist()
            langs, sources = (batch.column(c).slice(a, b - a).to_pylist() for c in (0, 1))
            texts = [raw[x:y] for x, y in zip(ends, ends[1:])]
            new: dict[tuple, bytes] = {}
            for lang, source, text in zip(langs, sources, texts):
                key = lang, hashlib.blake2b(text, digest_size=16).digest()
                met[(*key, source)] += 1
                if key not in seen:
                    seen.add(key)
                    new[key] = text
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in new], pa.string()),
                    pa.nulls(len(new), pa.string()),
                    pa.array([k[1] for k in new], pa.binary()),
                    pa.array(list(new.values()), pa.binary()).cast(pa.string()),
                    pa.nulls(len(new), pa.int64()),
                ],
                schema=schema,
            )
            if len(met) > KEPT_TEXTS:
                yield from counted()
    yield from counted()


def _packed(lang: int, cells: dict[int, tuple[Counter, Counter]], buckets: int) -> Iterator[pa.RecordBatch]:
    """The counts of a language by group as one row per bucket: its terms with blanks between them,
    their groups, occurrences and documents."""
    terms = list(chain.from_iterable(counts for counts, _ in cells.values()))
    groups = np.repeat(np.array(list(cells), np.int64), [len(counts) for counts, _ in cells.values()])
    n = np.fromiter(chain.from_iterable(counts.values() for counts, _ in cells.values()), np.int64, len(terms))
    n_docs = np.fromiter(chain.from_iterable(map(docs.__getitem__, counts) for counts, docs in cells.values()), np.int64, len(terms))
    bucket = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % buckets
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)).tolist()
    for a in range(0, len(bounds) - 1, _SLICE):
        rows: list[list] = [[] for _ in range(6)]
        for x, y in zip(bounds[a : a + _SLICE], bounds[a + 1 : a + 1 + _SLICE]):
            part = order[x:y]
            joined = b" ".join([terms[i] for i in part.tolist()])
            for column, value in zip(rows, (int(bucket[part[0]]), lang, joined, *(v[part].tobytes() for v in (groups, n, n_docs)))):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _PACKED_SCHEMA)], schema=_PACKED_SCHEMA)


def term_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``copy_batches`` with numbers for language and group, all of a text next to each other, as
    packed counts of part of the texts each."""
    found: dict[int, dict[int, tuple[Counter, Counter]]] = {}

    def add(lang: int, text: bytes, copies: Counter) -> None:
        words = terms_of(text)
        distinct = None
        for group, n in copies.items():
            counts, docs = found.setdefault(lang, {}).setdefault(group, (Counter(), Counter()))
            if n == 1:
                counts.update(words)
                docs.update(set(words))
                continue
            distinct = distinct or Counter(words)
            for term, times in distinct.items():
                counts[term] += times * n
                docs[term] += n

    def handed_on() -> Iterator[pa.RecordBatch]:
        for lang, cells in found.items():
            yield from _packed(lang, cells, buckets)
        found.clear()

    key, text, copies = None, b"", Counter()
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            for lang, group, digest, row_text, n in zip(*(c.to_pylist() for c in batch.slice(a, 1000).columns)):
                if (lang, digest) != key:
                    if key:
                        add(key[0], text, copies)
                    key, text, copies = (lang, digest), b"", Counter()
                if n is None:
                    text = row_text.encode("utf-8")
                else:
                    copies[group] += n
            if sum(len(counts) for cells in found.values() for counts, _ in cells.values()) > KEPT_TERMS:
                yield from handed_on()
    if key:
        add(key[0], text, copies)
    yield from handed_on()


def _added(parts: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Packed counts of one bucket and language as ``(terms, groups, n, n_docs)``, each term and group once."""
    terms = pa.array(b" ".join([p[0] for p in parts]).split(b" "), pa.binary())
    columns = [np.frombuffer(b"".join([p[i] for p in parts]), np.int64) for i in (1, 2, 3)]
    table = pa.table([terms, *columns], names=["term", "group", "n", "n_docs"])
    summed = table.group_by(["term", "group"], use_threads=False).aggregate([("n", "sum"), ("n_docs", "sum")])
    return (summed["term"].combine_chunks(), *(summed[c].to_numpy() for c in ("group", "n_sum", "n_docs_sum")))


def kept_batches(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Packed counts, all of a bucket and language next to each other, as one row per kept term and group
    that has it; ``first`` marks one row of each term."""

    def kept(lang: int, parts: list[tuple]) -> pa.RecordBatch:
        terms, groups, n, n_docs = _added(parts)
        codes = terms.dictionary_encode()
        code = codes.indices.to_numpy()
        often = np.bincount(code, n_docs) >= min_docs  # sums of documents, far below 2 ** 53
        total = np.zeros(len(often), np.int64)
        np.add.at(total, code, n)
        rows = np.flatnonzero(often[code])
        rows = rows[np.argsort(code[rows], kind="stable")]
        first = np.diff(code[rows], prepend=-1) != 0
        chosen = codes.dictionary.take(pa.array(code[rows])).cast(pa.string())
        columns = [pa.array(np.full(len(rows), lang)), pa.array(groups[rows]), chosen, pa.array(n[rows]), pa.array(total[code[rows]]), pa.array(first)]
        return pa.RecordBatch.from_arrays(columns, names=["lang_key", "group_key", "term", "n", "lang_n", "first"])

    key, parts, cells = None, [], 0
    for batch in batches:
        for bucket, lang, *packed in zip(*(c.to_pylist() for c in batch.columns)):
            if (bucket, lang) != key:
                if key:
                    yield kept(key[1], parts)
                key, parts, cells = (bucket, lang), [], 0
            parts.append(tuple(packed))
            cells += len(packed[1]) // 8
            if cells > MERGED_CELLS:
                terms, *numbers = _added(parts)
                parts = [(b" ".join(terms.to_pylist()), *(v.tobytes() for v in numbers))]
                cells = len(terms)
                cells = cells if cells * 2 < MERGED_CELLS else 0  # a bucket this large is added up in steps of its size
    if key:
        yield kept(key[1], parts)


def _named(docs: DataFrame, lang: str, source: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))]


def kept_terms(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS
) -> DataFrame:
    """``(lang_key, group_key, term, n, lang_n, first)``: how often each kept term occurs in the texts of a
    group and in those of its language.  The keys are hashes of lang, and of lang and source; nulls
    count as ''."""
    ship(docs.sparkSession)
    buckets = max(LEAST_BUCKETS, docs.count() // BUCKET_DOCS)
    texts = docs.select(*_named(docs, lang, source), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    copies = texts.mapInArrow(copy_batches, _COPIES)
    keyed = copies.select(F.xxhash64("lang").alias("lang"), F.xxhash64("lang", "source").alias("group"), "digest", "text", "n")
    together = keyed.repartition("lang", "digest").sortWithinPartitions("lang", "digest")
    packed = together.mapInArrow(lambda batches: term_batches(batches, buckets), _PACKED)
    by_bucket = packed.repartition("bucket").sortWithinPartitions("bucket", "lang")
    return by_bucket.mapInArrow(lambda batches: kept_batches(batches, min_docs), _KEPT)


# ---------------------------------------------------------------- divergence


def share(n: str, total: str, kept: str) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * kept))`` in whole numbers of any size."""
    return F.expr(
        f"1L + cast(cast({n} + 2 as decimal(19, 0)) * {SCALE} as decimal(38, 0)) div cast({total} + 2 * {kept} as decimal(20, 0))"
    )


def distance(p: str, q: str) -> str:
    """``floor((p - q) ** 2 / (p + q))``; both are at most ``SCALE + 1``."""
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _groups(docs: DataFrame, kept: DataFrame, lang: str, source: str) -> DataFrame:
    """One row per group that occurs: ``total`` and ``terms`` of its kept terms, of its language
    ``vocabulary`` and ``lang_total``, and ``p0``, its value for a term that it has not."""
    occurring = docs.select(*_named(docs, lang, source)).distinct()
    occurring = occurring.withColumns({"lang_key": F.xxhash64("lang"), "group_key": F.xxhash64("lang", "source")})
    own = kept.groupBy("group_key").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    langs = kept.filter("first").groupBy("lang_key").agg(F.count("*").alias("vocabulary"), F.sum("lang_n").alias("lang_total"))
    all_groups = occurring.join(own, "group_key", "left").join(langs, "lang_key", "left").na.fill(0)
    p0 = F.when(F.col("vocabulary") > 0, share("0L", "total", "vocabulary"))
    return all_groups.withColumn("p0", p0)


def _pairs(cells: DataFrame, of_groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every two groups of a language."""
    side = of_groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("terms").alias("item_terms"))
    # terms of one group against those that the other has not, by distinct values
    values = cells.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    alone = (
        values.join(side, "lang").filter("source <> item")
        .groupBy("lang", "source", "item").agg(F.expr(f"sum(n * ({distance('p', 'q0')}))").alias("alone"))
    )
    other = cells.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    both = (
        cells.drop("q").join(other, ["lang", "term"]).filter("source < item")
        .groupBy("lang", "source", "item")
        .agg(
            F.expr(f"sum({distance('p', 'q')} - {distance('p', 'q0')} - {distance('p0', 'q')})").alias("both"),
            F.count("*").alias("shared"),
        )
    )
    pairs = (
        of_groups.join(side, "lang").filter("source < item")
        .join(both, ["lang", "source", "item"], "left")
        .join(alone, ["lang", "source", "item"], "left")
        .join(alone.select("lang", F.col("source").alias("item"), F.col("item").alias("source"), F.col("alone").alias("item_alone")),
              ["lang", "source", "item"], "left")
        .na.fill(0, ["both", "shared", "alone", "item_alone"])
    )
    neither = f"(vocabulary - terms - item_terms + shared) * ({distance('p0', 'q0')})"
    value = F.expr(f"case when vocabulary > 0 then both + alone + item_alone + {neither} else 0L end")
    pairs = pairs.select("lang", "source", "item", value.alias("value"))
    return pairs.union(pairs.select("lang", F.col("item"), F.col("source"), "value"))


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    *,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` has, for each source of a
    language, its divergence from each other one, all ranks; part ``term`` the ``top_terms`` terms that
    it uses more than its language does, by divergence.  Larger values first, ties by item.

    Null lang, source and text count as ''.  Ids play no part, so repeated rows count as
    often as they are there.  A source without any term has pairs and no terms; in a language without
    kept terms, all pairs are 0.  An empty table gives an empty table; other columns are ignored.

    The result has a row for every two sources of a language, as asked; beyond that, the join of a
    term's groups is the only work that grows with the square of the number of sources, and
    only of those that have the term.
    """
    kept = stage(kept_terms(docs, lang, source, text, min_docs), "kept_terms")
    of_groups = stage(_groups(docs, kept, lang, source), "groups")
    if of_groups.count() > of_groups.select("group_key").distinct().count():
        raise ValueError("two groups have the same 64-bit key")
    keyed = of_groups.filter("terms > 0").drop("lang_key")
    rows = join_per_key(kept.drop("lang_key"), keyed, "group_key", "terms").withColumns(
        {"p": share("n", "total", "vocabulary"), "q": share("lang_n", "lang_total", "vocabulary")}
    )
    cells = stage(rows.select("lang", "source", "term", "p", "q", "p0"), "cells")
    release(kept)
    best_first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    over = cells.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(distance("p", "q")).alias("value"))
    terms = over.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top_terms)
    pairs = _pairs(cells, of_groups).withColumn("rank", F.row_number().over(best_first))
    parts = [part.withColumn("part", F.lit(name)) for name, part in (("pair", pairs), ("term", terms))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
