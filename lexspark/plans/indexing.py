"""From chunks of text to an index on disk."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexspark.functions.weights import bm25_idf
from lexspark.operators.terms import (
    add_counts,
    as_entries,
    by_title_key,
    corpus_stats,
    count_terms,
    counts_by_title,
    document_counts,
    document_frequency,
    one_by_one,
    stem_counts,
    stem_packed,
    stemmed_titled_counts,
    title_counts,
    title_texts,
    titled_counts,
    tokens,
    unpacked,
)
from lexspark.session import TEXT_CODEC, keep, release, scope, settings, stage, store
from lexspark.sources.index_store import BUCKETS, SearchIndex, new_version, publish, term_bucket

TASK_POSTINGS = 2_000_000


def term_counts(
    chunks: DataFrame, *, stem: bool = False, count_titles: bool | None = None, keep_empty: bool = False
) -> DataFrame:
    """``(doc, term, tf)`` of the given chunks.

    ``count_titles`` counts the words of title lines too, as written and never stemmed; it
    needs the column ``title_line``, and is the default where there is one.  ``keep_empty`` keeps
    documents without any token.
    """
    if count_titles is None:
        count_titles = "title_line" in chunks.columns
    if not count_titles:
        if "text" not in chunks.columns:
            counts = count_terms(tokens(chunks, keep_empty))
            return add_counts(stem_counts(stage(counts, "raw_counts")).repartition("doc")) if stem else counts
        counts = unpacked(stage(document_counts(chunks, keep_empty), "raw_counts"))
        return add_counts(stem_counts(counts).repartition("doc")) if stem else counts
    if not stem and "line_id" in chunks.columns:
        return unpacked(stage(titled_counts(title_texts(chunks)), "raw_counts"))
    if "line_id" in chunks.columns:
        return stemmed_titled_counts(title_texts(chunks)).select("doc", "term", "tf")
    counts = stage(counts_by_title(chunks), "raw_counts")
    body = stem_counts(counts) if stem else counts
    merged = add_counts(by_title_key(body), by_title_key(title_counts(counts)))
    return merged.filter(F.col("term").isNotNull())


def build_index(
    chunks: DataFrame,
    path: str,
    *,
    stem: bool = False,
    count_titles: bool | None = None,
    keep_empty: bool = False,
    buckets: int = BUCKETS,
    files: int | None = None,
    dropped: Observation | None = None,
    release_chunks: bool = False,
) -> SearchIndex:
    """Write the index tables of ``chunks(doc, chunk)`` to ``path`` and read them back;
    ``buckets``, ``files`` and ``dropped`` as in ``index_counts``.  ``release_chunks`` is for ``wiki_chunks`` that nothing
    else reads: the table that they are read from is deleted as soon as their words are stored."""
    spark = chunks.sparkSession
    with scope(spark):
        packed = packed_counts(
            chunks, stem=stem, count_titles=count_titles, keep_empty=keep_empty, release_chunks=release_chunks
        )
        return _write_index(spark, packed, path, buckets, files, dropped)


def index_counts(
    counts: DataFrame, path: str, *, buckets: int = BUCKETS, files: int | None = None, dropped: Observation | None = None
) -> SearchIndex:
    """Write the index tables of ``counts(doc, term, tf)`` to ``path`` and read them back.

    The counts are written once, with the lengths of their documents, and read three times, each time
    only the columns needed.
    Postings lie in ``buckets`` folders by term and in about ``files`` files (by default one per folder
    and ``TASK_POSTINGS`` of them).  Postings and term statistics are ordered by term, so that a query reads only
    the row groups of its terms; ordering postings by document within a term lets a frequent term
    spread over many files.  The index replaces the one at ``path`` when all its tables are written.
    ``dropped`` is what the source of the counts was given to count the rows that it leaves out; the figures are
    published with the index (``dropped_rows``).
    """
    with scope(counts.sparkSession):
        return _write_index(counts.sparkSession, stage(one_by_one(counts), "counts"), path, buckets, files, dropped)


def packed_counts(
    chunks: DataFrame,
    *,
    stem: bool = False,
    count_titles: bool | None = None,
    keep_empty: bool = False,
    release_chunks: bool = False,
) -> DataFrame:
    """The counts of ``term_counts`` as ``document_counts`` gives them, stored; what else is staged for them is deleted."""
    with scope(chunks.sparkSession):
        if count_titles is not False and {"title_line", "line_id"} <= set(chunks.columns):
            texts = title_texts(chunks)
            if release_chunks:
                release(chunks)
            packed = as_entries(stemmed_titled_counts(texts)) if stem else titled_counts(texts)
        elif "text" in chunks.columns and not count_titles:
            packed = document_counts(chunks, keep_empty)
            if stem:
                packed = stem_packed(stage(packed, "raw_counts"))
        else:
            packed = one_by_one(term_counts(chunks, stem=stem, count_titles=count_titles, keep_empty=keep_empty))
        return keep(stage(packed, "counts", TEXT_CODEC))


def packed_lengths(packed: DataFrame) -> DataFrame:
    """``(doc, dl, n_terms)`` of stored packed counts."""
    terms = packed.select("doc", "dl", F.size("terms").alias("n")).filter("n > 0")
    return terms.groupBy("doc").agg(F.max("dl").alias("dl"), F.sum("n").cast("long").alias("n_terms"))


def packed_postings(packed: DataFrame) -> DataFrame:
    """``(term, doc, tf, dl)`` of what is a document's term, of stored packed counts."""
    entries = packed.filter(F.col("doc").isNotNull()).select("doc", "dl", F.explode("terms").alias("entry"))
    return entries.select("entry.term", "doc", "entry.tf", "dl").filter(F.col("term").isNotNull())


def packed_frequency(packed: DataFrame) -> DataFrame:
    """``(term, df)`` of stored packed counts."""
    return document_frequency(packed.select(F.explode("terms.term").alias("term")))


def _write_index(spark, packed, path, buckets, files, dropped) -> SearchIndex:
    """Write the index tables of stored packed counts."""
    version = new_version(path)
    doc_lengths = store(packed_lengths(packed), f"{version}/doc_lengths")
    corpus = store(corpus_stats(doc_lengths).coalesce(1), f"{version}/corpus_stats")
    n_docs = corpus.select("n_docs").scalar()
    term_stats = store_terms(packed_frequency(packed).withColumn("idf", bm25_idf(n_docs, F.col("df"))), version)
    postings = store_postings(packed_postings(packed), version, buckets, files, doc_lengths)
    publish(spark, path, version, buckets, dropped=dropped)
    return SearchIndex(postings, doc_lengths, term_stats, corpus, buckets)


def store_terms(frequencies: DataFrame, version: str) -> DataFrame:
    """Write ``term_stats`` in term order."""
    return store(frequencies.repartitionByRange("term").sortWithinPartitions("term"), f"{version}/term_stats")


def dealt_shares(doc_lengths: DataFrame, buckets: int, files: int | None = None) -> int:
    """Into how many shares the postings of a bucket are dealt, so that a task has about ``TASK_POSTINGS``."""
    n = doc_lengths.agg(F.sum("n_terms").alias("n")).first().n or 0
    return max(1, math.ceil(files / buckets) if files else math.ceil(n / (TASK_POSTINGS * buckets)))


def store_postings(postings: DataFrame, version: str, buckets: int, files: int | None, doc_lengths: DataFrame) -> DataFrame:
    """Write ``postings(term, doc, tf, dl)`` by bucket, in the order of term and document.

    They are dealt by bucket and, where there are many, by a hash of the document, which takes one pass over
    them; a frequent term lies in as many files as its bucket has shares."""
    shares = dealt_shares(doc_lengths, buckets, files)
    bucketed = postings.withColumn("bucket", term_bucket(F.col("term"), buckets))
    share = F.pmod(F.xxhash64("doc"), F.lit(shares)).cast("int")
    dealt = bucketed.repartitionById(buckets * shares, F.col("bucket") * shares + share)
    # a task has one bucket, so its rows need no order by it, and are compared by the first letters of their terms
    written = {"spark.sql.maxConcurrentOutputFileWriters": "1", "spark.sql.parquet.compression.codec": TEXT_CODEC}
    with settings(postings.sparkSession, written):
        return store(dealt.sortWithinPartitions("term", "doc"), f"{version}/postings", ("bucket",))
