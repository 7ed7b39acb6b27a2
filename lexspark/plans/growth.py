"""An index that grows: documents added, replaced and removed without a rebuild, and compaction.

An addition writes a segment for its own documents only.  Of the tables that are there it reads the lengths,
and of the postings the columns term and document, to know what the replaced documents
take away from document frequencies.  Its work is in proportion to the new documents, but for that
one scan, which is left out where no document is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.weights import bm25_idf
from lexspark.operators.terms import one_by_one
from lexspark.plans.indexing import (
    packed_counts,
    packed_frequency,
    packed_lengths,
    packed_postings,
    store_postings,
    store_terms,
)
from lexspark.session import scope, stage, store
from lexspark.sources.index_store import SearchIndex, new_version, publish, read_index, segments


def add_documents(
    spark: SparkSession,
    path: str,
    chunks: DataFrame,
    *,
    removed: DataFrame | None = None,
    stem: bool = False,
    count_titles: bool | None = None,
    keep_empty: bool = False,
    files: int | None = None,
) -> SearchIndex:
    """Add the documents of ``chunks`` to the index at ``path``; one that is there already is replaced.

    ``removed(doc)`` names documents to take out; those of them that ``chunks`` holds are replaced
    instead.  Text is treated as ``build_index`` does with the same options, which should be those
    of the build.  A document whose new text has no token is not found among the new ones: name it
    in ``removed`` as well.  The index changes when all tables are written, and a failed
    addition leaves it as it was; additions to one index run one after the other.
    """
    before, index = segments(spark, path), read_index(spark, path)
    with scope(spark):
        packed = packed_counts(chunks, stem=stem, count_titles=count_titles, keep_empty=keep_empty)
        return _append(spark, path, before, index, packed, removed, files)


def add_counts_of(
    spark: SparkSession, path: str, counts: DataFrame, *, removed: DataFrame | None = None, files: int | None = None
) -> SearchIndex:
    """``add_documents`` for ``counts(doc, term, tf)``."""
    before, index = segments(spark, path), read_index(spark, path)
    with scope(spark):
        return _append(spark, path, before, index, stage(one_by_one(counts), "counts"), removed, files)


def _append(spark, path, before, index, packed, removed, files) -> SearchIndex:
    version = new_version(path)
    doc_lengths = store(packed_lengths(packed), f"{version}/doc_lengths")
    leaving = doc_lengths.select("doc")
    if removed is not None:
        leaving = leaving.union(removed.select(F.col("doc").cast(leaving.schema["doc"].dataType))).distinct()
    gone = index.doc_lengths.join(leaving, "doc", "left_semi").select("doc", "dl")
    superseded = store(gone, f"{version}/superseded")
    frequencies = packed_frequency(packed)
    if not superseded.isEmpty():
        lost = index.postings.select("term", "doc").join(superseded.select("doc"), "doc", "left_semi")
        lost = lost.groupBy("term").agg((-F.count("*")).alias("df"))
        frequencies = frequencies.unionByName(lost).groupBy("term").agg(F.sum("df").alias("df"))
    store(frequencies.filter("df <> 0").repartitionByRange("term").sortWithinPartitions("term"), f"{version}/term_changes")
    sums = [F.count("*").alias("n_docs"), F.coalesce(F.sum("dl"), F.lit(0)).alias("total_len")]
    new, old = doc_lengths.agg(*sums), superseded.agg(*((-c).alias(n) for c, n in zip(sums, ("n_docs", "total_len"))))
    changes = new.unionByName(old).agg(F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len"))
    store(changes.coalesce(1), f"{version}/corpus_changes")
    store_postings(packed_postings(packed), version, index.buckets, files, doc_lengths)
    publish(spark, path, version, index.buckets, before)
    return read_index(spark, path)


def compact(spark: SparkSession, path: str, *, files: int | None = None) -> SearchIndex:
    """Write the segments of the index at ``path`` as one.  No text is read again: lengths, counts and
    frequencies are those of the segments.  ``drop_old_versions`` deletes these afterwards."""
    index, version = read_index(spark, path), new_version(path)
    doc_lengths = store(index.doc_lengths, f"{version}/doc_lengths")
    corpus = store(index.corpus_stats.select("n_docs", "total_len", "avg_len").coalesce(1), f"{version}/corpus_stats")
    idf = bm25_idf(corpus.select("n_docs").scalar(), F.col("df"))
    term_stats = store_terms(index.term_stats.select("term", "df").withColumn("idf", idf), version)
    postings = store_postings(index.postings.select("term", "doc", "tf", "dl"), version, index.buckets, files, doc_lengths)
    publish(spark, path, version, index.buckets)
    return SearchIndex(postings, doc_lengths, term_stats, corpus, index.buckets)
