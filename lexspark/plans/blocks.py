"""Postings in blocks with score bounds, and an exact top k that leaves out what cannot enter.

Documents are ordered by length and cut into ranges of ``range_docs``.  The postings of a term in
a range are one row, a block, with the greatest and the least ``tf / (tf + K)`` of its postings.
Documents of a range have nearly the same K, so these bounds are tight.

A document's score for a query is at most the sum, over the query's terms in its range, of what the
term's block can give; terms of negative weight can give 0, as a document need not have them.  A range
without a term of positive weight is bounded by the best of its terms.  So:

1. the bounds of all ranges that a query meets, from the terms, ranges and bounds of blocks alone;
2. the ``k`` ranges of the highest bounds are scored; the k-th best score found is a threshold, as
   the ``k`` best documents score that much or more;
3. of the other ranges only those whose bound reaches the threshold are scored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions.weights import B, K1, exact_sum, length_coefficient
from lexspark.operators.ranks import number_rows
from lexspark.operators.skew import join_per_key
from lexspark.operators.topk import top_k_per_query
from lexspark.plans.indexing import dealt_shares
from lexspark.plans.ranking import (
    BROADCAST_ROWS,
    TASK_SCORES,
    asked_cells,
    asked_terms,
    document_scores,
    join_asked,
    pruned_join,
    query_terms,
)
from lexspark.session import scope, settings, stage, store
from lexspark.sources.index_store import SearchIndex, term_bucket

RANGE_DOCS = 16
SLACK = 1e-7  # scores are compared to 9 decimals; a bound may be short by rounding


@dataclass(frozen=True)
class BlockIndex:
    """``blocks(term, range, n, greatest, least, postings, bucket)``, ``postings`` an array of
    ``(doc, tf, dl)``, and the search index it was made of.  The bounds hold for one ``k1`` and ``b``."""

    blocks: DataFrame
    index: SearchIndex
    k1: float
    b: float


def _part(index: SearchIndex, k1: float, b: float) -> Column:
    """The share of ``(k1 + 1) * idf`` that a posting scores."""
    return F.col("tf") / (F.col("tf") + length_coefficient(F.col("dl"), index.stat("avg_len"), k1, b))


def build_blocks(
    index: SearchIndex, path: str, *, range_docs: int = RANGE_DOCS, k1: float = K1, b: float = B, files: int | None = None
) -> BlockIndex:
    """Write the postings of ``index`` in blocks to ``path`` and read them back.

    Postings learn the range of their document by a join in shares.  They are dealt once, by bucket and a
    hash of the range; the blocks of a partition are then complete, and a frequent term spreads
    over its bucket's shares.  They are sorted once, and blocks are cut from the sorted rows.  A block holds
    ``range_docs`` postings at most.
    """
    spark = index.postings.sparkSession
    with scope(spark):
        numbered = number_rows(index.doc_lengths.select("doc", "dl", "n_terms"), ["dl", "doc"], "number", 0)
        ranges = stage(numbered.select("doc", "n_terms", F.expr(f"number div {range_docs}").alias("range")), "ranges")
        placed = join_per_key(index.postings.select("term", "doc", "tf", "dl"), ranges, "doc", "n_terms")
        shares = dealt_shares(ranges, index.buckets, files)
        placed = placed.withColumn("bucket", term_bucket(F.col("term"), index.buckets))
        placed = placed.withColumn("share", F.pmod(F.xxhash64("range"), F.lit(shares)).cast("int"))
        order = ("bucket", "share", "term", "range")
        dealt = placed.repartition(index.buckets * shares, "bucket", "share").sortWithinPartitions(*order, "doc")
        part = _part(index, k1, b)
        blocks = dealt.groupBy(*order).agg(
            F.count("*").cast("int").alias("n"),
            F.max(part).alias("greatest"),
            F.min(part).alias("least"),
            F.sort_array(F.collect_list(F.struct("doc", "tf", "dl"))).alias("postings"),
        )
        blocks = blocks.select("term", "range", "n", "greatest", "least", "postings", "bucket")
        with settings(spark, {"spark.sql.execution.replaceHashWithSortAgg": "true"}):  # the rows are in order
            stored = store(blocks, f"{path}/blocks", ("bucket",))
    return BlockIndex(stored, index, k1, b)


def read_blocks(spark: SparkSession, path: str, index: SearchIndex, *, k1: float = K1, b: float = B) -> BlockIndex:
    """The blocks that ``build_blocks`` wrote to ``path`` of the same ``index``, ``k1`` and ``b``."""
    return BlockIndex(spark.read.parquet(f"{path}/blocks"), index, k1, b)


def _of_ranges(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Blocks by term and range, repeated for each query that wants them.  Beyond ``BROADCAST_ROWS``
    a plain join, whose large partitions Spark splits."""
    if wanted.count() <= BROADCAST_ROWS:
        return pruned_join(blocks, wanted, ["term", "range"])
    return blocks.join(wanted, ["bucket", "term", "range"])


def _bounds(blocked: BlockIndex, weighted: DataFrame) -> DataFrame:
    """``(query_id, range, bound, n)``: the most that a document of a range can score, and how many
    postings the query has there."""
    rows = blocked.blocks.select("bucket", "term", "range", "n", "greatest", "least")
    met = join_asked(rows, weighted)
    best = F.lit(blocked.k1 + 1) * F.col("idf") * F.when(F.col("idf") > 0, F.col("greatest")).otherwise(F.col("least"))
    met = met.select(F.explode("query_ids").alias("query_id"), "range", "n", best.alias("best"))
    together = met.groupBy("query_id", "range").agg(
        F.sum(F.greatest("best", F.lit(0.0))).alias("positive"), F.max("best").alias("single"), F.sum("n").alias("n")
    )
    bound = F.when(F.col("single") > 0, F.col("positive")).otherwise(F.col("single"))
    return together.select("query_id", "range", bound.alias("bound"), "n")


def _range_scores(blocked: BlockIndex, weighted: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(query_id, doc, score)`` of the documents in these ``(query_id, range, n)``.

    Where the queries are broadcast, what is shuffled are blocks of asked terms, by range: each block once, however
    many queries ask for it.  Queries are joined after that, and as a document lies in one range, its scores are
    added up where they are.  A task has about ``TASK_SCORES`` of them.
    """
    rows = blocked.blocks.select("bucket", "term", "range", "postings")
    if (asked_cells(weighted).cells or 0) > BROADCAST_ROWS:
        return _range_scores_by_term(blocked, rows, weighted, ranges)
    wanted = ranges.groupBy("range").agg(F.collect_list("query_id").alias("wanted"), F.sum("n").alias("n"))
    wanted = stage(wanted, "wanted_ranges")
    found = wanted.agg(F.count("*").alias("ranges"), F.sum("n").alias("n")).first()
    met = pruned_join(rows, weighted.select("bucket", "term", "idf").distinct(), ["term"])
    if found.ranges <= BROADCAST_ROWS:
        met = met.join(F.broadcast(wanted.select("range")), "range", "left_semi")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, (found.n or 0) // TASK_SCORES)
    placed = met.select("range", "term", "idf", "postings").repartition(tasks, "range")
    asked = placed.join(F.broadcast(weighted.select("term", "query_ids")), "term").join(wanted.drop("n"), "range")
    asked = asked.select("range", "idf", "postings", F.array_intersect("query_ids", "wanted").alias("query_ids"))
    entries = asked.select("range", "idf", "query_ids", F.explode("postings").alias("p")).select("range", "idf", "query_ids", "p.*")
    scores = entries.select("range", "doc", "query_ids", _range_score(blocked).alias("score"))
    scores = scores.select(F.explode("query_ids").alias("query_id"), "range", "doc", "score")
    return scores.groupBy("query_id", "range", "doc").agg(exact_sum(F.col("score")).alias("score")).drop("range")


def _range_score(blocked: BlockIndex) -> Column:
    return F.lit(blocked.k1 + 1) * F.col("idf") * _part(blocked.index, blocked.k1, blocked.b)


def _range_scores_by_term(blocked: BlockIndex, rows: DataFrame, weighted: DataFrame, ranges: DataFrame) -> DataFrame:
    asked = weighted.select(F.explode("query_ids").alias("query_id"), "term", "idf", "bucket")
    wanted = stage(ranges.select("query_id", "range").join(asked, "query_id"), "wanted_blocks")
    met = _of_ranges(rows, wanted)
    met = met.select("query_id", "idf", F.explode("postings").alias("p")).select("query_id", "idf", "p.*")
    return document_scores(met.select("query_id", "doc", _range_score(blocked).alias("score")))


def _search(blocked: BlockIndex, queries: DataFrame, k: int, analyse: bool, stem: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The best documents, the bounds, and the ranges that were scored."""
    weighted = asked_terms(blocked.index, query_terms(queries, analyse=analyse, stem=stem))
    bounds = stage(_bounds(blocked, weighted), "bounds")
    best_first = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "range")
    first = bounds.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= k)
    first = stage(first.select("query_id", "range", "n"), "first_ranges")
    found = stage(top_k_per_query(_range_scores(blocked, weighted, first), k), "first_scores")
    threshold = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("threshold"))
    left = bounds.join(first.select("query_id", "range"), ["query_id", "range"], "left_anti").join(threshold, "query_id", "left")
    open_ranges = left.filter(F.col("threshold").isNull() | (F.col("bound") + SLACK >= F.col("threshold")))
    later = stage(open_ranges.select("query_id", "range", "n"), "later_ranges")
    scores = found.select("query_id", "doc", "score").union(_range_scores(blocked, weighted, later))
    return top_k_per_query(scores, k), bounds, first.union(later)


def search_blocks(
    blocked: BlockIndex, queries: DataFrame, k: int = 10, *, analyse: bool = True, stem: bool = False
) -> DataFrame:
    """``(query_id, doc, score, rank)``: the best ``k`` documents of each query, the same rows as those of
    ``search_many``."""
    return _search(blocked, queries, k, analyse, stem)[0]


def search_work(
    blocked: BlockIndex, queries: DataFrame, k: int = 10, *, analyse: bool = True, stem: bool = False
) -> DataFrame:
    """``(query_id, n_matched, n_scored)``: how many postings each query meets, and how many of them
    ``search_blocks`` scores."""
    _, bounds, scored = _search(blocked, queries, k, analyse, stem)
    done = scored.groupBy("query_id").agg(F.sum("n").alias("n_scored"))
    return bounds.groupBy("query_id").agg(F.sum("n").alias("n_matched")).join(done, "query_id")
