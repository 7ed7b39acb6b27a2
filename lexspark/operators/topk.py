"""Order scored documents and keep the best.

Scores are added in fixed point, so they are the same in every run (``weights.exact_sum``).
Documents are compared by their score to 9 decimals, then by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.operators.ranks import number_rows

SCORE_DECIMALS = 9
DIRECT_K = 100  # rows of a query that each task hands to the last step at most; Spark's own limit is 1,000


def _best_first() -> list:
    return [F.round("score", SCORE_DECIMALS).desc(), F.col("doc").asc()]


def sort_by_score(scores: DataFrame) -> DataFrame:
    """All rows, best first: a range-partitioned sort, not one task."""
    return scores.orderBy(*_best_first())


def rank_all(scores: DataFrame) -> DataFrame:
    """All rows with their ``rank`` from 1, best first, whatever order the rows come in: no task sees
    more than its part of the order."""
    return number_rows(scores, _best_first(), "rank")


def top_k(scores: DataFrame, k: int = 10) -> DataFrame:
    """The best ``k`` rows: each task keeps its own best, the last step merges them."""
    return sort_by_score(scores).limit(k)


def top_k_per_query(scores: DataFrame, k: int = 10) -> DataFrame:
    """The best ``k`` rows of each query, with their ``rank``.

    Up to ``DIRECT_K``, Spark keeps each query's best ``k`` of a task before it moves anything.  Beyond, each
    query is first cut to its best ``k`` in each of 256 shares of the documents, so a query
    that matches most documents does not end up in one task, whatever ``k``.
    """
    by_query = Window.partitionBy("query_id").orderBy(*_best_first())
    if k <= DIRECT_K:
        return scores.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    share = F.pmod(F.xxhash64("doc"), F.lit(256))
    by_share = Window.partitionBy("query_id", share).orderBy(*_best_first())
    best = scores.withColumn("rank", F.row_number().over(by_share)).filter(F.col("rank") <= k).drop("rank")
    return best.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
