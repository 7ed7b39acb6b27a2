"""BM25 ranking of an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.porter import with_stem
from lexspark.functions.text import clean_word, has_letters, raw_words
from lexspark.functions.weights import B, K1, bm25_term_score, exact_sum, length_coefficient
from lexspark.operators.skew import join_per_key
from lexspark.operators.topk import rank_all, top_k, top_k_per_query
from lexspark.session import stage
from lexspark.sources.index_store import SearchIndex, term_bucket

QUERY_BLOCK = 1024  # about as many queries of a term go by one row
BROADCAST_ROWS = 200_000  # terms and ids of queries that are sent to all tasks at most
FILTER_TERMS = 2_000_000  # terms whose hashes are
TASK_SCORES = 2_000_000
TYPED_TERMS = 200  # of one query, that are pushed down to the scan as equality tests


def query_terms(queries: DataFrame, *, analyse: bool = True, stem: bool = False) -> DataFrame:
    """``(query_id, term)``: the distinct terms of ``queries(query_id, text)``.

    Queries go through the same cleaning as documents.  ``analyse=False`` only cuts the
    lower-cased text at blanks.
    """
    text = F.col("text")
    if analyse:
        cut = queries.select("query_id", F.explode(raw_words(text)).alias("word"))
        terms = cut.filter(has_letters(F.col("word"))).select("query_id", clean_word(F.col("word")).alias("term"))
    else:
        cut = queries.select("query_id", F.explode(F.split(F.lower(text), r"\s+")).alias("term"))
        terms = cut.filter("term <> ''")
    terms = terms.distinct()
    if stem:
        terms = with_stem(terms, "term", "stem").select("query_id", F.col("stem").alias("term")).distinct()
    return terms


def _one_of(terms: list[str]) -> Column:
    """A filter that reaches the scan as equality tests, so row groups of other terms are
    skipped.  (A long IN list would be pushed down as one range.)"""
    if len(terms) < 2:
        return F.col("term") == terms[0] if terms else F.lit(False)
    half = len(terms) // 2
    return _one_of(terms[:half]) | _one_of(terms[half:])


def _score(index: SearchIndex, k1: float, b: float) -> Column:
    k = length_coefficient(F.col("dl"), index.stat("avg_len"), k1, b)
    return bm25_term_score(F.col("tf"), F.col("idf"), k, k1)


def query_blocks(terms: DataFrame) -> DataFrame:
    """``(term, block, query_ids)``: the queries of each term, dealt by hash into blocks of about
    ``QUERY_BLOCK``, so a term that many queries hold is not one group."""
    counts = stage(terms.groupBy("term").agg(F.count("*").alias("n_queries")), "query_counts")
    sized = counts.withColumn("blocks", F.ceil(F.col("n_queries") / QUERY_BLOCK))
    dealt = join_per_key(terms, sized, "term", "n_queries")
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks")).alias("block")
    return dealt.groupBy("term", block).agg(F.collect_list("query_id").alias("query_ids"))


def asked_terms(index: SearchIndex, terms: DataFrame) -> DataFrame:
    """``(term, idf, df, bucket, query_ids)`` of ``terms(query_id, term)``, stored: one row per term and
    block of queries that hold it.  ``df`` is null but in a term's first block."""
    stats = index.term_stats.select("term", "idf", "df")
    terms = stage(terms, "query_terms")  # a filter by a stem would be a huge expression
    weighted = query_blocks(terms).join(stats, "term").withColumn("df", F.when(F.col("block") == 0, F.col("df")))
    bucket = term_bucket(F.col("term"), index.buckets).alias("bucket")
    return stage(weighted.select("term", "idf", "df", bucket, "query_ids"), "query_weights")


def pruned_join(rows: DataFrame, asked: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows``, in folders by ``bucket``, joined to a small table of what is asked for, which is broadcast:
    no row moves, and Spark reads only the folders of the buckets that turn up in the broadcast table,
    which it finds out while the query runs."""
    # a test that always holds: only a side with a condition prunes folders
    return rows.join(F.broadcast(asked.filter(F.col("bucket") >= 0)), ["bucket", *on], how)


def join_asked(rows: DataFrame, weighted: DataFrame) -> DataFrame:
    """``rows`` by term, a term having ``df`` of them at most, joined to the result of ``asked_terms``.

    How many terms and ids of queries there are is counted.  Up to ``BROADCAST_ROWS``, they are
    broadcast.  Beyond, rows and terms are dealt by term in shares, so a frequent term fills no task
    whatever the number of queries; up to ``FILTER_TERMS`` terms, their hashes are broadcast first, so that
    only folders and rows of asked terms are read and moved.
    """
    n = asked_cells(weighted)
    if (n.cells or 0) <= BROADCAST_ROWS:
        return pruned_join(rows, weighted.drop("df"), ["term"])
    return _join_many(rows, weighted, n)


def asked_cells(weighted: DataFrame):
    """How many terms and ids of queries there are, and how many terms."""
    return weighted.agg(F.sum(F.size("query_ids") + 1).alias("cells"), F.count("df").alias("terms")).first()


def _join_many(rows: DataFrame, weighted: DataFrame, n) -> DataFrame:
    if n.terms <= FILTER_TERMS:
        hashes = weighted.select("bucket", F.xxhash64("term").alias("__hash")).distinct()
        rows = pruned_join(rows.withColumn("__hash", F.xxhash64("term")), hashes, ["__hash"], "left_semi").drop("__hash")
    return join_per_key(rows, weighted.drop("bucket"), "term", "df")


def term_scores(index: SearchIndex, terms: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """``(query_id, doc, term, score)`` for every document and query term that meet; the postings are
    joined to the terms as ``join_asked`` says."""
    rows = index.postings.select("bucket", "term", "doc", "tf", "dl")
    met = join_asked(rows, asked_terms(index, terms)).withColumn("score", _score(index, k1, b))
    return met.select(F.explode("query_ids").alias("query_id"), "doc", "term", "score")


def scores_by_document(index: SearchIndex, terms: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """``(query_id, doc, score)`` as ``document_scores`` of ``term_scores``.

    Where the queries are broadcast, what is shuffled are the scores of postings, by document: each
    posting once, however many queries ask for its term.  Queries are joined after that, and all of a
    document's scores are added up where they are.  A task has about ``TASK_SCORES`` of them.
    """
    weighted = asked_terms(index, terms)
    rows = index.postings.select("bucket", "term", "doc", "tf", "dl")
    n = asked_cells(weighted)
    if (n.cells or 0) > BROADCAST_ROWS:
        met = _join_many(rows, weighted, n).withColumn("score", _score(index, k1, b))
        return document_scores(met.select(F.explode("query_ids").alias("query_id"), "doc", "score"))
    met = pruned_join(rows, weighted.select("bucket", "term", "idf").distinct(), ["term"])
    per_term = weighted.groupBy("term").agg((F.max("df") * F.sum(F.size("query_ids"))).alias("n"))
    found = per_term.agg(F.sum("n").alias("n")).first().n or 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, found // TASK_SCORES)
    placed = met.select("term", "doc", _score(index, k1, b).alias("score")).repartition(tasks, "doc")
    asked = placed.join(F.broadcast(weighted.select("term", "query_ids")), "term")
    return document_scores(asked.select(F.explode("query_ids").alias("query_id"), "doc", "score"))


def document_scores(scores: DataFrame) -> DataFrame:
    """``(query_id, doc, score)``: the term scores of a document added up."""
    return scores.groupBy("query_id", "doc").agg(exact_sum(F.col("score")).alias("score"))


def score_text(
    index: SearchIndex, text: str, *, analyse: bool = True, stem: bool = False, k1: float = K1, b: float = B
) -> DataFrame:
    """``(doc, score)`` of the documents that hold a word of the query ``text``.  A pasted text of more than
    ``TYPED_TERMS`` distinct words goes the way of a table of queries."""
    query = index.postings.sparkSession.range(1).select(F.lit(text).alias("text"), F.lit(0).alias("query_id"))
    words = query_terms(query, analyse=analyse, stem=stem)
    asked = words.select("term", term_bucket(F.col("term"), index.buckets).alias("bucket")).limit(TYPED_TERMS + 1).collect()
    if len(asked) > TYPED_TERMS:
        return scores_by_document(index, words, k1, b).select("doc", "score")
    terms, buckets = sorted(row.term for row in asked), sorted({row.bucket for row in asked})
    stats = F.broadcast(index.term_stats.filter(_one_of(terms)).select("term", "idf"))
    postings = index.postings.filter(F.col("bucket").isin(buckets)).filter(_one_of(terms))
    scores = postings.join(stats, "term").withColumn("score", _score(index, k1, b))
    return scores.groupBy("doc").agg(exact_sum(F.col("score")).alias("score"))


def all_scores(index: SearchIndex, text: str, **options) -> DataFrame:
    """``(doc, score)`` of every document; 0 where no word of the query is in it."""
    return (
        index.doc_lengths.select("doc")
        .join(score_text(index, text, **options), "doc", "left")
        .select("doc", F.coalesce("score", F.lit(0.0)).alias("score"))
    )


def rank_documents(index: SearchIndex, text: str, **options) -> DataFrame:
    """``(doc, score, rank)`` of every document, the best first: the sorted result as data."""
    return rank_all(all_scores(index, text, **options))


def search(index: SearchIndex, text: str, k: int = 10, *, matched_only: bool = True, **options) -> DataFrame:
    """The best ``k`` documents for one query.

    Weights are signed, so with ``matched_only=False`` a document without any query word,
    score 0, stands above one that only has words found in most documents.
    """
    return top_k((score_text if matched_only else all_scores)(index, text, **options), k)


def search_many(
    index: SearchIndex,
    queries: DataFrame,
    k: int = 10,
    *,
    analyse: bool = True,
    stem: bool = False,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """``(query_id, doc, score, rank)``: the best ``k`` documents of each query."""
    terms = query_terms(queries, analyse=analyse, stem=stem)
    return top_k_per_query(scores_by_document(index, terms, k1, b), k)
