"""

``entry`` is the flagship query, ``queries`` has one entry per operator and ``oracle_sql``
the same result as SQL (see ``oracles.py``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from lexspark.functions import weights  # noqa: E402
from lexspark.functions.weights import bm25_idf, log_tf, smoothed_idf  # noqa: E402
from lexspark.operators.articles import assemble_articles, stem_chunks  # noqa: E402
from lexspark.operators.terms import (  # noqa: E402
    corpus_stats,
    count_terms,
    document_frequency,
    document_lengths,
    stem_vocabulary,
    tokens,
    without_stopwords,
)
from lexspark.operators.topk import sort_by_score, top_k  # noqa: E402
from lexspark.plans.blocks import build_blocks, search_blocks, search_work  # noqa: E402
from lexspark.plans.growth import add_documents, compact  # noqa: E402
from lexspark.plans.indexing import build_index, index_counts, term_counts  # noqa: E402
from lexspark.plans.ranking import (  # noqa: E402
    all_scores,
    query_terms,
    rank_documents,
    score_text,
    search,
    search_many,
    term_scores,
)
from lexspark.plans.tfidf import tfidf  # noqa: E402
from lexspark.session import release, scratch_path, stage  # noqa: E402
from lexspark.sources.index_store import (  # noqa: E402
    SearchIndex,
    dropped_rows,
    export_text,
    import_text,
    malformed_lines,
    read_index,
)
from lexspark.sources.stopwords import read_stopwords  # noqa: E402
from lexspark.sources.tables import table_chunks, table_lines  # noqa: E402
from lexspark.sources.wiki import read_wiki, untitled_lines, wiki_chunks  # noqa: E402

try:
    import corpus_pipeline
    from lexspark.llm import queries as llm_queries
except ImportError:  # these two, or a library that only they use, may be missing
    corpus_pipeline = llm_queries = None

QUERY = oracles.QUERY
RAW_QUERY = oracles.RAW_QUERY


# ---------------------------------------------------------------- inputs


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table, read as it lies."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_chunks(_documents(spark, sf_dir).select("doc_id", "text"), "doc_id", "text")


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_terms(tokens(_chunks(spark, sf_dir)))


def _index(spark: SparkSession, sf_dir: str, **options) -> SearchIndex:
    return build_index(_chunks(spark, sf_dir), scratch_path(spark, "index"), **options)


def _benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return passages.select(F.col("item_id").alias("query_id"), "text")


def _one_query(spark: SparkSession, text: str) -> DataFrame:
    return spark.range(1).select(F.lit(0).alias("query_id"), F.lit(text).alias("text"))


def _wiki_lines(spark: SparkSession, sf_dir: str, compression: str = "none", in_order: bool = True) -> DataFrame:
    """The documents written as wiki text files and read back: a title line, a heading
    line, then the lines of the text.  Without ``in_order`` a document is written where it is read, which shuffles
    nothing; only the documents of a file are in order then."""
    path = scratch_path(spark, "wiki")
    title = F.concat(F.lit("[[Doc "), F.col("doc_id").cast("string"), F.lit("]]"))
    heading = F.concat(F.lit("=="), F.col("source"), F.lit("=="))
    lines = F.concat(F.array(title, heading), F.split("text", "\n"))
    placed = _documents(spark, sf_dir).select("doc_id", F.posexplode(lines).alias("pos", "value"))
    (
        (placed.repartitionByRange("doc_id") if in_order else placed)
        .sortWithinPartitions("doc_id", "pos")
        .select("value")
        .write.option("compression", compression)
        .text(path)
    )
    read = read_wiki(spark, path)
    read.stage_path = path
    return read


def _merged_wiki_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as wiki text in which 300 titles come again and again, with text behind
    their brackets; a body begins with a line of stray marks.  Each fifth document has no title
    and lies in a file without any."""
    path = scratch_path(spark, "wiki")
    number = F.col("doc_id").cast("string")
    title = F.concat(F.lit("[[Doc-"), (F.col("doc_id") % 300).cast("string"), F.lit("]] part "), number)
    odd = F.concat(F.lit("x]] y ==z== w-"), number)
    titled = F.col("doc_id") % 5 > 0
    body = F.concat(F.array(odd), F.split("text", "\n"))
    (
        _documents(spark, sf_dir)
        .select(titled.alias("titled"), "doc_id", F.when(titled, F.concat(F.array(title), body)).otherwise(body).alias("lines"))
        .select("titled", "doc_id", F.posexplode("lines").alias("pos", "value"))
        .repartitionByRange("titled", "doc_id")
        .sortWithinPartitions("titled", "doc_id", "pos")
        .select("titled", "value")
        .write.partitionBy("titled")
        .text(path)
    )
    return read_wiki(spark, path)


# ---------------------------------------------------------------- cleaning, tokens, counts


def clean_lines(spark, sf_dir):
    return table_lines(_documents(spark, sf_dir), "doc_id", "text")


def clean_lines_ascii_first(spark, sf_dir):
    return table_lines(_documents(spark, sf_dir), "doc_id", "text", ascii_first=True)


def tokens_per_doc(spark, sf_dir):
    return document_lengths(_counts(spark, sf_dir)).select("doc", F.col("dl").alias("n_tokens"), "n_terms")


def postings(spark, sf_dir):
    return _counts(spark, sf_dir)


def doc_length(spark, sf_dir):
    return document_lengths(_counts(spark, sf_dir)).select("doc", "dl")


def corpus_statistics(spark, sf_dir):
    stats = corpus_stats(document_lengths(_counts(spark, sf_dir)))
    return stats.select("n_docs", "total_len", F.round("avg_len", 6).alias("avg_len"))


def doc_frequency(spark, sf_dir):
    return document_frequency(_counts(spark, sf_dir))


# ---------------------------------------------------------------- BM25 parts


def idf(spark, sf_dir):
    counts = stage(_counts(spark, sf_dir), "counts")
    n_docs = counts.agg(F.count_distinct("doc").alias("n")).scalar()
    return document_frequency(counts).select(
        "term", "df", F.round(bm25_idf(n_docs, F.col("df")), 6).alias("idf")
    )


def length_coefficient(spark, sf_dir):
    lengths = stage(document_lengths(_counts(spark, sf_dir)), "lengths")
    avg_len = corpus_stats(lengths).select("avg_len").scalar()
    k = weights.length_coefficient(F.col("dl"), avg_len)
    return lengths.select("doc", "dl", F.round(k, 6).alias("k"))


def benchmark_query_terms(spark, sf_dir):
    return query_terms(_benchmark_queries(spark, sf_dir))


def bm25_term_scores(spark, sf_dir):
    scores = term_scores(_index(spark, sf_dir), query_terms(_one_query(spark, QUERY)))
    return scores.select("doc", "term", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- BM25 ranking


def _rounded(scores: DataFrame, *columns: str) -> DataFrame:
    return scores.select(*columns, "doc", F.round("score", 6).alias("score"))


def bm25_all_scores(spark, sf_dir):
    return _rounded(all_scores(_index(spark, sf_dir), QUERY))


def bm25_sorted(spark, sf_dir):
    return _rounded(sort_by_score(all_scores(_index(spark, sf_dir), QUERY)))


def bm25_top10(spark, sf_dir):
    return _rounded(search(_index(spark, sf_dir), QUERY))


def bm25_top10_all(spark, sf_dir):
    return _rounded(search(_index(spark, sf_dir), "the of", matched_only=False))


def bm25_top10_raw_query(spark, sf_dir):
    return _rounded(search(_index(spark, sf_dir), RAW_QUERY, analyse=False))


def bm25_topk_per_query(spark, sf_dir):
    best = search_many(_index(spark, sf_dir), _benchmark_queries(spark, sf_dir), k=10)
    return _rounded(best, "query_id", "rank")


def bm25_ranked(spark, sf_dir):
    """Every document with its place in the order."""
    return _rounded(rank_documents(_index(spark, sf_dir), QUERY), "rank")


def _blocks(spark, sf_dir):
    return build_blocks(_index(spark, sf_dir), scratch_path(spark, "blocks"), range_docs=16)


def bm25_topk_blocks(spark, sf_dir):
    best = search_blocks(_blocks(spark, sf_dir), _benchmark_queries(spark, sf_dir), k=10)
    return _rounded(best, "query_id", "rank")


def bm25_topk_blocks_negative(spark, sf_dir):
    """Queries of words that are in more than half of all documents of some corpora, alone and with others."""
    said = ["the of", "the", "of and the onen", "worthless the", "and of in the to"]
    asked = spark.createDataFrame(list(enumerate(said)), "query_id long, text string")
    return _rounded(search_blocks(_blocks(spark, sf_dir), asked, k=25), "query_id", "rank")


def bm25_blocks_work(spark, sf_dir):
    """How many postings each benchmark query meets; no more than these may be scored."""
    work = search_work(_blocks(spark, sf_dir), _benchmark_queries(spark, sf_dir), k=10)
    return work.select("query_id", "n_matched", (F.col("n_scored") <= F.col("n_matched")).alias("no_more_scored"))


def _grown_index(spark, sf_dir):
    """The documents indexed in three steps: some of them, some cut short and some that are no
    documents; then what is missing and the whole texts; then the strangers are removed."""
    path = scratch_path(spark, "index")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    third = F.col("doc_id") % 3
    cut = F.when(third == 1, F.substring("text", 1, 200)).otherwise(F.col("text"))
    strangers = docs.filter("doc_id % 5 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), "text")
    first = docs.filter(third > 0).withColumn("text", cut).unionByName(strangers)
    build_index(table_chunks(first, "doc_id", "text"), path)
    add_documents(spark, path, table_chunks(docs.filter(third < 2), "doc_id", "text"))
    gone = strangers.select(F.col("doc_id").alias("doc"))
    none = table_chunks(docs.filter("false"), "doc_id", "text")
    return add_documents(spark, path, none, removed=gone), path


def grown_index_top10(spark, sf_dir):
    return _rounded(search(_grown_index(spark, sf_dir)[0], QUERY))


def grown_index_postings(spark, sf_dir):
    return _grown_index(spark, sf_dir)[0].postings.select("doc", "term", "tf", "dl")


def grown_index_terms(spark, sf_dir):
    return _grown_index(spark, sf_dir)[0].term_stats.select("term", "df", F.round("idf", 6).alias("idf"))


def compacted_index_topk(spark, sf_dir):
    index = compact(spark, _grown_index(spark, sf_dir)[1])
    return _rounded(search_many(index, _benchmark_queries(spark, sf_dir), k=10), "query_id", "rank")


def index_roundtrip_top10(spark, sf_dir):
    path = scratch_path(spark, "index")
    build_index(_chunks(spark, sf_dir), path)
    return _rounded(top_k(score_text(read_index(spark, path), QUERY), 10))


def text_roundtrip_top10(spark, sf_dir):
    path = scratch_path(spark, "text")
    export_text(_index(spark, sf_dir), path)
    counts = import_text(spark, path).withColumn("doc", F.col("doc").cast("long"))
    return _rounded(search(index_counts(counts, scratch_path(spark, "index")), QUERY))


def text_roundtrip_postings(spark, sf_dir):
    odd = F.concat(F.lit("d-"), F.col("doc_id").cast("string"), F.lit("\t\\t\n\\"))
    chunks = table_chunks(_documents(spark, sf_dir).select(odd.alias("id"), "text"), "id", "text")
    path = scratch_path(spark, "text")
    export_text(build_index(chunks, scratch_path(spark, "index")), path)
    return import_text(spark, path)


def text_malformed_lines(spark, sf_dir):
    path = scratch_path(spark, "text")
    third = F.pmod("doc_id", F.lit(3))
    line = F.when(third == 0, F.concat_ws("\t", F.lit("a-b"), "doc_id")).when(third == 1, F.concat(F.lit("a-"), "doc_id"))
    lines = _documents(spark, sf_dir).select(F.coalesce(line, F.lit("-x\t1")).alias("value"))
    lines.write.text(f"{path}/counts")
    return malformed_lines(spark, path).groupBy("value").agg(F.count("*").alias("n_lines"))


def wiki_articles_segments(spark, sf_dir):
    """Bodies put together again from small segments."""
    parts = assemble_articles(wiki_chunks(_wiki_lines(spark, sf_dir)), segment_chars=500)
    in_order = F.array_sort(F.collect_list(F.struct("segment", "body")))["body"]
    return parts.groupBy("doc").agg(F.array_join(in_order, " ").alias("body"))


# ---------------------------------------------------------------- stop words, TF-IDF


def stopword_tokens(spark, sf_dir):
    return count_terms(without_stopwords(tokens(_chunks(spark, sf_dir)), read_stopwords(spark)))


def stopword_file_tokens(spark, sf_dir):
    """Without the words of all benchmark items, which are a file of one word per line."""
    path = scratch_path(spark, "stopwords")
    query_terms(_benchmark_queries(spark, sf_dir)).select("term").distinct().write.text(path)
    return count_terms(without_stopwords(tokens(_chunks(spark, sf_dir)), read_stopwords(spark, path)))


def tf_log(spark, sf_dir):
    return stopword_tokens(spark, sf_dir).select("doc", "term", F.round(log_tf(F.col("tf")), 6).alias("log_tf"))


def tfidf_idf(spark, sf_dir):
    counts = stage(_counts(spark, sf_dir), "counts")
    n_docs = counts.agg(F.count_distinct("doc").alias("n")).scalar()
    df = document_frequency(without_stopwords(counts, read_stopwords(spark)))
    return df.select("term", "df", F.round(smoothed_idf(n_docs, F.col("df")), 6).alias("idf"))


def _tfidf(spark, sf_dir, exact):
    weighted = tfidf(_chunks(spark, sf_dir), read_stopwords(spark), exact=exact)
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


def tfidf_weights(spark, sf_dir):
    return _tfidf(spark, sf_dir, exact=False)


def tfidf_exact(spark, sf_dir):
    return _tfidf(spark, sf_dir, exact=True)


# ---------------------------------------------------------------- stemming


def stems(spark, sf_dir):
    return stem_vocabulary(_counts(spark, sf_dir)).select("term", "stem")


def postings_stemmed(spark, sf_dir):
    return term_counts(_chunks(spark, sf_dir), stem=True)


def bm25_top10_stemmed(spark, sf_dir):
    return _rounded(search(_index(spark, sf_dir, stem=True), QUERY, stem=True))


# ---------------------------------------------------------------- wiki text


def wiki_title_carry(spark, sf_dir):
    return wiki_chunks(_wiki_lines(spark, sf_dir, "gzip")).select("doc", "chunk")


def wiki_title_carry_bzip2(spark, sf_dir):
    """The same from compressed files that Spark may split."""
    return wiki_chunks(_wiki_lines(spark, sf_dir, "bzip2")).select("doc", "chunk")


def wiki_articles(spark, sf_dir):
    return assemble_articles(wiki_chunks(_wiki_lines(spark, sf_dir)))


def wiki_articles_stemmed(spark, sf_dir):
    return assemble_articles(stem_chunks(wiki_chunks(_wiki_lines(spark, sf_dir))))


def wiki_postings(spark, sf_dir):
    return term_counts(wiki_chunks(_wiki_lines(spark, sf_dir)), stem=True, count_titles=True)


def wiki_bm25_top10(spark, sf_dir):
    lines = _wiki_lines(spark, sf_dir, in_order=False)
    chunks = wiki_chunks(lines)
    release(lines)  # the chunks are stored
    index = build_index(chunks, scratch_path(spark, "index"), stem=True, count_titles=True, release_chunks=True)
    return _rounded(search(index, QUERY, stem=True))


def wiki_tfidf(spark, sf_dir):
    chunks = wiki_chunks(_wiki_lines(spark, sf_dir), ascii_first=True)
    weighted = tfidf(chunks, read_stopwords(spark), count_titles=True)
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


def wiki_merged_postings(spark, sf_dir):
    return term_counts(wiki_chunks(_merged_wiki_lines(spark, sf_dir)))


def wiki_untitled_lines(spark, sf_dir):
    return untitled_lines(_merged_wiki_lines(spark, sf_dir)).agg(F.sum("n_lines").alias("n_lines"))


def dropped_while_building(spark, sf_dir):
    """What two builds count as left out, without a read of its own: lines of wiki text without a title,
    and malformed lines of text, each line of which is a document's id and number of characters or is not."""
    path = scratch_path(spark, "index")
    untitled = Observation("untitled")
    build_index(wiki_chunks(_merged_wiki_lines(spark, sf_dir), dropped=untitled), path, dropped=untitled)
    text = scratch_path(spark, "text")
    third = F.pmod("doc_id", F.lit(3))
    line = F.when(third == 0, F.concat_ws("\t", F.lit("a-b"), "doc_id")).otherwise(F.concat(F.lit("a-"), "doc_id"))
    _documents(spark, sf_dir).select(line.alias("value")).write.text(f"{text}/counts")
    malformed = Observation("malformed")
    counts = import_text(spark, text, malformed).groupBy("doc", "term").agg(F.sum("tf").alias("tf"))
    index_counts(counts, path, dropped=malformed)
    return dropped_rows(spark, path).select("kind", "n")


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """The ten best documents for a keyword query."""
    return bm25_top10(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Registered queries by name; each takes ``(spark, sf_dir)``."""
    registered = search_queries()
    if llm_queries:
        registered |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return registered


def search_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of everything but the operations on training text."""
    return {
        "clean_lines": clean_lines,
        "clean_lines_ascii_first": clean_lines_ascii_first,
        "tokens_per_doc": tokens_per_doc,
        "postings": postings,
        "doc_length": doc_length,
        "corpus_stats": corpus_statistics,
        "document_frequency": doc_frequency,
        "bm25_idf": idf,
        "length_coefficient": length_coefficient,
        "query_terms": benchmark_query_terms,
        "bm25_term_scores": bm25_term_scores,
        "bm25_all_scores": bm25_all_scores,
        "bm25_sorted": bm25_sorted,
        "bm25_top10": bm25_top10,
        "bm25_top10_all": bm25_top10_all,
        "bm25_top10_raw_query": bm25_top10_raw_query,
        "bm25_topk_per_query": bm25_topk_per_query,
        "bm25_ranked": bm25_ranked,
        "bm25_topk_blocks": bm25_topk_blocks,
        "bm25_topk_blocks_negative": bm25_topk_blocks_negative,
        "bm25_blocks_work": bm25_blocks_work,
        "grown_index_top10": grown_index_top10,
        "grown_index_postings": grown_index_postings,
        "grown_index_terms": grown_index_terms,
        "compacted_index_topk": compacted_index_topk,
        "index_roundtrip_top10": index_roundtrip_top10,
        "text_roundtrip_top10": text_roundtrip_top10,
        "text_roundtrip_postings": text_roundtrip_postings,
        "text_malformed_lines": text_malformed_lines,
        "stopword_tokens": stopword_tokens,
        "stopword_file_tokens": stopword_file_tokens,
        "tf_log": tf_log,
        "tfidf_idf": tfidf_idf,
        "tfidf": tfidf_weights,
        "tfidf_exact": tfidf_exact,
        "stem_vocabulary": stems,
        "postings_stemmed": postings_stemmed,
        "bm25_top10_stemmed": bm25_top10_stemmed,
        "wiki_title_carry": wiki_title_carry,
        "wiki_title_carry_bzip2": wiki_title_carry_bzip2,
        "wiki_articles": wiki_articles,
        "wiki_articles_stemmed": wiki_articles_stemmed,
        "wiki_articles_segments": wiki_articles_segments,
        "wiki_postings": wiki_postings,
        "wiki_bm25_top10": wiki_bm25_top10,
        "wiki_tfidf": wiki_tfidf,
        "wiki_merged_postings": wiki_merged_postings,
        "wiki_untitled_lines": wiki_untitled_lines,
        "dropped_while_building": dropped_while_building,
    }


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the same tables, by the same names, where SQL can say it."""
    return oracles.oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})
