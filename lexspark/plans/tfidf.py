"""TF-IDF weights with stop words removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.weights import log_tf, smoothed_idf
from lexspark.operators.skew import join_per_key
from lexspark.operators.terms import (
    add_counts,
    by_document,
    by_title_key,
    count_terms,
    counts_by_title,
    document_frequency,
    title_counts,
    title_texts,
    titled_counts_without,
    tokens,
    without_stopwords,
)
from lexspark.session import stage


def tfidf(
    chunks: DataFrame,
    stopwords: DataFrame,
    *,
    count_titles: bool = False,
    keep_empty: bool = False,
    exact: bool = False,
) -> DataFrame:
    """``(term, doc, tf, df, tfidf)`` of ``chunks(doc, chunk)``.

    Stop words are taken out of the counts, not of the tokens: the counts are fewer.  A
    document that only has stop words still counts in N.  ``exact`` divides N by the document
    frequency as real numbers.
    """
    if count_titles and "line_id" in chunks.columns:
        counts = kept = stage(titled_counts_without(title_texts(chunks), stopwords), "tfidf_counts")
    elif count_titles:
        counts = stage(counts_by_title(chunks), "tfidf_raw_counts")
        body = without_stopwords(counts, stopwords)
        kept = stage(add_counts(by_title_key(body), by_title_key(title_counts(counts))), "tfidf_counts")
        counts = kept
    else:
        counts = stage(count_terms(tokens(by_document(chunks), keep_empty)), "tfidf_counts")
        kept = without_stopwords(counts, stopwords)
    n_docs = counts.agg(F.count_distinct("doc").alias("n")).scalar()
    df = document_frequency(kept)
    weighted = df.select(
        "term", "df", smoothed_idf(n_docs, F.col("df"), exact).alias("idf"), F.col("df").alias("n_rows")
    )
    weighted = stage(weighted, "tfidf_weights")
    return join_per_key(kept, weighted, "term", "n_rows").select(
        "term", "doc", "tf", "df", (log_tf(F.col("tf")) * F.col("idf")).alias("tfidf")
    )
