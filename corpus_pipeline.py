"""A corpus made ready for training: five stages, each over all documents that the one before kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.

Rows without doc_id pass the near-duplicate stage; the others go by the text and treat them like
any row.  Rows that repeat a doc_id stay or go together.  Null and empty texts are kept by every
stage.  Empty tables give empty tables.  Further columns of ``documents`` are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import decontamination, minhash, queries, surrogates, toxicity, word_bpe
from lexspark.session import remove, scope, scratch_path, store

ORACLE_SQL = None  # a trained net, signatures and keyed hashes have no SQL; see tests/llm/test_llm.py


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language."""
    return toxicity.without_flagged(docs, queries.toxicity_net(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group: five words, similarity of 0.8 or more."""
    copies = minhash.near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(F.xxhash64("text").alias("key"), "text")
    leaking = decontamination.find_leaks(keyed, items, id="key").select("doc_id").distinct()
    return docs.join(leaking, F.xxhash64(docs["text"]) == leaking["doc_id"], "left_anti")


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, private data replaced by surrogates; ``n_chars`` is that of the new text."""
    replaced = surrogates.replace_entities(docs, queries.SURROGATE_KEY)
    n_chars = F.when(F.col("n_replaced") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", n_chars).select(docs.columns)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return word_bpe.digests(word_bpe.round_trip(docs, queries.WORD_BPE))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("private_data", replace_private_data),
    ("bpe", encode_and_decode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  Of each stage only its result is kept, until the next one's is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES:
        path = scratch_path(spark, name)
        with scope(spark):
            docs = store(function(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return docs
