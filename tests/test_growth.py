"""An index grown by additions against one built at once."""

import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexspark import add_documents, build_index, compact, drop_old_versions, read_index, search, table_chunks
from lexspark.plans.growth import add_counts_of
from lexspark.sources.index_store import segments

WORDS = "the of cat dog running house light link relational zebra".split()
TABLES = ("postings", "doc_lengths", "term_stats", "corpus_stats")


def texts_of(seed, ids):
    pick = random.Random(seed)
    return {i: " ".join(pick.choices(WORDS, range(len(WORDS), 0, -1), k=pick.randrange(1, 30))) for i in ids}


def chunks(spark, texts):
    return table_chunks(spark.createDataFrame(list(texts.items()), "id long, text string"), "id", "text")


def rows(index):
    out = {}
    for name in TABLES:
        df = getattr(index, name)
        if "idf" in df.columns:
            df = df.withColumn("idf", F.round("idf", 12))
        out[name] = sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)
    return out


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """An index of three segments; the last test of this file compacts it."""
    path = str(tmp_path_factory.mktemp("growth") / "grown")
    texts = texts_of(1, range(60))
    build_index(chunks(spark, texts), path, buckets=4)
    later = texts_of(2, [*range(50, 90), 3, 4])
    add_documents(spark, path, chunks(spark, later))
    texts |= later
    again = texts_of(3, [3, 55, 200])
    gone = [0, 55, 70, 999]
    add_documents(spark, path, chunks(spark, again), removed=spark.createDataFrame([(i,) for i in gone], "doc int"))
    texts = {i: t for i, t in texts.items() if i not in gone} | again
    return path, texts


def test_grown_index_equals_one_built_at_once(spark, grown, tmp_path):
    path, texts = grown
    whole = build_index(chunks(spark, texts), str(tmp_path / "whole"), buckets=4)
    index = read_index(spark, path)
    assert len(segments(spark, path)) == 3 and index.buckets == 4
    assert rows(index) == rows(whole)
    for query in ("zebra dog", "relational of the"):
        assert list(map(tuple, search(index, query).collect())) == list(map(tuple, search(whole, query).collect()))


def test_documents_without_a_token(spark, tmp_path):
    path = str(tmp_path)
    build_index(chunks(spark, {1: "cat", 2: "...", 3: "dog"}), path, keep_empty=True)
    index = add_documents(spark, path, chunks(spark, {3: "!", 4: "?"}), keep_empty=True)
    assert sorted((r.doc, r.dl) for r in index.doc_lengths.collect()) == [(1, 1), (2, 0), (3, 0), (4, 0)]
    assert index.corpus_stats.first()[:2] == (4, 1)
    assert [r.term for r in index.term_stats.collect()] == ["cat"]
    assert rows(compact(spark, path))["doc_lengths"] == rows(index)["doc_lengths"]


def test_all_documents_removed(spark, tmp_path):
    path = str(tmp_path)
    built = build_index(chunks(spark, texts_of(4, range(5))), path)
    index = add_documents(spark, path, chunks(spark, {9: "x"}).filter("false"), removed=built.doc_lengths.select("doc"))
    assert index.postings.isEmpty() and index.term_stats.isEmpty() and index.corpus_stats.first().n_docs == 0
    assert search(index, "the").isEmpty()


def test_a_failed_addition_leaves_the_index_as_it_was(spark, grown):
    path, _ = grown
    before = rows(read_index(spark, path))
    broken = read_index(spark, path).postings.select(
        "doc", "term", F.when(F.col("doc") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("tf")).cast("long").alias("tf")
    )
    with pytest.raises(PySparkException, match="lost"):
        add_counts_of(spark, path, broken)
    assert rows(read_index(spark, path)) == before


def test_the_last_number_counts_whatever_the_clocks_say(spark, grown):
    path, _ = grown
    published = spark.read.parquet(f"{path}/published").orderBy("number").collect()
    assert [r.number for r in published] == [1, 2, 3] and published[-1].segments == list(segments(spark, path))


def test_compaction_and_clean_up(spark, grown):
    path, texts = grown
    before = rows(read_index(spark, path))
    assert rows(compact(spark, path)) == before
    drop_old_versions(spark, path)
    assert len(list(Path(path).glob("version-*"))) == len(segments(spark, path)) == 1
    assert rows(read_index(spark, path)) == before
    add_documents(spark, path, chunks(spark, {500: "zebra"}))
    drop_old_versions(spark, path)
    assert read_index(spark, path).corpus_stats.first().n_docs == len(texts) + 1
