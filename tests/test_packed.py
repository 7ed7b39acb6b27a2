"""Counts kept as arrays, and blocks cut from sorted rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexspark import build_blocks, build_index, search_blocks, table_chunks
from lexspark.operators import terms

TEXTS = ["dog Dog cat]] ==gone== the-dog", "", None, "...", "x", "]] a]]b ab", "K İ kelvin", "the the the\nthe ==a b\nc== [[the"]


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(3)
    texts = TEXTS + [" ".join(pick.choices(["the", "Of", "w1", "w2", "[[w3", "w4]]", "-"], k=pick.randrange(30))) for _ in range(60)]
    ids = [*range(len(texts)), 3, 3, 5, None, None]
    return spark.createDataFrame([(d, texts[i % len(texts)]) for i, d in enumerate(ids)], "id long, text string")


@pytest.mark.parametrize("keep_empty", [False, True])
def test_packed_counts_are_those_of_tokens(rows, keep_empty):
    chunks = table_chunks(rows, "id", "text")
    want = terms.with_document_length(terms.count_terms(terms.tokens(chunks, keep_empty)))
    packed = terms.document_counts(chunks, keep_empty).select("doc", "dl", F.explode_outer("terms").alias("e"))
    got = packed.filter(F.col("e").isNotNull()).select("doc", "e.term", "e.tf", "dl")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select("doc", "term", "tf", "dl").collect()))


def test_documents_are_counted_without_a_shuffle(rows):
    physical = plan(terms.packed_texts(table_chunks(rows, "id", "text")))
    assert "Exchange" not in physical and "Aggregate" not in physical


def test_postings_and_blocks_are_dealt_in_one_pass(spark, rows, tmp_path, monkeypatch):
    from lexspark.plans import blocks, indexing

    monkeypatch.setattr(indexing, "TASK_POSTINGS", 5)
    stored = []

    def seen(keep):
        def store(df, path, by=()):
            if by:
                stored.append(plan(df))
            return keep(df, path, by)

        return store

    monkeypatch.setattr(indexing, "store", seen(indexing.store))
    monkeypatch.setattr(blocks, "store", seen(blocks.store))
    index = build_index(table_chunks(rows, "id", "text"), str(tmp_path / "index"), buckets=3)
    blocked = build_blocks(index, str(tmp_path / "blocks"))
    assert len(stored) == 2 and all("rangepartitioning" not in p for p in stored)
    assert "ObjectHashAggregate" not in stored[1] and "SortAggregate" in stored[1]
    assert spark.conf.get("spark.sql.execution.replaceHashWithSortAgg", "false") == "false"
    asked = spark.createDataFrame([(0, "the of w1"), (1, "w2 the")], "query_id long, text string")
    physical = plan(search_blocks(blocked, asked, 3))
    assert "hashpartitioning(range" in physical and "hashpartitioning(query_id#" in physical
    assert not any("hashpartitioning(query_id" in x and "doc" in x.split("hashpartitioning")[1].split(")")[0] for x in physical.splitlines())


def test_wiki_words_are_counted_in_rows(spark, tmp_path, monkeypatch):
    """Titles that come once, that come again, and that span many parts; words of title and body that meet."""
    from lexspark import read_wiki, tfidf, wiki_chunks
    from lexspark.plans.indexing import term_counts

    pick = random.Random(4)
    words = ["the", "dog", "w1", "Cat", "a]]b", "[[x", "of"]
    lines = []
    for i in range(80):
        lines.append(f"[[T{i % 50}]] the w1 the z\x00 part" + " again" * (i % 3))
        lines += [" ".join(pick.choices(words, k=pick.randrange(1, 9))) for _ in range(pick.randrange(6))]
    (tmp_path / "w.txt").write_text("\n".join(lines))
    chunks = wiki_chunks(read_wiki(spark, str(tmp_path)))
    flat = chunks.drop("line_id", "file", "block_start")  # goes the way of rows of any chunks
    listed = spark.createDataFrame([("the",), ("dog",)], "word string")

    def rows(df):
        return Counter(map(tuple, df.collect()))

    for bits in (1, 12):
        monkeypatch.setattr(terms, "PART_BITS", bits)
        for stem in (False, True):
            got = rows(term_counts(chunks, stem=stem).select("doc", "term", "tf"))
            assert got == rows(term_counts(flat, stem=stem).select("doc", "term", "tf")) and len(got) > 100
        assert rows(tfidf(chunks, listed, count_titles=True)) == rows(tfidf(flat, listed, count_titles=True))
