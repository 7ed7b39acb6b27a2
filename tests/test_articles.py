"""Stemmed lines and article bodies: what moves, and the same text however words and documents are dealt."""

import random

import pytest
from pyspark.sql import functions as F

from lexspark.functions.porter import with_stem
from lexspark.operators import stems
from lexspark.operators.articles import assemble_articles, stem_chunks

WORDS = ["", "the", "running", "dogs", "relational", "zebras", "w" * 70 + "ing", "cat"]


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.fixture(scope="module")
def lines(spark):
    pick = random.Random(5)
    rows = [(f"d{i % 9}", "f", 0, i, " ".join(pick.choices(WORDS, k=pick.randrange(1, 12)))) for i in range(90)]
    rows += [("d1", "f", 0, 200, None), ("d2", "f", 0, 201, ""), ("e", "f", 0, 202, ""), ("e", "f", 0, 203, ""), (None, "f", 0, 204, "dogs")]
    rows += [("x", "f", 0, 205, ""), ("x", "f", 0, 206, "dogs"), ("x", "f", 0, 207, ""), ("x", "f", 0, 208, "cat")]
    return spark.createDataFrame(rows, "doc string, file string, block_start int, line_id long, chunk string")


@pytest.mark.parametrize("share", [1, 7, 10**6])
def test_stems_of_common_and_rare_words(spark, lines, monkeypatch, share):
    monkeypatch.setattr(stems, "COMMON_SHARE", share)
    known = dict(with_stem(spark.createDataFrame([(w,) for w in WORDS], "term string"), "term", "stem").collect())
    want = [(*r[:4], " ".join(known[w] for w in r.chunk.split(" "))) for r in lines.collect() if r.chunk is not None]
    got = [tuple(r) for r in stem_chunks(lines).collect()]
    assert sorted(got, key=lambda r: r[3]) == want


def test_words_are_put_together_where_they_are_cut(lines):
    """No row of a word is shuffled but those of rare words: the text itself is dealt by line."""
    text = plan(stem_chunks(lines)).splitlines()
    assert all("__share" in x for x in text if "Exchange hashpartitioning(term" in x)
    by_line = [x for x in text if "Exchange hashpartitioning(__line" in x]
    assert by_line and all("REPARTITION_BY_NUM" in x for x in by_line)
    assert any("BroadcastHashJoin [term" in x for x in text)


@pytest.mark.parametrize("segment_chars", [10, 40, 10**6])
def test_bodies_of_short_and_long_documents(lines, segment_chars):
    lines = lines.filter("chunk is not null")
    got = {}
    for r in sorted(assemble_articles(lines, segment_chars).collect(), key=lambda r: (r.doc, r.segment)):
        got.setdefault(r.doc, []).append(r.body)
    want = {}
    for r in sorted(lines.collect(), key=lambda r: r.line_id):
        if r.doc is not None:
            body = want.setdefault(r.doc, [])
            if body or r.chunk:
                body.append(r.chunk)
    assert {d: " ".join(b) for d, b in got.items()} == {d: " ".join(b) for d, b in want.items()}
    if segment_chars == 10**6:
        assert all(len(b) == 1 for b in got.values())


def test_lines_of_short_documents_move_once(lines):
    text = plan(assemble_articles(lines))
    assert "Window" not in text and text.count("Exchange hashpartitioning(doc") <= 2  # the lines, and ids of long documents
