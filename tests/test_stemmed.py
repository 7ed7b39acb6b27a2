"""Stemmed counts: only rare words move to their stems, and a document's length comes with it."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexspark import table_chunks
from lexspark.functions.porter import with_stem
from lexspark.operators import stems, terms
from lexspark.plans.indexing import packed_counts
from lexspark.session import stage

TEXTS = ["running runs run dogs dog", "the the cats", None, "", "...", "relational " * 5 + "w" * 70 + "s", "zebra zebras Dog dogs"]


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.fixture(scope="module")
def rows(spark):
    ids = [0, 1, 2, 3, 4, 5, 6, 1, None, None]
    return spark.createDataFrame([(d, TEXTS[i % len(TEXTS)]) for i, d in enumerate(ids)], "id long, text string")


@pytest.mark.parametrize("share", [1, 4, 10**6])
@pytest.mark.parametrize("keep_empty", [False, True])
def test_stemmed_counts(spark, rows, monkeypatch, share, keep_empty):
    monkeypatch.setattr(stems, "COMMON_SHARE", share)
    want, lengths = Counter(), Counter()
    words = [tuple(r) for r in terms.tokens(table_chunks(rows, "id", "text"), keep_empty).collect()]
    stem = dict(with_stem(spark.createDataFrame([(w,) for w in {w for _, w in words if w}], "term string"), "term", "stem").collect())
    for doc, word in words:
        want[doc, stem.get(word)] += word is not None
        lengths[doc] += word is not None
    packed = packed_counts(table_chunks(rows, "id", "text"), stem=True, keep_empty=keep_empty)
    got = packed.select("doc", "dl", F.explode("terms").alias("e")).select("doc", "e.term", "e.tf", "dl").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((d, t, n, lengths[d])) for (d, t), n in want.items())


def test_only_rare_terms_move_to_their_stems(rows):
    packed = stage(terms.document_counts(table_chunks(rows, "id", "text")), "packed")
    text = plan(terms.stem_packed(packed))
    assert "Window" not in text and "BroadcastHashJoin [term" in text
    for x in text.splitlines():
        assert "Exchange hashpartitioning(term" not in x or "__share" in x
