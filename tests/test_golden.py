"""The worked corpus: every table and four queries."""

import pytest
from pyspark.sql import functions as F

from lexspark import all_scores, export_text, import_text, read_index, read_wiki, search, search_many, wiki_chunks
from lexspark.operators.articles import assemble_articles, stem_chunks
from lexspark.operators.topk import sort_by_score
from lexspark.plans.indexing import index_counts

ALPHA, BETA, GAMMA, DELTA, EPSILON = "[[Alpha Dog]]", "[[Beta]]", "[[Gamma]]", "[[Delta]]", "[[Epsilon]]"


def as_dict(df, key, value, digits=6):
    rows = df.select(key, value).collect()
    return {row[0]: round(row[1], digits) if isinstance(row[1], float) else row[1] for row in rows}


def test_articles(spark, corpus_path):
    chunks = stem_chunks(wiki_chunks(read_wiki(spark, corpus_path)))
    assert as_dict(assemble_articles(chunks), "doc", "body") == {
        ALPHA: "run dog  run cat the state of the art dog",
        BETA: "cat see [[file the cat sleep",
        GAMMA: "noth relev here",
        DELTA: "bird fly",
        EPSILON: "bird sing",
    }


def test_segments_put_together_are_the_article(spark, corpus_path):
    chunks = wiki_chunks(read_wiki(spark, corpus_path))
    whole = as_dict(assemble_articles(chunks), "doc", "body")
    pieces = assemble_articles(chunks, segment_chars=10)
    assert pieces.filter("segment > 0").count() > 0
    for doc, body in whole.items():
        rows = pieces.filter(F.col("doc") == doc).orderBy("segment").collect()
        assert " ".join(row.body for row in rows) == body


def test_lengths_and_coefficients(corpus_index):
    assert as_dict(corpus_index.length_coefficients(), "doc", "k") == {
        ALPHA: 2.702586, BETA: 1.732759, GAMMA: 1.150862, DELTA: 0.956897, EPSILON: 0.956897,
    }
    assert as_dict(corpus_index.doc_lengths, "doc", "dl") == {ALPHA: 12, BETA: 7, GAMMA: 4, DELTA: 3, EPSILON: 3}
    stats = corpus_index.corpus_stats.first()
    assert (stats.n_docs, stats.total_len, round(stats.avg_len, 6)) == (5, 29, 5.8)


def test_postings(corpus_index):
    assert as_dict(corpus_index.postings.filter(F.col("doc") == ALPHA), "term", "tf") == {
        "run": 2, "dog": 2, "the": 2, "[[Alpha": 1, "Dog]]": 1, "cat": 1, "state": 1, "of": 1, "art": 1,
    }
    assert as_dict(corpus_index.postings.filter(F.col("doc") == BETA), "term", "tf") == {
        "cat": 2, "[[Beta]]": 1, "see": 1, "[[file": 1, "the": 1, "sleep": 1,
    }


def test_idf(corpus_index):
    idf = as_dict(corpus_index.term_stats, "term", "idf")
    assert all(idf[term] == 0.477121 for term in ("dog", "run", "[[Alpha", "[[file"))
    assert idf["cat"] == idf["bird"] == 0.146128


@pytest.mark.parametrize(
    "text, options, expected",
    [
        ("cat dog", {}, {ALPHA: 0.605963, BETA: 0.195737}),
        ("cats dogs", {"stem": True}, {ALPHA: 0.605963, BETA: 0.195737}),
        ("cat dog cat DOG!", {}, {ALPHA: 0.605963, BETA: 0.195737}),
        ("cats dogs", {"analyse": False}, {}),
        ("bird", {}, {DELTA: 0.186683, EPSILON: 0.186683}),
        ("zzz", {}, {}),
    ],
)
def test_scores(corpus_index, text, options, expected):
    zeros = dict.fromkeys((ALPHA, BETA, GAMMA, DELTA, EPSILON), 0.0)
    assert as_dict(all_scores(corpus_index, text, **options), "doc", "score") == zeros | expected
    best = [row.doc for row in search(corpus_index, text, k=10, **options).collect()]
    assert best == sorted(expected, key=lambda doc: (-expected[doc], doc))


def test_top_k_is_a_prefix_of_the_sorted_scores(corpus_index):
    scores = all_scores(corpus_index, "cat bird")
    ordered = [row.doc for row in sort_by_score(scores).collect()]
    for k in range(1, 6):
        assert [row.doc for row in search(corpus_index, "cat bird", k, matched_only=False).collect()] == ordered[:k]


def test_query_table_equals_single_queries(spark, corpus_index):
    texts = {1: "cats dogs", 2: "bird", 3: "zzz", 4: "the cat"}
    queries = spark.createDataFrame(list(texts.items()), "query_id int, text string")
    many = search_many(corpus_index, queries, 3, stem=True).collect()
    for query_id, text in texts.items():
        ranked = sorted((row.rank, row.doc) for row in many if row.query_id == query_id)
        assert [doc for _, doc in ranked] == [r.doc for r in search(corpus_index, text, 3, stem=True).collect()]


def test_query_table_beyond_the_group_limit(spark, corpus_index):
    queries = spark.createDataFrame([(1, "cat dog"), (2, "bird")], "query_id int, text string")
    rows = search_many(corpus_index, queries, 5000).collect()
    assert {(r.query_id, r.rank, r.doc) for r in rows} == {(1, 1, ALPHA), (1, 2, BETA), (2, 1, DELTA), (2, 2, EPSILON)}


def test_many_distinct_terms_take_the_join(spark, corpus_index):
    filler = " ".join(f"w{i}" for i in range(300))
    queries = spark.createDataFrame([(1, f"cat dog {filler}")], "query_id int, text string")
    scores = {row.doc: round(row.score, 6) for row in search_many(corpus_index, queries).collect()}
    assert scores == {ALPHA: 0.605963, BETA: 0.195737}
    text_scores = {r.doc: round(r.score, 6) for r in search(corpus_index, f"cat dog {filler}").collect()}
    assert text_scores == scores


def test_text_form_reads_back(spark, corpus_index, tmp_path):
    export_text(corpus_index, str(tmp_path / "text"))
    counts = import_text(spark, str(tmp_path / "text"))
    assert sorted(counts.collect()) == sorted(corpus_index.postings.select("doc", "term", "tf").collect())
    again = index_counts(counts, str(tmp_path / "index"))
    best = search(read_index(spark, str(tmp_path / "index")), "cat dog").collect()
    assert best == search(again, "cat dog").collect() == search(corpus_index, "cat dog").collect()


def test_import_skips_malformed_lines(spark, tmp_path):
    (tmp_path / "counts").mkdir()
    (tmp_path / "counts" / "part").write_text("cat-[[A]]\t2\nbroken\ncat-[[B]]\tx\n\na-b\t1\t2\ndog-[[A=1]]\t3\n")
    assert sorted(import_text(spark, str(tmp_path)).collect()) == [("[[A=1]]", "dog", 3), ("[[A]]", "cat", 2)]
