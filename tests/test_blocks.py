"""Block-wise search against scoring everything, on queries of all kinds of weights."""

import random

import pytest
from pyspark.sql import functions as F

from lexspark import build_blocks, build_index, read_blocks, search_blocks, search_many, search_work, table_chunks
from lexspark.functions.weights import exact_sum
from lexspark.operators.ranks import number_rows
from lexspark.plans import blocks, ranking


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    pick = random.Random(11)
    words = ["the", "of", *(f"w{i}" for i in range(60))]
    weights = [60, 30, *(40 / (i + 1) for i in range(60))]
    texts = [(i, " ".join(pick.choices(words, weights, k=pick.choice([1, 3, 10, 40])))) for i in range(600)]
    texts += [(1000 + i, "same words w50 w51") for i in range(30)]  # ties
    docs = spark.createDataFrame(texts, "id long, text string")
    return build_index(table_chunks(docs, "id", "text"), str(tmp_path_factory.mktemp("index")), buckets=8)


@pytest.fixture(scope="module")
def queries(spark):
    pick = random.Random(12)
    rows = [(0, "the"), (1, "the of"), (2, "the w59"), (3, "nothing at all"), (4, ""), (5, "same"), (6, "w50 w51 words"), (7, "the same of")]
    rows += [(10 + i, " ".join(pick.choices(["the", "of", *(f"w{j}" for j in range(60))], k=pick.randrange(1, 12)))) for i in range(40)]
    return spark.createDataFrame(rows, "query_id long, text string")


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.doc, r.score) for r in df.collect())


@pytest.mark.parametrize("range_docs, k", [(1, 1), (7, 10), (10_000, 3)])
def test_same_rows_as_scoring_everything(index, queries, tmp_path, range_docs, k):
    blocked = build_blocks(index, str(tmp_path), range_docs=range_docs)
    assert rows_of(search_blocks(blocked, queries, k)) == rows_of(search_many(index, queries, k))


def test_joins_in_shares_give_the_same_rows(spark, index, queries, tmp_path, monkeypatch):
    build_blocks(index, str(tmp_path), range_docs=16)
    blocked = read_blocks(spark, str(tmp_path), index)
    want = rows_of(search_blocks(blocked, queries, 5))
    monkeypatch.setattr(blocks, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 0)
    assert rows_of(search_blocks(blocked, queries, 5)) == want == rows_of(search_many(index, queries, 5))
    monkeypatch.setattr(ranking, "FILTER_TERMS", 0)
    assert rows_of(search_blocks(blocked, queries, 5)) == want


def test_blocks_hold_all_postings_and_their_bounds(index, tmp_path):
    blocked = build_blocks(index, str(tmp_path), range_docs=16).blocks
    flat = blocked.select("term", "n", F.explode("postings").alias("p")).select("term", "p.*")
    assert flat.exceptAll(index.postings.select("term", "doc", "tf", "dl")).isEmpty()
    assert flat.count() == index.postings.count() == blocked.agg(F.sum("n")).first()[0]
    assert blocked.filter("n > 16 or n <> size(postings) or least > greatest").isEmpty()


def test_folders_are_pruned_while_the_query_runs(spark, index, queries, tmp_path):
    blocked = build_blocks(index, str(tmp_path), range_docs=16)
    weighted = ranking.asked_terms(index, ranking.query_terms(queries))
    plan = blocks._bounds(blocked, weighted)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "greatest" in line)
    assert "dynamicpruning" in scan and "postings" not in scan.split("ReadSchema")[1]


def test_most_postings_of_a_selective_query_are_not_scored(spark, index, tmp_path):
    blocked = build_blocks(index, str(tmp_path), range_docs=4)
    asked = spark.createDataFrame([(0, "the of w0 same words w50 w51")], "query_id long, text string")
    work = search_work(blocked, asked, 5).first()
    assert work.n_scored * 3 < work.n_matched


def test_empty_queries_and_empty_index(spark, index, queries, tmp_path):
    blocked = build_blocks(index, str(tmp_path / "a"))
    assert search_blocks(blocked, queries.filter("false")).isEmpty()
    none = build_index(table_chunks(spark.createDataFrame([], "id long, text string"), "id", "text"), str(tmp_path / "b"))
    assert search_blocks(build_blocks(none, str(tmp_path / "c")), queries).isEmpty()


@pytest.mark.parametrize("partitions", [1, 5])
def test_numbers_follow_the_order(spark, partitions):
    values = random.Random(3).sample(range(10_000), 500)
    rows = spark.createDataFrame([(v, v % 7) for v in values], "v int, w int").repartition(partitions)
    got = number_rows(rows, [F.col("w").desc(), F.col("v")], "place").collect()
    want = {v: i for i, v in enumerate(sorted(values, key=lambda v: (-(v % 7), v)), 1)}
    assert {r.v: r.place for r in got} == want
    assert number_rows(rows.filter("false"), ["v"], "place").isEmpty()


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    pick = random.Random(5)
    values = [pick.uniform(-30, 30) * 10 ** pick.randrange(-9, 1) for _ in range(4000)]
    rows = [(i % 3, v) for i, v in enumerate(values)]

    def sums(rows, partitions):
        df = spark.createDataFrame(rows, "k int, score double").repartition(partitions)
        return dict(map(tuple, df.groupBy("k").agg(exact_sum(F.col("score"))).collect()))

    first = sums(rows, 1)
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        assert sums(shuffled, 2 + 3 * seed) == first
    assert all(abs(first[k] - sum(v for j, v in rows if j == k)) < 1e-9 for k in first)
