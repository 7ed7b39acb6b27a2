"""Invariants, skew and the shape of plans."""

import bz2
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexspark import add_documents, build_blocks, build_index, read_index, read_wiki, search, search_many, table_chunks, tfidf, untitled_lines, wiki_chunks
from lexspark.functions.porter import with_stem
from lexspark.operators import skew, terms, topk
from lexspark.operators.articles import stem_chunks
from lexspark.plans import ranking
from lexspark.plans.indexing import index_counts
from lexspark.plans.ranking import score_text
from lexspark.session import SCRATCH_SETTING, scope, scratch_dir, stage, subfolders
from lexspark.sources.index_store import drop_old_versions
from lexspark.sources.stopwords import read_stopwords

WORDS = "the of cat dog running house light [[link relational zebra".split()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    weights = [40, 20, 8, 6, 5, 4, 3, 2, 2, 1]
    return {i: " ".join(rng.choices(WORDS, weights, k=rng.randint(1, 40))) for i in range(120)}


@pytest.fixture(scope="module")
def documents(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id long, text string")


@pytest.fixture(scope="module")
def index(spark, documents, tmp_path_factory):
    return build_index(table_chunks(documents, "id", "text"), str(tmp_path_factory.mktemp("plans")))


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scores_against_brute_force(index, texts):
    counts = {d: Counter(t.split()) for d, t in texts.items()}
    df = Counter(w for c in counts.values() for w in c)
    n, avg = len(texts), sum(sum(c.values()) for c in counts.values()) / len(texts)
    want = {}
    for d, c in counts.items():
        dl = sum(c.values())
        hits = [
            2.5 * c[w] * math.log10((n - df[w] + 0.5) / (df[w] + 0.5)) / (c[w] + 0.375 + 1.125 * dl / avg)
            for w in ("the", "zebra", "dog")
            if w in c
        ]
        if hits:
            want[d] = round(sum(hits), 9)
    got = {r.doc: round(r.score, 9) for r in score_text(index, "zebra the dog the").collect()}
    assert got == pytest.approx(want)


def test_invariants(index):
    totals = index.postings.groupBy("doc").agg(F.sum("tf").alias("s"), F.count("*").alias("c"))
    joined = totals.join(index.doc_lengths, "doc")
    assert joined.count() == index.doc_lengths.count()
    assert joined.filter("s <> dl or c <> n_terms").count() == 0
    stats = index.corpus_stats.first()
    assert index.postings.agg(F.sum("tf")).first()[0] == stats.total_len
    assert index.term_stats.filter(F.col("df") > stats.n_docs).count() == 0
    assert index.postings.groupBy("term", "doc").count().filter("count > 1").count() == 0


def test_input_order_does_not_matter(index, documents, tmp_path):
    shuffled = documents.orderBy(F.xxhash64("id")).repartition(9)
    again = build_index(table_chunks(shuffled, "id", "text"), str(tmp_path))
    for name in ("postings", "doc_lengths", "term_stats", "corpus_stats"):
        a, b = getattr(index, name), getattr(again, name)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("share", [1, 3, 20, 41, 10**6])
def test_join_per_key_is_an_inner_join(spark, monkeypatch, share):
    monkeypatch.setattr(skew, "HOT_SHARE", share)
    rows = [("hot", i) for i in range(300)] + [(f"k{i % 40}", i) for i in range(200)] + [("x" * 500, 1)] * 90
    facts = spark.createDataFrame(rows, "k string, v int")
    keys = facts.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m")).filter("k <> 'k3'")
    got = skew.join_per_key(facts, keys, "k", "n")
    want = facts.join(keys.drop("n"), "k")
    assert sorted(map(tuple, got.select("k", "v", "m").collect())) == sorted(map(tuple, want.select("k", "v", "m").collect()))


def test_search_reads_only_its_terms_and_shuffles_once(index):
    text = plan(search(index, "zebra dog"))
    scans = [line for line in text.splitlines() if "PushedFilters" in line and "tf" in line]
    assert scans and all("EqualTo(term,zebra)" in line for line in scans)
    assert all("PartitionFilters: [isnotnull(bucket" in line or "PartitionFilters: [bucket" in line for line in scans)
    physical = text.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def test_many_terms_read_their_buckets_and_are_dealt_in_shares(spark, documents, tmp_path, monkeypatch):
    index = build_index(table_chunks(documents, "id", "text"), str(tmp_path), buckets=64)
    words = [f"w{i}" for i in range(190)]
    few = plan(score_text(index, "zebra " + " ".join(words))).split("== Physical Plan ==")[1]
    assert "PartitionFilters: [bucket" in few and "EqualTo(term,w1)" in few  # the rest is cut off in print
    queries = spark.createDataFrame([(0, "zebra"), (1, "cat dog " + " ".join(words))], "query_id int, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # whether terms or only their hashes are broadcast, folders are pruned by what turns up in them
    for most in (ranking.BROADCAST_ROWS, 0):
        monkeypatch.setattr(ranking, "BROADCAST_ROWS", most)
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            physical = plan(search_many(index, queries)).split("== Physical Plan ==")[1]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        scans = [line for line in physical.splitlines() if "FileScan" in line and "tf#" in line]
        assert scans and all("dynamicpruningexpression(bucket" in line for line in scans)
        shuffled = [line for line in physical.splitlines() if "Exchange hashpartitioning(term" in line]
        assert all("__share" in line for line in shuffled) and bool(shuffled) == (most == 0)
    assert search_many(index, queries.filter("false")).isEmpty()
    assert search(index, "").isEmpty()


def test_a_pasted_text_goes_the_way_of_a_table(index, monkeypatch):
    want = list(map(tuple, search(index, "zebra the dog cat").collect()))
    monkeypatch.setattr(ranking, "TYPED_TERMS", 3)
    physical = plan(score_text(index, "zebra the dog cat")).split("== Physical Plan ==")[1]
    assert "dynamicpruning" in physical and "EqualTo(term" not in physical
    assert list(map(tuple, search(index, "zebra the dog cat").collect())) == want


def test_a_failed_build_leaves_the_index_as_it_was(spark, documents, tmp_path):
    path = str(tmp_path / "index")
    chunks = table_chunks(documents, "id", "text")
    built = build_index(chunks, path, buckets=3)
    before = sorted(map(tuple, read_index(spark, path).postings.collect()))
    broken = built.postings.select("doc", "term", F.when(F.col("doc") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("tf")).cast("long").alias("tf"))
    with pytest.raises(Exception, match="lost"):
        index_counts(broken, path)
    assert read_index(spark, path).buckets == 3
    assert sorted(map(tuple, read_index(spark, path).postings.collect())) == before
    again = read_index(spark, path).postings.select("doc", "term", "tf").filter("doc < 50")
    index_counts(again, path, files=2)
    drop_old_versions(spark, path)
    assert len(list((tmp_path / "index").glob("version-*"))) == 1
    assert read_index(spark, path).corpus_stats.first().n_docs == 50
    assert search(read_index(spark, path), "zebra dog").count() == 10


def test_text_is_split_once(documents):
    from lexspark.operators.terms import tokens

    physical = plan(tokens(table_chunks(documents, "id", "text"))).split("== Physical Plan ==")[1]
    assert physical.count("split(") == 1


def test_tfidf(spark, documents, texts):
    stop = {"the", "of"}
    stopwords = spark.createDataFrame([(w,) for w in (*stop, "absent")], "word string")
    counts = {d: Counter(w for w in t.split() if w not in stop) for d, t in texts.items()}
    df = Counter(w for c in counts.values() for w in c)
    for exact in (False, True):
        ratio = {w: len(texts) / n if exact else len(texts) // n for w, n in df.items()}
        want = {
            (w, d): round((1 + math.log10(tf)) * math.log10(1 + ratio[w]), 9)
            for d, c in counts.items() for w, tf in c.items()
        }
        rows = tfidf(table_chunks(documents, "id", "text"), stopwords, exact=exact).collect()
        assert {(r.term, r.doc): round(r.tfidf, 9) for r in rows} == pytest.approx(want)


def test_stopword_file(spark, tmp_path):
    (tmp_path / "words").write_text("the\nof\n\n")
    assert sorted(r.word for r in read_stopwords(spark, str(tmp_path / "words")).collect()) == ["of", "the"]
    assert read_stopwords(spark).filter("word = 'the'").count() == 1


def test_scratch_dir_is_the_one_the_session_names(spark):
    assert scratch_dir(spark) == spark.conf.get(SCRATCH_SETTING)


def test_builds_leave_nothing_staged(spark, documents, tmp_path):
    before = subfolders(spark, scratch_dir(spark))
    index = build_index(table_chunks(documents, "id", "text"), str(tmp_path / "index"), stem=True)
    build_blocks(index, str(tmp_path / "blocks"))
    add_documents(spark, str(tmp_path / "index"), table_chunks(documents.filter("id < 5"), "id", "text"), stem=True)
    assert subfolders(spark, scratch_dir(spark)) == before
    with pytest.raises(RuntimeError), scope(spark):
        stage(documents, "lost")
        raise RuntimeError
    assert subfolders(spark, scratch_dir(spark)) == before


def test_wiki_text_is_scanned_once(spark, corpus_path):
    """Positions come from one stored read, so no second scan has to agree with it."""
    physical = plan(wiki_chunks(read_wiki(spark, corpus_path))).split("== Physical Plan ==")[1]
    assert "FileScan text" not in physical and "monotonically_increasing_id" not in physical
    assert physical.count("FileScan parquet") == 3


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_titles_do_not_depend_on_splits(spark, tmp_path, compression):
    want = []
    lines = ["above any title"]
    for i in range(60):
        lines.append(f"[[T{i}]]")
        want += [(f"[[T{i}]]", f"line {i} {j}") for j in range(i % 4)]
        lines += [f"line {i} {j}" for j in range(i % 4)]
    written = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "n int, value string")
    written.coalesce(1).sortWithinPartitions("n").select("value").write.option("compression", compression).text(f"{tmp_path}/wiki")
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = wiki_chunks(read_wiki(spark, f"{tmp_path}/wiki")).select("doc", "chunk").collect()
        assert untitled_lines(read_wiki(spark, f"{tmp_path}/wiki")).first().n_lines == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(map(tuple, rows)) == sorted(want)


def test_one_bzip2_file_is_read_in_splits(spark, tmp_path):
    """Titles are carried over the splits of one compressed file of several blocks."""
    pick = random.Random(9)
    lines, want = [], []
    for i in range(3000):
        lines.append(f"[[T{i}]]")
        for j in range(i % 5):
            lines.append(f"{i} {j} " + "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=150)))
            want.append((f"[[T{i}]]", lines[-1]))
    text = "\n".join(lines) + "\n"
    (tmp_path / "dump.txt.bz2").write_bytes(bz2.compress(text.encode(), 1))  # blocks of 100 kB
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "150000")
        read = read_wiki(spark, str(tmp_path))
        assert read.select("block_start").distinct().count() > 3
        got = wiki_chunks(read).select("doc", "chunk").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, got)) == sorted(want)


def test_stemmer_sees_each_word_once(spark, documents):
    lines = documents.select(F.col("id").alias("doc"), F.lit(0).alias("line"), F.concat_ws("  ", "text", "text").alias("chunk"))
    stemmed = {r.doc: r.chunk for r in stem_chunks(lines).collect()}
    stems = dict(with_stem(spark.createDataFrame([(w,) for w in [*WORDS, ""]], "term string"), "term", "stem").collect())
    assert stemmed == {r.doc: " ".join(stems[w] for w in r.chunk.split(" ")) for r in lines.collect()}
    physical = plan(stem_chunks(lines)).split("== Physical Plan ==")[1]
    assert "regexp" not in physical and "rlike" not in physical.lower()  # only words counted before are stemmed


def test_queries_of_a_term_in_blocks(spark, index, monkeypatch):
    """A term that all queries hold is dealt into rows of bounded size, with the same result."""
    queries = spark.createDataFrame([(i, f"the {WORDS[2 + i % 6]}") for i in range(60)], "query_id long, text string")
    want = sorted(map(tuple, search_many(index, queries, 5).collect()))
    monkeypatch.setattr(ranking, "QUERY_BLOCK", 8)
    blocks = ranking.query_blocks(ranking.query_terms(queries)).filter("term = 'the'").collect()
    assert sorted(i for r in blocks for i in r.query_ids) == list(range(60)) and max(len(r.query_ids) for r in blocks) < 30
    got = sorted(map(tuple, search_many(index, queries, 5).collect()))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert all(math.isclose(g[2], w[2], abs_tol=1e-9) for g, w in zip(got, want))


def test_queries_are_joined_where_a_document_is(spark, index, monkeypatch):
    """Postings are shuffled once, not once per query that holds their term."""
    queries = spark.createDataFrame([(i, f"the dog {WORDS[2 + i % 6]}") for i in range(40)], "query_id long, text string")
    physical = plan(search_many(index, queries, 5)).split("== Physical Plan ==")[1]
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in physical.splitlines() if "Exchange hashpartitioning" in line]
    assert keys[:2] == ["query_id", "doc"] and not set(keys[2:]) & {"query_id", "doc"}
    got = sorted(map(tuple, search_many(index, queries, 5).collect()))
    monkeypatch.setattr(topk, "DIRECT_K", 0)
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, search_many(index, queries, 5).collect())) == got


def test_terms_and_lengths_are_counted_where_the_text_is(spark, documents, monkeypatch):
    twice = documents.union(documents.filter("id % 3 = 0")).union(spark.createDataFrame([(None, "dog dog cat")], documents.schema))

    def counted():
        chunks = table_chunks(twice, "id", "text")
        return terms.with_document_length(terms.count_terms(terms.tokens(terms.by_document(chunks))))

    physical = plan(counted()).split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning(doc") == 1 and "Join" not in physical
    want = sorted(map(str, counted().collect()))
    monkeypatch.setattr(terms, "CROWDED", 1)
    assert "Exchange hashpartitioning(doc#" in plan(counted())
    assert sorted(map(str, counted().collect())) == want
    lengths = counted().groupBy("doc").agg(F.sum("tf").alias("s"), F.max("dl").alias("dl"), F.min("dl").alias("least"))
    assert lengths.filter("s <> dl or s <> least").isEmpty()
