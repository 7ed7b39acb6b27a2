"""An index of wiki text is built with little on disk: lines and texts move once, and nothing stays that is not read again."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexspark import build_index, read_wiki, search, wiki_chunks
from lexspark.functions.porter import with_stem
from lexspark.operators import stems, terms
from lexspark.plans import indexing
from lexspark.session import release, scope, scratch_dir, stage, store, subfolders

WORDS = ["running", "runs", "run", "dogs", "dog", "cats", "Relational", "of-the", "x" * 70 + "s", "a]]b", "the", "zebras"]


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.fixture
def staged(monkeypatch):
    """Plans of what is staged, by name."""
    plans = {}

    def seen(df, name, codec=None):
        plans[name] = plan(df)
        return stage(df, name, codec)

    for module in (terms, indexing):
        monkeypatch.setattr(module, "stage", seen)
    return plans


@pytest.fixture
def wiki(spark, tmp_path):
    """Titles that come once, that come again, and one of much text."""
    pick = random.Random(5)
    lines = ["no title"]
    for i in range(70):
        lines.append(f"[[Dogs {i % 50}]] running the" + " again" * (i % 3))
        lines += [" ".join(pick.choices(WORDS, k=pick.randrange(1, 9))) for _ in range(pick.randrange(40 if i == 7 else 5))]
    (tmp_path / "w.txt").write_text("\n".join(lines))
    return read_wiki(spark, str(tmp_path / "w.txt"))


def counted(spark, chunks):
    """Counts and lengths, one word after the other."""
    want, lengths = Counter(), Counter()
    lines = chunks.select("doc", "title_line", "chunk").collect()
    words = {w for r in lines for w in r.chunk.split(" ") if w}
    stem = dict(with_stem(spark.createDataFrame([(w,) for w in words], "term string"), "term", "stem").collect())
    for doc, word in [(r.doc, stem[w]) for r in lines for w in r.chunk.split(" ") if w]:
        want[doc, word] += 1
    for doc, title in {(r.doc, r.title_line) for r in lines}:
        want.update((doc, word) for word in title.split())
    for (doc, _), n in want.items():
        lengths[doc] += n
    return Counter((doc, word, n, lengths[doc]) for (doc, word), n in want.items())


@pytest.mark.parametrize(("share", "task_bytes"), [(1, 500), (40, 500), (40, 8 << 20), (10**6, 8 << 20)])
def test_stemmed_words_of_titles_and_texts(spark, wiki, monkeypatch, share, task_bytes):
    """All words rare, some, none; documents of more text than a task has, and without."""
    monkeypatch.setattr(stems, "COMMON_SHARE", share)
    monkeypatch.setattr(terms, "TASK_BYTES", task_bytes)
    monkeypatch.setattr(terms, "PART_BITS", 2)
    chunks = wiki_chunks(wiki)
    want = counted(spark, chunks)
    packed = indexing.packed_counts(chunks, stem=True, count_titles=True)
    got = packed.select("doc", "dl", F.explode("terms").alias("e")).select("doc", "e.term", "e.tf", "dl")
    assert Counter(map(tuple, got.collect())) == want
    rows = indexing.term_counts(chunks, stem=True).collect()
    assert Counter(map(tuple, rows)) == Counter(r[:3] for r in want)


def test_lines_and_texts_move_once(wiki, staged, monkeypatch):
    monkeypatch.setattr(terms, "TASK_BYTES", 4000)
    indexing.packed_counts(wiki_chunks(wiki), stem=True)
    assert "hashpartitioning(title_line" not in staged["title_texts"]
    moved = [x for x in staged["counts"].splitlines() if "Exchange hashpartitioning(doc" in x]
    assert len([x for x in moved if "title_line" not in x]) == 1 and not any("term" in x for x in moved)


def test_without_stems_lines_move_once_too(wiki, staged):
    indexing.packed_counts(wiki_chunks(wiki))
    assert "hashpartitioning(title_line" not in staged["title_texts"]


def test_nothing_but_the_index_stays(spark, wiki, tmp_path):
    before = set(subfolders(spark, scratch_dir(spark)))
    chunks = wiki_chunks(wiki)
    kept = build_index(chunks, str(tmp_path / "kept"), stem=True)
    assert chunks.count() > 0  # still there
    given = build_index(chunks, str(tmp_path / "given"), stem=True, release_chunks=True)
    assert set(subfolders(spark, scratch_dir(spark))) == before
    best = [search(index, "running dogs", stem=True).collect() for index in (kept, given)]
    assert best[0] == best[1] and len(best[0]) == 10


def test_counts_outlive_the_tables_that_they_are_made_of(spark, wiki):
    chunks, before = wiki_chunks(wiki), set(subfolders(spark, scratch_dir(spark)))
    packed = indexing.packed_counts(chunks, stem=True)
    assert len(set(subfolders(spark, scratch_dir(spark))) - before) == 1 and packed.count() > 0
    with scope(spark):
        indexing.packed_counts(chunks, stem=True)
    assert len(set(subfolders(spark, scratch_dir(spark))) - before) == 1
    release(packed, chunks)


def test_shuffled_rows_are_deleted_with_the_write(spark, tmp_path):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList()
        return {found.apply(i).getName() for i in range(found.size())}

    before = files()
    stored = store(spark.range(5000).repartition(5, "id").groupBy(F.col("id") % 7).count(), str(tmp_path / "t"))
    until = time.time() + 20
    while (left := {x for x in files() - before if x.startswith("shuffle")}) and time.time() < until:
        time.sleep(0.2)  # they are deleted in the background
    assert not left and stored.count() == 7


def test_the_query_keeps_its_rows_and_no_text(spark, tmp_path):
    import __spark_entry__ as e

    pick = random.Random(6)
    rows = [(i % 90, "s" if i % 4 else None, "\n".join(" ".join(pick.choices([*WORDS, *e.QUERY.split()], k=5)) for _ in range(i % 6))) for i in range(100)]
    rows += [(200, "s", None), (201, "s", ""), (None, "s", "details of nothing")]
    spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    lines = e._wiki_lines(spark, str(tmp_path))
    chunks = wiki_chunks(lines)
    index = build_index(chunks, str(tmp_path / "index"), stem=True, count_titles=True)
    want = e._rounded(search(index, e.QUERY, stem=True)).collect()
    release(lines, chunks)
    before = set(subfolders(spark, scratch_dir(spark)))
    got = e.wiki_bm25_top10(spark, str(tmp_path)).collect()
    assert got == want and len(got) == 10
    left = set(subfolders(spark, scratch_dir(spark))) - before
    assert [x.split("-")[0] for x in left] == ["index"]
