"""Cleaning, titles and tokens, on lines chosen for their corners."""

import gzip

import pytest
from pyspark.sql import functions as F

from lexspark import build_index, read_wiki, table_chunks, wiki_chunks
from lexspark.functions.text import clean_body, has_line, is_title, normalise_line, strip_blanks, title_key
from lexspark.operators.carry import carry_forward
from lexspark.operators.terms import tokens
from lexspark.sources.tables import table_lines
from lexspark.sources.wiki import untitled_lines


def one(spark, line, *columns):
    return spark.range(1).select(F.lit(line).alias("v")).select(*columns).first()


@pytest.mark.parametrize(
    "line, expected",
    [
        ("  [[Gamma]]  ", "[[Gamma]]"),
        ("\t\x01[[Gamma]]\x1f\t", "[[Gamma]]"),
        ("[[Beta=2]] trailing words", "[[Beta=2]]"),
        ("[[Jean-Luc]]", "[[Jean Luc]]"),
        ("[[a]] b]] c", "[[a]] b]]"),
        ("==x== [[A]]", ""),
        ("see [[A]]", ""),
    ],
)
def test_title_key(spark, line, expected):
    assert one(spark, line, title_key(normalise_line(strip_blanks(F.col("v")))))[0] == expected


@pytest.mark.parametrize(
    "line, expected",
    [
        ("see [[Foo|Bar]] now", "see [[foo bar now"),
        ("beta body ]] x", "beta body x"),
        ("a]]b c]", "ab c]"),
        ("É K K élan", "k   lan"),
        ("-", ""),
        ("x  -  y!", "x y"),
    ],
)
def test_body_words(spark, line, expected):
    body = one(spark, line, clean_body(normalise_line(strip_blanks(F.col("v")))))[0]
    assert body.split() == expected.split()


def test_ascii_first_order(spark):
    title, body = one(
        spark, "[[Ünï-x]]", is_title(normalise_line(strip_blanks(F.col("v")), True)), normalise_line(strip_blanks(F.col("v")), True)
    )
    assert title and body == "[[ n  x]]"


@pytest.mark.parametrize("line", ["", "  ", "==a==", "==a== keep ==b==", " ==a== \t", "==a== x", "-", "=a=", "\t\x00"])
def test_has_line_is_what_is_left(spark, line):
    kept, normal, ascii_first = one(
        spark, line, has_line(F.col("v")), normalise_line(strip_blanks(F.col("v"))), normalise_line(strip_blanks(F.col("v")), True)
    )
    assert kept == (normal != "") == (ascii_first != "")


def test_whole_text_has_the_tokens_of_its_lines(spark):
    text = "==h==A-b c]]\r\n x]]]] ]] Straße  ==q\n r== 7 [[In|to]] ==a==\n]\n]\n\t-"
    df = spark.createDataFrame([(1, text), (2, ""), (3, "]] ]]]]"), (4, None)], "id int, t string")
    whole = sorted(tokens(table_chunks(df, "id", "t")).collect())
    lines = sorted(tokens(table_lines(df, "id", "t")).collect())
    assert whole == lines and len(whole) > 8


WIKI = [
    "orphan line",
    "[[A]]",
    "one",
    "two words",
    "[[B]] trailing",
    "three",
    "[[Empty]]",
    "[[A]]",
    "four",
    "[[Dash]]",
    "-",
    "[[B]]",
    "five",
]
EXPECTED = [
    ("[[A]]", "[[A]]", "one"),
    ("[[A]]", "[[A]]", "two words"),
    ("[[B]]", "[[B]] trailing", "three"),
    ("[[A]]", "[[A]]", "four"),
    ("[[Dash]]", "[[Dash]]", ""),
    ("[[B]]", "[[B]]", "five"),
]


def titled(lines):
    return [tuple(r) for r in wiki_chunks(lines).orderBy("file", "block_start", "line_id").select("doc", "title_line", "chunk").collect()]


def test_titles_carry_over_tiny_splits(spark, tmp_path):
    (tmp_path / "w.txt").write_text("\n".join(WIKI))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = read_wiki(spark, str(tmp_path))
        assert lines.select("block_start").distinct().count() > 3
        assert titled(lines) == EXPECTED
        assert untitled_lines(lines).first().n_lines == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)


def test_gzip_input(spark, tmp_path):
    with gzip.open(tmp_path / "w.txt.gz", "wt") as out:
        out.write("\n".join(WIKI))
    assert titled(read_wiki(spark, str(tmp_path))) == EXPECTED


def test_titles_do_not_carry_over_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("[[A]]\none\n")
    (tmp_path / "b.txt").write_text("stray\n[[B]]\ntwo\n")
    lines = read_wiki(spark, str(tmp_path))
    assert titled(lines) == [("[[A]]", "[[A]]", "one"), ("[[B]]", "[[B]]", "two")]


@pytest.mark.parametrize("run_bits", [0, 2, 18])
def test_carry_is_the_same_for_any_run_length(spark, run_bits):
    rows = [(f"f{i % 3}", i // 60, i, f"t{i}" if i % 17 == 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "file string, block_start int, line_id long, t string").repartition(7)
    latest, want = {}, {}
    for file, _, line_id, value in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        latest[file] = value or latest.get(file)
        want[line_id] = latest[file]
    got = {r.line_id: r.t for r in carry_forward(df, "t", run_bits).collect()}
    assert got == want


def test_title_words_count_once_per_title_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "w.txt").write_text("\n".join(WIKI))
    chunks = wiki_chunks(read_wiki(spark, str(tmp_path / "in")))
    index = build_index(chunks, str(tmp_path / "ix"), count_titles=True)
    counts = {(r.doc, r.term): r.tf for r in index.postings.collect()}
    assert counts[("[[A]]", "[[A]]")] == 1
    assert counts[("[[B]]", "[[B]]")] == 2  # two different title lines, one document
    assert counts[("[[B]]", "trailing")] == 1
    lengths = {r.doc: r.dl for r in index.doc_lengths.collect()}
    assert lengths == {"[[A]]": 5, "[[B]]": 5, "[[Dash]]": 1}


def test_documents_without_tokens(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "w.txt").write_text("\n".join(WIKI))
    chunks = wiki_chunks(read_wiki(spark, str(tmp_path / "in")))
    kept = build_index(chunks, str(tmp_path / "kept"), count_titles=False, keep_empty=True)
    assert kept.corpus_stats.first().n_docs == 3
    assert kept.postings.filter("term is null or tf = 0").count() == 0
    dropped = build_index(chunks, str(tmp_path / "dropped"), count_titles=False)
    assert dropped.corpus_stats.first().n_docs == 2
    titled = build_index(chunks, str(tmp_path / "titled"))  # by default words of titles count
    assert titled.corpus_stats.first().n_docs == 3
