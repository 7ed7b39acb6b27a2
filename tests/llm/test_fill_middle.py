"""Fill-in-the-middle forms against brute force, and the learned index against its values."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import fill_middle

SCHEMA = "doc_id long, text string, n long, form string, output string, h1 long"
LONG = "".join(random.Random(2).choices(["a", "é", "漢", "🙂", " ", "\n", "<", "P>"], k=150_000))
TEXTS = [None, "", "a", "<P>", "x<M>y", "<", "<S", ">", "<<P", "S><", LONG, LONG + "!", "漢字 かな\n🙂 x\x00y", "same", "same"]
IDS = [None, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 12]


def expected(doc_id, text, units):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in fill_middle.MARKERS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = ("".join(part) for part in (units[:i], units[i:j], units[j:]))
    if h4 % 100 < 20:
        return n, "spm", i, j - i, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", i, j - i, f"<P>{prefix}<S>{suffix}<M>{middle}"


SPLIT = {
    "characters": list,
    "words": lambda text: re.findall(r"[ \t-\r]*[^ \t-\r]+[ \t-\r]*|[ \t-\r]+", text)
    if not re.match(r"[ \t-\r]", text)
    else re.findall(r"^[ \t-\r]+|[^ \t-\r]+[ \t-\r]*", text),
    "lines": lambda text: re.findall(r"[^\n]*\n|[^\n]+", text),
}


@pytest.mark.parametrize("unit", fill_middle.UNITS)
def test_forms_equal_brute_force_and_come_back(spark, unit):
    seeds = random.Random(5)
    texts = TEXTS + ["".join(seeds.choices("ab é<SPM>\n🙂", k=seeds.randrange(40))) for _ in range(300)]
    ids = IDS + list(range(100, 400))
    docs = spark.createDataFrame([(i, t, 1, "f", "o", 2) for i, t in zip(ids, texts)], SCHEMA)
    formed = fill_middle.fill_middle(docs, unit=unit)
    got = formed.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    want = [expected(i, t or "", SPLIT[unit](t or "")) for i, t in zip(ids, texts)]
    assert [tuple(r)[:6] for r in got] == [(i, *w) for i, w in zip(ids, want)]
    assert [r.back for r in got] == [t or "" for t in texts]
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_no_rows(spark):
    assert fill_middle.fill_middle(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("tolerance", [0, 1, 126, 1000])
def test_index_is_exact_and_its_lines_are_bounded(tolerance):
    for seed in range(40):
        numbers = np.random.default_rng(seed)
        steps = numbers.choice([1, 2, 3, 4], size=numbers.integers(0, 4000), p=[0.7, 0.1, 0.1, 0.1])
        steps = np.repeat(steps, numbers.integers(1, 8))
        values = np.concatenate(([0], np.cumsum(steps)))
        index = fill_middle.RankIndex.fit(values, tolerance, window=4)
        assert (index.at(np.arange(len(values))) == values).all()
        assert np.abs(index.residual.astype(np.int64)).max() <= tolerance + 1
    straight = fill_middle.RankIndex.fit(np.arange(0, 3_000_000, 3))
    assert len(straight.first) == 1 and straight.residual.dtype == np.int8


def test_markers_that_could_overlap_are_refused(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for markers in (("aa", "b", "c"), ("ab", "ba", "c"), ("x", "x", "y"), ("", "b", "c"), ("abc", "b", "d")):
        with pytest.raises(ValueError):
            fill_middle.fill_middle(docs, markers=markers)
