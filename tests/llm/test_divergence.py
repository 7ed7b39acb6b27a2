"""The audit of sources against a dense computation, and its counting against plain counting."""

import collections
import random
import re

import pyarrow as pa
import pytest

from lexspark.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, value long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def corpus(seed, n):
    pick = random.Random(seed)
    words = ["The", "É", "é", "ß", "漢字", "a_b", "x-y", "İ", "don't", "42", "\x00z", "K", "k", "~"] + [f"w{chr(97 + i)}" for i in range(12)]
    texts = [" ".join(pick.choices(words, k=pick.randrange(12))) for _ in range(n // 3)]
    rows = []
    for i in range(n):
        text = pick.choice([None, "", "42 !", *texts])
        rows.append((i % 7, text, pick.choice(["en", "de", None, "", "rare"] if i % 20 == 0 else ["en", "de"]), pick.choice(["s1", "s1", "s2", "s3", None, ""]), "t", 1, 2))
    return rows


def dense(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        sources = sorted({d[1] for d in mine})
        counts = {s: collections.Counter(t for d in mine if d[1] == s for t in d[2]) for s in sources}
        whole = sum(counts.values(), collections.Counter())

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, n, min_docs", [(1, 400, 10), (2, 60, 10), (3, 12, 10), (4, 200, 1)])
def test_audit_equals_the_dense_computation(spark, seed, n, min_docs):
    rows = corpus(seed, n)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = divergence.audit(docs, min_docs=min_docs).collect()
    assert sorted(map(tuple, got)) == dense(rows, min_docs)


def test_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shares_of_large_counts_are_exact(spark):
    rows = [(10**18, 3 * 10**18, 10**9), (9 * 10**18, 9 * 10**18, 1), (0, 0, 1), (7, 10**18 + 9, 0)]
    got = spark.createDataFrame(rows, "n long, total long, kept long").select(divergence.share("n", "total", "kept")).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (n + 2) // (t + 2 * k) for n, t, k in rows]


def test_what_a_worker_hands_on_does_not_depend_on_when(monkeypatch):
    rows = corpus(5, 300)
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([r[2] or "" for r in part]), pa.array([r[3] or "" for r in part]), pa.array([r[1] or "" for r in part])],
            names=["lang", "source", "text"],
        )
        for part in (rows[:100], rows[100:110], rows[110:])
    ]

    def counts():
        copies = [r for b in divergence.copy_batches(iter(batches)) for r in b.to_pylist()]
        copies.sort(key=lambda r: (r["lang"], r["digest"]))
        schema = next(divergence.copy_batches(iter(batches))).schema
        parts = [pa.RecordBatch.from_pylist(copies[a : a + 37], schema) for a in range(0, len(copies), 37)]
        total = collections.Counter()
        for b in divergence.term_batches(iter(parts)):
            for r in b.to_pylist():
                total[r["lang"], r["source"], r["term"], "n"] += r["n"]
                total[r["lang"], r["source"], r["term"], "docs"] += r["n_docs"]
        return total

    plain = collections.Counter()
    for _, text, lang, source, *_ in rows:
        words = TERM.findall((text or "").translate(LOWER))
        plain.update((lang or "", source or "", w, "n") for w in words)
        plain.update((lang or "", source or "", w, "docs") for w in set(words))
    assert counts() == plain
    monkeypatch.setattr(divergence, "KEPT_TEXTS", 5)
    monkeypatch.setattr(divergence, "KEPT_TERMS", 5)
    monkeypatch.setattr(divergence, "_SLICE", 3)
    assert counts() == plain
