"""Rows that repeat an id, extreme values and bounds that raise instead of dropping."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexspark.llm import decontamination, neighbours, queries, repeats, token_file, word_bpe, words

DOCS = "doc_id long, text string, lang string, key long, spans string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", 7, "x") for i, t in rows], DOCS).repartition(3)


# ---------------------------------------------------------------- repeated passages


def expected(rows, kinds, short_docs=1):
    """What ``remove_repeats`` leaves of each row, by plain grouping of the units of each row."""
    found = []
    for i, text in rows:
        own = []
        if i is not None and text:
            (_, group), = words.word_groups(pa.array([text]))
            _, start, end, digest = repeats.units(group, repeats.MIN_WORDS, kinds)
            own = sorted(zip(start.tolist(), end.tolist(), digest.tolist()))
        found.append(own)
    docs_of, rows_with = collections.defaultdict(set), collections.Counter()
    for (i, _), own in zip(rows, found):
        for d in {u[2] for u in own}:
            docs_of[d].add(i)
            rows_with[d] += 1
    out = []
    for (i, text), own in zip(rows, found):
        raw, cut, first = (text or "").encode(), set(), {}
        for start, end, digest in own:
            overlaps_first = digest in first and ("pieces" not in kinds or start >= first[digest])
            first.setdefault(digest, end)
            short = len(raw[start:end].split()) < repeats.MIN_WORDS
            if short and rows_with[digest] < short_docs:
                continue
            if i != min(docs_of[digest]) or overlaps_first:
                cut.update(range(start, end))
        out.append((i, None if text is None else bytes(b for p, b in enumerate(raw) if p not in cut).decode()))
    return sorted(out, key=repr)


def corpus(seed):
    pick = random.Random(seed)
    sentence = [" ".join(pick.choices("alpha beta gamma delta eta theta iota kappa".split(), k=pick.randrange(1, 25))) + pick.choice([".", "", "!"]) for _ in range(25)]
    return [pick.choice(["", " ", "\n"]).join(pick.choices([s + pick.choice([" ", "\n", "\n\n"]) for s in sentence], k=pick.randrange(1, 8))) for _ in range(60)]


@pytest.mark.parametrize("kinds", [repeats.SENTENCES, repeats.ALL_KINDS])
@pytest.mark.parametrize("short_docs", [1, 4])
def test_repeats_equal_plain_grouping(spark, kinds, short_docs):
    texts = corpus(3)
    rows = list(enumerate(texts[:50])) + [(i, t) for i, t in zip([3, 3, 10, 10, 49, None, None], texts[50:])]
    rows += [(3, None), (10, ""), (10, "x"), (20, texts[20]), (60, texts[1] + " end"), (61, texts[1])]
    got = repeats.remove_repeats(table(spark, rows), kinds=kinds, short_docs=short_docs).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == expected(rows, kinds, short_docs)
    texts_by_id = collections.defaultdict(list)
    for i, t in rows:
        texts_by_id[i].append(t)
    for r in got:
        kept = [t for t in texts_by_id[r.doc_id] if t is None and r.text is None or t is not None and "".join(t[s.start : s.end] for s in r.kept) == r.text]
        assert kept


def test_rows_of_one_id_with_different_texts_keep_their_own_offsets(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen."
    rows = [(1, passage), (2, "Intro here.\n" + passage), (2, "short"), (2, None), (2, passage + "\nafter"), (2, "")]
    got = repeats.remove_repeats(table(spark, rows), kinds=repeats.ALL_KINDS).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.text is not None) == [(1, passage), (2, ""), (2, "\nafter"), (2, "Intro here.\n"), (2, "short")]


# ---------------------------------------------------------------- neighbours


def nearest_of(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    index, coder = neighbours.build_index(df, k)
    return neighbours.nearest(index, coder, index.filter("vec_id % 50 = 0"), k).collect()


def test_repeated_queries_are_one_and_extreme_vectors_have_their_cosine(spark):
    pick = np.random.default_rng(4)
    vectors = {i: pick.normal(size=8) for i in range(1, 200)}
    scales = [1.0, 1e200, 1e-200, 2.0**-1000, 2.0**1000]
    rows = [(i, (v * scales[i % 5]).tolist()) for i, v in vectors.items()]
    other = pick.normal(size=8)
    rows += [rows[49], rows[49], (100, other.tolist()), rows[6]]  # ids 50 and 7 again, 100 with another vector
    got = nearest_of(spark, rows)
    by_query = collections.defaultdict(list)
    for r in got:
        by_query[r.query_id].append((r["rank"], r.vec_id, r.score))

    def brute(query_id, vector):
        unit = vector / np.linalg.norm(vector)
        scored = [(-float(vectors[i] @ unit / np.linalg.norm(vectors[i])), i) for i, _ in rows if i != query_id and i != 100]
        if query_id != 100:
            scored += [(-float(v @ unit / np.linalg.norm(v)), 100) for v in (vectors[100], other)]
        return [(rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:5], 1)]

    def same(a, b):
        return len(a) == len(b) and all(x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-12 for x, y in zip(a, b))

    assert same(sorted(by_query[50]), brute(50, vectors[50])) and same(sorted(by_query[150]), brute(150, vectors[150]))
    want = sorted(brute(100, vectors[100]) + brute(100, other))
    assert same(sorted(by_query[100]), want)


# ---------------------------------------------------------------- encoding


def test_word_bpe_is_the_library_on_every_character():
    library = Tokenizer.from_file(queries.WORD_BPE)
    library.no_truncation()
    library.no_padding()
    model = word_bpe.WordBpe(queries.WORD_BPE)
    characters = [chr(c) for c in [*range(1, 0x33480), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000 and chr(c) not in " \t\n\r\x0b\x0c"]
    pick = random.Random(1)
    mixed = "<|endoftext|> <|startoftext|> É é a Z 's 'LL 9 漢 ̸ ​ 　 Σ ς İ ! <| |> \x00 \x1c".split(" ")
    for chunks in (characters, [f"e{c}'s" for c in characters], ["".join(pick.choices(mixed, k=pick.randrange(1, 9))) for _ in range(5000)]):
        ids, offset = model.encode_chunks(chunks)
        want = library.encode_batch(chunks, add_special_tokens=False)
        assert [c for i, c in enumerate(chunks) if ids[offset[i] : offset[i + 1]].tolist() != want[i].ids] == []


def test_too_many_ids_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "MOST_IDS", 3)
    with pytest.raises(ValueError, match="different ids"):
        token_file.write_tokens(table(spark, [(1, "one two three four five six")]), str(tmp_path), queries.WORD_BPE, end_id=2)


# ---------------------------------------------------------------- long items


def test_windows_of_a_long_item_come_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_SHINGLES", 4000)
    pick = random.Random(8)
    text = " ".join(f"w{pick.randrange(10**6)}" for _ in range(1500))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text + " " + text])], names=["doc_id", "text"])
    found = list(decontamination.window_batches(iter([batch]), np.ones(1 << 24, bool), [1000], 5, (4, 5)))
    assert max(b.num_rows for b in found) <= 4 and sum(b.num_rows for b in found) > 1500
