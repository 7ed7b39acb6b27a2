"""The operations on training text against brute force, and on odd tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
from lexspark.llm import (
    chat,
    chunks,
    decontamination,
    links,
    minhash,
    neighbours,
    prefix_counts,
    queries,
    repeats,
    surrogates,
    token_file,
    toxicity,
    word_bpe,
    words,
)
from lexspark.session import stage

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, block int"
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", None, None if t is None else len(t), 7, "x", None) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


LONG = " ".join(random.Random(1).choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=60_000))
ODD = [None, "", "  \n\t ", "One", "one", LONG, LONG + " omega", "é漢字 🙂 \x00 x", "Same words here.", "Same words here."]
ODD_IDS = [5, 3, 9, 1, 2, 10, 11, 12, 20, 20]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, [*ODD, "no id at all", "no id at all"], [*ODD_IDS, None, None])


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# ---------------------------------------------------------------- words, links


def test_words_and_shingles():
    texts = ["Ab c  ab", None, "", "\n", "é AB\tc", " lead trail ", "x"]
    seen = []
    for _, group in words.word_groups(pa.array(texts)):
        raw = group.data.tobytes()
        found = [raw[a:b].decode() for a, b in zip(group.start, group.end)]
        seen += [found[a:b] for a, b in zip(group.first, group.first[1:])]
        hashes = group.hashes()
        shingles, offset = words.shingle_hashes(hashes, group.first, 2)
        assert list(np.diff(offset)) == [2, 0, 0, 0, 2, 1, 1]
        assert shingles[1] != shingles[2] and hashes[0] == hashes[2]
    assert seen == [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)]
    edges += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    got = {r.id: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute_components({x for e in edges for x in e if e[0] != e[1]}, edges)
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_components(ids, edges):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a in root and b in root:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# ---------------------------------------------------------------- near duplicates


def sets_of(rows, width):
    out = {}
    for r in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (r.text or "").translate(A_TO_Z))
        out[r.doc_id] = frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)] if w else [])
    return out


def brute_near_duplicates(rows, width):
    sets = sets_of([r for r in rows if r.doc_id is not None], width)
    ids = sorted(sets)
    edges = [
        (a, b) for i, a in enumerate(ids) for b in ids[:i]
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    found = brute_components(ids, edges)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(documents, width):
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(documents, width=width).collect()}
    assert got == brute_near_duplicates(documents.collect(), width)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(40)] = f"v{rng.randrange(1000)}"
        texts.append(" ".join(text))
    docs = table(spark, texts)
    want = brute_near_duplicates(docs.collect(), 2)
    for lists, clusters in ((8192, 1 << 21), (40, 1000)):
        monkeypatch.setattr(minhash, "LIST_BLOCK", lists)
        monkeypatch.setattr(minhash, "CLUSTER_BLOCK", clusters)
        got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(docs, width=2).collect()}
        assert got == want


def test_near_duplicates_of_odd_rows(odd, empty):
    got = minhash.near_duplicates(odd, width=2).collect()
    assert len(got) == 12 and sum(r.doc_id is None and r.kept and r.component_id is None for r in got) == 2
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[i].n_shingles for i in (5, 3, 9, 1)] == [0, 0, 0, 1]
    assert (by_id[2].component_id, by_id[11].component_id, by_id[20].kept) == (1, 10, True)
    assert minhash.near_duplicates(empty).count() == 0


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.WORD_BPE)


def noise(n, seed):
    rng = random.Random(seed)
    letters = [*"abcXYZ'’sтЖß ΣσςİÉé́  \t\n\x0b\x0c\r\x1c\x85.,!?0123٣१漢字🙂_-<|>\x00▁▁", "<|endoftext|>", "'ll", " the ", "<s>", "hello", "aaaa"]
    return ["", None] + ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(n)]


def test_word_bpe_is_the_library(library):
    texts = noise(4000, 1)
    model, code = word_bpe.load(queries.WORD_BPE)
    for at, ids, offset in chunks.encoded_groups(pa.array(texts), code, words.BLANKS):
        for t in range(len(offset) - 1):
            want = library.encode(texts[at + t] or "", add_special_tokens=False).ids
            own = ids[offset[t] : offset[t + 1]]
            assert own.tolist() == want, texts[at + t]
            assert model.decode(own).decode() == library.decode(want, skip_special_tokens=False)


def test_word_bpe_of_odd_rows(odd, empty, library):
    got = word_bpe.digests(word_bpe.decode(word_bpe.encode(odd, queries.WORD_BPE), queries.WORD_BPE)).collect()
    assert sorted(map(str, got)) == sorted(
        map(str, word_bpe.digests(word_bpe.round_trip(odd, queries.WORD_BPE)).collect())
    )
    want = collections.Counter()
    for r in odd.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[(r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert word_bpe.encode(empty, queries.WORD_BPE).count() == 0


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 1000):
        values = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = token_file.pack(values)
        assert len(control) == -(-n // 4) and (token_file.unpack(control, data, n) == values).all()


def test_token_file(spark, documents, library, tmp_path):
    token_file.write_tokens(documents, str(tmp_path), queries.WORD_BPE, end_id=2)
    ranks = {r.rank: r.id for r in spark.read.parquet(f"{tmp_path}/ranks").collect()}
    counts, start = collections.Counter(), 0
    got = {r.doc_id: r for r in token_file.read_tokens(spark, str(tmp_path)).collect()}
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        own = got.pop(r.doc_id)
        assert (own.start, own.n_tokens, bytes(own.ids)) == (start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
        counts.update(ids)
    assert not got
    assert [ranks[i] for i in range(len(ranks))] == sorted(counts, key=lambda i: (-counts[i], i))


def test_token_file_of_odd_rows(spark, odd, empty, tmp_path):
    token_file.write_tokens(odd, str(tmp_path / "odd"), queries.WORD_BPE, end_id=2)
    got = token_file.read_tokens(spark, str(tmp_path / "odd")).orderBy("start").collect()
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and len(ids) == 12
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])
    token_file.write_tokens(empty, str(tmp_path / "empty"), queries.WORD_BPE, end_id=2)
    assert token_file.read_tokens(spark, str(tmp_path / "empty")).count() == 0


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)


def test_prefix_counts_are_the_library(pieces):
    texts = noise(3000, 2)
    model = prefix_counts.load(queries.PIECE_BPE)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    for part in prefix_counts.count_batches(iter([batch]), queries.PIECE_BPE):
        for i, size, n in zip(*(c.to_pylist() for c in part.columns)):
            assert (size, n) == (len((texts[i] or "").encode()), len(pieces.encode(texts[i] or "")))
    for text in texts[2:100]:
        counts = model.prefix_counts(model.lead + text)[len(model.lead) :] if text else []
        assert counts == [len(pieces.encode(text[: i + 1])) for i in range(len(text))]


def test_cut_to_budget(spark, pieces):
    """All prefixes are in the stored table, which answers without the model."""
    texts = noise(60, 4)
    stored = stage(prefix_counts.prefix_tables(table(spark, texts), queries.PIECE_BPE), "tables")
    for r in stored.collect():
        text = texts[r.doc_id] or ""
        counts = np.cumsum(np.frombuffer(r.steps, np.int8))
        assert counts.tolist() == [len(pieces.encode(text[: i + 1])) for i in range(len(text))]
    for budget in (0, 1, 7):
        for r in prefix_counts.cut_to_budget(stored, budget).collect():
            text = texts[r.doc_id] or ""
            fits = [i for i in range(len(text) + 1) if len(pieces.encode(text[:i])) <= budget]
            assert r.text == text[: fits[-1]] and r.n_tokens == len(pieces.encode(r.text))


def test_cutting_calls_no_model(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["été  a\nb漢", None])], names=["doc_id", "text"])
    (tables,) = prefix_counts.table_batches(iter([batch]), queries.PIECE_BPE)
    for name in ("prefix_counts", "tables", "keeps_apart"):
        monkeypatch.delattr(prefix_counts.PieceModel, name)
    monkeypatch.setattr(prefix_counts, "_loaded", {})
    (cut,) = prefix_counts.cut_batches(iter([tables.append_column("budget", pa.array([3, 3]))]))
    assert cut.column(1).to_pylist()[1] == "" and "été  a\nb漢".startswith(cut.column(1).to_pylist()[0]) and cut.column(2)[0].as_py() <= 3


def test_token_counts_of_odd_rows(odd, empty, pieces):
    got = collections.Counter(map(tuple, prefix_counts.token_counts(odd, queries.PIECE_BPE).collect()))
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), len(pieces.encode(r.text or ""))) for r in odd.collect())
    assert got == want and prefix_counts.token_counts(empty, queries.PIECE_BPE).count() == 0


# ---------------------------------------------------------------- repeated passages


def brute_repeats(rows, min_words):
    """By strings: the spans of units seen in an earlier document, or earlier in the same."""
    units = []
    for doc_id, text in rows:
        found = [(m.start(), m.end()) for m in re.finditer("[^\x20\x09-\x0d]+", text)]
        ends = [
            i + 1 for i, (s, e) in enumerate(found)
            if i + 1 == len(found) or text[e - 1] in ".!?:;。" or re.search("[\r\n]", text[e : found[i + 1][0]])
        ]
        for first in [0, *ends[:-1]] if ends else []:
            stop = next((e for e in ends if e >= first + min_words), None)
            if stop:
                own = tuple(text[s:e].translate(A_TO_Z) for s, e in found[first:stop])
                units.append((doc_id, found[first][0], found[stop - 1][1], own))
    seen, cut = set(), collections.defaultdict(set)
    for doc_id, start, end, own in sorted(units):
        if own in seen:
            cut[doc_id].update(range(start, end))
        seen.add(own)
    return cut


def test_repeats(documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    want = brute_repeats(rows, repeats.MIN_WORDS)
    assert want
    for r in repeats.remove_repeats(documents).collect():
        text = dict(rows)[r.doc_id]
        assert {i for s in r.removed for i in range(s.start, s.end)} == want.get(r.doc_id, set())
        assert {i for s in r.kept for i in range(s.start, s.end)} == set(range(len(text))) - want.get(r.doc_id, set())
        assert r.text == "".join(text[s.start : s.end] for s in r.kept)


def test_repeats_of_odd_rows(spark, odd, empty):
    got = repeats.remove_repeats(odd).collect()
    assert len(got) == 12 and sum(r.text is None for r in got) == 1
    passage = "Éins two three four five six seven eight nine ten eleven twelve。"
    docs = table(spark, [f"x. {passage} y", f"A\n{passage.upper()} z", f"{passage} {passage}"], [7, 4, 9])
    got = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    assert (got[4].removed, got[7].text, got[9].text.strip(), len(got[9].removed)) == ([], "x.  y", "", 2)
    assert repeats.remove_repeats(empty).count() == 0


def test_repeated_lines_of_any_length(spark):
    """Short lines, lines of scripts without blanks, and a short paragraph broken otherwise."""
    texts = [
        "Share this page\nBody one.\n\nin two\nlines here",
        "Body two.\nSHARE  this page\r\n\r\nin two lines\nhere\r\n\r\nend",
        "漢字かな交じり文\nx",
        "y\n漢字かな交じり文\nx y",
    ]
    got = {r.doc_id: r for r in repeats.remove_repeats(table(spark, texts), kinds=repeats.ALL_KINDS).collect()}
    assert [got[i].text for i in range(4)] == [texts[0], "Body two.\n\r\n\r\n\r\n\r\nend", texts[2], "y\n\nx y"]
    assert [(s.start, s.end) for s in got[3].removed] == [(2, 10)]


def test_repeated_runs_without_sentence_marks(spark):
    """Runs of 50 words or 80 characters inside lines lose most of themselves, and nothing else
    is lost; a run of one word keeps its first twelve."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(5_000)]
    signs = [chr(c) for c in (*range(0x4E00, 0x5E00), *range(0x0E01, 0x0E2F))]
    texts, runs = [], []
    for glue, letters, n in [(" ", vocabulary, 50)] * 40 + [("", signs, 80)] * 20:
        own = lambda k: glue.join(rng.choices(letters, k=k))
        runs.append(own(n))
        for _ in range(2):
            texts.append(glue.join([own(rng.randint(30, 60)), runs[-1], own(rng.randint(30, 60))]))
    got = {r.doc_id: r for r in repeats.remove_repeats(table(spark, texts), kinds=repeats.ALL_KINDS).collect()}
    for i, run in enumerate(runs):
        assert got[2 * i].text == texts[2 * i]
        text = texts[2 * i + 1]
        cut = got[2 * i + 1].removed
        assert all(text.index(run) <= s.start and s.end <= text.index(run) + len(run) for s in cut)
        assert sum(s.end - s.start for s in cut) > len(run) / 3
    lost = sum(s.end - s.start for r in got.values() for s in r.removed)
    assert lost > 0.6 * sum(map(len, runs))
    same = [" ".join(["a"] * 40), "b " + " ".join(["a"] * 13)]
    got = {r.doc_id: r.text for r in repeats.remove_repeats(table(spark, same), kinds=repeats.ALL_KINDS).collect()}
    assert len(got[0].split()) == 12 and got[1].split() == ["b"]


def repeated_lines(docs, kept, least):
    """``(line, doc)`` of all lines of so many words that stand in an earlier document, and of those that are left."""
    seen = collections.defaultdict(set)
    for r in docs:
        for line in re.split("[\r\n]+", r.text or ""):
            own = " ".join(line.translate(A_TO_Z).split())
            if len(own.split()) >= least:
                seen[own].add(r.doc_id)
    again = [(own, d) for own, ids in seen.items() if len(ids) > 1 for d in ids if d != min(ids)]
    lines = {d: {" ".join(x.translate(A_TO_Z).split()) for x in re.split("[\r\n]+", kept[d])} for d in {d for _, d in again}}
    return again, [own for own, d in again if own in lines[d]]


def test_repeats_take_all_kinds(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id: r.text for r in repeats.remove_repeats(docs, kinds=repeats.ALL_KINDS).collect()}
    again, left = repeated_lines(docs.collect(), kept, 1)
    assert again and not left


def test_repeats_query_takes_long_lines_and_leaves_short_ones(spark):
    """A text whose lines are all of fewer than 12 words and that is no run of sentences stays as it is."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = queries.queries()["op5_repeated_passages"](spark, SF_DIR).collect()
    again, left = repeated_lines(docs.collect(), {r.doc_id: r.text for r in got}, repeats.MIN_WORDS)
    assert again and not left
    all_lines = repeats.remove_repeats(docs, kinds=repeats.ALL_KINDS).filter("size(removed) > 0").count()
    assert 0 < sum(len(r.removed) > 0 for r in got) < 0.7 * all_lines


# ---------------------------------------------------------------- chat


def chat_table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid string")


def test_chat(spark, tmp_path):
    rng = random.Random(9)
    letters = ["a", "\\", "<", "[", "INST]", "s>", "/", "|>", "<|end|>", "</s>", "[INST]", "<<SYS>>", "\n", "🙂", "<|", "$1"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "tool", "to|>ol\\", ""])
            rows.append((conv, turn, role, "".join(rng.choices(letters, k=rng.randint(0, 12))), None))
    rows += [(100, 0, "user", "a", None), (100, 1, "assistant", None, None), (None, 0, "user", "x", None), (101, None, None, None, None)]
    rows += [(102, 0, "system", "s", None), (102, 1, "user", "u", None), (102, 2, "assistant", "v", None), (102, 2, "assistant", "v", None)]
    path = str(tmp_path / "chat")
    chat.write_formatted(chat.format_conversations(chat_table(spark, rows)), path)
    read = chat.read_formatted(spark.read.parquet(path))
    got = {r.conv_id: r for r in read.collect()}
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        by_conv[conv].append((turn if turn is not None else -1, role or "", text or ""))
    for conv, turns in by_conv.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[conv].turns] == [t[1:] for t in turns]
        assert got[conv].loss_texts == [t for _, role, t in turns if role == "assistant"]
        order = "".join(role[:1] if role in ("system", "user", "assistant") else "x" for _, role, _ in turns)
        assert got[conv].valid == bool(re.fullmatch("s?(ua)+", order))
    assert chat.format_conversations(chat_table(spark, [])).count() == 0


def test_chat_refuses_ambiguous_templates():
    with pytest.raises(ValueError):
        chat.Template({"user": ("<a", "a>")}, frozenset(), {}, "s", frozenset(), ("<|", "|>", ">b"))


# ---------------------------------------------------------------- private data


def test_surrogates(spark):
    text = (
        "Mr. John Smith met Frau Müller and Mr Smith, then Mrs Smith, at FOO.bar@Mail.Example.com or "
        "foo.bar@mail.example.com, x@mail.example.com; +1 (974) 555-3436, 4111 1111 1111 1111 or 4111111111111111; "
        "10.1.2.3, 8.8.8.8; 123-45-6789; Госпожа Иванова; GB82 WEST 1234 5698 7654 32; " + "ab12" * 8 + " " + "AB12" * 8
    )
    rows = table(spark, [text, "8.8.8.8 again", "no data", None, ""], [1, None, 2, 3, 3])
    got = surrogates.replace_entities(rows, "k").collect()
    assert got[0].asDict().keys() == {*rows.columns, "n_replaced"} and len(got) == 5
    new = next(r.text for r in got if r.doc_id == 1)
    shape = (
        r"Mr\. (\w+) (\w+) met Frau (\w+) and Mr \2, then Mrs \2, at ([A-Z]{3}\.[a-z]{3})@([A-Z][a-z]{3}\.[A-Z][a-z]{6}\.com) or "
        r"(?i:\4@\5), \w@(?i:\5); \+1 \(\d{3}\) \d{3}-\d{4}, (4\d{3}) (\d{4}) (\d{4}) (\d{4}) or \6\7\8\9; "
        r"10\.\d+\.\d+\.\d+, (\d+\.\d+\.\d+\.\d+); \d{3}-\d{2}-\d{4}; Госпожа (\w+); GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d; "
        r"([0-9a-f]{32}) ([0-9A-F]{32})"
    )
    match = re.fullmatch(shape, new)
    assert match, new
    digits = [int(d) for d in reversed("".join(match.group(6, 7, 8, 9)))]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert match[12].lower() == match[13].lower() and re.fullmatch("[А-Я][а-я]+", match[11])
    assert next(r.text for r in got if "again" in (r.text or "")) == f"{match[10]} again"
    assert not any(x in new for x in ("John", "Smith", "Müller", "8.8.8.8", "4111", "6789", "ab12ab12"))
    other = surrogates.replace_entities(rows, "other").filter("doc_id = 1").first().text
    assert other != new
    assert {r.text for r in got if r.doc_id in (2, 3)} == {"no data", None, ""}
    assert surrogates.replace_entities(rows.limit(0), "k").count() == 0


def test_surrogates_of_more_forms(spark):
    """National phone numbers, more titles and name words, initials, bare mentions, card lengths, IPv6, long tokens."""
    token = "0a1b" * 50
    text = (
        "Call 555-123-4567, 415.555.1234, 1-800-555-0199, 020 7946 0958 or 01 42 68 53 00. Mr. John Michael Smith's wife, Dr. Jane Doe, "
        "Prof. Dr. J. R. Tolk and Herr Ludwig van Beeth saw Mr. J. O'Brien. Smith and John left; Smithson stays with Doe. "
        f"3782 822463 10005, 378282246310005, 6011 0009 9013 9424 123; 2001:db8::8a2e:370:7334 or fe80::1; {token} {token.upper()}; std::map 12:30:45 2024-01-02"
    )
    texts = [text, "Smith and Jane of another text, Dr. Doe"]
    got = {r.doc_id: r for r in surrogates.replace_entities(table(spark, texts), "k").collect()}
    shape = (
        r"Call 5\d\d-\d{3}-\d{4}, 4\d\d\.\d{3}\.\d{4}, 1-\d{3}-\d{3}-\d{4}, 0\d\d \d{4} \d{4} or 0\d \d\d \d\d \d\d \d\d\. "
        r"Mr\. (\w+) (\w+) (\w+)'s wife, Dr\. (\w+) (\w+), Prof\. Dr\. [A-Z]\. [A-Z]\. (\w+) and Herr (\w+) van (\w+) saw "
        r"Mr\. [A-Z]\. (\w+)\. \3 and \1 left; Smithson stays with \5\. 3\d{3} \d{6} \d{5}, 3\d{14}, 6\d{3} \d{4} \d{4} \d{4} \d{3}; "
        r"2\d{3}:[a-f]{2}\d::\d[a-f]\d[a-f]:\d{3}:\d{4} or fe80::\d; ([0-9a-f]{200}) ([0-9A-F]{200}); std::map 12:30:45 2024-01-02"
    )
    new = got[0].text
    match = re.fullmatch(shape, new)
    assert match, new
    assert match[10] == match[11].lower() != token
    gone = "123-4567 555.1234 555-0199 7946 John Michael Tolk Jane Doe Ludwig Beeth Brien 822463 8a2e".split()
    assert not [x for x in gone if x in new] and " Smith " not in new and " Smith'" not in new
    assert got[1].text == f"Smith and Jane of another text, Dr. {match[5]}" and got[0].n_replaced == 20


def test_surrogates_of_one_person_agree(spark):
    """Whatever the title, over texts, and by independent counting: names map one to one."""
    pick = random.Random(6)
    given, sur = ["Jane", "Ann", "John", "Kim", "Élise", "Иван", "Ελένη"], ["Doe", "Smith", "O'Brien", "Иванов", "Παπαδόπουλος"]
    titles = {"Jane": ["Mrs", "Dr.", "Prof."], "Ann": ["Ms", "Miss"], "John": ["Mr", "Dr."], "Kim": ["Dr.", "Mr", "Mrs"], "Élise": ["Mme"], "Иван": ["Господин"], "Ελένη": ["Κυρία", "Dr."]}
    people = [(pick.choice(titles[g]), g, pick.choice(sur)) for g in given for _ in range(12)]
    texts = ["; ".join(f"{t} {g} {s}" for t, g, s in people[a : a + 4]) for a in range(0, len(people), 4)]
    got = sorted(surrogates.replace_entities(table(spark, texts), "k").collect(), key=lambda r: r.doc_id)
    maps = collections.defaultdict(set)
    for (t, g, s), new in zip(people, "; ".join(r.text for r in got).split("; ")):
        title, *name = new.split(" ")
        assert title == t and len(name) == 2
        maps["given", g].add(name[0])
        maps["sur", s].add(name[1])
    assert {len(v) for v in maps.values()} == {1}
    for kind in ("given", "sur"):
        new = [min(v) for k, v in maps.items() if k[0] == kind]
        assert len(set(new)) == len(new) and not {x.lower() for x in new} & {x.lower() for x in (*given, *sur)}
    assert re.search("(a|ia)$", min(maps["given", "Jane"])) and re.search("[nrsl]$", min(maps["given", "John"]))
    assert re.search("[nrsl]$|[aeiou]$", min(maps["given", "Kim"])) and re.fullmatch("[Α-Ωα-ω]+", min(maps["given", "Ελένη"]))
    assert re.fullmatch("[Α-Ωα-ω]+", min(maps["sur", "Παπαδόπουλος"])) and re.fullmatch("[А-Яа-я]+", min(maps["given", "Иван"]))


def test_no_letter_of_an_address_survives_in_any_script(spark):
    names = ["ελένη", "東京太郎", "さくら", "サクラ", "محمد", "משה", "राम", "김철수", "สมชาย", "ნინო", "արամ", "jürgen", "иван", "x" * 90]
    texts = [f"write to {n}.{n}@{n}.mail.example now" for n in names]
    got = sorted(surrogates.replace_entities(table(spark, texts), "k").collect(), key=lambda r: r.doc_id)
    for name, r in zip(names, got):
        local, domain = re.fullmatch(r"write to (\S+)@(\S+) now", r.text).groups()
        assert r.n_replaced == 1 and name not in r.text and domain.endswith(".example") and not domain.startswith(name)
        # by chance alone, few places keep their letter
        assert sum(a == b for a, b in zip(local, f"{name}.{name}")) - 1 <= len(local) // 3


def test_surrogates_stay_distinct(spark):
    """A thousand numbers of three free digits each must use every surrogate once."""
    numbers = [f"+1 (55) 00{i:02d}-00{j:02d}" for i in range(0, 99, 3) for j in range(0, 99, 3)]
    got = surrogates.replace_entities(table(spark, numbers), "k").collect()
    assert len({r.text for r in got}) == len(numbers) and not {r.text for r in got} & set(numbers)


@pytest.mark.parametrize("tries", [1, 3])
def test_surrogates_of_full_forms(spark, monkeypatch, tries):
    """Forms whose every value is in use, nearly all, or one, after few random rounds."""
    monkeypatch.setattr(surrogates, "TRIES", tries)
    monkeypatch.setattr(surrogates, "TRIES_BESIDE_ENTITIES", 0)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [("email", f"{c}@full.example.com") for c in letters] + [("email", f"{c}@most.example.org") for c in letters[:24]]
    rows += [("email", f"{a}{b}@two.example.net") for a in letters for b in letters[:25]]
    rows += [("ip6", f"::{d}") for d in range(10)] + [("ip6", "fe80::1"), ("surname", "smith"), ("card", "4111111111111111")]
    rows += [("ip", f"192.168.7.{d}") for d in range(256)] + [("initial", "j.")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "type string, canonical string, n_rows long")
    table = stage(table, "entities")
    got = [(r.type, r.canonical, r.surrogate) for r in surrogates.assign(table, "k").collect()]
    assert sorted(g[:2] for g in got) == sorted(rows)
    assert len({(t, s) for t, _, s in got if t != "initial"}) == len(rows) - 1
    assert not [g for g in got if g[1] == g[2]]
    assert {len(s) for _, c, s in got if c.endswith("@full.example.com")} == {len("a@full.example.com")}


# ---------------------------------------------------------------- toxicity


def test_toxicity(spark, empty):
    rng = random.Random(2)
    clean = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        text = rng.choices(clean, k=rng.randint(5, 60))
        if i % 4 == 0:
            text[rng.randrange(len(text))] = rng.choice(["Vile!", "vilest", "nasty,"])
        rows.append((i, " ".join(text), rng.choice(["en", "de", None]), int(i % 4 == 0)))
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    net = toxicity.fit(data.drop("toxic"), data.filter("doc_id % 5 > 0").select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.score(data, net).collect()}
    held = [i for i in got if i % 5 == 0]
    assert sum((got[i].score >= 0.5) == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    swapped = data.withColumn("lang", F.lit("xx")).withColumn("doc_id", -F.col("doc_id")).repartition(3)
    again = {-r.doc_id: r.score for r in toxicity.score(swapped, net).collect()}
    assert again == pytest.approx({i: r.score for i, r in got.items()}, abs=1e-6)
    odd_rows = table(spark, ODD, ODD_IDS)
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd_rows, net).collect())
    assert toxicity.score(empty, net).count() == 0
    flagged = {r.doc_id for r in got.values() if r.flagged}
    assert {r.doc_id for r in toxicity.without_flagged(data, net).collect()} == set(got) - flagged
    untrained = toxicity.fit(data, data.filter("toxic > 1").select("doc_id", "toxic"))
    assert toxicity.without_flagged(data, untrained).count() == 400


def test_toxicity_held_out(spark):
    sf_dir = SF_DIR.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in queries.op6_toxicity(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    toxic = [r.predicted for r in rows if labels[r.doc_id] == 1]
    clean = [r.predicted for r in rows if labels[r.doc_id] == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.02 * len(clean)


# ---------------------------------------------------------------- benchmark passages


def brute_leaks(docs, items, width=5):
    def cut(text):
        return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())

    found = set()
    for doc_id, text in docs:
        w = cut(text)
        for item_id, passage in items:
            own = cut(passage)
            if not own:
                continue
            k = min(width, len(own))
            shingles = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            want = collections.Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
            if not want.keys() & set(shingles):
                continue
            for s in range(len(shingles)):
                have = collections.Counter(shingles[s : s + len(own) - k + 1])
                if 5 * sum((want & have).values()) >= 4 * sum((want | have).values()):
                    found.add((doc_id, item_id))
                    break
    return found


def test_leaks(spark, documents):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(documents, items).collect()}
    want = brute_leaks([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and got


def test_changed_leaks(spark, odd, empty):
    rng = random.Random(8)
    passages = [" ".join(f"b{rng.randrange(60)}" for _ in range(n)) for n in (1, 3, 5, 20, 40, 40, 41)]
    texts = []
    for i in range(120):
        text = rng.choice(passages).split()
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = "changed"
        around = [f"a{rng.randrange(90)}" for _ in range(30)]
        texts.append(", ".join([*around[: rng.randrange(30)], *text, *around[: rng.randrange(30)]]).upper())
    docs, items = table(spark, texts), spark.createDataFrame([*enumerate(passages), (50, None), (51, ""), (None, "solo words")], "item_id long, text string")
    got = decontamination.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute_leaks(list(enumerate(texts)), list(enumerate(passages)))
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert decontamination.find_leaks(odd, items).count() == 0
    assert decontamination.find_leaks(empty, items).count() == decontamination.find_leaks(docs, items.limit(0)).count() == 0


# ---------------------------------------------------------------- neighbours


def test_pigeonhole():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 256, (500, 4), dtype=np.uint8)
    index = neighbours.MultiIndex(codes)
    for radius in (0, 1, 3, 7, 12, 32):
        assert sum(e + 1 for e in neighbours.allowed_errors(radius, 4)) == radius + 1 or radius == 32
        want = np.flatnonzero(np.unpackbits(codes ^ codes[0], axis=1).sum(axis=1) <= radius)
        assert (index.within(codes[0], radius) == want).all()


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, code int")


def test_neighbours_recall(spark):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(3000, 24)).astype(np.float32)
    data[1000:1040] = data[0]
    table_ = vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)])
    index, coder = neighbours.build_index(table_)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(index, coder, index.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    unit = data.astype(float) / np.linalg.norm(data.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        scores = unit @ unit[q]
        scores[q] = -2
        best = sorted(range(3000), key=lambda i: (-round(scores[i], 12), i))[:5]
        hits += len(set(best) & {v for v, _ in got[q]})
        assert len(got[q]) == 5 and all(abs(scores[v] - s) < 1e-9 for v, s in got[q])
    assert hits >= 0.9 * 300
    assert [v for v, _ in got[0]] == [1000, 1001, 1002, 1003, 1004]


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0])]
    index, coder = neighbours.build_index(vectors(spark, rows))
    got = sorted(map(tuple, neighbours.nearest(index, coder, index.filter("vec_id % 50 = 0")).collect()))
    assert got == [(0, 1, 1, 1.0), (0, 2, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 1, 0.0)]
    index, coder = neighbours.build_index(vectors(spark, []))
    assert neighbours.nearest(index, coder, index).count() == 0


# ---------------------------------------------------------------- contract, pipeline


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    same, note = check.compare(spark, check.oracle_connection(SF_DIR), SF_DIR, name)
    assert same, note


def test_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names


def test_pipeline(spark, documents):
    import corpus_pipeline

    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    docs = documents
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs.collect(), function(spark, docs, SF_DIR)
        after = {r.doc_id: r for r in docs.collect()}
        if name == "near_duplicates":
            want = {i for i, (_, _, kept) in brute_near_duplicates(before, 5).items() if kept}
            assert after.keys() == want
        elif name == "decontamination":
            leaking = {d for d, _ in brute_leaks([(r.doc_id, r.text) for r in before], [(r.item_id, r.text) for r in items])}
            assert after.keys() == {r.doc_id for r in before} - leaking
        elif name == "private_data":
            assert after.keys() == {r.doc_id for r in before}
            assert not any(re.search(r"@mail\d\.example\.com", r.text) for r in after.values())
        elif name == "bpe":
            assert after.keys() == {r.doc_id for r in before}
        if name != "bpe":
            assert docs.schema.names == documents.schema.names
        docs = stage(docs, "test")


def test_pipeline_of_odd_rows(spark, odd, empty):
    import corpus_pipeline

    for start in (odd, empty):
        docs = start
        for _, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, SF_DIR), "test")
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TASK_ROWS", 60)
    said = "the cat sat on a mat and the dog ran home to eat while rain fell"

    def text(i):
        bad = "" if i % 4 else " you vile zorkhead" if i < 40 else " you wretched quimble"
        return f"{said} w{i % 29}{bad}"

    # no word of the later toxic texts is among the first ids
    rows = [(i, text(i), "en", int(i % 4 == 0)) for i in range(1200)]
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "calibrate", lambda counts, f=toxicity.calibrate: seen.extend(counts) or f(counts))
    net = toxicity.fit(data.drop("toxic"), data.select("doc_id", "toxic"), first=20)
    assert sum(n for _, _, n, _ in seen) == 1200
    assert sum(n for _, toxic, n, _ in seen if toxic) == 300
    got = toxicity.score(data, net).join(data, "doc_id").groupBy("toxic").agg({"score": "avg"}).collect()
    mean = {r[0]: r[1] for r in got}
    assert mean[1] > 0.7 > 0.3 > mean[0]
