"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word is a run of letters, digits and other non-ASCII characters, lower-cased in A-Z.  It has
the sum of three rows of an embedding table: one picked by the hash of the word and two by the
hashes of its first bytes, so that unseen forms of a known stem are known too.  Filters of
widths 1, 2 and 3 slide over the words, each filter's largest value in a text is kept, and a
logistic layer makes the score.  Scores see nothing but the text.

The net is trained in numpy on all labelled texts; gradients pass only through the places of the
largest values.  It starts with several passes over the texts of at most ``FIRST`` ids, all toxic ones
up to half of them.  All other labelled texts are dealt into ``ROUNDS`` parts.  In each round tasks take
one pass over the texts of a part, each task from the net so far, and their nets are averaged.
Scoring runs in the tasks over all texts, whole.  Thresholds for decisions are calibrated by
language on all labelled texts, each scored by a net that has not seen it; scores do not depend on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.shipping import ship
from lexspark.llm.words import LOWER, NOT_ALNUM, Words, word_groups
from lexspark.session import release, stage

FIRST = 6000  # ids
REPEATED = 8  # rows of an id among these at most
ROUNDS = 6
TASK_ROWS, TASKS, GROUP = 3000, 64, 2048  # in a round: rows of a task, tasks at most, rows in memory
SLICES = 16
BUCKETS, WIDTH = 1 << 16, 12
WIDTHS, FILTERS = (1, 2, 3), 8
STEMS = (4, 6)  # bytes
PAD = max(WIDTHS) - 1
EPOCHS, BATCH, RATE, LATER_RATE = 8, 64, 0.02, 0.005
GRID = np.round(np.arange(0.1, 0.91, 0.05), 2)  # thresholds


def features(words: Words) -> np.ndarray:
    """The table rows of each word, one column per kind of hash; row 0 is kept for no word."""
    ends = [words.end, *(np.minimum(words.start + n, words.end) for n in STEMS)]
    out = np.empty((len(words.start), len(ends)), np.int32)
    for k, end in enumerate(ends):
        out[:, k] = 1 + (words.hash_spans(words.start, end) >> np.uint64(7 + 3 * k)) % np.uint64(BUCKETS - 1)
    return out


def padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each followed by ``PAD`` places without a word, and where
    they begin."""
    n = len(first) - 1
    out = np.zeros((len(rows) + PAD * n, rows.shape[1]), np.int32)
    text = np.repeat(np.arange(n), np.diff(first))
    out[np.arange(len(rows)) + PAD * text] = rows
    return out, first + PAD * np.arange(n + 1)


@dataclass
class Net:
    table: np.ndarray  # (BUCKETS, WIDTH)
    filters: list[np.ndarray]  # of width w: (w * WIDTH, FILTERS)
    out: np.ndarray
    bias: float
    thresholds: dict[str, float]

    def pooled(self, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The words' vectors, and for each text the largest value of each filter."""
        x = self.table[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            x += self.table[rows[:, k]]
        maxima, values = [], []
        # windows begin at words; a text without words has one, of no words
        ends = np.maximum(first[1:] - PAD, first[:-1] + 1)
        spans = np.stack([first[:-1], ends], axis=1).ravel()
        for w, weights in zip(WIDTHS, self.filters):
            y = np.zeros((len(x), FILTERS), np.float32)
            for j in range(w):
                y[: len(x) - j] += x[j:] @ weights[j * WIDTH : (j + 1) * WIDTH]
            values.append(y)
            maxima.append(np.maximum.reduceat(y, np.minimum(spans, len(y) - 1), axis=0)[::2])
        return x, np.concatenate(maxima, axis=1), values

    def scores(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        _, best, _ = self.pooled(rows, first)
        return 1 / (1 + np.exp(-np.clip(np.maximum(best, 0).astype(np.float64) @ self.out + self.bias, -30, 30)))


    def limits(self, langs: pa.Array) -> np.ndarray:
        return np.array([self.thresholds.get(x, self.thresholds[None]) for x in langs.to_pylist()], float)


def score_words(net: Net, words: Words) -> np.ndarray:
    """Scores of a group of texts, some at a time."""
    rows, first = padded(features(words), words.first)
    out = np.empty(words.texts)
    at = 0
    while at < words.texts:
        end = max(at + 1, int(np.searchsorted(first, first[at] + 100_000, "right")) - 1)
        out[at:end] = net.scores(rows[first[at] : first[end]], first[at : end + 1] - first[at])
        at = end
    return out


def train(
    texts: list[np.ndarray],
    labels: np.ndarray,
    seed: int = 7,
    net: Net | None = None,
    epochs: int = EPOCHS,
    rate: float = RATE,
    toxic_share: float | None = None,
) -> Net:
    """Fit a net to the feature rows of texts with labels 0 and 1, by Adam on single steps of
    ``BATCH`` texts; of the table only the rows in use are moved.  ``net`` is trained further, in place.
    Both labels weigh the same where ``toxic_share`` of the texts, by default of these, are toxic."""
    rng = np.random.default_rng(seed)
    if net is None:
        net = Net(
            rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32),
            [rng.normal(0, 0.3, (w * WIDTH, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.full(FILTERS * len(WIDTHS), 0.3),
            -1.0,
            {},
        )
        net.table[0] = 0
    if toxic_share is None:
        weights = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    else:
        weights = np.where(labels == 1, 0.5 / max(1e-6, toxic_share), 0.5 / max(1e-6, 1 - toxic_share))
    dense = [*net.filters, net.out, np.array([net.bias])]
    m, v = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    table_m, table_v = np.zeros_like(net.table), np.zeros_like(net.table)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            chosen = order[a : a + BATCH]
            first = np.concatenate(([0], np.cumsum([len(texts[i]) for i in chosen])))
            rows, first = padded(np.concatenate([texts[i] for i in chosen]).reshape(-1, 1 + len(STEMS)), first)
            rows = np.where(rng.random(rows.shape) < 0.1, 0, rows)  # some features are left out
            x, best, values = net.pooled(rows, first)
            hidden = np.maximum(best, 0)
            score = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.bias, -30, 30)))
            slope = (score - labels[chosen]) * weights[chosen] / len(chosen)
            grads = [None] * len(WIDTHS)
            moved = np.zeros_like(x)
            back = slope[:, None] * net.out[None, :] * (best > 0)
            for k, w in enumerate(WIDTHS):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                spans = zip(first[:-1], np.maximum(first[1:] - PAD, first[:-1] + 1))
                at = np.stack([a + values[k][a:b].argmax(axis=0) for a, b in spans])
                place = np.minimum(at[:, :, None] + np.arange(w), len(x) - 1)
                grads[k] = np.einsum("tf,tfd->df", own, x[place].reshape(*own.shape, -1)).astype(np.float32)
                t, f = np.nonzero(own)
                shares = own[t, f][:, None, None] * net.filters[k].T.reshape(FILTERS, w, WIDTH)[f]
                np.add.at(moved, place[t, f], shares.astype(np.float32))
            step += 1
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, mm, vv in zip(dense, [*grads, hidden.T @ slope, np.array([slope.sum()])], m, v):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                p -= (rate * fix * mm / (np.sqrt(vv) + 1e-8)).astype(p.dtype)
            net.bias = float(dense[-1][0])
            hit = np.flatnonzero(moved.any(axis=1))
            used = np.unique(rows[hit])
            used = used[used > 0]
            total = np.zeros((len(used), WIDTH), np.float32)
            for k in range(rows.shape[1]):
                own = rows[hit, k]
                keep = own > 0
                np.add.at(total, np.searchsorted(used, own[keep]), moved[hit][keep])
            table_m[used] += 0.1 * (total - table_m[used])
            table_v[used] += 0.001 * (total * total - table_v[used])
            net.table[used] -= rate * fix * table_m[used] / (np.sqrt(table_v[used]) + 1e-8)
    return net


def errors(scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How often each threshold of ``GRID`` errs."""
    return ((scores[:, None] >= GRID) != (labels[:, None] == 1)).sum(axis=0)


def calibrate(counts: list[tuple]) -> dict:
    """For each language, of rows ``(lang, toxic, n, errors)``, the threshold between 0.1 and 0.9 that errs
    least, the nearest to 0.5 among equals; none for a language without both labels."""
    total: dict = {}
    for lang, toxic, _, wrong in counts:
        if lang is not None:
            total.setdefault(lang, {}).setdefault(toxic, np.zeros(len(GRID), np.int64))
            total[lang][toxic] += np.array(wrong)
    return {
        lang: float(min(zip(sum(own.values()).tolist(), np.abs(GRID - 0.5), GRID))[2]) for lang, own in total.items() if len(own) == 2
    }


def count_errors(scores: np.ndarray, labels: np.ndarray, langs: list) -> list[tuple]:
    """``(lang, toxic, n, errors)`` of some rows."""
    out = []
    for lang, toxic in sorted({*zip(langs, labels.tolist())}, key=str):
        own = np.array([x == lang for x in langs]) & (labels == toxic)
        out.append((lang, toxic, int(own.sum()), errors(scores[own], labels[own]).tolist()))
    return out


def score_texts(net: Net, texts: list[np.ndarray]) -> np.ndarray:
    out = []
    for a in range(0, len(texts), BATCH):
        some = texts[a : a + BATCH]
        first = np.concatenate(([0], np.cumsum([len(t) for t in some])))
        out.append(net.scores(*padded(np.concatenate(some), first)))
    return np.concatenate(out)


def flat(net: Net) -> np.ndarray:
    """All parameters in one row, the table last."""
    return np.concatenate([np.append(net.out, net.bias), *(f.ravel() for f in net.filters), net.table.ravel()]).astype(np.float32)


def unflat(values: np.ndarray) -> Net:
    at = FILTERS * len(WIDTHS)
    out, bias, filters, values = values[:at].astype(float), float(values[at]), [], values[at + 1 :]
    for w in WIDTHS:
        size = w * WIDTH * FILTERS
        filters.append(values[:size].reshape(-1, FILTERS).copy())
        values = values[size:]
    return Net(values.reshape(BUCKETS, WIDTH).copy(), filters, out, bias, {})


def moves(start: np.ndarray, end: np.ndarray) -> bytes:
    """Which of up to 65,536 parameters were moved, and how far, in half precision."""
    changed = np.flatnonzero(end != start)
    return changed.astype("<u2").tobytes() + (end[changed] - start[changed]).astype("<f2").tobytes()


def merge(start: np.ndarray, moved: list[bytes], weights: list[int]) -> np.ndarray:
    """``start`` with the average of the ``moves`` of nets that began there; a parameter that some of them
    have not moved goes with the average of the others."""
    far, total = np.zeros(len(start)), np.zeros(len(start))
    for each, weight in zip(moved, weights):
        half = len(each) // 2
        changed = np.frombuffer(each[:half], "<u2")
        far[changed] += weight * np.frombuffer(each[half:], "<f2").astype(float)
        total[changed] += weight
    return (start + far / np.maximum(total, 1)).astype(np.float32)


FEATURES = "features binary, lang string, toxic int"
LEARNT = "slice int, n long, net binary, lang string, toxic int, errors array<long>"
LEARNT_NAMES = ["slice", "n", "net", "lang", "toxic", "errors"]


def feature_rows(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, "<i4").reshape(-1, 1 + len(STEMS))


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, words in word_groups(batch.column(0), NOT_ALNUM, LOWER):
            rows = features(words)
            own = [rows[a:b].astype("<i4").tobytes() for a, b in zip(words.first, words.first[1:])]
            part = batch.slice(first, words.texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.binary()), part.column(1), part.column(2)], names=["features", "lang", "toxic"]
            )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    first: int = FIRST,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
) -> Net:
    """Train on all rows of ``docs`` that ``labels`` has a label of 0 or 1 for, by ``id``.

    Training begins with at most ``first`` ids, chosen by a hash of the id: toxic ones up to half of
    them, then clean ones; these ids are broadcast and the feature rows come to the driver.  The
    others follow in ``ROUNDS`` rounds (``_round``), in each of which a part of the texts is shuffled to its
    labels.  Rows without id or label are left out.  Without any label the net is untrained and
    nothing is over a threshold of 1.
    """
    ship(docs.sparkSession)
    known = docs.select(F.col(id).cast("long").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    rows = labels.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("toxic"))
    rows = stage(rows.filter(F.col("toxic").isin(0, 1)).distinct().join(known, "id"), "labelled")
    by_hash = [F.xxhash64("id", F.lit(11)), F.col("id")]
    few = rows.filter(F.col("n") <= REPEATED)
    toxic = few.filter("toxic = 1").orderBy(*by_hash).limit(first // 2)
    clean = few.filter("toxic = 0").orderBy(*by_hash).limit(first - first // 2)
    chosen = stage(toxic.unionByName(clean).select("id", "toxic"), "first")
    texts = docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    labelled = texts.join(F.broadcast(chosen), "id")
    found = labelled.select("text", "lang", "toxic").mapInArrow(feature_batches, FEATURES).collect()
    found.sort(key=lambda r: (r.features, r.lang or "", r.toxic))
    own, truth, langs = [feature_rows(r.features) for r in found], np.array([r.toxic for r in found], np.int64), [r.lang for r in found]
    net, counts = train(own, truth), []
    half = np.random.default_rng(5).random(len(found)) < 0.5
    for part in (half, ~half):
        if part.any() and not part.all():
            other = train([t for t, h in zip(own, part) if not h], truth[~part])
            scores = score_texts(other, [t for t, h in zip(own, part) if h])
            counts += count_errors(scores, truth[part], [x for x, h in zip(langs, part) if h])
    rest = stage(rows.join(F.broadcast(chosen), ["id", "toxic"], "left_anti"), "later")
    sizes = rest.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")).first()
    for k in range(ROUNDS if sizes.n else 0):
        net, seen = _round(texts, rest, net, k, sizes.n, sizes.toxic / sizes.n)
        counts += seen
    release(rows, chosen, rest)
    net.thresholds = {None: 0.5 if len(found) or sizes.n else 1.1} | calibrate(counts)
    return net


def _round(texts: DataFrame, rest: DataFrame, net: Net, k: int, n: int, toxic_share: float) -> tuple[Net, list[tuple]]:
    """The net after one pass over part ``k`` of the labelled rows ``rest``, and the counts of errors of the
    net before.

    Tasks hold ``GROUP`` texts at a time.  A task hands on what it moved of the net in ``SLICES`` pieces, and
    these are averaged piece by piece, so what moves is bounded by ``TASKS`` nets; one comes to the driver.
    """
    spark = texts.sparkSession
    tasks = int(min(TASKS, max(1, n // (ROUNDS * TASK_ROWS))))
    part = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(ROUNDS)) == k
    asked = rest.filter(part).select("id", "toxic").repartition(tasks, "id")
    met = texts.filter(part).repartition(tasks, "id").join(asked.hint("merge"), "id")
    # the same order in every run
    rows = met.sortWithinPartitions("id", "text", "lang", "toxic").select("text", "lang", "toxic")
    shared = spark.sparkContext.broadcast(flat(net))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        before, local, counts, held, done = unflat(start), None, [], [], 0

        def step() -> None:
            nonlocal local, done
            own, truth = [feature_rows(f) for f, _, _ in held], np.array([t for _, _, t in held], np.int64)
            counts.extend(count_errors(score_texts(before, own), truth, [x for _, x, _ in held]))
            local = train(own, truth, 7 + done, local or unflat(start), 1, LATER_RATE, toxic_share)
            done += len(held)
            held.clear()

        for batch in feature_batches(batches):
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held.append(row)
                if len(held) >= GROUP:
                    step()
        if held:
            step()
        if local is None:
            return
        pieces = zip(np.array_split(start, SLICES), np.array_split(flat(local), SLICES))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([done] * SLICES, pa.int64()), pa.array([moves(*p) for p in pieces], pa.binary())]
            + [pa.nulls(SLICES, t) for t in (pa.string(), pa.int32(), pa.list_(pa.int64()))],
            names=LEARNT_NAMES,
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([SLICES] * len(counts), pa.int32()), pa.array([c[2] for c in counts], pa.int64()), pa.nulls(len(counts), pa.binary())]
            + [pa.array([c[0] for c in counts], pa.string()), pa.array([c[1] for c in counts], pa.int32())]
            + [pa.array([c[3] for c in counts], pa.list_(pa.int64()))],
            names=LEARNT_NAMES,
        )

    def gather(group: pa.Table) -> pa.Table:
        k = group.column("slice")[0].as_py()
        if k == SLICES:
            total: dict = {}
            for lang, toxic, n, wrong in zip(*(group.column(c).to_pylist() for c in ("lang", "toxic", "n", "errors"))):
                total[lang, toxic] = total.get((lang, toxic), 0) + np.array([n, *wrong])
            out = [(k, int(v[0]), None, lang, toxic, v[1:].tolist()) for (lang, toxic), v in total.items()]
        else:
            start = np.array_split(shared.value, SLICES)[k]
            moved = sorted(zip(group.column("n").to_pylist(), group.column("net").to_pylist()))
            merged = merge(start, [m for _, m in moved], [w for w, _ in moved])
            out = [(k, sum(w for w, _ in moved), merged.tobytes(), None, None, None)]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=LEARNT_NAMES)

    learnt = rows.mapInArrow(learn, LEARNT).groupBy("slice").applyInArrow(gather, LEARNT).collect()
    pieces = {r.slice: np.frombuffer(r.net, np.float32) for r in learnt if r.slice < SLICES}
    if pieces:
        net = unflat(np.concatenate([pieces[i] for i in range(SLICES)]))
    return net, [(r.lang, r.toxic, r.n, r.errors) for r in learnt if r.slice == SLICES]


def score(docs: DataFrame, net: Net, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(doc_id, score, flagged)`` for each row: the score of the text, and whether it reaches
    the threshold of the row's language (that of no language if it is unknown or null).

    Null, empty and wordless texts get the score of no words.  Rows with a null or repeated id
    are scored like any other; an empty table gives an empty table; other columns are ignored.
    The net, of a fixed size of about 3 MB, is broadcast.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(net)
    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in parts:
            for first, words in word_groups(batch.column(1), NOT_ALNUM, LOWER):
                found = score_words(own, words)
                part = batch.slice(first, words.texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found), pa.array(found >= own.limits(part.column(2)))], names=["doc_id", "score", "flagged"]
                )

    return rows.mapInArrow(batches, "doc_id long, score double, flagged boolean")


def without_flagged(docs: DataFrame, net: Net, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, whose text stays below the threshold of its language."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(net)
    columns = docs.columns
    at_text, at_lang = columns.index(text), columns.index(lang)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in parts:
            for first, words in word_groups(batch.column(at_text), NOT_ALNUM, LOWER):
                part = batch.slice(first, words.texts)
                yield part.filter(pa.array(score_words(own, words) < own.limits(part.column(at_lang))))

    return docs.mapInArrow(batches, docs.schema)
