"""Tokens, term counts and the statistics made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.porter import with_stem
from lexspark.functions.text import chunk_words, clean_word, has_letters, raw_words, title_key, title_words
from lexspark.operators.stems import stems_of
from lexspark.session import TEXT_CODEC, stage

CROWDED = 1000  # rows of one document
TASK_BYTES = 8 << 20
PART_BITS = 12  # of a line's number: as many lines of a title are put together at most
MARK = "\x00"


def tokens(chunks: DataFrame, keep_empty: bool = False) -> DataFrame:
    """``(doc, term)``: one row per token of ``chunks(doc, chunk)``, cleaned lines, or of
    ``chunks(doc, text)``, whole texts.

    With ``keep_empty`` a place without a token is kept as a null term, so that a document
    whose lines hold no token at all still counts as a document.

    The words are split inside ``explode``: of a column split before, Spark would test the
    size in a filter of its own, and split every text once more for it.
    """
    word = F.col("word")
    if "text" in chunks.columns:
        cut = chunks.select("doc", F.explode(raw_words(F.col("text"))).alias("word"))
        kept, term = has_letters(word), clean_word(word)
    else:
        cut = chunks.select("doc", F.explode(chunk_words(F.col("chunk"))).alias("word"))
        kept, term = word != "", word
    if keep_empty:
        return cut.select("doc", F.when(kept, term).alias("term"))
    return cut.filter(kept).select("doc", term.alias("term"))


def by_document(chunks: DataFrame) -> DataFrame:
    """``chunks(doc, text)`` dealt by document, so that its terms are counted, and the counts added up, where
    its text is: the text is shuffled, which is smaller than its counts.

    A task has about ``TASK_BYTES`` of text, as its counts, which lie in memory, are many times that.
    Not where an id, or null, has more than ``CROWDED`` rows: its counts are combined first, then.
    """
    if "text" not in chunks.columns:
        return chunks
    sizes = chunks.groupBy("doc").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    seen = sizes.agg(F.max("n").alias("most"), F.sum("size").alias("size")).first()
    if (seen.most or 0) > CROWDED:
        return chunks
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    return chunks.repartition(max(cores, (seen.size or 0) // TASK_BYTES), "doc")


def pack_words(rows: DataFrame, words: str) -> DataFrame:
    """``rows`` with their array ``words`` counted: ``dl``, how many there are, and ``terms``, an array of
    ``(term, tf)`` in the order of terms, each term once.  Null words make one term, null, that counts 0.

    The words of a row are sorted and cut where they change: nothing is shuffled, and no task holds more than a row.
    """
    rows = rows.withColumn("__words", F.coalesce(F.sort_array(words), F.array().cast("array<string>"))).drop(words)
    sorted_words, n = F.col("__words"), F.size("__words")

    def begins(i):
        return (i == 0) | ~F.get(sorted_words, i).eqNullSafe(F.get(sorted_words, i - 1))

    rows = rows.withColumn("__starts", F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), begins)).otherwise(F.array().cast("array<int>")))

    has_null = F.get(sorted_words, F.lit(0)).isNull()

    def count(start, place):
        end = F.coalesce(F.get("__starts", place + 1), n)
        return F.when((start == 0) & has_null, 0).otherwise(end - start).cast("long")

    rows = rows.withColumn("term", F.array_distinct(sorted_words)).withColumn("tf", F.transform("__starts", count))
    rows = rows.withColumn("terms", F.arrays_zip("term", "tf")).drop("term", "tf")
    nulls = F.when((n > 0) & F.get(sorted_words, F.lit(0)).isNull(), F.coalesce(F.get("__starts", F.lit(1)), n)).otherwise(0)
    return rows.withColumn("dl", (n - nulls).cast("long")).drop("__words", "__starts")


def cleaned_words(raw: Column, keep_empty: bool) -> Column:
    """An array of raw words as terms; what nothing is left of is null or, without ``keep_empty``, dropped."""
    terms = F.transform(raw, clean_word)
    return F.transform(terms, lambda w: F.nullif(w, F.lit(""))) if keep_empty else F.filter(terms, lambda w: w != "")


def packed_texts(chunks: DataFrame, keep_empty: bool = False) -> DataFrame:
    """``(doc, dl, terms)`` of ``chunks(doc, text)``: each row counted by itself."""
    words = chunks.select("doc", cleaned_words(raw_words(F.col("text")), keep_empty).alias("words"))
    return pack_words(words, "words").select("doc", "dl", "terms")


def unpacked(packed: DataFrame) -> DataFrame:
    """``(doc, term, tf)`` of ``(doc, .., terms)``.  (Of a plain ``explode`` Spark would test the size in a filter of
    its own, and count every text once more for it.)"""
    entries = packed.select("doc", F.explode_outer("terms").alias("entry")).filter(F.col("entry").isNotNull())
    return entries.select("doc", "entry.term", "entry.tf")


def repeated_docs(rows: DataFrame) -> DataFrame:
    """``(doc)``, stored: the ids that have more than one row."""
    sizes = rows.groupBy("doc").agg(F.count("*").alias("n"))
    return stage(sizes.filter((F.col("n") > 1) & F.col("doc").isNotNull()).select("doc"), "repeated")


def rows_of_docs(rows: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose id has no other row, and the rest, null ids among them."""
    known = rows.filter(F.col("doc").isNotNull())
    rest = known.join(repeated, "doc", "left_semi").unionByName(rows.filter(F.col("doc").isNull()))
    return known.join(repeated, "doc", "left_anti"), rest


def one_by_one(counts: DataFrame) -> DataFrame:
    """``(doc, dl, terms)`` of counts, added up, one row per document and term: no document has to fit into a row."""
    return as_entries(with_document_length(counts))


def as_entries(counts: DataFrame) -> DataFrame:
    """``(doc, dl, terms)`` of counts with their ``dl``, one row per document and term."""
    entry = F.array(F.struct("term", F.col("tf").cast("long").alias("tf")))
    return counts.select("doc", F.col("dl").cast("long").alias("dl"), entry.alias("terms"))


def dealt_texts(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to tasks of about ``TASK_BYTES`` of their column ``text``, so that what a task combines of their
    counts does not grow with the input.  Texts are dealt, not counts: they are smaller."""
    size = rows.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    return rows.repartition(max(1, size // TASK_BYTES))


def document_counts(chunks: DataFrame, keep_empty: bool = False) -> DataFrame:
    """``(doc, dl, terms)`` of ``chunks(doc, text)``: ``terms`` an array of ``(term, tf)``, ``dl`` the length of the whole
    document.  Store it before a filter.

    A document of one row is counted where it is read, and is one row.  One whose id, or null, comes again
    has its counts added up, and one row per term; a row without a term has an empty array.
    """
    once, rest = rows_of_docs(chunks, repeated_docs(chunks))
    counts = add_counts(unpacked(packed_texts(dealt_texts(rest), keep_empty)))
    return packed_texts(once, keep_empty).unionByName(one_by_one(counts))


def title_texts(chunks: DataFrame) -> DataFrame:
    """``(doc, title_line, text)``, stored: the chunks under a title line put together, in parts of 2 ** ``PART_BITS`` lines
    of a file at most.  ``chunks`` has ``file``, ``block_start`` and ``line_id``; ``doc`` is the title's key.  Chunks that
    have their ``run``, in which there are whole parts, are put together where it is, without a shuffle."""
    part = F.shiftright("line_id", PART_BITS).alias("part")
    text = F.array_join(F.collect_list("chunk"), " ").alias("text")
    place = [c for c in ("title_line", "file", "block_start", "run") if c in chunks.columns]
    texts = stage(chunks.groupBy(*place, part).agg(text).select("title_line", "text"), "title_texts", TEXT_CODEC)
    return by_title_key(texts.withColumn("doc", F.col("title_line"))).select("doc", "title_line", "text")


def _not_empty(words: Column) -> Column:
    return F.filter(words, lambda w: w != "")


def packed_parts(texts: DataFrame) -> DataFrame:
    """``(doc, dl, terms)`` of each of ``title_texts``, without the words of titles."""
    words = texts.select("doc", _not_empty(chunk_words(F.col("text"))).alias("words"))
    return pack_words(words, "words").select("doc", "dl", "terms")


def packed_titles(texts: DataFrame) -> DataFrame:
    """``(doc, dl, terms)`` of the words of each title line, as written; equal lines count once."""
    titles = texts.select("doc", "title_line").distinct()
    words = titles.select("doc", _not_empty(title_words(F.col("title_line"))).alias("words"))
    return pack_words(words, "words").select("doc", "dl", "terms")


def titled_counts(texts: DataFrame) -> DataFrame:
    """As ``document_counts``, of ``title_texts``, the words of title lines included."""
    once, rest = rows_of_docs(texts, repeated_docs(texts))
    both = F.concat(chunk_words(F.col("text")), title_words(F.col("title_line")))
    whole = pack_words(once.select("doc", _not_empty(both).alias("words")), "words").select("doc", "dl", "terms")
    counts = add_counts(unpacked(packed_parts(dealt_texts(rest))), unpacked(packed_titles(rest)))
    return whole.unionByName(one_by_one(counts))


def stemmed_titled_counts(texts: DataFrame) -> DataFrame:
    """``(doc, dl, term, tf)`` of ``title_texts``: words of texts stemmed, those of title lines as written.

    Texts are dealt by document, about ``TASK_BYTES`` to a task, and their words meet their stems and are counted
    there: a text is smaller than its counts.  Rare words, as their stems, and those of titles come to them as rows
    of their own.  Documents with more text than that, of which there are few, are dealt by row instead, and their
    counts are shuffled and added up.
    """
    sizes = stage(texts.groupBy("doc").agg(F.sum(F.octet_length("text")).alias("size")), "text_sizes")
    large = sizes.filter(F.col("size") > TASK_BYTES).select("doc")
    tasks = max(1, (sizes.agg(F.sum("size").alias("size")).first().size or 0) // TASK_BYTES)
    words = tokens(texts.select("doc", F.col("text").alias("chunk")))
    stems = stems_of(words.select("term"))
    titles = texts.select("doc", "title_line").distinct()
    titles = titles.select("doc", F.explode(title_words(F.col("title_line"))).alias("given")).filter("given <> ''")
    none = F.lit(None).cast("string")
    n_words = F.size(F.array_remove(chunk_words(F.col("text")), ""))  # rare words are among them
    rows = texts.select("doc", "text", none.alias("given"), n_words.alias("n"))
    rows = rows.unionByName(titles.select("doc", none.alias("text"), "given", F.lit(1).alias("n")))
    rare = stems.others(words).select("doc", none.alias("text"), F.col("stem").alias("given"), F.lit(0).alias("n"))
    rows = rows.unionByName(rare)

    def counted(dealt: DataFrame, *of_doc: str) -> DataFrame:
        cut = dealt.select("doc", *of_doc, "given", F.explode_outer(chunk_words(F.col("text"))).alias("term"))
        found = stems.known(cut).select("doc", *of_doc, F.coalesce("given", "stem").alias("term"))
        return found.filter(F.col("term").isNotNull()).groupBy("doc", *of_doc, "term").agg(F.count("term").alias("tf"))

    def by_doc(whole: DataFrame) -> DataFrame:
        dealt = whole.repartition(tasks, "doc").withColumn("dl", F.sum("n").over(Window.partitionBy("doc")))
        return counted(dealt, "dl")

    if large.isEmpty():
        return by_doc(rows)
    others = with_document_length(counted(rows.join(F.broadcast(large), "doc").repartition(tasks)))
    return by_doc(rows.join(F.broadcast(large), "doc", "left_anti")).unionByName(others)


def titled_counts_without(texts: DataFrame, stopwords: DataFrame) -> DataFrame:
    """``(doc, term, tf)`` of ``title_texts`` without the listed words, which stay in title lines.

    Where a document is one row, its body's and title's words are counted apart and added up in the row: title words
    have a mark behind them, which no body word has, and come next to the same word of the body."""
    once, rest = rows_of_docs(texts, repeated_docs(texts))
    listed = stopwords.select(F.col("word").alias("term"), F.lit(True).alias("listed")).distinct()
    marked = F.transform(_not_empty(title_words(F.col("title_line"))), lambda w: F.concat(w, F.lit(MARK)))
    words = once.select("doc", F.concat(_not_empty(chunk_words(F.col("text"))), marked).alias("words"))

    def side(entry, place):
        term, tf = entry["term"], entry["tf"]
        is_title, before, after = term.endswith(MARK), F.get("terms", place - 1), F.get("terms", place + 1)
        word = F.substring(term, F.lit(1), F.length(term) - 1)
        body = F.when((before["term"] == word) & ~word.endswith(MARK), before["tf"]).otherwise(0)
        again = F.coalesce(after["term"] == F.concat(term, F.lit(MARK)), F.lit(False))  # it comes with its title's count
        return F.struct(
            F.when(is_title, word).otherwise(term).alias("term"),
            F.when(is_title, body).otherwise(tf).cast("long").alias("body"),
            F.when(is_title, tf).otherwise(0).cast("long").alias("title"),
            (~is_title & again).alias("again"),
        )

    packed = pack_words(words, "words").select("doc", F.transform("terms", side).alias("terms"))
    entries = packed.select("doc", F.explode_outer("terms").alias("entry")).select("doc", "entry.*").filter(~F.col("again"))
    tf = F.col("title") + F.when(F.col("listed"), 0).otherwise(F.col("body"))
    kept = entries.join(listed, "term", "left").select("doc", "term", tf.alias("tf")).filter("tf > 0")
    body = without_stopwords(unpacked(packed_parts(dealt_texts(rest))), stopwords)
    others = add_counts(body, unpacked(packed_titles(rest)))
    return kept.unionByName(others)


def without_stopwords(terms: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Tokens that are not in the list; repeated tokens stay repeated."""
    listed = stopwords.select(F.col("word").alias("term")).distinct()
    return terms.join(listed, "term", "left_anti").select(terms.columns)


def count_terms(terms: DataFrame) -> DataFrame:
    """``(doc, term, tf)``.  Combined before the shuffle; null terms count 0."""
    return terms.groupBy("doc", "term").agg(F.count("term").alias("tf"))


def counts_by_title(chunks: DataFrame) -> DataFrame:
    """Term counts with the whole title line as ``doc``, a null term where a chunk holds a
    place without a token: every title with a chunk is there, and no second pass over the
    text is needed to know the titles."""
    lines = chunks.select(F.col("title_line").alias("doc"), "chunk")
    return count_terms(tokens(lines, keep_empty=True))


def add_counts(*counts: DataFrame) -> DataFrame:
    """Counts of the same document and term added up."""
    return reduce(DataFrame.unionByName, counts).groupBy("doc", "term").agg(F.sum("tf").alias("tf"))


def title_counts(counts: DataFrame) -> DataFrame:
    """``(doc, term, tf)`` of the words of each title line, as written, where ``doc`` is the
    title line: each counts once, however many chunks stand under it."""
    titles = counts.select("doc").distinct()
    return count_terms(
        titles.select("doc", F.explode(title_words(F.col("doc"))).alias("term")).filter("term <> ''")
    )


def by_title_key(counts: DataFrame) -> DataFrame:
    """Counts by title line as counts by document: the bracketed part of the line."""
    return counts.withColumn("doc", title_key(F.col("doc")))


def with_document_length(counts: DataFrame) -> DataFrame:
    """Counts, one row per document and term, with the length ``dl`` of their document; they are in the
    order of documents.  A task sees each of a document's terms once, whatever the size of its text."""
    return counts.withColumn("dl", F.sum("tf").over(Window.partitionBy("doc")))


def document_lengths(counts: DataFrame) -> DataFrame:
    """``(doc, dl, n_terms)``: tokens and distinct terms of each document."""
    return counts.groupBy("doc").agg(F.sum("tf").alias("dl"), F.count("*").alias("n_terms"))


def corpus_stats(doc_lengths: DataFrame) -> DataFrame:
    """One row ``(n_docs, total_len, avg_len)``."""
    return doc_lengths.agg(
        F.count("*").alias("n_docs"), F.sum("dl").alias("total_len"), F.avg("dl").alias("avg_len")
    )


def document_frequency(counts: DataFrame) -> DataFrame:
    """``(term, df)``: in how many documents a term is."""
    return counts.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"))


def stem_vocabulary(counts: DataFrame) -> DataFrame:
    """``(term, stem, n_rows)``: each distinct term once, however often it occurs."""
    vocabulary = counts.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("n_rows"))
    return with_stem(vocabulary, "term", "stem").select("term", "stem", "n_rows")


def stem_counts(counts: DataFrame) -> DataFrame:
    """``(doc, .., term, tf)``, a stored table, with each term replaced by its stem, not yet added up.  The distinct
    terms are stemmed and joined back; only rows of rare terms are shuffled for it."""
    stems = stems_of(counts.select("term"))
    known = stems.known(counts.filter(F.col("term").isNotNull())).filter(F.col("stem").isNotNull())
    stemmed = known.unionByName(stems.others(counts)).drop("term").withColumnRenamed("stem", "term")
    return stemmed.select(counts.columns).unionByName(counts.filter(F.col("term").isNull()))


def stem_packed(packed: DataFrame) -> DataFrame:
    """Stored packed counts with their terms stemmed, one row per document and stem.  Stems do not change a document's
    length, so its rows are only added up where they are dealt by document."""
    rows = packed.select("doc", "dl", F.explode_outer("terms").alias("entry")).filter(F.col("entry").isNotNull())
    stemmed = stem_counts(rows.select("doc", "dl", "entry.term", "entry.tf")).repartition("doc")
    added = stemmed.groupBy("doc", "dl", "term").agg(F.sum("tf").alias("tf"))
    return added.select("doc", "dl", F.array(F.struct("term", "tf")).alias("terms"))
