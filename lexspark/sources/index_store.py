"""The index on disk: four Parquet tables, and a plain-text form for exchange.

A build writes its tables to a new folder of its own and then appends one row to ``published``,
which names that folder.  Until then, and if a build fails, readers see the index before; an
index may be rebuilt from its own tables.

An index may consist of several folders, its segments: a build, and one for each later addition
of documents (``plans.growth``).  A segment's tables are about its own documents; ``superseded``
lists the documents of earlier segments that it replaces or removes, ``term_changes`` and
``corpus_changes`` say what that does to document frequencies, to N and to the total length.  So
statistics add up over segments, and a row of an older segment counts unless a later one supersedes its
document.
"""

from __future__ import annotations

import uuid

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.weights import B, K1, bm25_idf, length_coefficient
from lexspark.session import exists, remove, subfolders

TABLES = ("postings", "doc_lengths", "term_stats", "corpus_stats")
BUCKETS = 32
_PUBLISHED = "at timestamp, version string, buckets int, number long, segments array<string>, dropped map<string, bigint>"


@dataclass(frozen=True)
class SearchIndex:
    """``postings(term, doc, tf, dl, bucket)``, ``doc_lengths(doc, dl, n_terms)``,
    ``term_stats(term, df, idf)`` in term order, ``corpus_stats(n_docs, total_len, avg_len)``.

    A posting carries the length of its document, so ranking needs no join by document.  Postings
    lie in ``buckets`` partition folders by a hash of the term, in term order in each, so that a
    search opens the files of its terms' buckets only.
    """

    postings: DataFrame
    doc_lengths: DataFrame
    term_stats: DataFrame
    corpus_stats: DataFrame
    buckets: int = BUCKETS

    def stat(self, name: str) -> Column:
        """A corpus statistic as a scalar subquery, evaluated once per query."""
        return self.corpus_stats.select(name).scalar()

    def length_coefficients(self, k1: float = K1, b: float = B) -> DataFrame:
        """``(doc, dl, k)``."""
        k = length_coefficient(F.col("dl"), self.stat("avg_len"), k1, b)
        return self.doc_lengths.select("doc", "dl", k.alias("k"))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def new_version(path: str) -> str:
    """A folder for the tables of one build."""
    return f"{path}/version-{uuid.uuid4().hex}"


def publish(
    spark: SparkSession,
    path: str,
    version: str,
    buckets: int,
    before: tuple[str, ...] = (),
    dropped: Observation | None = None,
) -> None:
    """Make the complete tables in the folder ``version``, added to the segments ``before``, the index
    at ``path``.  The row published last has the highest number, whatever the clocks of drivers say.
    It keeps what the build's read of its input counted as ``dropped``."""
    name = version.rsplit("/", 1)[1]
    last = _published(spark, path).number if exists(spark, f"{path}/published") else 0
    counted = dropped.get if dropped is not None else {}
    row = spark.range(1, numPartitions=1).select(
        F.current_timestamp().alias("at"),
        F.lit(name).alias("version"),
        F.lit(buckets).alias("buckets"),
        F.lit(last + 1).cast("long").alias("number"),
        F.array(*map(F.lit, (*before, name))).alias("segments"),
        F.create_map(*(F.lit(x) for item in counted.items() for x in item)).cast("map<string, bigint>").alias("dropped"),
    )
    row.write.mode("append").parquet(f"{path}/published")


def _published(spark: SparkSession, path: str):
    rows = spark.read.schema(_PUBLISHED).parquet(f"{path}/published")
    number = F.coalesce("number", F.lit(0)).alias("number")
    segments = F.coalesce("segments", F.array("version")).alias("segments")
    last = F.max_by(F.struct("version", "buckets", number, segments), F.struct(number, "at", "version"))
    return rows.agg(last.alias("last")).first().last


def dropped_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(version, kind, n)``: what the builds and additions at ``path`` counted as left out, each in the
    read that it made anyway.  A count may be too high where a lost executor made Spark read again."""
    rows = spark.read.schema(_PUBLISHED).parquet(f"{path}/published")
    return rows.select("version", F.explode("dropped").alias("kind", "n"))


def segments(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The folders of the index published last at ``path``, oldest first."""
    return tuple(_published(spark, path).segments)


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a segment.  Postings in folders by bucket have no file, and so no schema, where there are none."""
    if name != "postings":
        return spark.read.parquet(f"{folder}/{name}")
    doc = _read(spark, folder, "doc_lengths").schema["doc"].dataType.simpleString()
    return spark.read.schema(f"term string, doc {doc}, tf bigint, dl bigint, bucket int").parquet(f"{folder}/{name}")


def read_index(spark: SparkSession, path: str) -> SearchIndex:
    """The index that was published last at ``path``."""
    last = _published(spark, path)
    folders = [f"{path}/{name}" for name in last.segments]
    if len(folders) == 1:
        return SearchIndex(*(_read(spark, folders[0], name) for name in TABLES), last.buckets)

    def current(name: str) -> DataFrame:
        parts = []
        for i, folder in enumerate(folders):
            rows = _read(spark, folder, name)
            columns = rows.columns
            for later in folders[i + 1 :]:
                rows = rows.join(_read(spark, later, "superseded"), "doc", "left_anti")
            parts.append(rows.select(columns))
        return reduce(DataFrame.unionByName, parts)

    def added(name: str, changes: str) -> DataFrame:
        later = [spark.read.parquet(f"{folder}/{changes}") for folder in folders[1:]]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), later, spark.read.parquet(f"{folders[0]}/{name}"))

    corpus = added("corpus_stats", "corpus_changes").agg(F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len"))
    corpus = corpus.withColumn("avg_len", F.try_divide("total_len", "n_docs"))
    terms = added("term_stats", "term_changes").groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
    terms = terms.withColumn("idf", bm25_idf(corpus.select("n_docs").scalar(), F.col("df")))
    return SearchIndex(current("postings"), current("doc_lengths"), terms, corpus, last.buckets)


def drop_old_versions(spark: SparkSession, path: str) -> None:
    """Delete the tables of all builds at ``path`` that are no part of the index published last: those
    before it, and those that failed.  Not while another build or a reader of an older version runs."""
    kept = segments(spark, path)
    for folder in subfolders(spark, path):
        if folder.startswith("version-") and folder not in kept:
            remove(spark, f"{path}/{folder}")


_ESCAPES = {"\t": "\\t", "\r": "\\r", "\n": "\\n"}
_LINE = r"^([^-\t]+)-([^\t]+)\t([0-9]{1,18})$"


def _escape(text: Column, *, hyphen: bool = False) -> Column:
    """Backslash, tab and line breaks, and a hyphen where it would end a term, as two characters."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, written in (_ESCAPES | ({"-": "\\h"} if hyphen else {})).items():
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def _unescape(text: Column) -> Column:
    """Between two written backslashes, each other pair stands for one character."""

    def part(piece: Column) -> Column:
        for raw, written in (_ESCAPES | {"-": "\\h"}).items():
            piece = F.replace(piece, F.lit(written), F.lit(raw))
        return piece

    written = F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")
    return F.when(text.contains("\\"), written).otherwise(text)


def export_text(index: SearchIndex, path: str) -> None:
    """Write the index as ``key<TAB>value`` text: ``counts`` and ``idf`` keyed by
    ``term-doc``, ``lengths`` and ``coefficients`` by ``doc``, ``average`` as one line.

    Backslashes, tabs and line breaks in terms and ids are escaped, so every row comes back.
    """

    def save(df: DataFrame, key: Column, value: str, name: str) -> None:
        df.select(F.concat_ws("\t", key, F.col(value).cast("string"))).write.mode("overwrite").text(
            f"{path}/{name}"
        )

    term = _escape(F.col("term"), hyphen=True)
    doc = _escape(F.col("doc").cast("string"))
    save(index.postings, F.concat_ws("-", term, doc), "tf", "counts")
    save(index.doc_lengths, doc, "dl", "lengths")
    save(index.length_coefficients(), doc, "k", "coefficients")
    save(index.corpus_stats, F.lit("Avg"), "avg_len", "average")
    # idf stands at every posting of its term; a term's own row is enough to read it back
    save(index.term_stats, term, "idf", "idf")


def import_text(spark: SparkSession, path: str, dropped: Observation | None = None) -> DataFrame:
    """``(doc, term, tf)`` from a ``counts`` folder of ``term-doc<TAB>n`` lines.

    ``malformed_lines`` has the lines that are left out: those without exactly one tab, or
    without a term, a document and a whole number.  ``dropped`` counts them, as ``malformed_lines``,
    while the rows are used.
    """
    value = F.col("value")
    lines = spark.read.text(f"{path}/counts")
    if dropped is not None:
        lines = lines.observe(dropped, F.count(F.when(~value.rlike(_LINE), 1)).alias("malformed_lines"))
    key, tail = F.substring_index(value, "\t", 1), F.substring_index(value, "\t", -1)
    parts = lines.filter(value.rlike(_LINE)).select(key.alias("key"), F.substring_index(key, "-", 1).alias("term"), tail.alias("tail"))
    # the pattern lets a line end in one of the rarer line breaks
    tf = F.coalesce(F.col("tail").try_cast("long"), F.regexp_extract("tail", "^[0-9]+", 0).cast("long"))
    return parts.select(
        _unescape(F.substring("key", F.length("term") + 2, F.length("key"))).alias("doc"),
        _unescape(F.col("term")).alias("term"),
        tf.alias("tf"),
    )


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: the lines of a ``counts`` folder that ``import_text`` leaves out."""
    return spark.read.text(f"{path}/counts").filter(~F.col("value").rlike(_LINE))
