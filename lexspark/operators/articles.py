"""Article bodies put together from their chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.text import chunk_words
from lexspark.operators.carry import RUN_BITS
from lexspark.operators.stems import stems_of
from lexspark.operators.terms import TASK_BYTES
from lexspark.session import TEXT_CODEC, stage

SEGMENT_CHARS = 16 * 1024 * 1024


def stem_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks with each word stemmed, order and spacing kept.

    Each distinct word is stemmed once.  Lines are dealt by number, so that their words, (line number, position,
    word) rows, are put together again where they are cut: the text moves once, and common words, nearly all of it,
    meet their stems there.  Of the others only those that change move, to their stems and back to their line;
    the other columns of a line wait in the stored table.
    """
    lines = stage(chunks.withColumn("__line", F.monotonically_increasing_id()), "stem_lines", TEXT_CODEC)
    words = F.posexplode(chunk_words(F.col("chunk"))).alias("pos", "term")
    placed = lines.select("__line", words)
    stems = stems_of(placed.select("term"))
    size = lines.agg(F.sum(F.octet_length("chunk")).alias("size")).first().size or 0
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, "__line")

    changed = dealt(stems.others(placed).filter("stem <> term").select("__line", "pos", "stem"))
    changed = changed.groupBy("__line").agg(F.array_sort(F.collect_list(F.struct("pos", "stem"))).alias("changed"))
    stemmed = stems.known(dealt(lines.select("__line", "chunk")).select("__line", words))
    in_order = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("stem", "term").alias("stem"))))["stem"]
    rebuilt = stemmed.groupBy("__line").agg(in_order.alias("words")).join(changed, "__line", "left")
    rebuilt = rebuilt.select("__line", _put("words", "changed").alias("chunk"))
    return dealt(lines.drop("chunk")).join(rebuilt, "__line").select(chunks.columns)


def _put(words: str, changed: str) -> Column:
    """The array ``words`` joined by spaces, ``changed``, an array of ``(pos, stem)`` in order, or null, put in."""
    n, stems = F.size(words), F.col(changed)

    def piece(k):
        before, at = F.get(stems, k - 1), F.get(stems, k)
        start, end = F.coalesce(before["pos"] + 1, F.lit(0)), F.coalesce(at["pos"], n)
        kept = F.slice(words, start + 1, end - start)
        return F.when(at.isNull(), kept).otherwise(F.concat(kept, F.array(at["stem"])))

    pieces = F.transform(F.sequence(F.lit(0), F.size(stems)), piece)
    return F.when(stems.isNull(), F.array_join(words, " ")).otherwise(F.array_join(F.flatten(pieces), " "))


def assemble_articles(chunks: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``(doc, segment, body)``: the chunks of a document joined by spaces, in line order.

    Nearly every document has one segment, number 0.  A document of more than
    ``segment_chars`` characters is cut, at a line, into as many segments as it takes: its
    text is not collected into one task.  Segments in order of their numbers, which may skip where a
    line is longer than a segment, joined by a space are the whole body.  Where a line of such a document
    starts is known from a running sum within its run of lines and a running sum over the runs; the lines of
    others move once, by document.  The chunks are stored once, so that finding the sizes reads neither the
    input nor the text again.

    Empty chunks at the start of a document add nothing, later ones add a space.
    """
    run = ["doc", "file", "block_start", "run"]
    sized = chunks.select(
        "doc", "file", "block_start", F.shiftright("line_id", RUN_BITS).alias("run"), "line_id", "chunk",
        (F.length("chunk") + 1).cast("long").alias("size"),
    )
    sized = stage(sized.dropna(subset=run), "chunks", TEXT_CODEC)
    long_docs = sized.groupBy("doc").agg(F.sum("size").alias("n")).filter(F.col("n") > segment_chars)
    long_docs = stage(long_docs.select("doc"), "long_docs")
    short = sized.join(long_docs, "doc", "left_anti")
    in_order = F.array_sort(F.collect_list(F.struct("file", "block_start", "line_id", "chunk")))["chunk"]
    lines = short.groupBy("doc").agg(in_order.alias("lines"))
    whole = lines.select("doc", F.lit(0).cast("long").alias("segment"), F.array_join(_begun("lines"), " ").alias("body"))
    if long_docs.isEmpty():
        return whole
    return whole.unionByName(_segments(sized.join(long_docs, "doc", "left_semi"), run, segment_chars))


def _begun(lines: str) -> Column:
    """The array ``lines`` without the empty ones that it begins with."""
    first = F.array_position(F.transform(lines, lambda c: c != ""), True)
    return F.when(first > 1, F.slice(lines, first.cast("int"), F.size(lines))).when(first == 1, F.col(lines)).otherwise(F.array().cast("array<string>"))


def _segments(sized: DataFrame, run: list[str], segment_chars: int) -> DataFrame:
    """``(doc, segment, body)`` of the stored lines of long documents."""
    above = Window.partitionBy("doc").orderBy("file", "block_start", "run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*run).orderBy("line_id")
    # whether a line, or one above it in its run, is not empty
    begun = F.max(F.col("chunk") != "").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    marked = sized.withColumn("begun", begun)
    runs = marked.groupBy(*run).agg(
        F.sum("size").alias("whole"),
        F.sum(F.when(F.col("begun"), F.col("size")).otherwise(0)).alias("part"),
        F.max("begun").alias("begins"),
    )
    runs = runs.withColumn("begun_above", F.coalesce(F.max("begins").over(above), F.lit(False)))
    size = F.when(F.col("begun_above"), F.col("whole")).otherwise(F.col("part"))
    runs = runs.withColumn("run_size", size).select(
        *run, "begun_above", F.coalesce(F.sum("run_size").over(above), F.lit(0)).alias("run_start")
    )
    kept = F.col("begun_above") | F.col("begun")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.join(runs, run).withColumn("kept", kept)
    start = F.coalesce(F.sum(F.when(F.col("kept"), F.col("size")).otherwise(0)).over(before), F.lit(0))
    placed = placed.withColumn("start", start)
    segment = F.floor((F.col("run_start") + F.col("start")) / segment_chars).alias("segment")
    line = F.when(F.col("kept"), F.struct("file", "block_start", "line_id", "chunk"))
    lines = F.array_sort(F.collect_list(line))["chunk"]
    return placed.groupBy("doc", segment).agg(F.array_join(lines, " ").alias("body"))
