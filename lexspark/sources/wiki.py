"""Wiki-style text files: ``[[Title]]`` lines, ``==Heading==`` lines and body lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.text import clean_body, has_line, is_title, normalise_line, strip_blanks, title_key
from lexspark.operators.carry import carry_forward
from lexspark.session import TEXT_CODEC, stage

POSITION = ["file", "block_start", "line_id"]


def read_wiki(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, block_start, line_id, value)``: the lines of plain or compressed text files.

    Plain files are split; ``line_id`` grows along the lines of a split, so
    ``(file, block_start, line_id)`` is the order of the lines.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )


def titled_lines(lines: DataFrame, ascii_first: bool = False) -> DataFrame:
    """Body lines, cleaned, each with the latest title line above it (null if none).

    Headings and empty lines are gone before anything is shuffled.  The text is read once: the cleaned
    lines are stored with their positions, which depend on how Spark splits the files and would
    not have to agree between two scans.
    """
    norm = F.col("line")
    marked = (
        lines.filter(has_line(F.col("value")))
        .withColumn("line", strip_blanks(F.col("value")))
        .withColumn("line", normalise_line(F.col("line"), ascii_first))
        .select(
            *POSITION,
            F.when(is_title(norm), norm).alias("title_line"),
            F.when(~is_title(norm), clean_body(norm, ascii_first)).alias("chunk"),
        )
    )
    stored = stage(marked, "lines", TEXT_CODEC)
    titled = carry_forward(stored, "title_line").filter(F.col("chunk").isNotNull())
    titled.stage_path = stored.stage_path
    return titled


def wiki_chunks(lines: DataFrame, ascii_first: bool = False, dropped: Observation | None = None) -> DataFrame:
    """``(doc, title_line, file, block_start, line_id, run, chunk)``: body lines under their title.

    The key of a document is the bracketed part of its title line, so equal titles anywhere
    in the input are one document.  Lines above the first title of a file belong to none;
    see ``untitled_lines``.  ``dropped`` counts them, as ``untitled_lines``, while the chunks are used.
    The text is not read again: chunks are read from a stored table, which ``release(chunks)`` deletes.
    """
    titled = titled_lines(lines, ascii_first)
    stored = titled.stage_path
    if dropped is not None:
        titled = titled.observe(dropped, F.count(F.when(F.col("title_line").isNull(), 1)).alias("untitled_lines"))
    chunks = titled.filter(F.col("title_line").isNotNull()).select(
        title_key(F.col("title_line")).alias("doc"), "title_line", *POSITION, "run", "chunk"
    )
    chunks.stage_path = stored
    return chunks


def untitled_lines(lines: DataFrame, ascii_first: bool = False) -> DataFrame:
    """``(file, n_lines)``: how many body lines stand above the first title of their file."""
    return (
        titled_lines(lines, ascii_first)
        .filter(F.col("title_line").isNull())
        .groupBy("file")
        .agg(F.count("*").alias("n_lines"))
    )
