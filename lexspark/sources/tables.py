"""Tables of documents: one row per document, with an id and a text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexspark.functions.text import LINE_BREAK, clean_body, has_line, normalise_line, strip_blanks


def table_chunks(df: DataFrame, doc: str, text: str, dropped: Observation | None = None) -> DataFrame:
    """``(doc, text)``: each row's text, whole, to be cut into words in one go.  ``dropped`` counts the
    rows that an index can't hold, ``null_ids`` and ``null_texts``, while the chunks are used."""
    if dropped is not None:
        df = df.observe(dropped, *(F.count(F.when(F.col(c).isNull(), 1)).alias(n) for c, n in ((doc, "null_ids"), (text, "null_texts"))))
    return df.select(F.col(doc).alias("doc"), F.col(text).alias("text"))


def table_lines(df: DataFrame, doc: str, text: str, ascii_first: bool = False) -> DataFrame:
    """``(doc, line_no, chunk)``: the cleaned lines of each row, lines left empty dropped."""
    lines = df.select(
        F.col(doc).alias("doc"), F.posexplode(F.split(F.col(text), LINE_BREAK)).alias("line_no", "raw")
    )
    stripped = lines.filter(has_line(F.col("raw"))).withColumn("line", strip_blanks(F.col("raw")))
    normal = normalise_line(F.col("line"), ascii_first)
    return stripped.select("doc", "line_no", clean_body(normal, ascii_first).alias("chunk"))
