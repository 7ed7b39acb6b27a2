"""Stems of the words of rows: each distinct word is stemmed once, and most words meet their stem without moving."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.porter import with_stem
from lexspark.operators.skew import join_per_key
from lexspark.session import release, stage

COMMON_SHARE = 1_000_000
COMMON_LETTERS = 64


@dataclass(frozen=True)
class Stems:
    """The stems of a corpus, ``common(term, stem)`` and ``rare(term, stem, n_rows)``, both stored.

    A word that makes up more than 1/``COMMON_SHARE`` of all words, of which there are fewer than ``COMMON_SHARE``,
    whatever the data, and is no longer than ``COMMON_LETTERS``, is common.  These are nearly all of a text, and
    are broadcast; only rows of other words are shuffled to their stems."""

    common: DataFrame
    rare: DataFrame

    def known(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``stem``: that of a common ``term``, null for any other."""
        return rows.join(F.broadcast(self.common), "term", "left")

    def others(self, rows: DataFrame) -> DataFrame:
        """The ``rows`` whose ``term`` is not common, with its ``stem``."""
        unknown = rows.join(F.broadcast(self.common.select("term")), "term", "left_anti")
        return join_per_key(unknown, self.rare, "term", "n_rows")


def stems_of(terms: DataFrame) -> Stems:
    """The stems of ``terms(term)``, one row per word of the corpus; null words have none."""
    counts = terms.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("n_rows"))
    vocabulary = stage(with_stem(counts, "term", "stem").select("term", "stem", "n_rows"), "vocabulary")
    total = vocabulary.agg(F.sum("n_rows").alias("total")).scalar()
    is_common = (F.col("n_rows") * COMMON_SHARE > total) & (F.length("term") <= COMMON_LETTERS)
    known = stage(vocabulary.withColumn("is_common", is_common), "stems")
    release(vocabulary)
    return Stems(known.filter("is_common").select("term", "stem"), known.filter("not is_common").drop("is_common"))
