"""Stop-word lists."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stopwords(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(word)`` from a text file with one word per line, or Spark's English list."""
    if path is None:
        listed = F.array(*map(F.lit, StopWordsRemover.loadDefaultStopWords("english")))
        return spark.range(1).select(F.explode(listed).alias("word"))
    return spark.read.text(path).select(F.col("value").alias("word")).filter("word <> ''")
