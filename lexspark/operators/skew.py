"""Join a large table to a per-key table when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 10_000


def join_per_key(rows: DataFrame, keys: DataFrame, key: str, n_rows: str) -> DataFrame:
    """Inner join of ``rows`` to ``keys``, which has one row per key and says in column
    ``n_rows`` how many rows the key has in ``rows``.

    A key with more than 1/HOT_SHARE of all rows is hot.  There are fewer than HOT_SHARE of
    these, whatever the data.  Their 64-bit hashes, each with the number of shares that its
    rows are dealt into, are broadcast: two numbers per hot key, however long the keys and
    whatever else ``keys`` holds.  Both sides are salted by them and joined on the full key and
    the share, so no key fills a task.  A key whose hash is that of a hot one is dealt alike on
    both sides.  ``keys`` is read three times, so it should be a stored table.
    """
    keys = keys.filter(F.col(key).isNotNull())
    total = keys.agg(F.sum(n_rows).alias("total")).scalar()
    hot = (
        keys.filter(F.col(n_rows) * HOT_SHARE > total)
        .select(
            F.xxhash64(key).alias("__hash"), F.ceil(F.col(n_rows) * HOT_SHARE / total).cast("int").alias("__shares")
        )
        .groupBy("__hash")
        .agg(F.max("__shares").alias("__shares"))
    )
    shares = F.coalesce("__shares", F.lit(1))

    def dealt(side: DataFrame, share) -> DataFrame:
        hashed = side.withColumn("__hash", F.xxhash64(key)).join(F.broadcast(hot), "__hash", "left")
        return hashed.withColumn("__share", share).drop("__hash", "__shares")

    own = F.pmod(F.xxhash64(*rows.columns), shares).cast("int")
    every = F.explode(F.sequence(F.lit(0), shares - 1))
    return dealt(rows, own).join(dealt(keys.drop(n_rows), every), [key, "__share"]).drop("__share")
