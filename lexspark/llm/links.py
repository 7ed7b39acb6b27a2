"""Connected components of links, and tasks of a bounded size made of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.session import release, stage


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct links, the larger id in ``a``."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``: the smallest id reachable.

    Large-star and small-star steps: each id hands its neighbours the smallest id it knows.
    Every step keeps the components, the number of links never grows, and it ends, after about
    log(longest path) steps, with one star per component.  Each step writes its links as a table
    in the shared folder, so no lineage grows and no link comes to the driver.  Minima are
    combined before the shuffle; the joins are plain ones, whose large partitions Spark splits.
    """
    edges = stage(_ordered(edges), "links")
    state = None
    while True:
        known = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("s")).first()
        if (known.n, known.s) == state or known.n == 0:
            break
        state = (known.n, known.s)
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(_ordered(large.union(_own_least(least))), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        smaller = stage(_ordered(small.union(least.select("a", F.col("m").alias("b")))), "links")
        release(edges, large)
        edges = smaller
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def _own_least(least: DataFrame) -> DataFrame:
    return least.filter("m < a").select("a", F.col("m").alias("b"))


def block_pairs(members: DataFrame, group: str, member: Column, blocks: Column) -> DataFrame:
    """``members`` repeated so that every two members of a group meet in some row set of the
    same ``(group, bi, bj)``, ``bi <= bj``.

    ``blocks``, constant in a group, says into how many blocks its members are dealt; a set then
    holds two blocks at most.  A group of one block is not repeated at all.
    """
    own = F.pmod(F.xxhash64(member), F.col("__blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks").cast("int") - 1))
    dealt = members.withColumn("__blocks", blocks.cast("long")).withColumn("__own", own.cast("int"))
    dealt = dealt.select("*", other.alias("__other"))
    return dealt.withColumns(
        {"bi": F.least("__own", "__other"), "bj": F.greatest("__own", "__other")}
    ).drop("__blocks", "__own", "__other")


def spread(rows: DataFrame, keys: list[str], n_tasks: int) -> DataFrame:
    """``rows`` with a column ``__task`` that puts whole keys together; for grouped maps that
    take many small groups at a time."""
    return rows.withColumn("__task", F.pmod(F.xxhash64(*keys), F.lit(max(1, n_tasks))))
