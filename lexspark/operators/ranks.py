"""Consecutive numbers in a global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.session import stage

_LOCAL_BITS = 33  # of monotonically_increasing_id: the number within a partition; above it, the partition


def number_rows(rows: DataFrame, order: list[Column | str], name: str, start: int = 1) -> DataFrame:
    """``rows`` with a column ``name`` that numbers them from ``start`` in the given order, which should
    leave no ties.

    The rows are range-partitioned, sorted and stored with their place in their partition.  What the
    partitions before hold in all is a running sum over one row per partition, and is broadcast: as
    many pairs of numbers as there are shuffle partitions.  No task sees more than its partition.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(sorted_rows.withColumn("__place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__place", _LOCAL_BITS).alias("__part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = F.col("__place").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, (F.col("__before") + local + start).cast("long"))
        .drop("__part", "__place", "__before")
    )
