"""Carry the latest value down the lines of a file, at any file size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN_BITS = 18  # lines in a run: 2 ** RUN_BITS at most


def carry_forward(lines: DataFrame, value: str, run_bits: int = RUN_BITS) -> DataFrame:
    """Fill nulls of ``value`` with the latest one above, in the order of
    ``(file, block_start, line_id)`` within each file.

    ``lines`` should be a stored table: it is read three times, and positions must be the same
    in each.  One window per file would put a whole dump into one task.  Instead the lines are cut
    into runs of bounded length: values are carried inside each run, then a table with one
    row per run says what each run inherits from those above it, and the lines are joined
    to it.  The join has the keys of the first window, so the lines are shuffled once, and
    the window per file sees one row per run, not per line.  The table of runs needs positions and
    the few rows that have a value.  The result has the column ``run`` too: what is grouped by it,
    by file and by block_start, among others, needs no further shuffle.
    """
    run = ["file", "block_start", "run"]
    cut = lines.withColumn("run", F.shiftright("line_id", run_bits))
    inside = Window.partitionBy(*run).orderBy("line_id").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy("file").orderBy("block_start", "run").rowsBetween(Window.unboundedPreceding, -1)

    with_value = cut.filter(F.col(value).isNotNull())
    last_of_run = with_value.groupBy(*run).agg(F.max_by(value, "line_id").alias("__last"))
    runs = cut.select(*run).distinct().join(last_of_run, run, "left")
    inherited = runs.select(*run, F.last("__last", ignorenulls=True).over(above).alias("__above"))
    filled = cut.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    return (
        filled.join(inherited, run, "left")
        .withColumn(value, F.coalesce(F.col(value), F.col("__above")))
        .select(*lines.columns, "run")
    )
