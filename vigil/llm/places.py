"""Places of rows in an order, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.tables import saved


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with ``place`` (from 0) of each row among those of equal ``by``
    (nulls are equal) in the given order, and ``places``, their number.

    Rows are dealt by ranges of (by, order, place in the input), so that a
    group with a third of the rows, or of one key, lies in many tasks, and are
    written once in that order. What a task lacks is how many rows of a group
    the tasks before it hold: one row for each task and group that meet, at
    most tasks + groups in all."""
    keys = [*[F.col(c).asc_nulls_first() for c in by], *order, F.col("_row")]
    laid = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = saved(laid.drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    laid = laid.withColumn("_task", F.shiftright("_at", 33))  # its upper bits number the task
    runs = laid.groupBy("_task", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = saved(runs.select("_task", *by, "_first", F.sum("_n").over(group).alias("places"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    runs = runs.select(F.col("_task").alias("_task2"), *[F.col(c).alias(f"_{c}2") for c in by], "_first", "places", "_before")
    same = F.col("_task") == F.col("_task2")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}2"))
    return laid.join(runs, same).select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "places")
