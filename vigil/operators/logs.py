"""Harmonised inference logs: counts, trends and class transitions
(A16-A21, W1-W3, U1).

Input: (id, timestamp, inference[, class]). The transition operators use the
lag of ``vigil.operators.ordered``, whose windows are split by hour, rather than
a window partitioned by device id, so one very busy device does not land in a
single task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.operators.ordered import lag_by_group, lag_pair_counts


def _n():
    return F.count(F.lit(1)).alias("n")


# U1
def union_logs(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# A16 / A17 / A18
def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("class").agg(_n()).orderBy("class")


def daily_trend(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("timestamp").alias("d"), "class").agg(_n()).orderBy("d", "class")


def activity_heatmap(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.to_date("timestamp").alias("d"), F.hour("timestamp").alias("h"))
              .agg(_n()).orderBy("d", "h"))


# A19
def timeline_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width time bins between the first and last timestamp; the last
    edge belongs to the last bin. Bounds are one row, broadcast."""
    us = F.unix_micros(F.col("timestamp").cast("timestamp"))
    bounds = df.agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))
    j = df.filter(F.col("timestamp").isNotNull()).crossJoin(F.broadcast(bounds))
    span = F.col("_hi") - F.col("_lo")
    # exact integer arithmetic: (t - lo) * bins div (hi - lo)
    b = F.when(span == 0, F.lit(0)).otherwise(
        F.expr(f"(unix_micros(cast(timestamp as timestamp)) - _lo) * {int(bins)} div greatest(_hi - _lo, 1)"))
    b = F.least(b, F.lit(bins - 1)).cast("int")
    return j.groupBy(b.alias("bin"), "class").agg(_n()).orderBy("bin", "class")


# A20 / A21
def log_status(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.col("class") != F.lit(K.UNASSIGNED)).alias("mapped"),
                  F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def device_ids(df: DataFrame) -> DataFrame:
    return df.select("id").distinct()


# W1 / W2 / W3
def _hour():
    return F.date_trunc("hour", F.col("timestamp"))


def with_previous_class(df: DataFrame) -> DataFrame:
    """Previous class of the same id in time order (ties: inference text,
    then class); the first row of every id is dropped."""
    lagged = lag_by_group(df, ["id"], ["timestamp", "inference"], ["class"], _hour())
    return lagged.filter(F.col("prev_class").isNotNull()).select("id", "timestamp", "prev_class", "class")


def transition_matrix(df: DataFrame) -> DataFrame:
    """n per (prev_class, class) and its share of the source class; the share
    window runs over the matrix (classes^2 rows)."""
    pairs = lag_pair_counts(df, ["id"], ["timestamp", "inference"], "class", _hour())
    pairs = pairs.filter(F.col("prev").isNotNull()).select(F.col("prev").alias("prev_class"),
                                                           F.col("cur").alias("class"), "n")
    w = Window.partitionBy("prev_class")
    return pairs.withColumn("prob", F.col("n") / F.sum("n").over(w)).orderBy("prev_class", "class")


def device_class_share(df: DataFrame, device: str) -> DataFrame:
    per = df.filter(F.col("id") == F.lit(device)).groupBy("class").agg(_n())
    total = per.agg(F.sum("n").alias("_total"))  # one row
    return (per.crossJoin(F.broadcast(total))
            .select("class", "n", (F.col("n") * F.lit(100.0) / F.col("_total")).alias("pct")).orderBy("class"))
