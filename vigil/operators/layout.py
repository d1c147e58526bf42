"""Physical-layout and comparison jobs.

Rows per partition are counted by Spark's own aggregate over the number of the
partition that each row is in.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.risk import row_count
from vigil.sources.files import sql_row_count


# P1
def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows of each partition, empty ones included. A partition without rows
    reports nothing, so the counts are joined to all numbers; how many there
    are is the partitioning of the plan that is counted."""
    rows = df.select(F.spark_partition_id().alias("partition"))
    counts = rows.groupBy("partition").agg(F.count(F.lit(1)).alias("records"))
    n = rows.rdd.getNumPartitions()  # of the physical plan; no row is read
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return every.join(counts, "partition", "left").select("partition", F.coalesce("records", F.lit(0)).alias("records")).orderBy("partition")


# P2
def repartition_report(df: DataFrame, n: int) -> DataFrame:
    if n < 1:
        raise ValueError("n must be at least 1")
    return partition_sizes(df.repartition(n))


# P3 / P4
def format_counts(spark: SparkSession, csv_path: str, parquet_path: str, infer: bool = True) -> DataFrame:
    """Row count of the same data read as CSV and as Parquet (lazy)."""
    reader = spark.read.option("header", True).option("inferSchema", infer)
    c = reader.csv(csv_path).agg(F.lit("CSV").alias("format"), F.count(F.lit(1)).alias("rows"))
    p = spark.read.parquet(parquet_path).agg(F.lit("Parquet").alias("format"), F.count(F.lit(1)).alias("rows"))
    return c.unionByName(p)


def api_sql_counts(df: DataFrame, view: str = "safety_events") -> DataFrame:
    """Row count through the DataFrame API and through SQL text (lazy)."""
    a = row_count(df).select(F.lit("Spark DataFrame API").alias("method"), F.col("row_count").alias("rows"))
    s = sql_row_count(df.sparkSession, df, view).select(F.lit("Spark SQL").alias("method"),
                                                       F.col("total_rows").alias("rows"))
    return a.unionByName(s)


def _timed(action):
    t0 = time.perf_counter()
    value = action()
    return value, time.perf_counter() - t0


def compare_formats(spark: SparkSession, csv_path: str, parquet_path: str, infer: bool = True) -> list[tuple]:
    """(format, rows, seconds): each load + count timed on its own."""
    reader = spark.read.option("header", True).option("inferSchema", infer)
    n_csv, t_csv = _timed(lambda: reader.csv(csv_path).count())
    n_pq, t_pq = _timed(lambda: spark.read.parquet(parquet_path).count())
    return [("CSV", n_csv, t_csv), ("Parquet", n_pq, t_pq)]


def compare_api_sql(df: DataFrame) -> list[tuple]:
    """(method, rows, seconds) for the DataFrame API and for SQL."""
    n_api, t_api = _timed(lambda: row_count(df).first()[0])
    n_sql, t_sql = _timed(lambda: sql_row_count(df.sparkSession, df).first()[0])
    return [("Spark DataFrame API", n_api, t_api), ("Spark SQL", n_sql, t_sql)]
