"""Pre-aggregated OLAP cubes and their readers.

``build_cubes`` reads the events once: a single GROUPING SETS aggregation
at the two finest grains, (hour, emotion, risk) and (lat cell, lon cell,
risk), with partial aggregation before the shuffle. The three coarser cubes
are roll-ups of the (hour, emotion, risk) result, which has at most
25 x |emotions| x 3 rows, so they cost nothing. The aggregate is
checkpointed into the shared checkpoint folder before the five writes, so
the writes do not re-read the events and a lost executor does not either.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.scalars import bucket_center, to_numeric, with_geo_bucket, with_hour
from vigil.operators.risk import is_danger

CUBE_NAMES = ["hour_risk_cube", "emotion_risk_cube", "geographic_cube", "hour_emotion_risk_cube", "risk_score_cube"]


def _count():
    return F.count(F.lit(1)).alias("count")


# C1-C5 as single queries
def hour_risk_cube(df: DataFrame) -> DataFrame:
    return with_hour(df).groupBy("hour", "risk_level").agg(_count())


def emotion_risk_cube(df: DataFrame) -> DataFrame:
    return df.groupBy("emotion", "risk_level").agg(_count())


def geographic_cube(df: DataFrame) -> DataFrame:
    return with_geo_bucket(df).groupBy("lat_bucket", "lon_bucket", "risk_level").agg(_count())


def hour_emotion_risk_cube(df: DataFrame) -> DataFrame:
    return with_hour(df).groupBy("hour", "emotion", "risk_level").agg(_count())


def risk_score_from(her: DataFrame) -> DataFrame:
    """C5 rolled up from C4 rows: total, danger and their ratio per (emotion, hour)."""
    agg = her.groupBy("emotion", "hour").agg(
        F.sum("count").cast("long").alias("total_events"),
        F.sum(F.when(is_danger(), F.col("count")).otherwise(F.lit(0))).cast("long").alias("danger_events"))
    return agg.withColumn("risk_score", F.col("danger_events") / F.col("total_events"))


def risk_score_cube(df: DataFrame) -> DataFrame:
    from vigil.operators.risk import risk_score_cube as rs

    return rs(df)


# C6
def cube_aggregate(df: DataFrame) -> DataFrame:
    """All cube cells from one pass: GROUPING SETS at the two finest grains."""
    src = with_geo_bucket(with_hour(df)).select("hour", "emotion", "risk_level", "lat_bucket", "lon_bucket")
    return src.groupingSets(
        [["hour", "emotion", "risk_level"], ["lat_bucket", "lon_bucket", "risk_level"]],
        "hour", "emotion", "lat_bucket", "lon_bucket", "risk_level",
    ).agg(_count(), F.grouping("hour").alias("g_geo"))


def split_cubes(cells: DataFrame) -> dict[str, DataFrame]:
    """Five cubes from the grouping-sets result (``g_geo`` = 1 on the geographic set)."""
    her = cells.filter(F.col("g_geo") == F.lit(0)).select("hour", "emotion", "risk_level", "count")
    geo = cells.filter(F.col("g_geo") == F.lit(1)).select("lat_bucket", "lon_bucket", "risk_level", "count")
    hr = her.groupBy("hour", "risk_level").agg(F.sum("count").cast("long").alias("count"))
    er = her.groupBy("emotion", "risk_level").agg(F.sum("count").cast("long").alias("count"))
    return {
        "hour_risk_cube": hr,
        "emotion_risk_cube": er,
        "geographic_cube": geo,
        "hour_emotion_risk_cube": her,
        "risk_score_cube": risk_score_from(her),
    }


def build_cubes(df: DataFrame, out: str, files: int | None = None) -> dict[str, str]:
    """Write the five cubes under ``out``; returns name -> path.

    Cubes are small by construction (bounded by hours x emotions x risk
    levels, or by the number of 0.1-degree cells); AQE coalesces their
    shuffle output into few partitions, so the default keeps Spark's file
    layout. ``files=n`` forces n files per cube. The five writes read the
    checkpointed cells and run as concurrent jobs.
    """
    from vigil.session import run_concurrently
    from vigil.sources.files import write_parquet

    cells = cube_aggregate(df).checkpoint(eager=True)
    jobs = {name: (lambda c=cube, p=os.path.join(out, name): write_parquet(c, p, files=files))
            for name, cube in split_cubes(cells).items()}
    return run_concurrently(jobs)  # five independent writes of small frames


def read_cube(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out, name))


# C7-C10 readers
def cube_peak_hours(cube: DataFrame) -> DataFrame:
    return (cube.filter(is_danger()).select("hour", "count")
                .orderBy(F.desc("count"), F.asc_nulls_last("hour")))


def cube_geo_hotspots(cube: DataFrame, n: int = 50) -> DataFrame:
    """The n busiest DANGER cells (a top-k report; ties by cell) with coordinates."""
    top = (cube.filter(is_danger())
               .orderBy(F.desc("count"), F.asc_nulls_last("lat_bucket"), F.asc_nulls_last("lon_bucket"))
               .limit(n))
    return bucket_center(top).select("lat_bucket", "lon_bucket", "lat", "lon", "count")


def cube_top_risk(cube: DataFrame, n: int = 20) -> DataFrame:
    """The n riskiest (emotion, hour) conditions (a top-k report)."""
    return (cube.orderBy(F.desc_nulls_last("risk_score"), F.asc_nulls_last("emotion"), F.asc_nulls_last("hour"))
                .limit(n))


def cube_explorer(spark: SparkSession, path: str | None = None, cube: DataFrame | None = None) -> DataFrame:
    """Feed of the 3-D explorer: hour and count forced numeric (bad -> null)."""
    if cube is None:
        if path is None:
            raise ValueError("need a path or a cube")
        try:
            cube = spark.read.parquet(path)
        except Exception as e:  # noqa: BLE001 - surface as a clear error
            raise FileNotFoundError(f"cube not found: {path}") from e
    return to_numeric(cube, ["hour", "count"]).select("hour", "emotion", "risk_level", "count")


# A15
def hour_emotion_pivot(cube: DataFrame, emotions=K.MODEL_CLASSES) -> DataFrame:
    """hour x emotion table of summed counts, empty cells 0; emotions outside
    the fixed list, and null, are summed in ``other``."""
    known = F.coalesce(F.col("emotion").isin(*emotions), F.lit(False))
    cols = [F.coalesce(F.sum(F.when(F.col("emotion") == F.lit(e), F.col("count"))), F.lit(0)).cast("long").alias(e)
            for e in emotions]
    cols.append(F.coalesce(F.sum(F.when(~known, F.col("count"))), F.lit(0)).cast("long").alias("other"))
    return cube.groupBy("hour").agg(*cols).orderBy(F.asc_nulls_last("hour"))


def cube_explorer_status(cube: DataFrame) -> DataFrame:
    """One row for the explorer: number of cells and whether the cube is empty
    (the explorer shows a message instead of a chart then)."""
    return cube.agg(F.count(F.lit(1)).alias("cells")).withColumn("empty", F.col("cells") == F.lit(0))
