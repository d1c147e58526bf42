"""Counts, rates and risk ratios over safety events.

Every operator is one scan with a partial (map-side) aggregation, so the
shuffle carries at most one row per group per task no matter how the keys
are skewed. The reference computes the risk ratio as a left join of two
aggregates (two scans, and a null emotion loses its danger rows); here it
is one conditional aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.scalars import with_hour


def is_danger(col: str = "risk_level"):
    return F.col(col) == F.lit(K.DANGER)


# A1
def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


# A2
def risk_distribution(df: DataFrame) -> DataFrame:
    return (df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc("risk_level")))


# A3
def danger_rate(df: DataFrame) -> DataFrame:
    """total, danger and percentage; percentage is null on an empty table."""
    agg = df.agg(F.count(F.lit(1)).alias("total_events"), F.count_if(is_danger()).alias("danger_events"))
    return agg.withColumn("danger_rate",
                          F.try_divide(F.col("danger_events").cast("double") * F.lit(100.0), F.col("total_events")))


# A4 / A5 / A6
def emotion_distribution(df: DataFrame) -> DataFrame:
    return (df.groupBy("emotion").agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc("emotion")))


def emotion_risk(df: DataFrame) -> DataFrame:
    return (df.groupBy("emotion", "risk_level").agg(F.count(F.lit(1)).alias("count"))
              .orderBy("emotion", "risk_level"))


def _risk_columns():
    # pivot on the three fixed literals, any other level (or none) in ``other``: one pass, no distinct-values job
    known = F.coalesce(F.col("risk_level").isin(*K.RISK_LEVELS), F.lit(False))
    return [F.count_if(F.col("risk_level") == F.lit(r)).alias(r) for r in K.RISK_LEVELS] + [F.count_if(~known).alias("other")]


def emotion_risk_pivot(df: DataFrame) -> DataFrame:
    return df.groupBy("emotion").agg(*_risk_columns()).orderBy("emotion")


# A7 / A8 / A9
def hourly_risk(df: DataFrame) -> DataFrame:
    return (with_hour(df).groupBy("hour", "risk_level").agg(F.count(F.lit(1)).alias("count"))
              .orderBy("hour", "risk_level"))


def hourly_risk_pivot(df: DataFrame) -> DataFrame:
    return with_hour(df).groupBy("hour").agg(*_risk_columns()).orderBy("hour")


def _peak(counts: DataFrame, key: str, count: str) -> tuple:
    """(key, count) of the largest count; ties go to the smallest key."""
    order = F.struct(-F.col(count), F.col(key))
    return F.min_by(F.col(key), order), F.max(F.col(count))


def peak_danger_hour(df: DataFrame) -> DataFrame:
    """Hour with most DANGER events; ties -> earliest hour; null if none."""
    per_hour = (with_hour(df).filter(is_danger() & F.col("hour").isNotNull())
                .groupBy("hour").agg(F.count(F.lit(1)).alias("n")))
    k, n = _peak(per_hour, "hour", "n")
    out = per_hour.agg(k.alias("peak_danger_hour"), n.alias("peak_danger_events"))
    return out.withColumn("peak_danger_label",
                          F.when(F.col("peak_danger_hour").isNotNull(),
                                 F.concat(F.col("peak_danger_hour").cast("string"), F.lit(":00"))))


# A10
def top_emotion(df: DataFrame) -> DataFrame:
    """Most common emotion; ties -> alphabetically first; null on empty."""
    per = df.filter(F.col("emotion").isNotNull()).groupBy("emotion").agg(F.count(F.lit(1)).alias("n"))
    k, n = _peak(per, "emotion", "n")
    return per.agg(k.alias("top_emotion"), n.alias("top_emotion_events"))


# A11
def summary_report(df: DataFrame, stream_df: DataFrame | None = None) -> DataFrame:
    """One-row report from a single scan.

    One aggregation at (emotion, hour) grain (at most |emotions| x 25 rows)
    feeds every figure: per-emotion totals and per-hour danger counts are
    windows over that small result, and one global aggregation picks the
    figures. The plan is linear, so the event table is read once.
    """
    fine = (with_hour(df).groupBy("emotion", "hour")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_danger()).alias("d")))
    fine = fine.withColumns({
        "_emo_n": F.sum("n").over(Window.partitionBy("emotion")),
        "_hour_d": F.sum("d").over(Window.partitionBy("hour")),
    })
    emo_key = F.when(F.col("emotion").isNotNull(), F.struct(-F.col("_emo_n"), F.col("emotion")))
    hour_key = F.when(F.col("hour").isNotNull() & (F.col("_hour_d") > 0), F.struct(-F.col("_hour_d"), F.col("hour")))
    out = fine.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_events"),
        F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("danger_events"),
        F.min_by(F.col("emotion"), emo_key).alias("top_emotion"),   # rows with a null key are skipped
        F.min_by(F.col("hour"), hour_key).alias("peak_danger_hour"),
    ).withColumn("danger_rate", F.try_divide(F.col("danger_events").cast("double") * F.lit(100.0),
                                             F.col("total_events")))
    if stream_df is None:
        stream = out.sparkSession.range(1).select(F.lit(0).cast("long").alias("streaming_events"))
    else:
        stream = stream_df.agg(F.count(F.lit(1)).alias("streaming_events"))
    return out.crossJoin(stream).select("total_events", "danger_events", "danger_rate", "top_emotion",
                                        "peak_danger_hour", "streaming_events")


# J1 / J2
def _risk_score(df: DataFrame, keys: list[str]) -> DataFrame:
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_events"),
                                F.count_if(is_danger()).alias("danger_events"))
    return agg.withColumn("risk_score", F.col("danger_events") / F.col("total_events"))


def risk_score_by_emotion(df: DataFrame) -> DataFrame:
    return _risk_score(df, ["emotion"]).orderBy(F.desc("risk_score"), F.asc("emotion"))


def risk_score_cube(df: DataFrame) -> DataFrame:
    return _risk_score(with_hour(df), ["emotion", "hour"])
