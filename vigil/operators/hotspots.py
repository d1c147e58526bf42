"""Geographic hotspots of danger events (K1, K2).

KMeans is Spark ML's distributed implementation (k-means|| initialisation,
one aggregation per iteration); only the k centres reach the driver.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.scalars import danger

CENTRES = T.StructType([T.StructField("hotspot", T.IntegerType()), T.StructField("latitude", T.DoubleType()),
                        T.StructField("longitude", T.DoubleType())])


# K1
def geo_features(df: DataFrame, out: str = "features") -> DataFrame:
    """(latitude, longitude) vector; rows without a location are skipped."""
    va = VectorAssembler(inputCols=["latitude", "longitude"], outputCol=out, handleInvalid="skip")
    return va.transform(df)


# K2
def fit_hotspots(df: DataFrame, k: int = 10, seed: int = 1, max_iter: int = 20, tol: float = 1e-4) -> KMeansModel:
    if not 2 <= k <= 20:
        raise ValueError("k must be between 2 and 20")
    return KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features").fit(geo_features(danger(df)))


def centres_frame(spark, centres) -> DataFrame:
    """k centres as a small frame, ordered by position (k <= 20 rows)."""
    rows = sorted((float(c[0]), float(c[1])) for c in centres)
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], CENTRES)


def geo_hotspots(df: DataFrame, k: int = 10, seed: int = 1, max_iter: int = 20, tol: float = 1e-4) -> DataFrame:
    """Cluster centres of DANGER events, ordered by (latitude, longitude). With
    enough iterations and a small ``tol`` (degrees) the centres settle on the
    means of their events."""
    model = fit_hotspots(df, k, seed, max_iter, tol)
    return centres_frame(df.sparkSession, model.clusterCenters())


def assign_hotspot(df: DataFrame, centres: DataFrame) -> DataFrame:
    """Nearest centre of every located row, without a shuffle: the k <= 20
    centres are gathered into one array row, broadcast, and each row takes
    the minimum of (squared distance, hotspot) over that array."""
    cs = centres.agg(F.collect_list(F.struct("hotspot", "latitude", "longitude")).alias("_cs"))
    j = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).crossJoin(F.broadcast(cs))
    dist = F.transform("_cs", lambda c: F.struct(
        (F.pow(F.col("latitude") - c["latitude"], 2) + F.pow(F.col("longitude") - c["longitude"], 2)).alias("d2"),
        c["hotspot"].alias("hotspot")))
    return j.withColumn("hotspot", F.array_min(dist)["hotspot"]).drop("_cs")
