"""Stand-in inputs built from the driver's test tables.

Each adapter is a projection of one test table into the schema an operator
expects; none of them does an operator's work. The one rule applied here
is the stored ``risk_level`` of the safety-event table, assigned by the
library's risk rule as the live logger does when an event is written. They
are narrow (no shuffle), so an adapter followed by an operator is one scan
of the source table with its columns pruned at the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.scalars import with_risk
from vigil.schema import AUDIO_MEASURES, SAFETY_EVENT_COLUMNS

# fixed values: event type -> emotion of the stand-in safety events
EVENT_EMOTION = [("error", "fear"), ("click", "angry"), ("view", "neutral"),
                 ("signup", "sad"), ("purchase", "disgust")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _emotion(col: str = "event_type"):
    out = F.when(F.col(col) == F.lit(EVENT_EMOTION[0][0]), F.lit(EVENT_EMOTION[0][1]))
    for et, emo in EVENT_EMOTION[1:]:
        out = out.when(F.col(col) == F.lit(et), F.lit(emo))
    return out


def event_projection(events: DataFrame) -> DataFrame:
    """Raw events as safety-event columns, before any risk level is assigned."""
    conf = F.get_json_object("props", "$.k").try_cast("double")
    lat = F.lit(28.6139) + ((F.col("user_id") % F.lit(41)) - F.lit(20)).cast("double") * F.lit(0.01)
    lon = F.lit(77.209) + ((F.col("event_id") % F.lit(37)) - F.lit(18)).cast("double") * F.lit(0.01)
    base = events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("synthetic").alias("source"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        _emotion().alias("emotion"),
        conf.alias("confidence"),
        F.col("value"),
        F.concat(F.lit("device_"), F.col("user_id").cast("string")).alias("device_id"),
    )
    measures = {m: F.lit(None).cast("double") for m in AUDIO_MEASURES}
    measures["rms_energy"] = F.col("value") / F.lit(1000.0)
    measures["duration"] = F.lit(3.0)
    return base.select(
        "id", "timestamp", "source", "latitude", "longitude", "emotion", "confidence",
        *[measures[m].alias(m) for m in AUDIO_MEASURES],
        F.lit(K.MODEL_VERSION).alias("model_version"),
        "device_id",
        F.lit(None).cast("double").alias("processing_time_ms"),
    )


def safety_events_from(events: DataFrame) -> DataFrame:
    """SE: the 20-column safety event table as the event log stores it (the
    risk level is the one the live rule assigned when the event was logged)."""
    return with_risk(event_projection(events)).select(*SAFETY_EVENT_COLUMNS)


def safety_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return safety_events_from(table(spark, sf_dir, "events"))


def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IL: (id, time, inference_of_emotion) with fixed dirty rows."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    label = (F.when(eid % 50 == 0, F.lit(" Surprised "))
             .when(eid % 97 == 0, F.lit("unknown_x"))
             .when(eid % 101 == 0, F.lit(None).cast("string"))
             .otherwise(_emotion()))
    time = (F.when(eid % 53 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(eid % 59 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm"))
            .when(eid % 61 == 0, F.lit("n/a"))
            .when(eid % 67 == 0, F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
            .otherwise(F.date_format("ts", "HH:mm:ss")))
    return ev.select(eid.cast("string").alias("id"),
                     time.alias("time"),
                     label.alias("inference_of_emotion"))


def harmonised_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HL: (id, timestamp, inference)."""
    se = safety_events(spark, sf_dir)
    return se.select(F.col("device_id").alias("id"), "timestamp", F.initcap("emotion").alias("inference"))


def window_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WS: (clip_id, window_start, p_safe, p_fear, p_angry)."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    p_fear = k / F.lit(200.0)
    p_angry = (F.col("event_id") % F.lit(100)).cast("double") / F.lit(200.0)
    return ev.select(F.col("user_id").alias("clip_id"), F.col("ts").cast("timestamp").alias("window_start"),
                     (F.lit(1.0) - p_fear - p_angry).alias("p_safe"), p_fear.alias("p_fear"),
                     p_angry.alias("p_angry"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SG: (clip_id, sample_rate, samples array<double>)."""
    em = table(spark, sf_dir, "embeddings")
    factor = ((F.col("vec_id") % F.lit(10)).cast("double") + F.lit(0.5)) / F.lit(50.0)
    return em.select(F.col("vec_id").alias("clip_id"), F.lit(16).alias("sample_rate"),
                     F.transform("embedding", lambda x: x.cast("double") * factor).alias("samples"))


def probability_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PV: a 7-value class-score vector per embedding (first 7 values, absolute)."""
    em = table(spark, sf_dir, "embeddings")
    return em.select(F.col("vec_id").alias("clip_id"),
                     F.transform(F.slice("embedding", 1, 7), lambda x: F.abs(x.cast("double"))).alias("probs"))


# fixed values: code lists of the stand-in corpus (one invalid code each)
RAVDESS_CODES = ["01", "02", "03", "04", "05", "06", "07", "08", "09"]
CREMAD_CODES = ["ANG", "DIS", "FEA", "HAP", "NEU", "SAD", "ZZZ"]
TESS_WORDS = ["angry", "disgust", "fear", "happy", "neutral", "sad", "ps", "fearful"]
SAVEE_CODES = ["a", "d", "f", "h", "n", "sa", "su", "x"]


def _pick(codes, idx):
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (idx + F.lit(1)).cast("int"))


def corpus_paths(spark: SparkSession, sf_dir: str, root: str = "/corpus") -> DataFrame:
    """CP: one audio path per event in one of four naming schemes."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    sid = eid.cast("string")
    rav = F.concat(F.lit(f"{root}/ravdess/Actor_"), F.lpad(((eid % 24) + 1).cast("string"), 2, "0"),
                   F.lit("/03-01-"), _pick(RAVDESS_CODES, eid % 9), F.lit("-01-"), sid, F.lit(".wav"))
    cre = F.concat(F.lit(f"{root}/cremad/"), (eid + 1000).cast("string"), F.lit("_DFA_"),
                   _pick(CREMAD_CODES, eid % 7), F.lit("_XX.wav"))
    word = _pick(TESS_WORDS, eid % 8)
    tess = F.concat(F.lit(f"{root}/tess/OAF_"), word, F.lit("/OAF_w"), sid, F.lit("_"), word, F.lit(".wav"))
    sav = F.concat(F.lit(f"{root}/savee/"), _pick(SAVEE_CODES, eid % 8), sid, F.lit(".wav"))
    scheme = eid % 4
    path = (F.when(scheme == 0, rav).when(scheme == 1, cre).when(scheme == 2, tess).otherwise(sav))
    return ev.select(path.alias("path"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR: (label, prediction) from the labels table."""
    lb = table(spark, sf_dir, "labels")
    return lb.select(F.col("doc_id"), F.col("quality").alias("label"), (F.lit(1) - F.col("toxic")).alias("prediction"))
