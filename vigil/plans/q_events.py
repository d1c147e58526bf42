"""Queries over safety events: scalars, counts, risk ratios and cubes."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import adapters as A
from vigil.functions import scalars as X
from vigil.operators import cubes as C
from vigil.operators import profile as PF
from vigil.operators import risk as R
from vigil.plans.catalog import register
from vigil.plans.sql_inputs import CAUTION, DANGER, IL, PV, SAFE, SE, risk_case, with_
from vigil.schema import SAFETY_EVENT_COLUMNS

W = with_(SE)
HOUR = 'CAST(hour("timestamp") AS INTEGER)'
RISK_COLS = ", ".join(f"count_if(risk_level = '{r}') AS \"{r}\"" for r in (DANGER, CAUTION, SAFE))
RISK_COLS += f", count_if(NOT coalesce(risk_level IN ('{DANGER}', '{CAUTION}', '{SAFE}'), false)) AS other"


def se(spark, d):
    return A.safety_events(spark, d)


# ---- A1-A11, J1, J2 --------------------------------------------------------------
@register("row_count", W + "SELECT count(*) AS row_count FROM se")
def q_row_count(spark, d):
    return R.row_count(se(spark, d))


@register("risk_distribution", W + "SELECT risk_level, count(*) AS count FROM se GROUP BY risk_level")
def q_risk_distribution(spark, d):
    return R.risk_distribution(se(spark, d))


@register("danger_rate", W + f"""
SELECT count(*) AS total_events, count_if(risk_level = '{DANGER}') AS danger_events,
       CASE WHEN count(*) = 0 THEN NULL
            ELSE CAST(count_if(risk_level = '{DANGER}') AS DOUBLE) * 100.0::DOUBLE / count(*) END AS danger_rate
FROM se""")
def q_danger_rate(spark, d):
    return R.danger_rate(se(spark, d))


@register("emotion_distribution", W + "SELECT emotion, count(*) AS count FROM se GROUP BY emotion")
def q_emotion_distribution(spark, d):
    return R.emotion_distribution(se(spark, d))


@register("emotion_risk", W + "SELECT emotion, risk_level, count(*) AS count FROM se GROUP BY emotion, risk_level")
def q_emotion_risk(spark, d):
    return R.emotion_risk(se(spark, d))


@register("emotion_risk_pivot", W + f"SELECT emotion, {RISK_COLS} FROM se GROUP BY emotion")
def q_emotion_risk_pivot(spark, d):
    return R.emotion_risk_pivot(se(spark, d))


@register("hourly_risk", W + f"SELECT {HOUR} AS hour, risk_level, count(*) AS count FROM se GROUP BY 1, 2")
def q_hourly_risk(spark, d):
    return R.hourly_risk(se(spark, d))


@register("hourly_risk_pivot", W + f"SELECT {HOUR} AS hour, {RISK_COLS} FROM se GROUP BY 1")
def q_hourly_risk_pivot(spark, d):
    return R.hourly_risk_pivot(se(spark, d))


PEAK_CTE = f""", ph AS (
SELECT {HOUR} AS hour, count(*) AS n FROM se
WHERE risk_level = '{DANGER}' AND "timestamp" IS NOT NULL GROUP BY 1)
"""


@register("peak_danger_hour", W + PEAK_CTE + """
SELECT (SELECT hour FROM ph ORDER BY n DESC, hour LIMIT 1) AS peak_danger_hour,
       (SELECT max(n) FROM ph) AS peak_danger_events,
       (SELECT CAST(hour AS VARCHAR) || ':00' FROM ph ORDER BY n DESC, hour LIMIT 1) AS peak_danger_label""")
def q_peak_danger_hour(spark, d):
    return R.peak_danger_hour(se(spark, d))


TOP_CTE = """, te AS (SELECT emotion, count(*) AS n FROM se WHERE emotion IS NOT NULL GROUP BY 1)
"""


@register("top_emotion", W + TOP_CTE + """
SELECT (SELECT emotion FROM te ORDER BY n DESC, emotion LIMIT 1) AS top_emotion,
       (SELECT max(n) FROM te) AS top_emotion_events""")
def q_top_emotion(spark, d):
    return R.top_emotion(se(spark, d))


@register("summary_report", W + PEAK_CTE + TOP_CTE + f"""
SELECT count(*) AS total_events, count_if(risk_level = '{DANGER}') AS danger_events,
       CASE WHEN count(*) = 0 THEN NULL
            ELSE CAST(count_if(risk_level = '{DANGER}') AS DOUBLE) * 100.0::DOUBLE / count(*) END AS danger_rate,
       (SELECT emotion FROM te ORDER BY n DESC, emotion LIMIT 1) AS top_emotion,
       (SELECT hour FROM ph ORDER BY n DESC, hour LIMIT 1) AS peak_danger_hour,
       CAST(0 AS BIGINT) AS streaming_events
FROM se""")
def q_summary_report(spark, d):
    return R.summary_report(se(spark, d))


RISK_SCORE_SQL = f"""
SELECT emotion, count(*) AS total_events, count_if(risk_level = '{DANGER}') AS danger_events,
       CAST(count_if(risk_level = '{DANGER}') AS DOUBLE) / count(*) AS risk_score
FROM se GROUP BY emotion"""


@register("risk_score_by_emotion", W + RISK_SCORE_SQL)
def q_risk_score_by_emotion(spark, d):
    return R.risk_score_by_emotion(se(spark, d))


RISK_CUBE_SQL = f"""
SELECT emotion, {HOUR} AS hour, count(*) AS total_events, count_if(risk_level = '{DANGER}') AS danger_events,
       CAST(count_if(risk_level = '{DANGER}') AS DOUBLE) / count(*) AS risk_score
FROM se GROUP BY 1, 2"""


@register("risk_score_cube", W + RISK_CUBE_SQL)
def q_risk_score_cube(spark, d):
    return R.risk_score_cube(se(spark, d))


# ---- cubes C1-C10, A15 -------------------------------------------------------------
HR_SQL = f"SELECT {HOUR} AS hour, risk_level, count(*) AS count FROM se GROUP BY 1, 2"
GEO_SQL = ("SELECT CAST(trunc(latitude * 10.0::DOUBLE) AS INTEGER) AS lat_bucket, "
           "CAST(trunc(longitude * 10.0::DOUBLE) AS INTEGER) AS lon_bucket, risk_level, count(*) AS count "
           "FROM se GROUP BY 1, 2, 3")
HER_SQL = f"SELECT {HOUR} AS hour, emotion, risk_level, count(*) AS count FROM se GROUP BY 1, 2, 3"


@register("hour_risk_cube", W + HR_SQL)
def q_hour_risk_cube(spark, d):
    return C.hour_risk_cube(se(spark, d))


@register("emotion_risk_cube", W + "SELECT emotion, risk_level, count(*) AS count FROM se GROUP BY 1, 2")
def q_emotion_risk_cube(spark, d):
    return C.emotion_risk_cube(se(spark, d))


@register("geographic_cube", W + GEO_SQL)
def q_geographic_cube(spark, d):
    return C.geographic_cube(se(spark, d))


@register("hour_emotion_risk_cube", W + HER_SQL)
def q_hour_emotion_risk_cube(spark, d):
    return C.hour_emotion_risk_cube(se(spark, d))


@register("cube_peak_hours", W + f", cube AS ({HR_SQL})\nSELECT hour, count FROM cube WHERE risk_level = '{DANGER}'")
def q_cube_peak_hours(spark, d):
    return C.cube_peak_hours(C.hour_risk_cube(se(spark, d)))


@register("cube_geo_hotspots", W + f""", cube AS ({GEO_SQL})
SELECT lat_bucket, lon_bucket, lat_bucket / 10.0::DOUBLE AS lat, lon_bucket / 10.0::DOUBLE AS lon, count
FROM cube WHERE risk_level = '{DANGER}' ORDER BY count DESC, lat_bucket, lon_bucket LIMIT 50""")
def q_cube_geo_hotspots(spark, d):
    return C.cube_geo_hotspots(C.geographic_cube(se(spark, d)), 50)


@register("cube_top_risk", W + f""", cube AS ({RISK_CUBE_SQL})
SELECT * FROM cube ORDER BY risk_score DESC NULLS LAST, emotion, hour LIMIT 20""")
def q_cube_top_risk(spark, d):
    return C.cube_top_risk(C.risk_score_cube(se(spark, d)), 20)


@register("cube_explorer", W + f""", cube AS ({HER_SQL})
SELECT TRY_CAST(hour AS DOUBLE) AS hour, emotion, risk_level, TRY_CAST(count AS DOUBLE) AS count FROM cube""")
def q_cube_explorer(spark, d):
    return C.cube_explorer(spark, cube=C.hour_emotion_risk_cube(se(spark, d)))


PIVOT_COLS = ", ".join(f"CAST(coalesce(sum(CASE WHEN emotion = '{e}' THEN count END), 0) AS BIGINT) AS \"{e}\""
                       for e in X.K.MODEL_CLASSES)
PIVOT_COLS += (", CAST(coalesce(sum(CASE WHEN NOT coalesce(emotion IN (" + ", ".join(f"'{e}'" for e in X.K.MODEL_CLASSES)
               + "), false) THEN count END), 0) AS BIGINT) AS other")


@register("hour_emotion_pivot", W + f", cube AS ({HER_SQL})\nSELECT hour, {PIVOT_COLS} FROM cube GROUP BY hour")
def q_hour_emotion_pivot(spark, d):
    return C.hour_emotion_pivot(C.hour_emotion_risk_cube(se(spark, d)))


@register("build_cubes", W + f""", c AS (
SELECT 'emotion_risk_cube' AS cube, count(*) AS cells, sum(n) AS events FROM (SELECT emotion, risk_level, count(*) AS n FROM se GROUP BY 1, 2)
UNION ALL SELECT 'geographic_cube', count(*), sum(count) FROM ({GEO_SQL})
UNION ALL SELECT 'hour_emotion_risk_cube', count(*), sum(count) FROM ({HER_SQL})
UNION ALL SELECT 'hour_risk_cube', count(*), sum(count) FROM ({HR_SQL})
UNION ALL SELECT 'risk_score_cube', count(*), sum(total_events) FROM ({RISK_CUBE_SQL}))
SELECT cube, cells, CAST(events AS BIGINT) AS events FROM c""")
def q_build_cubes(spark, d):
    """Writes all five cubes (one scan of the events), then reads them back."""
    from vigil.session import scratch_path

    out = scratch_path(spark, "cubes")
    paths = C.build_cubes(se(spark, d), out)
    frames = []
    for name in C.CUBE_NAMES:
        cube = spark.read.parquet(paths[name])
        measure = "total_events" if name == "risk_score_cube" else "count"
        frames.append(cube.agg(F.lit(name).alias("cube"), F.count(F.lit(1)).alias("cells"),
                               F.sum(measure).cast("long").alias("events")))
    out_df = frames[0]
    for f in frames[1:]:
        out_df = out_df.unionByName(f)
    return out_df


# ---- scalars X1-X25 ------------------------------------------------------------------
@register("danger", W + f"""SELECT id, "timestamp", emotion, confidence, risk_level FROM se
WHERE risk_level = '{DANGER}'""")
def q_danger(spark, d):
    return X.danger(se(spark, d)).select("id", "timestamp", "emotion", "confidence", "risk_level")


@register("with_time_parts", W + f"""SELECT id, "timestamp" AS timestamp_parsed, {HOUR} AS hour,
CAST("timestamp" AS DATE) AS date FROM se""")
def q_with_time_parts(spark, d):
    df = X.with_date(X.with_hour(X.with_timestamp(se(spark, d))))
    return df.select("id", "timestamp_parsed", "hour", "date")


@register("with_geo_bucket", W + """SELECT id, CAST(trunc(latitude * 10.0::DOUBLE) AS INTEGER) AS lat_bucket,
CAST(trunc(longitude * 10.0::DOUBLE) AS INTEGER) AS lon_bucket,
CAST(trunc(latitude * 10.0::DOUBLE) AS INTEGER) / 10.0::DOUBLE AS lat,
CAST(trunc(longitude * 10.0::DOUBLE) AS INTEGER) / 10.0::DOUBLE AS lon FROM se""")
def q_with_geo_bucket(spark, d):
    return X.bucket_center(X.with_geo_bucket(se(spark, d))).select("id", "lat_bucket", "lon_bucket", "lat", "lon")


@register("with_risk_strict", W + f"""SELECT id, {risk_case(50.0, True)} AS risk_level,
{risk_case(50.0, True, True)} AS mqtt_signal FROM se""")
def q_with_risk_strict(spark, d):
    return X.with_risk(se(spark, d), threshold=50.0, strict=True).select("id", "risk_level", "mqtt_signal")


@register("with_risk_no_threshold", W + f"""SELECT id, {risk_case(None)} AS risk_level,
{risk_case(None, signal=True)} AS mqtt_signal FROM se""")
def q_with_risk_no_threshold(spark, d):
    return X.with_risk(se(spark, d), threshold=None).select("id", "risk_level", "mqtt_signal")


@register("with_safety_status", W + f"""SELECT id, emotion,
coalesce(emotion IN ('fear', 'angry'), false) AND coalesce(emotion <> 'disgust', true) AS is_unsafe,
CASE WHEN emotion = 'disgust' THEN '{X.K.STATUS_FILTERED}'
     WHEN coalesce(emotion IN ('fear', 'angry'), false) THEN '{X.K.STATUS_UNSAFE}'
     ELSE '{X.K.STATUS_SAFE}' END AS status FROM se""")
def q_with_safety_status(spark, d):
    return X.with_safety_status(se(spark, d)).select("id", "emotion", "is_unsafe", "status")


CLASS_LIST = "[" + ", ".join(f"'{c}'" for c in X.K.MODEL_CLASSES) + "]"


@register("with_top_class", with_(PV) + f"""SELECT clip_id,
CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS top_index,
({CLASS_LIST})[list_position(probs, list_max(probs))] AS top_label,
list_max(probs) * 100.0::DOUBLE AS top_confidence FROM pv""")
def q_with_top_class(spark, d):
    return X.with_top_class(A.probability_vectors(spark, d)).select("clip_id", "top_index", "top_label",
                                                                      "top_confidence")


def title_one(v: str) -> str:
    """Title case of a one-token label in DuckDB (no initcap there)."""
    rx = "'^([^a-z]*)([a-z])(.*)$'"
    return (f"regexp_extract(lower({v}), {rx}, 1) || upper(regexp_extract(lower({v}), {rx}, 2)) "
            f"|| regexp_extract(lower({v}), {rx}, 3)")


@register("class_probabilities", with_(PV) + f"""SELECT clip_id, CAST(i - 1 AS INTEGER) AS class_index,
upper(substr(({CLASS_LIST})[i], 1, 1)) || substr(({CLASS_LIST})[i], 2) AS "class",
probs[i] AS probability
FROM pv, range(1, 8) t(i)""")
def q_class_probabilities(spark, d):
    return X.class_probabilities(A.probability_vectors(spark, d), keys=["clip_id"])


@register("with_alert_colour", W + """SELECT id, risk_level,
CASE WHEN contains(risk_level, 'DANGER') THEN 'red' WHEN contains(risk_level, 'CAUTION') THEN 'orange'
ELSE 'green' END AS colour FROM se""")
def q_with_alert_colour(spark, d):
    return X.with_alert_colour(se(spark, d)).select("id", "risk_level", "colour")


@register("within_radius", W + """SELECT id, latitude, longitude FROM se
WHERE sqrt(pow(latitude - 28.6139::DOUBLE, 2) + pow(longitude - 77.209::DOUBLE, 2)) <= 1.5::DOUBLE / 111.0::DOUBLE""")
def q_within_radius(spark, d):
    return X.within_radius(se(spark, d), 28.6139, 77.209, 1.5).select("id", "latitude", "longitude")


@register("fill_measures", W + """SELECT id, coalesce(rms_energy, 0) AS rms_energy,
coalesce(zero_crossing_rate, 0) AS zero_crossing_rate, coalesce(mfcc_mean, 0) AS mfcc_mean FROM se""")
def q_fill_measures(spark, d):
    cols = ["rms_energy", "zero_crossing_rate", "mfcc_mean"]
    return X.fill_measures(se(spark, d), cols).select("id", *cols)


@register("canonical_label", with_(IL) + """SELECT id,
CASE WHEN lower(trim(coalesce(inference_of_emotion, 'nan'))) = 'surprised' THEN 'surprise'
     ELSE lower(trim(coalesce(inference_of_emotion, 'nan'))) END AS label FROM il""")
def q_canonical_label(spark, d):
    return A.inference_log(spark, d).select("id", X.canonical_label("inference_of_emotion").alias("label"))


@register("title_label", with_(IL) + f"""SELECT id,
CASE WHEN inference_of_emotion IS NULL THEN NULL ELSE {title_one('inference_of_emotion')} END AS title
FROM il""")
def q_title_label(spark, d):
    return A.inference_log(spark, d).select("id", X.title_label("inference_of_emotion").alias("title"))


@register("to_numeric", with_(IL) + """SELECT TRY_CAST(id AS DOUBLE) AS id, TRY_CAST("time" AS DOUBLE) AS "time",
inference_of_emotion FROM il""")
def q_to_numeric(spark, d):
    return X.to_numeric(A.inference_log(spark, d), ["id", "time"])


# ---- profiling A12-A14, samples L1/L2, stamping X22 ------------------------------------

ALL_SE = ", ".join(f'"{c}"' for c in SAFETY_EVENT_COLUMNS)


@register("null_counts", W + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count_if(\"{c}\" IS NULL) AS nulls FROM se" for c in SAFETY_EVENT_COLUMNS))
def q_null_counts(spark, d):
    return PF.null_counts(se(spark, d))


NUMERIC_SE = ["latitude", "longitude", "confidence", "rms_energy", "zero_crossing_rate", "spectral_centroid",
              "spectral_bandwidth", "mfcc_mean", "mfcc_std", "duration", "silence_ratio", "processing_time_ms"]


@register("describe_table", W + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 9) AS mean,
       round(stddev_samp({c}), 9) AS stddev, min({c}) AS min, max({c}) AS max FROM se""" for c in NUMERIC_SE))
def q_describe_table(spark, d):
    out = PF.describe_table(se(spark, d))
    return out.withColumns({"mean": F.round("mean", 9), "stddev": F.round("stddev", 9)})


@register("sample_records", W + f"SELECT {ALL_SE} FROM se ORDER BY id LIMIT 10")
def q_sample_records(spark, d):
    return PF.sample_records(se(spark, d), 10)


@register("recent_events", W + f"""SELECT {ALL_SE} FROM se ORDER BY "timestamp" DESC, id DESC LIMIT 10""")
def q_recent_events(spark, d):
    return PF.recent_events(se(spark, d), 10)


@register("stamp_events")
def q_stamp_events(spark, d):
    """Events re-stamped as live arrivals: new uuid and current time (rows check)."""
    out = X.stamp_events(se(spark, d), "live")
    return out.select("id", "timestamp", "source", "model_version", "device_id", "emotion", "risk_level")
