"""The adapters of ``vigil.adapters`` written as SQL CTEs for the oracle.

Each constant is the body of a ``WITH`` entry over the driver's views.
Literals are cast to DOUBLE because DuckDB reads ``0.01`` as DECIMAL.
"""

from vigil import constants as K

DANGER, CAUTION, SAFE = K.DANGER, K.CAUTION, K.SAFE

EMOTION_CASE = ("CASE event_type WHEN 'error' THEN 'fear' WHEN 'click' THEN 'angry' WHEN 'view' THEN 'neutral' "
                "WHEN 'signup' THEN 'sad' WHEN 'purchase' THEN 'disgust' END")

SE_BASE = f"""
SELECT CAST(event_id AS VARCHAR) AS id,
       CAST(ts AS TIMESTAMP) AS "timestamp",
       'synthetic' AS source,
       28.6139::DOUBLE + CAST((user_id % 41) - 20 AS DOUBLE) * 0.01::DOUBLE AS latitude,
       77.209::DOUBLE + CAST((event_id % 37) - 18 AS DOUBLE) * 0.01::DOUBLE AS longitude,
       {EMOTION_CASE} AS emotion,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS confidence,
       value / 1000.0::DOUBLE AS rms_energy,
       CAST(NULL AS DOUBLE) AS zero_crossing_rate,
       CAST(NULL AS DOUBLE) AS spectral_centroid,
       CAST(NULL AS DOUBLE) AS spectral_bandwidth,
       CAST(NULL AS DOUBLE) AS mfcc_mean,
       CAST(NULL AS DOUBLE) AS mfcc_std,
       3.0::DOUBLE AS duration,
       CAST(NULL AS DOUBLE) AS silence_ratio,
       '{K.MODEL_VERSION}' AS model_version,
       'device_' || CAST(user_id AS VARCHAR) AS device_id,
       CAST(NULL AS DOUBLE) AS processing_time_ms
FROM events
"""


def risk_case(threshold: float | None = 50.0, strict: bool = False, signal: bool = False) -> str:
    op = ">" if strict else ">="
    cond = "" if threshold is None else f" AND confidence {op} {float(threshold)}::DOUBLE"
    d, c, s = ("'D'", "'C'", "'S'") if signal else (f"'{DANGER}'", f"'{CAUTION}'", f"'{SAFE}'")
    return (f"CASE WHEN emotion = 'fear'{cond} THEN {d} WHEN emotion = 'angry'{cond} THEN {c} ELSE {s} END")


SE = f"""
se_base AS ({SE_BASE}),
se AS (
SELECT id, "timestamp", source, latitude, longitude, emotion, confidence,
       {risk_case()} AS risk_level,
       rms_energy, zero_crossing_rate, spectral_centroid, spectral_bandwidth, mfcc_mean, mfcc_std,
       duration, silence_ratio, model_version, device_id,
       {risk_case(signal=True)} AS mqtt_signal,
       processing_time_ms
FROM se_base)
"""

IL = f"""
il AS (
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_id % 53 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
            WHEN event_id % 59 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M')
            WHEN event_id % 61 = 0 THEN 'n/a'
            WHEN event_id % 67 = 0 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
            ELSE strftime(ts, '%H:%M:%S') END AS "time",
       CASE WHEN event_id % 50 = 0 THEN ' Surprised '
            WHEN event_id % 97 = 0 THEN 'unknown_x'
            WHEN event_id % 101 = 0 THEN NULL
            ELSE {EMOTION_CASE} END AS inference_of_emotion
FROM events)
"""

# title case of a one-word emotion (what initcap does to it)
HL = """
hl AS (
SELECT device_id AS id, "timestamp", upper(substr(emotion, 1, 1)) || lower(substr(emotion, 2)) AS inference
FROM se)
"""

HLC = """
hlc AS (
SELECT id, "timestamp", inference,
       CASE WHEN inference IN ('Fear', 'Angry', 'Sad', 'Disgust') THEN 'Unsafe'
            WHEN inference IN ('Neutral', 'Happy', 'Calm', 'Surprise') THEN 'Safe'
            ELSE 'Unassigned' END AS "class"
FROM hl)
"""

WS = """
ws AS (
SELECT user_id AS clip_id, CAST(ts AS TIMESTAMP) AS window_start,
       1.0::DOUBLE - TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) / 200.0::DOUBLE
                   - CAST(event_id % 100 AS DOUBLE) / 200.0::DOUBLE AS p_safe,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) / 200.0::DOUBLE AS p_fear,
       CAST(event_id % 100 AS DOUBLE) / 200.0::DOUBLE AS p_angry
FROM events)
"""

SG = """
sg AS (
SELECT vec_id AS clip_id, 16 AS sample_rate,
       list_transform(embedding, lambda x: CAST(x AS DOUBLE) * ((CAST(vec_id % 10 AS DOUBLE) + 0.5::DOUBLE) / 50.0::DOUBLE)) AS samples
FROM embeddings)
"""

PV = """
pv AS (
SELECT vec_id AS clip_id, list_transform(embedding[1:7], lambda x: abs(CAST(x AS DOUBLE))) AS probs
FROM embeddings)
"""

PR = """
pr AS (SELECT doc_id, quality AS label, 1 - toxic AS prediction FROM labels)
"""

CP = """
cp AS (
SELECT CASE event_id % 4
  WHEN 0 THEN '/corpus/ravdess/Actor_' || lpad(CAST(event_id % 24 + 1 AS VARCHAR), 2, '0') || '/03-01-'
              || (['01','02','03','04','05','06','07','08','09'])[event_id % 9 + 1] || '-01-' || CAST(event_id AS VARCHAR) || '.wav'
  WHEN 1 THEN '/corpus/cremad/' || CAST(event_id + 1000 AS VARCHAR) || '_DFA_'
              || (['ANG','DIS','FEA','HAP','NEU','SAD','ZZZ'])[event_id % 7 + 1] || '_XX.wav'
  WHEN 2 THEN '/corpus/tess/OAF_' || (['angry','disgust','fear','happy','neutral','sad','ps','fearful'])[event_id % 8 + 1]
              || '/OAF_w' || CAST(event_id AS VARCHAR) || '_'
              || (['angry','disgust','fear','happy','neutral','sad','ps','fearful'])[event_id % 8 + 1] || '.wav'
  ELSE '/corpus/savee/' || (['a','d','f','h','n','sa','su','x'])[event_id % 8 + 1] || CAST(event_id AS VARCHAR) || '.wav'
  END AS path
FROM events)
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
