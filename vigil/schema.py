"""Fixed StructTypes of the tables the library reads and writes."""

from pyspark.sql import types as T

D = T.DoubleType()
S = T.StringType()

AUDIO_MEASURES = [
    "rms_energy", "zero_crossing_rate", "spectral_centroid", "spectral_bandwidth",
    "mfcc_mean", "mfcc_std", "duration", "silence_ratio",
]

SAFETY_EVENT = T.StructType(
    [
        T.StructField("id", S, False),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("source", S, True),
        T.StructField("latitude", D, True),
        T.StructField("longitude", D, True),
        T.StructField("emotion", S, True),
        T.StructField("confidence", D, True),
        T.StructField("risk_level", S, True),
    ]
    + [T.StructField(c, D, True) for c in AUDIO_MEASURES]
    + [
        T.StructField("model_version", S, True),
        T.StructField("device_id", S, True),
        T.StructField("mqtt_signal", S, True),
        T.StructField("processing_time_ms", D, True),
    ]
)
SAFETY_EVENT_COLUMNS = [f.name for f in SAFETY_EVENT.fields]

# same columns with the timestamp kept as text, as written by the CSV exporter
SAFETY_EVENT_CSV = T.StructType(
    [T.StructField(f.name, S if f.name == "timestamp" else f.dataType, f.nullable) for f in SAFETY_EVENT.fields]
)

INFERENCE_LOG = T.StructType(
    [T.StructField("id", S, True), T.StructField("time", S, True), T.StructField("inference_of_emotion", S, True)]
)

HARMONISED_LOG = T.StructType(
    [T.StructField("id", S, True), T.StructField("timestamp", T.TimestampType(), True),
     T.StructField("inference", S, True)]
)

STREAM_EVENT = T.StructType(
    [T.StructField("timestamp", T.TimestampType(), True), T.StructField("latitude", D, True),
     T.StructField("longitude", D, True), T.StructField("risk_level", S, True)]
)

WINDOW_SCORE = T.StructType(
    [T.StructField("clip_id", T.LongType(), True), T.StructField("window_start", T.TimestampType(), True),
     T.StructField("p_safe", D, True), T.StructField("p_fear", D, True), T.StructField("p_angry", D, True)]
)

SIGNAL = T.StructType(
    [T.StructField("clip_id", T.LongType(), True), T.StructField("sample_rate", T.IntegerType(), True),
     T.StructField("samples", T.ArrayType(D), True)]
)

# raw events as they arrive (the stream source); event time without zone
RAW_EVENT = T.StructType(
    [T.StructField("event_id", T.LongType(), True), T.StructField("ts", T.TimestampNTZType(), True),
     T.StructField("user_id", T.LongType(), True), T.StructField("event_type", S, True),
     T.StructField("value", D, True), T.StructField("props", S, True)]
)
