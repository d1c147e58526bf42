"""Fixed values the results depend on.

Everything in this module is a literal that must equal the values used by the
application whose queries this library answers (risk labels, label sets,
thresholds, corpus code tables). Keep them here, in natural order, and import
them; never retype them elsewhere.
"""

# --- fixed values: risk levels and MQTT signals -----------------------------
DANGER = "🚨 DANGER"
CAUTION = "⚠️ CAUTION"  # warning sign and variation selector 16
SAFE = "✅ SAFE"
RISK_LEVELS = [DANGER, CAUTION, SAFE]

SIGNAL_DANGER = "D"
SIGNAL_CAUTION = "C"
SIGNAL_SAFE = "S"

# emotion -> (risk level, signal); every other emotion is SAFE / S
EMOTION_RISK = {
    "fear": (DANGER, SIGNAL_DANGER),
    "angry": (CAUTION, SIGNAL_CAUTION),
}
CONFIDENCE_THRESHOLD = 50.0

# --- fixed values: label sets ------------------------------------------------
MODEL_CLASSES = ["angry", "disgust", "fear", "happy", "neutral", "sad", "surprise"]
VALID_LABELS = ["happy", "sad", "fear", "neutral", "angry", "disgust", "surprise"]
LABEL_NORMALIZE = {"surprised": "surprise"}
REQUIRED_LOG_COLUMNS = ["id", "time", "inference_of_emotion"]
UNSAFE_EMOTIONS = ["fear", "angry"]

# default two-class mapping of the log dashboard (class name -> labels)
DEFAULT_CLASS_MAP = [
    ("Safe", ["Neutral", "Happy", "Calm", "Surprise"]),
    ("Unsafe", ["Fear", "Angry", "Sad", "Disgust"]),
]
UNASSIGNED = "Unassigned"

# --- fixed values: event log defaults ---------------------------------------
MODEL_VERSION = "v1.0"
DEVICE_ID = "device_001"
DEFAULT_LOG_ID = "Device_1"
STREAM_LOG_ID = "Stream_1"
UNKNOWN_INFERENCE = "Unknown"
COUNTER_ID_SHARE = 0.9

# --- fixed values: alert colours ---------------------------------------------
COLOUR_DANGER = "red"
COLOUR_CAUTION = "orange"
COLOUR_SAFE = "green"

# --- fixed values: drift thresholds ------------------------------------------
DRIFT_PER_LABEL = 0.20
DRIFT_JS = 0.10
DRIFT_UNKNOWN = 0.05
DRIFT_MIN_ROWS = 200
JS_EPS = 1e-12

# --- fixed values: drift alert texts (fields are filled in by the report) ------
ALERT_FEW_ROWS = "WARNING: {side} sample size low (n={n})"
ALERT_LABELS = "ALERT: per-label drift > {percent} for [{labels}]"
ALERT_UNKNOWN = "ALERT: unknown-label share drift is high (check label normalization / new classes)"
ALERT_JS = "ALERT: JS divergence {js} > {threshold}"
FILE_MISSING = "CRITICAL ERROR: File {path} not found!"

# --- fixed values: signal processing -----------------------------------------
SILENCE_RMS = 0.01
SHORT_CLIP_SECONDS = 0.1
THREAT_THRESHOLD = 0.50
REPORT_CONTEXT_SECONDS = 4.0
REPORT_INTERVAL_SECONDS = 3.0
SUB_WINDOW_SECONDS = 1.0
CHUNK_SECONDS = 3.0
NORMALIZE_EPS = 1e-6

# --- fixed values: corpus label tables ---------------------------------------
RAVDESS_LABELS = {"01": "neutral", "02": "neutral", "03": "happy", "04": "sad",
                  "05": "angry", "06": "fear", "07": "disgust", "08": "surprise"}
CREMAD_LABELS = {"ANG": "angry", "DIS": "disgust", "FEA": "fear", "HAP": "happy",
                 "NEU": "neutral", "SAD": "sad"}
SAVEE_LABELS = {"a": "angry", "d": "disgust", "f": "fear", "h": "happy", "n": "neutral",
                "sa": "sad", "su": "surprise"}
TESS_RENAMES = {"ps": "surprise", "fearful": "fear"}
FINAL_LABEL_RENAMES = {"fearful": "fear", "calm": "neutral"}

# two-class corpus (1 unsafe, 0 safe, -1 dropped)
RAVDESS_BINARY = {"01": 0, "02": 0, "03": 0, "04": -1, "05": 1, "06": 1, "07": -1, "08": -1}
CREMAD_BINARY = {"ANG": 1, "FEA": 1, "NEU": 0, "HAP": 0, "SAD": -1, "DIS": -1}
SAVEE_BINARY = {"a": 1, "f": 1, "n": 0, "h": 0, "d": -1, "sa": -1, "su": -1}
TESS_BINARY_UNSAFE = ["angry", "fear"]
TESS_BINARY_SAFE = ["neutral", "happy"]

# three-class corpus, searched in this order (0 safe, 1 danger, 2 caution)
SAFETY_CLASS_ORDER = [("neutral", 0), ("happy", 0), ("sad", 0), ("disgust", 0),
                      ("surprise", 0), ("fear", 1), ("angry", 2)]

# corpus log: start time and gap between files
CORPUS_LOG_START = "09:00:00"
CORPUS_LOG_GAP_SECONDS = 3

# geo
GEO_BUCKET_SCALE = 10
KM_PER_DEGREE = 111.0

# --- fixed values: safety status texts ----------------------------------------
STATUS_UNSAFE = "UNSAFE 🚨"
STATUS_SAFE = "SAFE ✅"
STATUS_FILTERED = "SAFE ✅ (Filtered Noise)"
VERDICT_DANGER_FEAR = "Fear"
VERDICT_DANGER_ANGRY = "Scream (Angry)"
VERDICT_SAFE = "Safe"
