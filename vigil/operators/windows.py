"""Windows over signals and window scores.

A signal is one row; its chunks and windows are generated with
``sequence`` + ``explode`` + ``slice`` on that row, so the work spreads with
the clips and never shuffles. The verdict over window scores is a grouped
aggregation with ``min_by`` (partial aggregation before the shuffle; a clip
with very many windows still ships one row per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.signals import fixed_length, rms


def _positions(length, step):
    """0, step, 2*step, ... < length; empty (not a descending range) when length <= 0."""
    return F.when(length > 0, F.sequence(F.lit(0), length - 1, F.greatest(step, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))


def _samples_of(rate_col: str, seconds: float):
    return (F.lit(float(seconds)) * F.col(rate_col).cast("double")).cast("int")


# W5
def chunk_signal(df: DataFrame, seconds: float = K.CHUNK_SECONDS, samples: str = "samples",
                 rate: str = "sample_rate", key: str = "clip_id") -> DataFrame:
    """Non-overlapping chunks of ``seconds``; the last one zero-padded."""
    n = _samples_of(rate, seconds)
    size = F.size(samples)
    starts = _positions(size, n)
    x = df.select(key, rate, samples, n.alias("_n"), F.posexplode(starts).alias("chunk_index", "_start"))
    chunk = fixed_length(F.slice(samples, F.col("_start") + 1, F.col("_n")), F.col("_n"))
    end = F.least(F.col("_start") + F.col("_n"), F.size(samples))
    return x.select(
        key, F.col("chunk_index").cast("int").alias("chunk_index"),
        (F.col("_start") / F.col(rate).cast("double")).alias("start_s"),
        (end / F.col(rate).cast("double")).alias("end_s"),
        chunk.alias("chunk"))


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def clip_verdict(chunks: DataFrame, key="clip_id", emotion: str = "emotion") -> DataFrame:
    """A clip is unsafe if any chunk's emotion is unsafe (disgust never is).
    ``key`` is one column or a list of columns."""
    e = F.col(emotion)
    unsafe = F.coalesce(e.isin(*K.UNSAFE_EMOTIONS) & (e != F.lit("disgust")), F.lit(False))
    return chunks.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("chunks"), F.count_if(unsafe).alias("unsafe_chunks"),
                                   F.bool_or(unsafe).alias("unsafe"))


# W6
def _report_contexts(df: DataFrame, samples: str, rate: str, key: str) -> DataFrame:
    """Every 3 s a 4 s context ending at the report point; contexts shorter
    than one sub-window are skipped."""
    step = _samples_of(rate, K.REPORT_INTERVAL_SECONDS)
    win = _samples_of(rate, K.REPORT_CONTEXT_SECONDS)
    sub = _samples_of(rate, K.SUB_WINDOW_SECONDS)
    size = F.size(samples)
    x = df.select(key, rate, samples, step.alias("_step"), win.alias("_win"), sub.alias("_sub"),
                  F.posexplode(_positions(size, step)).alias("report_index", "_cur"))
    start = F.greatest(F.lit(0), F.col("_cur") - F.col("_win") + F.col("_step"))
    x = x.withColumn("_ctx_start", start).withColumn(
        "_ctx_end", F.least(F.size(samples), F.col("_ctx_start") + F.col("_win")))
    x = x.withColumn("_ctx", F.slice(samples, F.col("_ctx_start") + 1, F.col("_ctx_end") - F.col("_ctx_start")))
    x = x.filter(F.size("_ctx") >= F.col("_sub"))
    return x.withColumns({"_rms": rms("_ctx"),
                          "_sub_step": F.greatest((F.col("_sub").cast("double") * F.lit(0.5)).cast("int"), F.lit(1))})


def report_windows(df: DataFrame, samples: str = "samples", rate: str = "sample_rate",
                   key: str = "clip_id") -> DataFrame:
    """Report contexts: ``silent`` when the context RMS < 0.01; ``n_sub``
    half-overlapping 1 s sub-windows inside a non-silent context."""
    x = _report_contexts(df, samples, rate, key)
    n_sub = F.floor((F.size("_ctx") - F.col("_sub")) / F.col("_sub_step")).cast("int") + F.lit(1)
    silent = F.col("_rms") < F.lit(K.SILENCE_RMS)
    return x.select(key, F.col("report_index").cast("int").alias("report_index"),
                    (F.col("_cur") / F.col(rate).cast("double")).alias("report_s"),
                    F.col("_ctx_start").alias("context_start"), F.size("_ctx").alias("context_len"),
                    F.col("_rms").alias("rms"), silent.alias("silent"),
                    F.when(silent, F.lit(0)).otherwise(n_sub).alias("n_sub"))


def report_subwindows(df: DataFrame, samples: str = "samples", rate: str = "sample_rate",
                      key: str = "clip_id") -> DataFrame:
    """The 1 s sub-windows (every 0.5 s) of each non-silent report context,
    exploded from the context on the same row (no join back to the clips)."""
    x = _report_contexts(df, samples, rate, key).filter(F.col("_rms") >= F.lit(K.SILENCE_RMS))
    offs = _positions(F.size("_ctx") - F.col("_sub") + 1, F.col("_sub_step"))
    y = x.select(key, F.col("report_index").cast("int").alias("report_index"), "_ctx_start", "_ctx", "_sub",
                 F.posexplode(offs).alias("sub_index", "_off"))
    return y.select(key, "report_index", F.col("sub_index").cast("int").alias("sub_index"),
                    (F.col("_ctx_start") + F.col("_off")).alias("sub_start"),
                    F.slice("_ctx", F.col("_off") + 1, F.col("_sub")).alias("window"))


# W7
def half_windows(df: DataFrame, samples: str = "samples", rate: str = "sample_rate",
                 key: str = "clip_id") -> DataFrame:
    """1 s windows every 0.5 s, starts < len - 1 s (the last full window is
    not taken); silent windows (RMS < 0.01) dropped."""
    win = F.col(rate).cast("int")
    step = (win.cast("double") * F.lit(0.5)).cast("int")
    # each generated row carries one window's start and RMS, never the clip
    windows = F.transform(_positions(F.size(samples) - win, step),
                          lambda at: F.struct(at.alias("start"), rms(F.slice(F.col(samples), at + 1, win)).alias("rms")))
    x = df.select(key, F.posexplode(windows).alias("window_index", "_w"))
    x = x.select(key, F.col("window_index").cast("int").alias("window_index"), F.col("_w.start").alias("start"), F.col("_w.rms").alias("rms"))
    return x.filter(F.col("rms") >= F.lit(K.SILENCE_RMS))


# W8
def clip_alarm(verdicts: DataFrame, key="clip_id") -> DataFrame:
    """Verdicts per report -> one row per clip: reports, dangerous ones, and the
    alarm that any of them raises."""
    return verdicts.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("reports"), F.count_if("danger").alias("danger_reports"),
                                             F.bool_or("danger").alias("alarm"))


def threat_verdict(ws: DataFrame, key="clip_id", threshold: float = K.THREAT_THRESHOLD) -> DataFrame:
    """Per clip (or per any key columns, e.g. clip and report window):
    max(p_fear + p_angry), the driver at the first window that reaches it
    (Fear if p_fear > p_angry else Scream (Angry); Safe when the max is not
    above 0), DANGER when above the threshold."""
    threat = F.col("p_fear") + F.col("p_angry")
    driver = F.when(F.col("p_fear") > F.col("p_angry"), F.lit(K.VERDICT_DANGER_FEAR)).otherwise(
        F.lit(K.VERDICT_DANGER_ANGRY))
    order = F.struct(-threat, F.col("window_start"), -F.col("p_fear"), -F.col("p_angry"))
    agg = ws.groupBy(*_keys(key)).agg(
        F.max(threat).alias("max_threat"),
        F.min_by(driver, order).alias("_driver"),
        F.count(F.lit(1)).alias("windows"),
        F.count_if(threat > F.lit(threshold)).alias("danger_windows"),
    )
    return agg.select(
        *_keys(key), "max_threat",
        F.when(F.col("max_threat") > F.lit(0.0), F.col("_driver")).otherwise(F.lit(K.VERDICT_SAFE)).alias("dominant"),
        (F.col("max_threat") > F.lit(threshold)).alias("danger"), "windows", "danger_windows")
