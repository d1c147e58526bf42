"""Queries over signals (embeddings as sample arrays) and window scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import adapters as A
from vigil.functions import signals as G
from vigil.operators import windows as WN
from vigil.plans.catalog import register
from vigil.plans.sql_inputs import SE, SG, WS, with_

WG = with_(SG)


def sg(spark, d):
    return A.signals(spark, d)


def r9(c):
    return F.round(c, 9)


RMS = "sqrt(list_sum(list_transform({s}, lambda x: x * x)) / len({s}))"


@register("with_rms", WG + f"SELECT clip_id, round({RMS.format(s='samples')}, 9) AS rms FROM sg")
def q_with_rms(spark, d):
    return G.with_rms(sg(spark, d)).select("clip_id", r9(F.col("rms")).alias("rms"))


@register("drop_silent", WG + f"SELECT clip_id FROM sg WHERE {RMS.format(s='samples')} >= 0.01::DOUBLE")
def q_drop_silent(spark, d):
    return G.drop_silent(sg(spark, d)).select("clip_id")


@register("with_clip_stats", WG + """SELECT clip_id, CAST(len(samples) AS DOUBLE) / sample_rate AS duration,
CAST(len(list_filter(samples, lambda x: abs(x) < 0.01::DOUBLE)) AS DOUBLE) / len(samples) AS silence_ratio FROM sg""")
def q_with_clip_stats(spark, d):
    return G.with_clip_stats(sg(spark, d)).select("clip_id", "duration", "silence_ratio")


FIX = ("CASE WHEN len(samples) >= {n} THEN samples[1:{n}] "
       "ELSE list_concat(samples, list_transform(range({n} - len(samples)), lambda i: 0.0::DOUBLE)) END")


@register("fix_length", WG + f""", f AS (SELECT clip_id, {FIX.format(n=48)} AS cut, {FIX.format(n=80)} AS pad FROM sg)
SELECT clip_id, CAST(len(cut) AS INTEGER) AS len_cut, round(list_sum(cut), 9) AS sum_cut,
       CAST(len(pad) AS INTEGER) AS len_pad,
       round(list_sum(pad), 9) AS sum_pad, pad[80] AS last_pad FROM f""")
def q_fix_length(spark, d):
    df = G.fix_length(G.fix_length(sg(spark, d), 48, out="cut"), 80, out="pad")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return df.select("clip_id", F.size("cut").alias("len_cut"), r9(total(F.col("cut"))).alias("sum_cut"),
                     F.size("pad").alias("len_pad"), r9(total(F.col("pad"))).alias("sum_pad"),
                     F.element_at("pad", 80).alias("last_pad"))


@register("normalize_vector", WG + """, n AS (
  SELECT clip_id, samples,
         list_max(list_transform(samples, lambda x: abs(x))) AS peak,
         list_min(samples) AS lo, list_max(samples) AS hi,
         list_sum(samples) / len(samples) AS mean FROM sg),
m AS (SELECT *, list_sum(list_transform(samples, lambda x: (x - mean) * (x - mean))) / len(samples) AS var FROM n),
e AS (SELECT clip_id, unnest(samples) AS x, generate_subscripts(samples, 1) AS i, peak, lo, hi, mean, var FROM m)
SELECT clip_id, CAST(i - 1 AS INTEGER) AS pos,
       round(CASE WHEN peak > 0 THEN x / peak ELSE x END, 9) AS peak,
       round((x - lo) / (hi - lo + 1e-6), 9) AS minmax,
       round((x - mean) / (sqrt(var) + 1e-6), 9) AS z
FROM e""")
def q_normalize_vector(spark, d):
    df = sg(spark, d)
    for how in ("peak", "minmax", "z"):
        df = G.normalize_vector(df, how, out=how)
    z = F.arrays_zip(F.col("peak"), F.col("minmax"), F.col("z"))
    x = df.select("clip_id", F.posexplode(z).alias("pos", "v"))
    return x.select("clip_id", F.col("pos").cast("int").alias("pos"), r9(F.col("v.peak")).alias("peak"),
                    r9(F.col("v.minmax")).alias("minmax"), r9(F.col("v.z")).alias("z"))


@register("drop_short", WG + "SELECT clip_id, CAST(len(samples) AS INTEGER) AS n FROM sg WHERE len(samples) >= 0.1 * sample_rate")
def q_drop_short(spark, d):
    return G.drop_short(sg(spark, d)).select("clip_id", F.size("samples").alias("n"))


STEP = "CAST(trunc({sec} * sample_rate) AS INTEGER)"


@register("chunk_signal", WG + f""", c AS (
  SELECT clip_id, sample_rate, samples, {STEP.format(sec=3.0)} AS n,
         unnest(range(0, len(samples), {STEP.format(sec=3.0)})) AS st FROM sg),
k AS (SELECT clip_id, sample_rate, samples, n, st,
             samples[st + 1: least(st + n, len(samples))] AS raw FROM c)
SELECT clip_id, CAST(st // n AS INTEGER) AS chunk_index, st / sample_rate AS start_s,
       least(st + n, len(samples)) / sample_rate AS end_s,
       CAST(len(list_concat(raw, list_transform(range(n - len(raw)), lambda i: 0.0::DOUBLE))) AS INTEGER) AS chunk_len,
       round(list_sum(list_concat(raw, list_transform(range(n - len(raw)), lambda i: 0.0::DOUBLE))), 9) AS chunk_sum
FROM k""")
def q_chunk_signal(spark, d):
    ch = WN.chunk_signal(sg(spark, d))
    return ch.select("clip_id", "chunk_index", "start_s", "end_s", F.size("chunk").alias("chunk_len"),
                     r9(F.aggregate("chunk", F.lit(0.0), lambda a, x: a + x)).alias("chunk_sum"))


@register("clip_verdict", with_(SE) + """SELECT device_id, count(*) AS chunks,
count_if(coalesce(emotion IN ('fear', 'angry') AND emotion <> 'disgust', false)) AS unsafe_chunks,
bool_or(coalesce(emotion IN ('fear', 'angry') AND emotion <> 'disgust', false)) AS unsafe
FROM se GROUP BY device_id""")
def q_clip_verdict(spark, d):
    """Per device, the chunk-level emotions of its events decide the verdict."""
    return WN.clip_verdict(A.safety_events(spark, d), key="device_id")


@register("report_windows", WG + f""", c AS (
  SELECT clip_id, sample_rate, samples, {STEP.format(sec=3.0)} AS step, {STEP.format(sec=4.0)} AS win,
         {STEP.format(sec=1.0)} AS sub, unnest(range(0, len(samples), {STEP.format(sec=3.0)})) AS cur FROM sg),
k AS (SELECT *, greatest(0, cur - win + step) AS cs FROM c),
k2 AS (SELECT *, samples[cs + 1: least(len(samples), cs + win)] AS ctx FROM k),
k3 AS (SELECT *, {RMS.format(s='ctx')} AS r FROM k2 WHERE len(ctx) >= sub)
SELECT clip_id, CAST(cur // step AS INTEGER) AS report_index, cur / sample_rate AS report_s,
       CAST(cs AS INTEGER) AS context_start, CAST(len(ctx) AS INTEGER) AS context_len, round(r, 9) AS rms,
       r < 0.01::DOUBLE AS silent,
       CAST(CASE WHEN r < 0.01::DOUBLE THEN 0
            ELSE (len(ctx) - sub) // greatest(CAST(trunc(sub * 0.5) AS INTEGER), 1) + 1 END AS INTEGER) AS n_sub
FROM k3""")
def q_report_windows(spark, d):
    rw = WN.report_windows(sg(spark, d))
    return rw.withColumn("rms", r9(F.col("rms")))


@register("half_windows", WG + f""", c AS (
  SELECT clip_id, samples, sample_rate AS w, CAST(trunc(sample_rate * 0.5) AS INTEGER) AS step,
         unnest(range(0, len(samples) - sample_rate, CAST(trunc(sample_rate * 0.5) AS INTEGER))) AS start FROM sg),
k AS (SELECT clip_id, step, start, {RMS.format(s='samples[start + 1: start + w]')} AS r FROM c)
SELECT clip_id, CAST(start // step AS INTEGER) AS window_index, CAST(start AS INTEGER) AS start, round(r, 9) AS rms
FROM k WHERE r >= 0.01::DOUBLE""")
def q_half_windows(spark, d):
    hw = WN.half_windows(sg(spark, d))
    return hw.withColumn("rms", r9(F.col("rms")))


@register("threat_verdict", with_(WS) + """, t AS (
  SELECT *, p_fear + p_angry AS threat,
         row_number() OVER (PARTITION BY clip_id ORDER BY p_fear + p_angry DESC, window_start, p_fear DESC,
                            p_angry DESC) AS rn FROM ws),
a AS (SELECT clip_id, max(threat) AS max_threat, count(*) AS windows, count_if(threat > 0.5::DOUBLE) AS danger_windows
      FROM t GROUP BY clip_id)
SELECT a.clip_id, a.max_threat,
       CASE WHEN a.max_threat > 0.0 THEN (CASE WHEN t.p_fear > t.p_angry THEN 'Fear' ELSE 'Scream (Angry)' END)
            ELSE 'Safe' END AS dominant,
       a.max_threat > 0.5::DOUBLE AS danger, a.windows, a.danger_windows
FROM a JOIN t ON a.clip_id = t.clip_id AND t.rn = 1""")
def q_threat_verdict(spark, d):
    return WN.threat_verdict(A.window_scores(spark, d))


@register("report_subwindows", WG + f""", c AS (
  SELECT clip_id, sample_rate, samples, {STEP.format(sec=3.0)} AS step, {STEP.format(sec=4.0)} AS win,
         {STEP.format(sec=1.0)} AS sub, unnest(range(0, len(samples), {STEP.format(sec=3.0)})) AS cur FROM sg),
k AS (SELECT *, greatest(0, cur - win + step) AS cs FROM c),
k2 AS (SELECT *, samples[cs + 1: least(len(samples), cs + win)] AS ctx FROM k),
k3 AS (SELECT *, greatest(CAST(trunc(sub * 0.5) AS INTEGER), 1) AS sstep FROM k2
       WHERE len(ctx) >= sub AND {RMS.format(s='ctx')} >= 0.01::DOUBLE),
s AS (SELECT clip_id, cur // step AS report_index, cs, ctx, sub, sstep,
             unnest(range(0, len(ctx) - sub + 1, sstep)) AS off FROM k3)
SELECT clip_id, CAST(report_index AS INTEGER) AS report_index, CAST(off // sstep AS INTEGER) AS sub_index,
       CAST(cs + off AS INTEGER) AS sub_start, CAST(len(ctx[off + 1: off + sub]) AS INTEGER) AS window_len,
       round({RMS.format(s='ctx[off + 1: off + sub]')}, 9) AS window_rms
FROM s""")
def q_report_subwindows(spark, d):
    """The 1 s sub-windows, every 0.5 s, of every non-silent 4 s report context."""
    sw = WN.report_subwindows(sg(spark, d))
    return sw.select("clip_id", "report_index", "sub_index", "sub_start", F.size("window").alias("window_len"),
                     r9(G.rms("window")).alias("window_rms"))
