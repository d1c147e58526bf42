"""Streaming jobs run with an available-now trigger over the events folder;
the sink is read back as a batch table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil import adapters as A
from vigil.plans.catalog import register
from vigil.plans.sql_inputs import DANGER, SE, with_
from vigil.schema import RAW_EVENT, SAFETY_EVENT_COLUMNS
from vigil.session import scratch_path
from vigil.sources.files import read_refused
from vigil.streaming import jobs as S

W = with_(SE)
ALL = ", ".join(f'"{c}"' for c in SAFETY_EVENT_COLUMNS)


PARTS = 3


def arriving(spark, d):
    """The events table as a stream of several files, one per micro-batch; a
    stand-in for the live source, mapped to the event columns by the adapter."""
    src = scratch_path(spark, "arriving")
    for i in range(PARTS):
        part = A.table(spark, d, "events").where(F.pmod(F.col("event_id"), F.lit(PARTS)) == i)
        part.write.mode("append").parquet(src)
    return A.event_projection(S.event_stream(spark, src, max_files_per_trigger=1, schema=RAW_EVENT))


def arriving_in_order(spark, d):
    """As ``arriving``, the files holding consecutive stretches of event time."""
    src = scratch_path(spark, "arriving-in-order")
    events = A.table(spark, d, "events").withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    cut = events.groupBy().agg(F.min("_us").alias("lo"), F.max("_us").alias("hi")).first()
    for i in range(PARTS):
        lo, hi = (cut["lo"] + (cut["hi"] + 1 - cut["lo"]) * j // PARTS for j in (i, i + 1))
        events.where((F.col("_us") >= lo) & (F.col("_us") < hi)).drop("_us").write.mode("append").parquet(src)
    return A.event_projection(S.event_stream(spark, src, max_files_per_trigger=1, schema=RAW_EVENT))


def arriving_twice(spark, d):
    """As ``arriving``, but every event arrives twice, in different files."""
    once = scratch_path(spark, "arriving-twice")
    for _ in range(2):
        A.table(spark, d, "events").repartition(PARTS).write.mode("append").parquet(once)
    return A.event_projection(S.event_stream(spark, once, max_files_per_trigger=1, schema=RAW_EVENT))


def run(spark, name, start):
    out, ckpt = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")
    q = start(out, ckpt)
    q.awaitTermination()
    return out


@register("stream_risk_log", W + f"SELECT {ALL} FROM se")
def q_stream_risk_log(spark, d):
    out = run(spark, "risk-log", lambda o, c: S.stream_risk_log(arriving_twice(spark, d), o, c))
    return spark.read.parquet(out).select(*SAFETY_EVENT_COLUMNS)


@register("stream_risk_log_refused", W + """
SELECT 'no id' AS reason, CAST(1 AS BIGINT) AS n, CAST(2 * count(*) AS BIGINT) AS total FROM se WHERE CAST(id AS BIGINT) % 97 = 0
UNION ALL SELECT 'repeated id', CAST(1 AS BIGINT), count(*) FROM se WHERE CAST(id AS BIGINT) % 97 <> 0""")
def q_stream_risk_log_refused(spark, d):
    """Every event arrives twice, some without id: the stream ends and lists
    what it refused."""
    events = arriving_twice(spark, d)
    events = events.withColumn("id", F.when(F.col("id").cast("long") % 97 != 0, F.col("id")))
    out = run(spark, "risk-log-refused", lambda o, c: S.stream_risk_log(events, o, c))
    return read_refused(spark, out).groupBy(F.col("rows").alias("n"), "reason").agg(F.sum("rows").alias("total"))


@register("stream_danger_alerts", W + f"""SELECT "timestamp", latitude, longitude, risk_level FROM se
WHERE risk_level = '{DANGER}'""")
def q_stream_danger_alerts(spark, d):
    out = run(spark, "alerts", lambda o, c: S.stream_danger_alerts(arriving(spark, d), o, c))
    return spark.read.parquet(out)


@register("stream_event_total", "SELECT count(*) AS streaming_events FROM events")
def q_stream_event_total(spark, d):
    out = run(spark, "total", lambda o, c: S.stream_event_total(arriving(spark, d), o, c))
    return S.read_recent(spark, out)


@register("stream_recent", W + f"""SELECT {ALL} FROM se ORDER BY "timestamp" DESC, id DESC LIMIT 10""")
def q_stream_recent(spark, d):
    out = run(spark, "recent", lambda o, c: S.stream_recent(arriving(spark, d), o, c, 10))
    return S.read_recent(spark, out).select(*SAFETY_EVENT_COLUMNS)


@register("stream_rolling_rms", W + """, loud AS (SELECT device_id, "timestamp", rms_energy FROM se WHERE rms_energy >= 0.01::DOUBLE),
wm AS (SELECT max(epoch_us("timestamp")) - 10000000 AS wm FROM loud),
w AS (SELECT device_id, rms_energy, (epoch_us("timestamp") - epoch_us("timestamp") % 500000) - k * 500000 AS ws
      FROM loud, range(0, 6) t(k))
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + 3000000) AS window_end, device_id,
       count(*) AS n, round(avg(rms_energy), 9) AS mean_rms
FROM w, wm WHERE ws + 3000000 <= wm GROUP BY ws, device_id""")
def q_stream_rolling_rms(spark, d):
    """3 s / 0.5 s windows per device; closed windows (end <= watermark) are emitted."""
    out = run(spark, "rolling", lambda o, c: S.stream_rolling_rms(arriving_in_order(spark, d), o, c))
    return spark.read.parquet(out).withColumn("mean_rms", F.round("mean_rms", 9))


@register("stream_dedup", W + f"SELECT {ALL} FROM se")
def q_stream_dedup(spark, d):
    """Every id arrives two times, in different micro-batches; the first is kept."""
    out = run(spark, "dedup", lambda o, c: S.stream_dedup(arriving_twice(spark, d), o, c))
    return spark.read.parquet(out).select(*SAFETY_EVENT_COLUMNS)


@register("stream_hotspots", W + f"""SELECT CAST(count(*) AS BIGINT) AS located, CAST(10 AS BIGINT) AS centres FROM se
WHERE risk_level = '{DANGER}' AND latitude IS NOT NULL AND longitude IS NOT NULL""")
def q_stream_hotspots(spark, d):
    """Hotspot centres maintained per micro-batch: their number, and the sum
    of their weights, which is the number of located danger events."""
    out = run(spark, "hotspots", lambda o, c: S.stream_hotspots(arriving(spark, d), o, c, 10, 1))
    return S.read_hotspots(spark, out).select(F.sum("weight").over(Window.partitionBy()).alias("located"), F.count("*").over(Window.partitionBy()).alias("centres")).distinct()
