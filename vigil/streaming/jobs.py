"""Structured Streaming jobs for the live side.

Sources are file streams with a fixed schema; sinks are Parquet folders
with checkpoints in the shared checkpoint folder, so a restarted or
recovered query resumes where it stopped. Every job can run with
``trigger(availableNow=True)``: it then drains what has arrived and stops,
which makes it checkable against the same query run as a batch.

Jobs take events in the columns of the event log, with or without a risk
level. State stays bounded: the rolling windows are watermarked; the running
total, the "latest n" and the hotspot centres are 1, n and k rows kept in
versioned Parquet folders (the last two versions) by ``foreachBatch``. Repeated
ids are refused by the keyed log's own id buckets (S1) or by a RocksDB state
store (S6).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vigil import constants as K
from vigil.functions.scalars import danger, with_risk
from vigil.schema import SAFETY_EVENT, SAFETY_EVENT_COLUMNS

ROLLING_WINDOW = "3 seconds"
ROLLING_SLIDE = "500 milliseconds"


def event_stream(spark: SparkSession, folder: str, file_glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None, schema: StructType = SAFETY_EVENT) -> DataFrame:
    """Events arriving as Parquet files in ``folder`` with a fixed schema (no
    inference): the 20-column event (``SAFETY_EVENT``), the four-column live
    event (``STREAM_EVENT``), or any other whose columns the caller maps."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def _start(df: DataFrame, out: str, ckpt: str, mode: str = "append", available_now: bool = True,
           partition_by: list[str] | None = None) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start(out)


def _start_batches(df: DataFrame, fn: Callable, ckpt: str, mode: str = "append",
                   available_now: bool = True) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt).outputMode(mode)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


# S1
def risk_events(events: DataFrame, threshold: float | None = K.CONFIDENCE_THRESHOLD, strict: bool = False) -> DataFrame:
    """Arriving events with their risk level: the risk rule (X14) assigns level
    and signal to every event that does not carry a level yet."""
    return events if "risk_level" in events.columns else with_risk(events, threshold=threshold, strict=strict)


def stream_risk_log(events: DataFrame, out: str, ckpt: str, available_now: bool = True) -> StreamingQuery:
    """The 20-column event log, keyed for ever: of an id only the first event is
    written, whenever a repeat arrives. Each micro-batch is one entry of the
    log's ledger, so a replayed batch is skipped and one that was cut short is
    finished. An event without id or with a known id goes to the reject table
    (``read_refused``) and the stream goes on."""
    from vigil.sources.files import append_events

    def write(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")  # lives as long as the checkpoint
        append_events(batch, out, query, epoch)

    return _start_batches(risk_events(events).select(*SAFETY_EVENT_COLUMNS), write, ckpt, available_now=available_now)


# S2
def stream_danger_alerts(events: DataFrame, out: str, ckpt: str, available_now: bool = True) -> StreamingQuery:
    alerts = danger(risk_events(events)).select("timestamp", "latitude", "longitude", "risk_level")
    return _start(alerts, out, ckpt, available_now=available_now)


# versioned tables: a folder ``v=<batch>`` per batch, of which the last two stay
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, out: str) -> list[int]:
    """Complete versions below ``out``, oldest first."""
    fs, p = _fs(spark, out)
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName()[2:]) for st in fs.listStatus(p)
                  if st.getPath().getName().startswith("v=") and fs.exists(st.getPath().suffix("/_SUCCESS")))


def version_path(out: str, version: int) -> str:
    return f"{out.rstrip('/')}/v={version}"


def latest_version(spark: SparkSession, out: str, before: int | None = None) -> str | None:
    """Folder of the newest complete version, optionally among those older
    than ``before``."""
    found = [v for v in versions(spark, out) if before is None or v < before]
    return version_path(out, found[-1]) if found else None


def write_version(df: DataFrame, out: str, epoch: int) -> None:
    """Write version ``epoch`` and remove all but it and the one before (a
    reader of the newest version never meets a half-written table, and a
    replayed batch still finds the version it builds on)."""
    df.write.mode("overwrite").parquet(version_path(out, epoch))
    fs, _ = _fs(df.sparkSession, out)
    for old in [v for v in versions(df.sparkSession, out) if v <= epoch][:-2]:
        fs.delete(_fs(df.sparkSession, version_path(out, old))[1], True)


def read_recent(spark: SparkSession, out: str) -> DataFrame:
    """The newest version of a versioned table."""
    v = latest_version(spark, out)
    if v is None:
        raise FileNotFoundError(out)
    return spark.read.parquet(v)


# S3
def stream_event_total(events: DataFrame, out: str, ckpt: str, available_now: bool = True) -> StreamingQuery:
    """Running count of events as a one-row versioned table (``read_recent``)."""
    total = events.agg(F.count(F.lit(1)).alias("streaming_events"))

    def write(batch: DataFrame, epoch: int) -> None:
        write_version(batch, out, epoch)

    return _start_batches(total, write, ckpt, mode="complete", available_now=available_now)


# S4
def stream_recent(events: DataFrame, out: str, ckpt: str, n: int = 10, available_now: bool = True) -> StreamingQuery:
    """Latest n events after every trigger: top-n of (kept n rows + batch),
    written as a new version (idempotent when a batch is replayed)."""
    order = [F.desc("timestamp"), F.desc("id")]

    def write(batch: DataFrame, epoch: int) -> None:
        prev = latest_version(batch.sparkSession, out, before=epoch)  # a replayed batch rebuilds from the older version
        cand = batch if prev is None else batch.unionByName(batch.sparkSession.read.parquet(prev))
        write_version(cand.orderBy(*order).limit(n), out, epoch)

    return _start_batches(risk_events(events).select(*SAFETY_EVENT_COLUMNS), write, ckpt, available_now=available_now)


# S5
def rolling_rms(events: DataFrame, watermark: str = "10 seconds") -> DataFrame:
    """3 s windows every 0.5 s per device over non-silent chunks."""
    loud = events.filter(F.col("rms_energy") >= F.lit(K.SILENCE_RMS))
    w = (loud.withWatermark("timestamp", watermark)
         .groupBy(F.window("timestamp", ROLLING_WINDOW, ROLLING_SLIDE), F.col("device_id"))
         .agg(F.count(F.lit(1)).alias("n"), F.avg("rms_energy").alias("mean_rms")))
    return w.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "device_id", "n", "mean_rms")


def stream_rolling_rms(events: DataFrame, out: str, ckpt: str, watermark: str = "10 seconds",
                       available_now: bool = True) -> StreamingQuery:
    return _start(rolling_rms(events, watermark), out, ckpt, available_now=available_now)


# S6
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def distinct_events(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """The first event of each id, kept apart in the query's own state: for
    ever, or with ``watermark`` for that event time. Events without id have no
    key and are left out (``stream_risk_log`` lists them)."""
    keyed = risk_events(events).select(*SAFETY_EVENT_COLUMNS).where(F.col("id").isNotNull())
    return keyed.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["id"]) if watermark else keyed.dropDuplicates(["id"])


def stream_dedup(events: DataFrame, out: str, ckpt: str, watermark: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Refuse repeated ids without reading any log: the ids lie in a RocksDB
    state store, dealt by id over the shuffle partitions, on each executor's
    disk rather than its heap and saved in the checkpoint. Without
    ``watermark`` the state is one id per event for ever."""
    conf = events.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB)
    try:  # a started query holds its settings, also in its checkpoint
        return _start(distinct_events(events, watermark), out, ckpt, available_now=available_now)
    finally:
        conf.set(STATE_STORE, before)


# S7
def stream_hotspots(events: DataFrame, out: str, ckpt: str, k: int = 10, seed: int = 1,
                    available_now: bool = True) -> StreamingQuery:
    """Hotspot centres updated per micro-batch, as a versioned table. Until k
    located danger events are there they wait in the version (rows without
    ``hotspot``); then KMeans seeds the centres with all of them. Later batches
    assign each event to its nearest centre and move the centre to the
    count-weighted mean of its old position and its new points, so the weights
    always sum to the number of located danger events."""
    from vigil.operators.hotspots import assign_hotspot, geo_hotspots

    columns = ["hotspot", "latitude", "longitude", "weight"]

    def write(batch: DataFrame, epoch: int) -> None:
        pts = danger(batch).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        prev = latest_version(batch.sparkSession, out, before=epoch)  # a replayed batch recomputes the same version
        old = None if prev is None else batch.sparkSession.read.parquet(prev).select(*columns)
        seeded = old is not None and not old.filter(F.col("hotspot").isNotNull()).isEmpty()
        pts = pts.select("latitude", "longitude")
        if not seeded and old is not None:
            pts = pts.unionByName(old.select("latitude", "longitude"))
        pts = pts.withColumn("risk_level", F.lit(K.DANGER)).persist()  # read by several actions below
        try:
            new = moved(pts, old) if seeded else first(pts)
            write_version(new.select(*columns).withColumn("batch_id", F.lit(epoch)), out, epoch)
        finally:
            pts.unpersist()

    def first(pts: DataFrame) -> DataFrame:
        if pts.limit(k).count() < k:  # fewer than k rows wait
            return pts.select(F.lit(None).cast("int").alias("hotspot"), "latitude", "longitude", F.lit(1).cast("long").alias("weight"))
        centres = geo_hotspots(pts, k, seed)
        counts = assign_hotspot(pts, centres).groupBy("hotspot").agg(F.count(F.lit(1)).alias("weight"))
        return centres.join(counts, on="hotspot", how="left").withColumn("weight", F.coalesce("weight", F.lit(0)))

    def moved(pts: DataFrame, old: DataFrame) -> DataFrame:
        upd = assign_hotspot(pts, old.select("hotspot", "latitude", "longitude")).groupBy("hotspot").agg(
            F.sum("latitude").alias("_slat"), F.sum("longitude").alias("_slon"), F.count(F.lit(1)).alias("_n"))
        j = old.join(upd, on="hotspot", how="left").fillna(0, subset=["_slat", "_slon", "_n"])
        tot = F.col("weight") + F.col("_n")
        mean = lambda c, s: F.when(tot > 0, (F.col(c) * F.col("weight") + F.col(s)) / tot).otherwise(F.col(c)).alias(c)
        return j.select("hotspot", mean("latitude", "_slat"), mean("longitude", "_slon"), tot.cast("long").alias("weight"))

    return _start_batches(risk_events(events), write, ckpt, available_now=available_now)


def read_hotspots(spark: SparkSession, out: str) -> DataFrame:
    """The newest centres (none while events still wait for seeding)."""
    return read_recent(spark, out).filter(F.col("hotspot").isNotNull())
