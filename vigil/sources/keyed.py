"""The keyed event log (I8, J5): appended batches, one event per id for ever.

Below the log's folder:

* Parquet files of the events themselves, as any reader expects them;
* ``_keys/bucket=<b>/run=<token>``: the ids alone, by hash bucket, sorted, with
  a Bloom filter. An append reads the buckets that its batch touches and no
  event file. Its new ids become a run of the bucket, together with the newest
  runs of at most twice its size, so each run has more than twice the ids of
  the next and a bucket of n ids at most log2(n) + 1 runs;
* ``_ledger/<n>.json``: one entry per committed batch with the runs of every
  bucket, the rows written and refused, and the last epoch of each writer. A
  batch that a writer's ledger entry covers is not looked at again;
* ``_refused/batch=<token>``: events without id (whole) and repeated ids (id
  and number of rows), so that one bad event stops nothing;
* ``_staged``: what the newest batch decided, written before anything else
  changes. An append that finds a decided batch without ledger entry carries
  it out first; only then are the log's own ids read.

One append runs at a time, as a primary key's lock would have it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schema import SAFETY_EVENT, SAFETY_EVENT_COLUMNS
from vigil.session import ensure_checkpoint_dir, run_concurrently

BUCKETS = 64  # of a new log; a bucket's ids should fit a few files
POINT_IDS = 10  # so many ids are looked up by value, which Bloom filters answer
KEPT_ENTRIES = 100
SPREAD = 32  # parts over which the rows of one id are dealt before they are sorted
REFUSED = "reason string, id string, rows long, event struct<" + ", ".join(
    f"`{f.name}`: {f.dataType.simpleString()}" for f in SAFETY_EVENT.fields) + ">"
NEW = "id IS NOT NULL AND NOT known"  # of a decided candidate
NO_ID, REPEATED = "no id", "repeated id"


# --- files ------------------------------------------------------------------------
class Folder:
    """A folder of the log, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self._paths(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def names(self, name: str) -> list[str]:
        p = self._paths(self.at(name))
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> dict | None:
        p = self._paths(self.at(name))
        if not self.fs.exists(p):
            return None
        stream = self.fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, entry: dict) -> None:
        """A small file that appears whole or not at all."""
        part = self._paths(self.at(f"{name}.{uuid.uuid4().hex[:8]}"))
        out = self.fs.create(part)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if not self.fs.rename(part, self._paths(self.at(name))):
            raise RuntimeError(f"{self.at(name)} is there already: another append runs on this log")

    def remove(self, name: str) -> None:
        self.fs.delete(self._paths(self.at(name)), True)

    def has_events(self) -> bool:
        p = self._paths(self.path)
        return self.fs.exists(p) and any(s.getPath().getName()[0] not in "_." for s in self.fs.listStatus(p))


def ledger(log: Folder) -> dict | None:
    """The newest ledger entry."""
    entries = [n for n in log.names("_ledger") if n.endswith(".json")]
    return log.read(f"_ledger/{entries[-1]}") if entries else None


# --- ids --------------------------------------------------------------------------
def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def key_paths(log: Folder, runs: dict[str, list], buckets: list[int]) -> list[str]:
    return [log.at(f"_keys/bucket={b}/run={token}") for b in buckets for token, _ in runs.get(str(b), [])]


def keys(log: Folder, runs: dict[str, list], buckets: list[int]) -> DataFrame:
    """Ids of some buckets."""
    paths = key_paths(log, runs, buckets)
    reader = log.spark.read.schema("id string")
    return reader.parquet(*paths) if paths else log.spark.createDataFrame([], "id string")


def write_keys(log: Folder, new: DataFrame, fresh: dict[int, int], runs: dict[str, list], buckets: int, token: str) -> dict[str, list]:
    """Add ``new`` ids, ``fresh`` of them in each bucket, to their buckets as
    run ``token``; the runs there are then. Runs of at most twice the ids that
    follow them are taken into the new one."""
    after, merged = dict(runs), {}
    for b, n in fresh.items():
        old = list(runs.get(str(b), []))
        taken = []
        while old and old[-1][1] <= 2 * n:
            taken.append(old.pop())
            n += taken[-1][1]
        after[str(b)] = [*old, [token, n]]
        if taken:
            merged[str(b)] = taken
    if fresh:
        ids = new.select("id")
        if merged:
            ids = ids.unionByName(keys(log, merged, sorted(map(int, merged))))
        laid = ids.withColumn("bucket", bucket_of(buckets)).withColumn("run", F.lit(token)).repartition("bucket").sortWithinPartitions("bucket", "id")
        (laid.write.mode("append").partitionBy("bucket", "run").option("maxRecordsPerFile", 5_000_000)
         .option("parquet.bloom.filter.enabled#id", "true").parquet(log.at("_keys")))
    return after


# --- decisions ----------------------------------------------------------------------
def place_in_input(df: DataFrame) -> Column:
    """Where a row stands in the input: by file and place in it where the rows
    come straight from files."""
    here = F.monotonically_increasing_id()
    try:
        key = F.struct(*[df.metadataColumn("_metadata")[c] for c in ("file_path", "file_block_start")], here)
        df.select(key)
    except AnalysisException:  # not a file scan
        return here
    return key


def candidates(batch: DataFrame) -> DataFrame:
    """(id, rows, event): the first event of each id and the number of its
    rows; each event without id by itself. ``min_by`` of an event sorts whole
    rows, and a task that reads a row group of a file has millions of them: the
    rows leave the scan unsorted, by id and one of ``SPREAD`` parts, and are
    sorted in shuffle partitions. There ``min_by`` aggregates before the second
    shuffle, so an id with a third of the rows ships one row a part."""
    event = F.struct(*[F.col(c) for c in batch.columns])
    tagged = batch.select(F.col("id"), event.alias("event"), place_in_input(batch).alias("_ord"))
    dealt = tagged.where("id IS NOT NULL").repartition("id", F.pmod(F.xxhash64("_ord"), F.lit(SPREAD)))
    firsts = dealt.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.min_by("event", "_ord").alias("event"))
    return firsts.unionByName(tagged.where("id IS NULL").select("id", F.lit(1).cast("long").alias("rows"), "event"))


def refusals(decided: DataFrame) -> DataFrame:
    """Refused events of decided candidates (id, rows, event, known)."""
    again = F.col("rows") - F.when(F.col("known"), 0).otherwise(1)
    refused = decided.where("id IS NULL OR known OR rows > 1")
    return refused.select(F.when(F.col("id").isNull(), NO_ID).otherwise(REPEATED).alias("reason"), "id",
                          F.when(F.col("id").isNull(), F.col("rows")).otherwise(again).alias("rows"),
                          F.when(F.col("id").isNull(), F.col("event")).alias("event"))


def decide(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Candidates with ``known``: whether their id is among the known ones."""
    if known is None:
        return rows.withColumn("known", F.lit(False))
    named, nameless = rows.where("id IS NOT NULL"), rows.where("id IS NULL")
    # of the known ids only the batch's: by Spark's own size check without moving them
    hits = known.join(named.select("id"), "id", "left_semi").distinct().withColumn("known", F.lit(True))
    return named.join(hits, "id", "left").withColumn("known", F.coalesce("known", F.lit(False))).unionByName(nameless.withColumn("known", F.lit(False)))


def accepted(decided: DataFrame) -> DataFrame:
    return decided.where(NEW).select("event.*")


# --- appends ------------------------------------------------------------------------
def _carry_out(log: Folder, intent: dict, state: dict, resumed: bool) -> dict:
    """Write what a staged batch decided and commit it."""
    spark, token = log.spark, intent["token"]
    decided = spark.read.parquet(log.at(f"_staged/{token}/decided"))
    new = decided.where(NEW)
    counted = decided.groupBy(F.when(F.expr(NEW), bucket_of(state["buckets"])).alias("bucket")).agg(
        F.count(F.lit(1)).alias("ids"), F.sum("rows").alias("rows")).collect()  # a row a bucket
    fresh = {r["bucket"]: r["ids"] for r in counted if r["bucket"] is not None}
    written, total = sum(fresh.values()), sum(r["rows"] for r in counted)

    def write_rows():
        rows = accepted(decided)
        if resumed and log.has_events():  # some of them may have been written
            rows = rows.join(spark.read.schema(SAFETY_EVENT).parquet(log.path).select("id"), "id", "left_anti").select(*SAFETY_EVENT_COLUMNS)
        rows.write.mode("append").option("compression", "snappy").parquet(log.path)

    steps = {}  # each may be done again from the staged batch, in any order
    if written:
        key_token = f"{token}-{uuid.uuid4().hex[:8]}" if resumed else token
        steps |= {"rows": write_rows, "keys": lambda: write_keys(log, new.select("id"), fresh, state["keys"], state["buckets"], key_token)}
    if total > written:
        steps["refused"] = lambda: refusals(decided).write.mode("overwrite").parquet(log.at(f"_refused/batch={token}"))
    runs = run_concurrently(steps).get("keys", state["keys"])
    entry = {"batch": intent["batch"], "token": token, "buckets": state["buckets"], "written": written, "refused": total - written,
             "writers": state["writers"] | ({intent["writer"]: intent["epoch"]} if intent["writer"] else {}), "keys": runs}
    log.write(f"_ledger/{entry['batch']:012d}.json", entry)
    for b, old in state["keys"].items():  # runs that the new ones hold
        for gone in {t for t, _ in old} - {t for t, _ in runs[b]}:
            log.remove(f"_keys/bucket={b}/run={gone}")
    for name in log.names("_ledger")[:-KEPT_ENTRIES]:
        log.remove(f"_ledger/{name}")
    return entry


def _opened(log: Folder, buckets: int) -> dict:
    """State of the log: its newest ledger entry, after a batch that was left
    half done. The ids of a log without ledger are gathered first."""
    state = ledger(log)
    if state is None:
        state = {"batch": -1, "buckets": buckets, "writers": {}, "keys": {}}
        if log.has_events():
            token = f"first-{uuid.uuid4().hex[:12]}"
            old = log.spark.read.schema(SAFETY_EVENT).parquet(log.path).select("id").where("id IS NOT NULL").distinct()
            old = old.checkpoint()  # written below as it was counted
            sizes = old.groupBy(bucket_of(buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a bucket
            state["keys"] = write_keys(log, old, {r["bucket"]: r["n"] for r in sizes}, {}, buckets, token)
    intents = [n for n in log.names("_staged") if n.endswith(".json")]
    for name in intents:
        intent = log.read(f"_staged/{name}")
        if intent["batch"] > state["batch"]:
            state = _carry_out(log, intent, state, resumed=True)
    return state


def append_batch(batch: DataFrame, path: str, writer: str | None = None, epoch: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Append a batch to the keyed log; the events written (readable until the
    log's next append).

    ``writer`` and ``epoch`` number the batches of one writer: one that the
    ledger covers is skipped. ``buckets`` is taken by a new log."""
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    log = Folder(spark, path)
    state = _opened(log, buckets)
    if writer is not None and state["writers"].get(writer, -1) >= epoch:
        return spark.createDataFrame([], SAFETY_EVENT)
    for name in log.names("_staged"):
        log.remove(f"_staged/{name}")
    token = f"{state['batch'] + 1:012d}-{uuid.uuid4().hex[:12]}"
    candidates(batch).write.parquet(log.at(f"_staged/{token}/candidates"))
    rows = spark.read.parquet(log.at(f"_staged/{token}/candidates"))
    decide(rows, known_ids(log, state, rows)).write.parquet(log.at(f"_staged/{token}/decided"))
    intent = {"batch": state["batch"] + 1, "token": token, "writer": writer, "epoch": epoch}
    log.write(f"_staged/{token}.json", intent)
    _carry_out(log, intent, state, resumed=False)
    return accepted(spark.read.parquet(log.at(f"_staged/{token}/decided")))


def known_ids(log: Folder, state: dict, rows: DataFrame) -> DataFrame | None:
    """The log's ids in the buckets that candidates touch; None if there are none."""
    here = rows.where("id IS NOT NULL")
    counted = here.groupBy(bucket_of(state["buckets"]).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a bucket
    touched = [r["bucket"] for r in counted]
    if not key_paths(log, state["keys"], touched):
        return None
    found = keys(log, state["keys"], touched)
    if sum(r["n"] for r in counted) > POINT_IDS:
        return found
    return found.where(F.col("id").isin([r["id"] for r in here.select("id").collect()]))


def read_refused(spark: SparkSession, path: str) -> DataFrame:
    """Refused events of all batches: (reason, id, rows, event); ``event`` is
    given for events without id, ``rows`` counts the refused rows of an id."""
    log = Folder(spark, path)
    if not log.names("_refused"):
        return spark.createDataFrame([], REFUSED)
    return spark.read.schema(REFUSED).parquet(log.at("_refused")).select("reason", "id", "rows", "event")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The newest ledger entries: (batch, written, refused), oldest first."""
    log = Folder(spark, path)
    rows = [log.read(f"_ledger/{n}") for n in log.names("_ledger") if n.endswith(".json")]
    return spark.createDataFrame([(r["batch"], r["written"], r["refused"]) for r in rows], "batch long, written long, refused long")
