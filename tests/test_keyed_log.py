"""The keyed event log: rejects, replays, a cut-short batch, files read."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from vigil import adapters as A
from vigil.schema import RAW_EVENT, SAFETY_EVENT_COLUMNS
from vigil.sources import files as I
from vigil.sources import keyed as KL
from vigil.streaming import jobs as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def se(spark):
    return A.safety_events(spark, SF).cache()


def ids(spark, path):
    return sorted(r.id for r in I.read_log(spark, path).select("id").collect())


def batch_of(se, names):
    """One event per name, in order; None is an event without id."""
    spark = se.sparkSession
    rest = [c for c in SAFETY_EVENT_COLUMNS if c != "id"]
    one = se.limit(1).select(*rest)
    named = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "id string, confidence2 int").coalesce(1)
    return named.join(one, how="cross").withColumn("confidence", F.col("confidence2").cast("double")).select(*SAFETY_EVENT_COLUMNS)


def test_rejects_are_listed_and_first_rows_stay(spark, se, tmp):
    path = os.path.join(tmp, "log")
    assert I.append_events(batch_of(se, ["a", None, "b", "a", "a", None]), path).count() == 2
    assert I.append_events(batch_of(se, ["b", "c", "c", None]), path).count() == 1
    assert ids(spark, path) == ["a", "b", "c"]
    assert I.read_log(spark, path).where("id = 'c'").first().confidence == 1.0
    refused = rows(I.read_refused(spark, path), "reason", "id", "rows")
    assert refused == sorted([("no id", None, 1)] * 3 + [("repeated id", "a", 2), ("repeated id", "b", 1), ("repeated id", "c", 1)],
                             key=lambda r: tuple((x is None, str(x)) for x in r))
    assert [tuple(r) for r in KL.read_ledger(spark, path).collect()] == [(0, 2, 4), (1, 1, 3)]
    empty = I.append_events(se.limit(0), path)
    assert empty.count() == 0 and ids(spark, path) == ["a", "b", "c"]


def test_epochs_of_a_writer_count_once(spark, se, tmp):
    path = os.path.join(tmp, "log")
    assert I.append_events(batch_of(se, ["a", None]), path, "w", 0).count() == 1
    assert I.append_events(batch_of(se, ["a", None, "x"]), path, "w", 0).count() == 0  # a replay is not looked at
    assert I.append_events(batch_of(se, ["x"]), path, "other", 0).count() == 1
    assert I.append_events(batch_of(se, ["d"]), path, "w", 1).count() == 1
    assert ids(spark, path) == ["a", "d", "x"] and I.read_refused(spark, path).count() == 1


@pytest.mark.parametrize("stop", ["write_keys", "refusals", "rows"])
def test_a_batch_cut_short_is_finished(spark, se, tmp, stop, monkeypatch):
    path = os.path.join(tmp, "log")
    I.append_events(batch_of(se, ["a", "b"]), path)

    def fail(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if stop == "rows":
            m.setattr(KL, "accepted", fail)
        else:
            m.setattr(KL, stop, fail)
        with pytest.raises(RuntimeError, match="lost"):
            I.append_events(batch_of(se, ["b", "c", "d", None]), path, "w", 7)
    # the writer tries the same epoch again, or somebody else appends
    again = I.append_events(batch_of(se, ["b", "c", "d", None]), path, "w", 7)
    assert again.count() == 0 and ids(spark, path) == ["a", "b", "c", "d"]
    assert rows(I.read_refused(spark, path), "reason", "id", "rows") == [("no id", None, 1), ("repeated id", "b", 1)]
    assert I.append_events(batch_of(se, ["d", "e"]), path).count() == 1


def test_files_read_do_not_grow_with_the_log(spark, se, tmp):
    path = os.path.join(tmp, "log")
    seen = []
    probe = batch_of(se, [f"p{i}" for i in range(20)])
    for n in range(17):
        KL.append_batch(batch_of(se, [f"{n}-{i}" for i in range(40)]), path, buckets=4)
        log = KL.Folder(spark, path)
        found = KL.known_ids(log, KL.ledger(log), KL.candidates(probe))
        seen.append(len(found.inputFiles()))
        assert not any(f.rsplit("/", 2)[1] == "log" for f in found.inputFiles())  # no event file
    assert max(seen) <= 4 * 4 and max(seen[9:]) <= max(seen[:9]) + 4  # a few runs a bucket, not one a batch
    one = KL.known_ids(log, KL.ledger(log), KL.candidates(batch_of(se, ["3-1"])))
    assert len(one.inputFiles()) <= 2  # one bucket, looked up by value
    assert one.collect()[0].id == "3-1"
    assert I.append_events(batch_of(se, ["0-0", "16-39", "new"]), path).count() == 1
    kept = [t for runs in KL.ledger(log)["keys"].values() for t, _ in runs]
    there = [r for b in log.names("_keys") if b.startswith("bucket") for r in log.names(f"_keys/{b}")]
    assert sorted(f"run={t}" for t in kept) == sorted(there)


def test_key_files_have_bloom_filters(spark, se, tmp):
    path = os.path.join(tmp, "log")
    KL.append_batch(se, path, buckets=1)
    folder = os.path.join(path, "_keys", "bucket=0")
    file = [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")][0]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    assert reader.getFooter().getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0
    reader.close()


def test_a_log_without_ledger_is_taken_over(spark, se, tmp):
    path = os.path.join(tmp, "old")
    batch_of(se, ["a", "b"]).write.parquet(path)
    assert I.append_events(batch_of(se, ["b", "c"]), path).count() == 1
    assert ids(spark, path) == ["a", "b", "c"]


def live(spark, src):
    return A.event_projection(S.event_stream(spark, src, max_files_per_trigger=1, schema=RAW_EVENT))


def raw(spark, src, names):
    spark.createDataFrame([(i, "error", 50.0, '{"k": 80}') for i in names], "event_id long, event_type string, value double, props string").select(
        "event_id", F.lit("2026-03-01 10:00:00").cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"), "event_type", "value", "props"
    ).coalesce(1).write.mode("append").parquet(src)


def test_stream_survives_bad_rows_and_replays(spark, tmp):
    src, out, ck = (os.path.join(tmp, x) for x in ("src", "out", "ck"))
    raw(spark, src, [1, None, 2])
    S.stream_risk_log(live(spark, src), out, ck).awaitTermination()
    raw(spark, src, [2, 3, None])
    S.stream_risk_log(live(spark, src), out, ck).awaitTermination()
    assert ids(spark, out) == ["1", "2", "3"]
    assert rows(I.read_refused(spark, out), "reason", "id", "rows") == [("no id", None, 1), ("no id", None, 1), ("repeated id", "2", 1)]
    # the last micro-batch is run again: its commit was lost
    for name in ("1", ".1.crc"):
        if os.path.exists(os.path.join(ck, "commits", name)):
            os.remove(os.path.join(ck, "commits", name))
    S.stream_risk_log(live(spark, src), out, ck).awaitTermination()
    assert ids(spark, out) == ["1", "2", "3"] and I.read_refused(spark, out).count() == 3
    # a new checkpoint is another writer: known ids are refused, new ones come in
    raw(spark, src, [4])
    S.stream_risk_log(live(spark, src), out, ck + "-2").awaitTermination()
    assert ids(spark, out) == ["1", "2", "3", "4"]


def test_keyed_stream_keeps_its_state_over_a_restart(spark, tmp):
    src, out, ck = (os.path.join(tmp, x) for x in ("src", "out", "ck"))
    before = spark.conf.get(S.STATE_STORE)
    raw(spark, src, [1, 1, 2, None])
    S.stream_dedup(live(spark, src), out, ck).awaitTermination()
    raw(spark, src, [2, 3, 1])
    q = S.stream_dedup(live(spark, src), out, ck)
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]
    assert spark.conf.get(S.STATE_STORE) == before
    state = [f for _, _, fs in os.walk(os.path.join(ck, "state")) for f in fs]
    assert any(f.endswith((".zip", ".changelog")) for f in state) and not any(f.endswith(".snapshot") for f in state)  # RocksDB
    plan = S.distinct_events(live(spark, src))._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate [id" in plan and "Join" not in plan


def test_events_leave_the_scan_unsorted(spark, se, tmp):
    path = os.path.join(tmp, "big-batch")
    repeated = se.withColumn("id", F.when(F.col("id").cast("long") % 3 == 0, F.lit("hot")).otherwise(F.col("id")))
    repeated.coalesce(1).write.parquet(path)
    batch = spark.read.parquet(path)
    found = KL.candidates(batch)
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
    shuffle = max(i for i, line in enumerate(plan[:scan]) if "Exchange" in line)
    assert not [line for line in plan[shuffle:scan] if "Sort" in line]  # a task's memory doesn't grow with its row group
    want = {r["id"]: r["n"] for r in batch.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert {r["id"]: r["rows"] for r in found.select("id", "rows").collect()} == want
    first = next(r for r in batch.collect() if r["id"] == "hot")  # one file, read in its order
    assert found.where("id = 'hot'").select("event.*").first() == first
