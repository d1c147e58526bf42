import os
import re
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from vigil import adapters as A
from vigil import constants as K
from vigil.operators import hotspots as H
from vigil.operators import layout as P
from vigil.schema import RAW_EVENT, SAFETY_EVENT_COLUMNS, STREAM_EVENT
from vigil.sources import files as I
from vigil.streaming import jobs as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def se(spark):
    return A.safety_events(spark, SF).cache()


def test_csv_and_parquet_round_trips_and_sizes(spark, se, tmp):
    csv = os.path.join(tmp, "csv")
    se.write.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(csv)
    back = I.read_events_csv(spark, csv).select(*SAFETY_EVENT_COLUMNS)
    assert rows(back) == rows(se)
    pq = I.write_parquet(se, os.path.join(tmp, "pq"), files=1)
    assert len([f for f in os.listdir(pq) if f.endswith(".parquet")]) == 1
    rep = I.size_report(spark, csv, pq).first()
    assert rep.csv_bytes > rep.parquet_bytes > 0 and rep.ratio > 1
    counts = dict((r.format, r.rows) for r in P.format_counts(spark, csv, pq, infer=False).collect())
    assert counts == {"CSV": se.count(), "Parquet": se.count()}
    timed = P.compare_formats(spark, csv, pq)
    assert [t[1] for t in timed] == [se.count()] * 2


def test_convert_folder_and_listing(spark, tmp):
    folder = os.path.join(tmp, "in")
    os.makedirs(os.path.join(folder, "tess", "OAF_fear"))
    pd.DataFrame({"a": [1, 2], "b": ["x", "y"]}).to_csv(os.path.join(folder, "one.csv"), index=False)
    for name in ["tess/OAF_fear/a_fear.wav", "tess/OAF_fear/b.WAV", "c.wav"]:
        open(os.path.join(folder, name), "wb").write(b"RIFF")
    out = I.convert_folder(spark, folder)
    assert [os.path.basename(p) for p in out] == ["one.parquet"]
    assert rows(spark.read.parquet(out[0])) == [(1, "x"), (2, "y")]
    listed = sorted(os.path.basename(r.path) for r in I.list_corpus(spark, folder).collect())
    assert listed == ["a_fear.wav", "c.wav"]


def test_summary_csv_and_sql_count(spark, se, tmp):
    from vigil.operators.risk import summary_report

    path = I.write_summary_csv(summary_report(se), os.path.join(tmp, "summary"))
    back = spark.read.option("header", True).csv(path).first()
    assert int(back.total_events) == se.count()
    assert I.sql_row_count(spark, se).first()[0] == se.count()
    api = dict((r.method, r.rows) for r in P.api_sql_counts(se).collect())
    assert set(api.values()) == {se.count()}


def test_append_refuses_known_and_repeated_ids(spark, se, tmp):
    path = os.path.join(tmp, "log")
    first = se.limit(10)
    assert I.append_events(first, path).count() == 10
    again = I.append_events(se.unionByName(first), path)
    assert again.count() == se.count() - 10
    log = I.read_log(spark, path)
    assert log.count() == se.count() and log.select("id").distinct().count() == se.count()


def test_partition_sizes_include_empty(spark):
    df = spark.range(0, 10, numPartitions=4).filter("id < 3")
    got = rows(P.partition_sizes(df))
    assert len(got) == 4 and sum(r[1] for r in got) == 3 and any(r[1] == 0 for r in got)
    sizes = [r[1] for r in P.repartition_report(spark.range(100), 5).collect()]
    assert len(sizes) == 5 and sum(sizes) == 100 and min(sizes) > 0


def test_hotspots_on_separated_blobs(spark):
    import random

    rnd = random.Random(5)
    centres = [(10.0, 10.0), (20.0, 50.0), (-30.0, 5.0)]
    data = [(str(i), K.DANGER, c[0] + rnd.gauss(0, 0.01), c[1] + rnd.gauss(0, 0.01))
            for i in range(300) for c in [centres[i % 3]]]
    data.append(("x", K.DANGER, None, None))  # no location: skipped
    df = spark.createDataFrame(data, "id string, risk_level string, latitude double, longitude double")
    got = H.geo_hotspots(df, k=3, seed=1).collect()
    assert [(round(r.latitude), round(r.longitude)) for r in got] == sorted((int(a), int(b)) for a, b in centres)
    assigned = H.assign_hotspot(df, H.geo_hotspots(df, k=3, seed=1))
    assert assigned.count() == 300 and assigned.groupBy("hotspot").count().count() == 3


def live(spark, src):
    """Files of raw events as a stream of event columns, one file per batch."""
    return A.event_projection(S.event_stream(spark, src, max_files_per_trigger=1, schema=RAW_EVENT))


def write_events(folder, name, ids, ts):
    df = pd.DataFrame({"event_id": pd.Series(ids, dtype="int64"), "ts": pd.Series(pd.to_datetime(ts), dtype="datetime64[us]"),
                       "user_id": pd.Series([1] * len(ids), dtype="int64"),
                       "event_type": pd.Series(["error"] * len(ids), dtype="object"),
                       "value": pd.Series([50.0] * len(ids), dtype="float64"),
                       "props": pd.Series(['{"k": 80}'] * len(ids), dtype="object")})
    df.to_parquet(os.path.join(folder, name))


def test_streams_dedup_late_rows_and_empty_file(spark, tmp):
    src = os.path.join(tmp, "src")
    os.makedirs(src)
    write_events(src, "a.parquet", [1, 2], ["2026-03-01 10:00:00", "2026-03-01 10:00:01"])
    write_events(src, "b.parquet", [2, 3], ["2026-03-01 10:00:01", "2026-03-01 10:30:00"])
    write_events(src, "c.parquet", [], [])
    raw = live(spark, src)

    def run(name, start):
        out, ck = os.path.join(tmp, name), os.path.join(tmp, name + "_ck")
        start(raw, out, ck).awaitTermination()
        return out

    log = spark.read.parquet(run("log", S.stream_risk_log))
    assert sorted(r.id for r in log.collect()) == ["1", "2", "3"] and set(log.columns) == set(SAFETY_EVENT_COLUMNS)
    assert {r.risk_level for r in log.collect()} == {K.DANGER}
    dd = spark.read.parquet(run("dedup", S.stream_dedup))
    assert sorted(r.id for r in dd.collect()) == ["1", "2", "3"]
    total = S.read_recent(spark, run("total", S.stream_event_total)).first()[0]
    assert total == 4
    recent = S.read_recent(spark, run("recent", lambda r, o, c: S.stream_recent(r, o, c, 2)))
    assert sorted(r.id for r in recent.collect()) == ["2", "3"]
    alerts = spark.read.parquet(run("alerts", S.stream_danger_alerts))
    assert alerts.columns == ["timestamp", "latitude", "longitude", "risk_level"] and alerts.count() == 4
    # rolling windows: windows ending after the final watermark (10:30:00 - 10 s) stay open
    roll = spark.read.parquet(run("roll", S.stream_rolling_rms))
    assert roll.filter(F.col("window_end") > F.lit("2026-03-01 10:29:50").cast("timestamp")).count() == 0
    assert roll.agg(F.sum("n")).first()[0] == 6 * 3  # rows at 10:00:00, 10:00:01 (twice): 6 windows each


def test_cli_jobs(spark, se, tmp):
    import json

    from vigil import cli

    good = os.path.join(tmp, "good.csv")
    pd.DataFrame({"id": ["1", "2"], "time": ["10:00:00", "10:00:01"],
                  "inference_of_emotion": ["fear", "Surprised"]}).to_csv(good, index=False)
    assert cli.main(["validate", good, "--out", os.path.join(tmp, "v1")]) == 0
    assert cli.main(["validate", good, os.path.join(tmp, "nope.csv"), "--out", os.path.join(tmp, "v2")]) == 1
    doc = json.loads(open([os.path.join(tmp, "v2", f) for f in os.listdir(os.path.join(tmp, "v2"))
                           if f.endswith(".json")][0]).read())
    assert doc["overall_success"] is False and len(doc["runs"]) == 2 and doc["suite"] == "integrity_suite"
    ok_run = [r for r in doc["runs"] if r["success"]][0]
    assert ok_run["checks"]["labels_valid"] is True and ok_run["diagnostics"]["row_count"] == 2
    assert cli.main(["drift", good, good, "--out", os.path.join(tmp, "d")]) == 0
    pq = I.write_parquet(se, os.path.join(tmp, "ev"))
    assert cli.main(["cubes", pq, "--out", os.path.join(tmp, "cubes")]) == 0
    assert spark.read.parquet(os.path.join(tmp, "cubes", "hour_risk_cube")).agg(F.sum("count")).first()[0] == se.count()
    assert cli.main(["summary", pq, "--out", os.path.join(tmp, "sum")]) == 0


def test_stream_hotspots_seed_then_update(spark, tmp):
    src = os.path.join(tmp, "hsrc")
    os.makedirs(src)
    # user_id sets the latitude cell, event_id the longitude cell of the stand-in events
    def batch(name, ids, users):
        df = pd.DataFrame({"event_id": pd.Series(ids, dtype="int64"),
                           "ts": pd.Series(pd.to_datetime(["2026-03-01 10:00:00"] * len(ids)), dtype="datetime64[us]"),
                           "user_id": pd.Series(users, dtype="int64"), "event_type": ["error"] * len(ids),
                           "value": [50.0] * len(ids), "props": ['{"k": 90}'] * len(ids)})
        df.to_parquet(os.path.join(src, name))
    batch("a.parquet", list(range(0, 40)), [0] * 20 + [30] * 20)
    batch("b.parquet", list(range(100, 120)), [0] * 20)
    raw = live(spark, src)
    out, ck = os.path.join(tmp, "hot"), os.path.join(tmp, "hot_ck")
    S.stream_hotspots(raw, out, ck, k=2, seed=1).awaitTermination()
    versions = sorted(os.listdir(out))
    assert versions == ["v=0", "v=1"]
    first = spark.read.parquet(os.path.join(out, "v=0"))
    last = S.read_recent(spark, out)
    assert first.agg(F.sum("weight")).first()[0] == 40 and last.agg(F.sum("weight")).first()[0] == 60
    assert last.count() == 2 and set(last.columns) >= {"hotspot", "latitude", "longitude", "weight", "batch_id"}


def test_streams_resume_from_checkpoint(spark, tmp):
    src = os.path.join(tmp, "rsrc")
    os.makedirs(src)
    write_events(src, "a.parquet", [1, 2], ["2026-03-01 10:00:00", "2026-03-01 10:00:01"])
    out, ck = os.path.join(tmp, "rlog"), os.path.join(tmp, "rlog_ck")
    rout, rck = os.path.join(tmp, "rrec"), os.path.join(tmp, "rrec_ck")
    S.stream_risk_log(live(spark, src), out, ck).awaitTermination()
    S.stream_recent(live(spark, src), rout, rck, 2).awaitTermination()
    # a restart with nothing new writes nothing new
    S.stream_risk_log(live(spark, src), out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    # a new file is picked up once, incrementally
    write_events(src, "b.parquet", [3], ["2026-03-01 11:00:00"])
    S.stream_risk_log(live(spark, src), out, ck).awaitTermination()
    S.stream_recent(live(spark, src), rout, rck, 2).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]
    assert sorted(r.id for r in S.read_recent(spark, rout).collect()) == ["2", "3"]


def test_ingest_groups_files_by_shape(spark, tmp):
    shape_a = [os.path.join(tmp, f"a{i}.csv") for i in range(3)]
    for i, p in enumerate(shape_a):
        pd.DataFrame({"ID": [f"dev{i}"] * 2, "Time_Log": ["10:00:00", "10:00:01"],
                      "Inference_Of_Emotion": ["fear", "sad"]}).to_csv(p, index=False)
    other = os.path.join(tmp, "b.csv")
    pd.DataFrame({"inference": ["happy", "fear"]}).to_csv(other, index=False, sep=";")
    out = I.ingest_logs(spark, shape_a + [other, os.path.join(tmp, "missing.csv")], ref_date="2026-03-01",
                        now="2026-03-01 12:00:00")
    got = rows(out)
    assert len(got) == 8
    assert {r[0] for r in got} == {"dev0", "dev1", "dev2", "Device_1"}
    assert sum(1 for r in got if r[0] == "Device_1") == 2 and {r[2] for r in got} == {"Fear", "Sad", "Happy"}


def test_ingest_counter_ids_decided_per_file(spark, tmp):
    paths = [os.path.join(tmp, f"c{i}.csv") for i in range(2)]
    for p in paths:  # each file: ids 1..10 are a row counter; together 10 distinct ids on 20 rows are not
        pd.DataFrame({"id": list(range(1, 11)), "time": ["10:00:00"] * 10,
                      "inference_of_emotion": ["fear"] * 10}).to_csv(p, index=False)
    out = I.ingest_logs(spark, paths, ref_date="2026-03-01")
    assert {r.id for r in out.collect()} == {"Stream_1"} and out.count() == 20


def test_ingest_moves_no_rows_of_a_log_to_one_task(spark, tmp):
    """Decisions taken per log go to the rows; joining by log would bring all
    rows of a log into one task."""
    a, b = os.path.join(tmp, "a.csv"), os.path.join(tmp, "b.csv")
    pd.DataFrame({"id": [1, 2], "time": ["10:00:00", "13/04/2026 10:00:00"], "inference_of_emotion": ["fear", "very-sad"]}).to_csv(a, index=False)
    pd.DataFrame({"ID": ["d", "d"], "Timestamp": ["2026-03-01 10:00:00", None], "Inference": ["fear", "sad"]}).to_csv(b, index=False, sep=";")
    out = I.ingest_logs(spark, [a, b], ref_date="2026-03-01")
    assert rows(out.select("id", F.col("timestamp").cast("string"), "inference")) == [
        ("Stream_1", "2026-03-01 10:00:00", "Fear"), ("Stream_1", "2026-04-13 10:00:00", "Very-Sad"), ("d", "2026-03-01 10:00:00", "Fear"), ("d", None, "Sad")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") >= 4
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:  # Java compiles no method of over 8000 bytes
        again = I.ingest_logs(spark, [a, b], ref_date="2026-03-01")
        made = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(again._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", made)]
    assert sizes and max(sizes) < 8000


def test_ingest_repeated_path_is_bound_twice(spark, tmp):
    p = os.path.join(tmp, "r.csv")
    pd.DataFrame({"id": ["d", "d"], "time": ["10:00:00", "10:00:01"], "inference": ["fear", "sad"]}).to_csv(p, index=False)
    assert I.ingest_logs(spark, [p, p], ref_date="2026-03-01").count() == 4


def test_hotspots_keep_every_event_before_seeding(spark, tmp):
    src = os.path.join(tmp, "few")
    os.makedirs(src)
    for b, n in enumerate([3, 3, 0, 3, 3, 20]):
        ids = list(range(b * 100, b * 100 + n))
        write_events(src, f"{b}.parquet", ids, ["2026-03-01 10:00:00"] * n)
    out = os.path.join(tmp, "few_out")
    S.stream_hotspots(live(spark, src), out, os.path.join(tmp, "few_ck"), k=8, seed=1).awaitTermination()
    assert S.read_hotspots(spark, out).agg(F.sum("weight")).first()[0] == 32 and 1 <= S.read_hotspots(spark, out).count() <= 8
    assert len(S.versions(spark, out)) == 2  # older versions are removed


def test_streams_take_four_column_events(spark, tmp):
    src = os.path.join(tmp, "four")
    spark.createDataFrame([(datetime(2026, 3, 1), 1.0, 2.0, level) for level in (K.DANGER, K.SAFE)], STREAM_EVENT).write.parquet(src)
    events = S.event_stream(spark, src, schema=STREAM_EVENT)
    S.stream_danger_alerts(events, os.path.join(tmp, "f_out"), os.path.join(tmp, "f_ck")).awaitTermination()
    assert spark.read.parquet(os.path.join(tmp, "f_out")).count() == 1


def test_append_lists_a_null_id_and_goes_on(spark, se, tmp):
    path = os.path.join(tmp, "nulls")
    batch = se.orderBy("id").limit(3).withColumn("id", F.when(F.col("id") != "0", F.col("id")))
    assert I.append_events(batch, path).count() == 2
    refused = I.read_refused(spark, path).collect()
    assert [(r.reason, r.id, r.rows) for r in refused] == [("no id", None, 1)] and refused[0].event.emotion is not None


def test_ingest_reports_skipped_paths_and_keeps_part_order(spark, tmp):
    folder = os.path.join(tmp, "parts")
    os.makedirs(folder)
    for i, n in enumerate([2, 2000]):  # the larger part would be scanned first
        pd.DataFrame({"inference": [f"x{i}"] * n}).to_csv(os.path.join(folder, f"part-{i}.csv"), index=False)
    open(os.path.join(tmp, "empty.csv"), "w").close()
    skipped = []
    out = I.ingest_logs(spark, [folder, os.path.join(tmp, "gone.csv"), os.path.join(tmp, "empty.csv")], now="2026-03-01 12:00:00", skipped=skipped)
    assert skipped == [os.path.join(tmp, "gone.csv"), os.path.join(tmp, "empty.csv")]
    assert [r.inference for r in out.orderBy(F.desc("timestamp")).limit(3).collect()] == ["X0", "X0", "X1"]


def test_layout_takes_any_number_of_partitions(spark):
    sizes = [r[1] for r in P.repartition_report(spark.range(1000), 50).collect()]
    assert len(sizes) == 50 and sum(sizes) == 1000
