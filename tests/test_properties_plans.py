"""Property tests (drift metrics) and plan-shape tests (scale properties)."""

import math
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil import adapters as A
from vigil.functions import scalars as X
from vigil.operators import cubes as C
from vigil.operators import drift as D
from vigil.operators import risk as R
from vigil.operators.ordered import global_position
from vigil.sources.files import read_events, write_parquet

LABELS = st.lists(st.sampled_from(["fear", "sad", "happy", "odd", " Surprised ", None]), min_size=1, max_size=30)


def side(spark, labels):
    return spark.createDataFrame([(x,) for x in labels], "inference_of_emotion string")


@settings(max_examples=8, deadline=None)
@given(a=LABELS, b=LABELS)
def test_drift_metric_properties(spark, a, b):
    f = D.drift_frames(side(spark, a), side(spark, b), names=("tess", "synth"))
    js, l1 = f["js"].first()[0], f["l1"].first()[0]
    assert -1e-12 <= js <= 1 + 1e-12 and -1e-12 <= l1 <= 2 + 1e-12
    back = D.drift_frames(side(spark, b), side(spark, a), names=("tess", "synth"))["js"].first()[0]
    assert math.isclose(js, back, abs_tol=1e-12)
    al = f["aligned"].agg(F.sum("p"), F.sum("q")).first()
    assert math.isclose(al[0], 1.0) and math.isclose(al[1], 1.0)
    same = D.drift_frames(side(spark, a), side(spark, a), names=("tess", "synth"))
    assert same["js"].first()[0] == 0.0 and same["l1"].first()[0] == 0.0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_danger_filter_reaches_parquet_scan(spark, tmp):
    path = write_parquet(A.safety_events(spark, "/root/testdata/sf0.001"), os.path.join(tmp, "log"))
    q = X.danger(read_events(spark, path)).select("id", "latitude")
    p = plan(q)
    assert "EqualTo(risk_level" in p
    assert "ReadSchema: struct<id:string,latitude:double,risk_level:string>" in p


def test_single_scan_reports(spark, tmp):
    path = write_parquet(A.safety_events(spark, "/root/testdata/sf0.001"), os.path.join(tmp, "log"))
    ev = read_events(spark, path)
    assert plan(R.summary_report(ev)).count("FileScan parquet") == 1
    cells = plan(C.cube_aggregate(ev))
    assert cells.count("FileScan parquet") == 1 and "Expand" in cells
    assert plan(R.risk_score_by_emotion(ev)).count("FileScan parquet") == 1


def test_positions_deal_rows_by_range_of_the_full_key(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, "hot").otherwise("cold").alias("g"), F.col("id").alias("t"))
    pos = global_position(df, ["g", "t"], partitions=4)
    p = plan(pos)
    assert "hashpartitioning(__range" in p and "hashpartitioning(g" not in p and "SinglePartition" not in p.split("Window")[0]
    sizes = pos.groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in sizes.collect()) <= 60  # the hot key is split


def test_drift_counts_both_sides_in_one_shuffle(spark):
    a = A.inference_log(spark, "/root/testdata/sf0.001")
    b = X.danger(A.safety_events(spark, "/root/testdata/sf0.001"))
    counts = plan(D.label_counts_of_both(a, b, "inference_of_emotion", "emotion"))
    assert counts.count("FileScan") == 2 and counts.count("hashpartitioning") == 1


ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "hot", None]), st.integers(0, 6), st.sampled_from(["x", "y", "z"])),
                min_size=0, max_size=60)


@settings(max_examples=6, deadline=None)
@given(data=ROWS, parts=st.integers(1, 7))
def test_ordered_helpers_match_windows(spark, data, parts):
    from pyspark.sql import Window

    from vigil.operators.ordered import global_position, lag_by_group, lag_pair_counts

    # distinct (g, t, v) rows with a unique order key, so the window answer is unique
    df = spark.createDataFrame([(g, t * 100 + i, v) for i, (g, t, v) in enumerate(data)], "g string, t long, v string")
    w = Window.partitionBy("g").orderBy("t")
    want = df.withColumn("prev_v", F.lag("v").over(w))
    got = lag_by_group(df, ["g"], ["t"], ["v"], F.floor(F.col("t") / (parts * 50)))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.select("g", "t", "v", "prev_v").collect()), key=key) == \
        sorted(map(tuple, want.select("g", "t", "v", "prev_v").collect()), key=key)
    pairs = lag_pair_counts(df, ["g"], ["t"], "v", F.floor(F.col("t") / (parts * 50))).filter("prev IS NOT NULL")
    want_pairs = want.filter("prev_v IS NOT NULL").groupBy("prev_v", "v").count()
    assert sorted(map(tuple, pairs.select("prev", "cur", "n").collect())) == \
        sorted(map(tuple, want_pairs.collect()))
    pos = global_position(df, ["t"], out="p", partitions=parts)
    assert sorted(r.p for r in pos.collect()) == list(range(len(data)))


EVENTS = st.lists(st.tuples(st.sampled_from(["2026-03-01 01:00:00", "2026-03-01 23:59:59", "bad", None]),
                            st.sampled_from(["fear", "angry", "sad", None]),
                            st.sampled_from(["\U0001F6A8 DANGER", "✅ SAFE"]),
                            st.one_of(st.none(), st.floats(-90, 90, allow_nan=False)),
                            st.one_of(st.none(), st.floats(-180, 180, allow_nan=False))),
                  min_size=0, max_size=25)


@settings(max_examples=5, deadline=None)
@given(data=EVENTS)
def test_cube_counts_sum_to_rows(spark, data):
    df = spark.createDataFrame(data, "ts string, emotion string, risk_level string, latitude double, longitude double")
    df = df.withColumn("timestamp", F.col("ts"))
    cubes = C.split_cubes(C.cube_aggregate(df))
    for name, cube in cubes.items():
        measure = "total_events" if name == "risk_score_cube" else "count"
        assert (cube.agg(F.sum(measure)).first()[0] or 0) == len(data), name
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, cubes["hour_risk_cube"].collect()), key=key) == \
        sorted(map(tuple, C.hour_risk_cube(df).select("hour", "risk_level", "count").collect()), key=key)
