import pytest
from pyspark.sql import functions as F

from conftest import rows
from vigil import constants as K
from vigil.operators import cubes as C
from vigil.operators import risk as R

D, CA, S = K.DANGER, K.CAUTION, K.SAFE
SCHEMA = "id string, timestamp timestamp, emotion string, risk_level string, latitude double, longitude double"


def ev(spark, data):
    df = spark.createDataFrame([(i, t, e, r, la, lo) for i, (t, e, r, la, lo) in enumerate(data)],
                               "n long, ts string, emotion string, risk_level string, latitude double, longitude double")
    return df.select(F.col("n").cast("string").alias("id"), F.to_timestamp("ts").alias("timestamp"), "emotion",
                     "risk_level", "latitude", "longitude")


def test_null_emotion_keeps_its_danger_rows(spark):
    df = ev(spark, [("2026-03-01 01:00:00", None, D, 1.0, 1.0), ("2026-03-01 01:00:00", None, D, 1.0, 1.0),
                    ("2026-03-01 02:00:00", None, S, 1.0, 1.0)])
    assert rows(R.risk_score_by_emotion(df)) == [(None, 3, 2, 2 / 3)]


def test_empty_table(spark):
    df = ev(spark, []).filter(F.lit(False))
    assert R.danger_rate(df).first() == (0, 0, None)
    assert R.peak_danger_hour(df).first() == (None, None, None)
    s = R.summary_report(df).first()
    assert (s.total_events, s.danger_events, s.danger_rate, s.top_emotion, s.peak_danger_hour,
            s.streaming_events) == (0, 0, None, None, None, 0)


def test_no_danger_rows(spark):
    df = ev(spark, [("2026-03-01 01:00:00", "sad", S, 1.0, 1.0)] * 3)
    assert R.danger_rate(df).first() == (3, 0, 0.0)
    assert R.peak_danger_hour(df).first()["peak_danger_hour"] is None


def test_ties_go_to_smallest_hour_and_first_name(spark):
    df = ev(spark, [("2026-03-01 05:00:00", "sad", D, 1.0, 1.0), ("2026-03-01 03:00:00", "fear", D, 1.0, 1.0),
                    ("2026-03-01 05:10:00", "fear", D, 1.0, 1.0), ("2026-03-01 03:10:00", "sad", D, 1.0, 1.0)])
    p = R.peak_danger_hour(df).first()
    assert (p.peak_danger_hour, p.peak_danger_label, p.peak_danger_events) == (3, "3:00", 2)
    assert R.top_emotion(df).first()["top_emotion"] == "fear"
    s = R.summary_report(df, stream_df=df.limit(1)).first()
    assert (s.top_emotion, s.peak_danger_hour, s.streaming_events) == ("fear", 3, 1)


def test_pivots_fill_zero(spark):
    df = ev(spark, [("2026-03-01 05:00:00", "sad", D, 1.0, 1.0), ("2026-03-01 06:00:00", "fear", S, 1.0, 1.0)])
    assert rows(R.emotion_risk_pivot(df)) == [("fear", 0, 0, 1, 0), ("sad", 1, 0, 0, 0)]
    assert rows(R.hourly_risk_pivot(df)) == [(5, 1, 0, 0, 0), (6, 0, 0, 1, 0)]


def test_build_cubes_from_one_pass(spark, tmp):
    data = [("2026-03-01 0%d:00:00" % (i % 5), ["fear", "sad", "angry"][i % 3], [D, CA, S][i % 3],
             28.6 + i * 0.01, -77.2 + i * 0.02) for i in range(40)]
    df = ev(spark, data)
    paths = C.build_cubes(df, tmp)
    for name in C.CUBE_NAMES:
        cube = spark.read.parquet(paths[name])
        measure = "total_events" if name == "risk_score_cube" else "count"
        assert cube.agg(F.sum(measure)).first()[0] == 40, name
    # each cube equals its single-query form
    assert rows(spark.read.parquet(paths["hour_risk_cube"]), "hour", "risk_level", "count") == \
        rows(C.hour_risk_cube(df), "hour", "risk_level", "count")
    assert rows(spark.read.parquet(paths["geographic_cube"]), "lat_bucket", "lon_bucket", "risk_level", "count") == \
        rows(C.geographic_cube(df), "lat_bucket", "lon_bucket", "risk_level", "count")
    assert rows(spark.read.parquet(paths["risk_score_cube"])) == rows(
        C.risk_score_cube(df).select("emotion", "hour", "total_events", "danger_events", "risk_score"))


def test_cube_readers(spark):
    cube = spark.createDataFrame([(1, D, 5), (2, D, 9), (3, S, 50), (4, D, 9)], "hour int, risk_level string, count long")
    assert [r[0] for r in C.cube_peak_hours(cube).collect()] == [2, 4, 1]
    geo = spark.createDataFrame([(286, 772, D, 3), (-17, 0, D, 3), (1, 1, S, 10)],
                                "lat_bucket int, lon_bucket int, risk_level string, count long")
    top = C.cube_geo_hotspots(geo, 1).collect()
    assert [(r.lat_bucket, r.lat) for r in top] == [(-17, -1.7)]
    with pytest.raises(FileNotFoundError):
        C.cube_explorer(spark, "/nonexistent/cube")


def test_cube_explorer_status(spark):
    cube = spark.createDataFrame([(1, "fear", D, 2)], "hour int, emotion string, risk_level string, count long")
    assert tuple(C.cube_explorer_status(cube).first()) == (1, False)
    assert tuple(C.cube_explorer_status(cube.filter(F.lit(False))).first()) == (0, True)
