from pyspark.sql import functions as F

from conftest import rows
from vigil.functions import scalars as X
from vigil.operators import profile as PF


def events(spark):
    return spark.createDataFrame(
        [("1", "2026-03-01 10:00:00", 1.0, None), ("2", "2026-03-01 11:00:00", 3.0, "x"),
         ("3", "2026-03-01 11:00:00", None, "y")],
        "id string, ts string, confidence double, note string").withColumn("timestamp", F.to_timestamp("ts"))


def test_null_counts_and_typed_describe(spark):
    df = events(spark)
    assert dict(rows(PF.null_counts(df))) == {"id": 0, "ts": 0, "confidence": 1, "note": 1, "timestamp": 0}
    d = PF.describe_table(df).collect()
    assert [r.column for r in d] == ["confidence"]
    r = d[0]
    assert (r["count"], r["mean"], r["min"], r["max"]) == (2, 2.0, 1.0, 3.0)
    assert abs(r["stddev"] - 2 ** 0.5) < 1e-12  # sample standard deviation


def test_schema_report(spark):
    rep = PF.schema_report(events(spark)).collect()
    assert [(r.position, r.column, r.type) for r in rep][:3] == [(0, "id", "string"), (1, "ts", "string"),
                                                              (2, "confidence", "double")]
    assert len(rep) == 5


def test_samples_and_recent(spark):
    df = events(spark)
    assert [r.id for r in PF.sample_records(df, 2).collect()] == ["1", "2"]
    assert [r.id for r in PF.recent_events(df, 2).collect()] == ["3", "2"]  # equal times: larger id first


def test_stamp_filter_numeric(spark):
    df = events(spark)
    st = X.stamp_events(df, "live")
    got = st.select("id", "source", "model_version", "device_id").collect()
    assert len({r.id for r in got}) == 3 and {r.source for r in got} == {"live"}
    assert rows(X.for_device(df, "2"), "id") == [("2",)]
    num = X.to_numeric(df.select("id", "note"), ["id", "note"]).collect()
    assert [(r.id, r.note) for r in num] == [(1.0, None), (2.0, None), (3.0, None)]
