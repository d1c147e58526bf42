import json
import math
import os

from pyspark.sql import functions as F

from conftest import rows
from vigil import constants as K
from vigil.operators import drift as D
from vigil.operators import quality as Q
from vigil.sources import files as I


def logdf(spark, data, schema="id string, time string, inference_of_emotion string"):
    return Q.normalize_log(spark.createDataFrame(data, schema))


def checks(df, **kw):
    return {r["check"]: r["ok"] for r in Q.validation_checks(df, **kw).collect()}


def test_duplicate_and_null_ids(spark):
    df = logdf(spark, [("a", "10:00:00", "fear"), ("a", "10:00:01", "sad"), ("b", "10:00:02", "sad"),
                       (None, "10:00:03", "sad"), (None, "10:00:04", "sad")])
    diag = {r.metric: r.value for r in Q.diagnostics(df).collect()}
    assert diag["duplicate_id_count"] == 2  # second 'a' and second null
    assert diag["null_id_count"] == 2
    c = checks(df)
    assert c["id_unique"] is False and c["not_null_id"] is False and c["labels_valid"] is True
    assert rows(Q.duplicate_ids(df)) == [("a", 1), (None, 1)]


def test_labels_nan_trap_and_verdicts(spark):
    df = logdf(spark, [("1", "10:00:00", " Surprised "), ("2", "10:00:00", "FEAR"), ("3", "10:00:00", None),
                       ("4", "bad", "unknown_x")])
    c = checks(df)
    assert c["not_null_inference_of_emotion"] is True  # null became 'nan' first
    assert c["labels_valid"] is False
    v = Q.validation_verdict(Q.validation_checks(df)).first()
    assert (v.strict_ok, v.lenient_ok) == (False, False)
    diag = {r.metric: r.value for r in Q.diagnostics(df).collect()}
    assert diag["invalid_label_count"] == 2 and diag["time_unparseable_count"] == 1
    assert rows(Q.top_invalid_labels(df), "inference_of_emotion", "count") == [("nan", 1), ("unknown_x", 1)]
    assert [r.id for r in Q.sample_invalid_rows(df, 1, [F.col("id")]).collect()] == ["3"]


def test_schema_checks(spark):
    missing = spark.createDataFrame([("1", "x")], "id string, time string")
    extra = spark.createDataFrame([("x", "1", "y", "fear")], "extra string, id string, time string, inference_of_emotion string")
    assert Q.column_diff(missing) == (["inference_of_emotion"], [])
    assert Q.column_diff(extra) == ([], ["extra"])
    assert Q.check_columns(extra, exact=False) and not Q.check_columns(extra, exact=True)
    assert checks(missing)["labels_valid"] is False
    assert checks(extra, allow_extra=True)["schema_ok"] is True


def test_validate_all_missing_file_and_separator_sniffing(spark, tmp):
    p = os.path.join(tmp, "log.csv")
    with open(p, "wb") as f:
        f.write(" id ;time; inference_of_emotion \n1;10:00:00;fear\n2;10:00:01;caf\xe9\n".encode("latin-1"))
    df = I.read_log_csv(spark, p)
    assert df.columns == ["id", "time", "inference_of_emotion"]
    assert rows(df, "inference_of_emotion") == [("café",), ("fear",)]
    runs, overall = Q.validate_all(spark, [p, os.path.join(tmp, "missing.csv")], strict=False)
    got = {r.file: (r.success, r.error) for r in runs.collect()}
    assert got[os.path.join(tmp, "missing.csv")][0] is False and "not found" in got[os.path.join(tmp, "missing.csv")][1]
    assert overall.first()[0] is False


def side(spark, labels):
    return spark.createDataFrame([(x,) for x in labels], "inference_of_emotion string")


def metrics(spark, a, b):
    f = D.drift_frames(side(spark, a), side(spark, b), names=("tess", "synth"))
    return f["js"].first()[0], f["l1"].first()[0], [r.alert for r in f["alerts"].orderBy("alert_index").collect()]


def test_identical_and_disjoint(spark):
    js, l1, _ = metrics(spark, ["fear", "sad"] * 150, ["fear", "sad"] * 150)
    assert js == 0.0 and l1 == 0.0
    js, l1, alerts = metrics(spark, ["fear"] * 300, ["sad"] * 300)
    assert abs(js - 1.0) < 1e-9 and l1 == 2.0
    assert alerts[0] == "ALERT: per-label drift > 20% for ['sad', 'fear']"
    assert alerts[-1] == "ALERT: JS divergence 1.000 > 0.100"


def test_sample_size_warning_edge(spark):
    _, _, a = metrics(spark, ["fear"] * 199, ["fear"] * 200)
    assert a == ["WARNING: tess sample size low (n=199)"]


def test_unknown_share_and_symmetry(spark):
    a, b = ["fear"] * 90 + ["weird"] * 10, ["fear"] * 100
    f = D.drift_frames(side(spark, a), side(spark, b), names=("tess", "synth"))
    u = f["unknown"].first()
    assert (u.unknown_a, u.unknown_b, u.abs_drift) == (0.1, 0.0, 0.1)
    js_ab = f["js"].first()[0]
    js_ba = D.drift_frames(side(spark, b), side(spark, a), names=("tess", "synth"))["js"].first()[0]
    assert math.isclose(js_ab, js_ba, abs_tol=1e-12) and 0 <= js_ab <= 1


def test_drift_report_json(spark, tmp):
    rep = D.drift_report(side(spark, ["fear", "sad"] * 100), side(spark, ["fear"] * 150), names=("tess", "synth"))
    path = I.write_report_json(rep, os.path.join(tmp, "report"))
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(path, files[0])).read())
    assert doc["sizes"] == {"tess_n": 200, "synth_n": 150} and doc["thresholds"]["js"] == K.DRIFT_JS
    assert set(doc["unknown_share"]) == {"tess", "synth", "abs_drift"} and doc["tess_label_counts"]["fear"] == 100
    assert set(doc["per_label_abs_drift"]) == set(K.VALID_LABELS)


def test_single_checks(spark):
    df = logdf(spark, [("a", None, "fear"), ("a", "10:00:00", "weird")])
    assert Q.check_nonempty(df).first().ok is True
    assert Q.check_nonempty(df.filter("false")).first().ok is False
    assert rows(Q.check_not_null(df)) == [("id", True), ("inference_of_emotion", True), ("time", False)]
    assert Q.check_unique(df).first().ok is False
    assert Q.check_labels(df).first().ok is False
    assert Q.check_labels(df.drop("inference_of_emotion")).first().ok is False
