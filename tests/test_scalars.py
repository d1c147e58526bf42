from pyspark.sql import functions as F

from conftest import rows
from vigil import constants as K
from vigil.functions import scalars as X


def test_bad_and_null_timestamps_give_null_hour(mk):
    df = mk([("a", "2026-03-01T10:15:00"), ("b", "bad"), ("c", None)], "id string, timestamp string")
    out = X.with_hour(X.with_timestamp(df))
    assert rows(out, "id", "hour") == [("a", 10), ("b", None), ("c", None)]


def test_risk_boundary_three_modes(mk):
    data = [("fear", 49.999), ("fear", 50.0), ("fear", 50.001), ("angry", 49.999), ("angry", 50.0),
            ("angry", 50.001), ("happy", 99.0)]
    df = mk(data, "emotion string, confidence double")
    ge = [r[0] for r in X.with_risk(df).select("risk_level").collect()]
    gt = [r[0] for r in X.with_risk(df, strict=True).select("risk_level").collect()]
    no = [r[0] for r in X.with_risk(df, threshold=None).select("risk_level").collect()]
    D, C, S = K.DANGER, K.CAUTION, K.SAFE
    assert ge == [S, D, D, S, C, C, S]
    assert gt == [S, S, D, S, S, C, S]
    assert no == [D, D, D, C, C, C, S]


def test_null_confidence_is_safe(mk):
    df = mk([("fear", None)], "emotion string, confidence double")
    assert X.with_risk(df).select("risk_level", "mqtt_signal").first() == (K.SAFE, "S")


def test_geo_bucket_truncates_toward_zero(mk):
    df = mk([(-0.05, 0.05), (-1.71, 28.699)], "latitude double, longitude double")
    assert rows(X.with_geo_bucket(df), "lat_bucket", "lon_bucket") == [(-17, 286), (0, 0)]


def test_title_label_breaks_on_non_letters(mk):
    df = mk([("feAr-x of",), (" Surprised ",), ("unknown_x",), (None,)], "s string")
    got = [r[0] for r in df.select(X.title_label("s")).collect()]
    assert got == ["Fear-X Of", " Surprised ", "Unknown_x", None]


def test_canonical_label(mk):
    df = mk([(" Surprised ",), ("FEAR",), (None,), ("unknown_x",)], "s string")
    got = [r[0] for r in df.select(X.canonical_label("s")).collect()]
    assert got == ["surprise", "fear", "nan", "unknown_x"]


def test_classify_later_class_overrides(mk):
    df = mk([("Fear",), ("Calm",), ("Other",), (None,)], "inference string")
    mapping = [("A", ["Fear", "Calm"]), ("B", ["Calm"])]
    assert rows(X.classify(df, mapping), "inference", "class") == [
        ("Calm", "B"), ("Fear", "A"), ("Other", K.UNASSIGNED), (None, K.UNASSIGNED)]


def test_top_class_first_on_ties(mk):
    df = mk([([0.4, 0.4, 0.2],)], "probs array<double>")
    r = X.with_top_class(df, classes=["a", "b", "c"]).first()
    assert (r["top_index"], r["top_label"], round(r["top_confidence"], 9)) == (0, "a", 40.0)


def test_class_probabilities_rows(mk):
    df = mk([(1, [0.1, 0.9])], "k int, probs array<double>")
    out = X.class_probabilities(df, classes=["sad", "fear"], keys=["k"])
    assert rows(out, "class_index", "class", "probability") == [(0, "Sad", 0.1), (1, "Fear", 0.9)]


def test_alert_colour_and_safety_status(mk):
    df = mk([(K.DANGER, "fear"), (K.CAUTION, "angry"), (K.SAFE, "disgust")], "risk_level string, emotion string")
    got = X.with_safety_status(X.with_alert_colour(df)).select("colour", "is_unsafe", "status").collect()
    assert [tuple(r) for r in got] == [("red", True, K.STATUS_UNSAFE), ("orange", True, K.STATUS_UNSAFE),
                                       ("green", False, K.STATUS_FILTERED)]


def test_parse_log_time_layouts(mk):
    df = mk([("2026-03-01 10:00:00",), ("03/04/2026 10:00:00",), ("25/12/2026 10:00:00",), ("09:30:00",), ("x",)],
            "time string")
    out = X.parse_log_time(df, ref_date="2026-03-05").select(F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("t"))
    assert [r[0] for r in out.collect()] == ["2026-03-01 10:00", "2026-04-03 10:00", "2026-12-25 10:00",
                                             "2026-03-05 09:30", None]


def test_no_time_column_counts_minutes_back(mk, spark):
    df = mk([("a",), ("b",), ("c",)], "inference string")
    out = X.parse_log_time(df, now="2026-03-01 12:00:00")
    got = [r[0] for r in out.select(F.date_format("timestamp", "HH:mm")).collect()]
    assert sorted(got) == ["11:58", "11:59", "12:00"]


def test_fill_defaults_and_synonyms(mk):
    df = mk([("x", "fear")], "Time_Log string, Inference_Of_Emotion string")
    out = X.fill_log_defaults(X.rename_synonyms(X.normalize_columns(df)))
    assert sorted(out.columns) == ["id", "inference", "time"]
    assert out.select("id").first()[0] == K.DEFAULT_LOG_ID


def test_collapse_counter_ids(mk):
    counter = mk([(str(i),) for i in range(20)], "id string")
    three = mk([(str(i % 3),) for i in range(20)], "id string")
    edge = mk([(str(i % 18),) for i in range(20)], "id string")  # exactly 0.9 x rows distinct
    assert {r[0] for r in X.collapse_counter_ids(counter).select("id").collect()} == {K.STREAM_LOG_ID}
    assert {r[0] for r in X.collapse_counter_ids(three).select("id").collect()} == {"0", "1", "2"}
    assert len({r[0] for r in X.collapse_counter_ids(edge).select("id").collect()}) == 18


def test_last_days_and_radius(mk):
    df = mk([("a", "2026-03-01 00:00:00", 28.6139, 77.209), ("b", "2026-02-01 00:00:00", 28.7, 77.3)],
            "id string, ts string, latitude double, longitude double").withColumn("timestamp", F.to_timestamp("ts"))
    assert rows(X.last_days(df, 7, "2026-03-05 00:00:00"), "id") == [("a",)]
    assert rows(X.within_radius(df, 28.6139, 77.209, 1.5), "id") == [("a",)]


def test_parse_log_time_one_digit_fields(mk):
    df = mk([("9:05:07",), ("3/4/2026 9:5:7",), ("2026-3-4 10:00:00",)], "time string")
    out = X.parse_log_time(df, ref_date="2026-03-05").select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    assert [r[0] for r in out.collect()] == ["2026-03-05 09:05:07", "2026-03-04 09:05:07", "2026-03-04 10:00:00"]


def test_text_timestamp_column_layouts(mk):
    df = mk([("2026-03-01 10:00:00",), ("2026/03/02 11:00:00",), ("bad",)], "timestamp string")
    out = X.parse_log_time(df).select(F.date_format("timestamp", "yyyy-MM-dd HH"))
    assert [r[0] for r in out.collect()] == ["2026-03-01 10", "2026-03-02 11", None]


def test_log_times_iso_fractions_zones_and_one_day_order(spark):
    from vigil.functions import scalars as X

    def parse(values, **kw):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, time string")
        return [str(r.timestamp) if r.timestamp else None for r in X.parse_log_time(df, ref_date="2026-03-01", **kw).orderBy("i").collect()]

    assert parse(["2026-03-01T10:15:00.123456", "2026-03-01T10:15:00Z", "10:15:00.5", "2026-03-01", "2026-03-01 10:15", "10:15", "9:05:07", "x", None, "2026"]) == [
        "2026-03-01 10:15:00.123456", "2026-03-01 10:15:00", "2026-03-01 10:15:00.500000", "2026-03-01 00:00:00", "2026-03-01 10:15:00",
        "2026-03-01 10:15:00", "2026-03-01 09:05:07", None, None, None]
    assert parse(["03/04/2026 00:00:00", "13/04/2026 00:00:00"]) == ["2026-04-03 00:00:00", "2026-04-13 00:00:00"]
    assert parse(["03/04/2026 00:00:00", "04/13/2026 00:00:00"]) == ["2026-03-04 00:00:00", "2026-04-13 00:00:00"]
    assert parse(["03/04/2026", "3.4.2026 10:00"]) == ["2026-04-03 00:00:00", "2026-04-03 10:00:00"]


def test_generated_times_pass_the_int_range(spark):
    from pyspark.sql import functions as F

    row = F.lit(3_000_000_000)
    back = F.make_dt_interval((row / 1440).cast("int"), F.lit(0), (row % 1440).cast("int"))
    assert str(spark.range(1).select((F.to_timestamp(F.lit("9000-01-01 00:00:00")) - back).cast("string")).first()[0]) == "3296-01-10 16:00:00"


def test_layouts_are_tried_on_texts_of_their_shape(spark):
    """The guards of the layouts keep every text that a layout reads."""
    texts = ["3/4/2026", "03/04/2026 9:5", "13/04/2026 09:05:07", "04/13/2026 09:05:07", "31/02/2026", "2/30/2026 10:00", "1-2-2026 23:59:59", "1-2--2026", "31.12.2026", "12.31.2026",
             "2026/3/4", "2026/12/31 0:0:0", "-2026/3/4", "+12026/3/4", "3/4/+12026", "003/0004/2026 007:008:009", "3/4/26", "3/4-2026", "3/4/2026 24:00", "3/4/2026 10:00:60", "3/4/2026  10:00",
             "3/4/2026T10:00", "3/4/2026 10:00:00.5", "0/4/2026", "3/0/2026", " 3/4/2026 10:00 ", "3/4/2026 10:00\n", "10:00:00", "2026-03-01 10:00:00", "2026-03-01", "n/a", "", None]
    df = spark.createDataFrame([(i, v, order) for i, v in enumerate(texts) for order in (True, False, None)], "i int, t string, d boolean")
    c = F.trim("t")
    for layouts in (X.YEAR_FIRST, X.MONTH_FIRST, X.DAY_FIRST):
        every = F.coalesce(*[F.try_to_timestamp(c, F.lit(x)) for x in layouts])
        got = df.select("t", X._first_layout(c, layouts).alias("a"), every.alias("b"))
        assert got.where("NOT a <=> b").collect() == [] and got.where("a IS NOT NULL").count() > 0
        for x in layouts:  # a text of another shape is never handed to the parser
            kept = df.where(c.rlike(X.layout_shape(x) + "$"))
            assert kept.where(F.trim("t").isin("10:00:00", "2026-03-01 10:00:00", "n/a", "")).count() == 0
    month, day = (F.coalesce(*[F.try_to_timestamp(c, F.lit(x)) for x in p]) for p in (X.MONTH_FIRST, X.DAY_FIRST))
    year = F.coalesce(*[F.try_to_timestamp(c, F.lit(x)) for x in X.YEAR_FIRST])
    whole = F.coalesce(F.when(c.rlike(X.ISO_TEXT), F.try_to_timestamp(c)), year, F.when(F.col("d"), F.coalesce(day, month)).otherwise(F.coalesce(month, day)))
    got = df.select("t", "d", X.parse_log_time_column("t", None, F.col("d")).alias("a"), whole.alias("b"))
    assert got.where("NOT a <=> b").collect() == []


def test_titles_of_plain_and_separated_labels(spark):
    labels = [" surprised ", "a  b", "O'NEIL_x 2nd", "very-SAD face", "a/b.c", "-", "", "élan vital", "a\tb", None]
    df = spark.createDataFrame([(v,) for v in labels], "s string")
    spaced = F.initcap(F.regexp_replace(F.lower("s"), r"([^\p{L}\p{N}'_])", "$1 "))
    whole = F.regexp_replace(spaced, r"([^\p{L}\p{N}'_]) ", "$1")
    assert df.where(~X.title_label("s").eqNullSafe(whole)).collect() == []
