"""Chained operators and reports that have no query of their own elsewhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import adapters as A
from vigil import constants as K
from vigil.functions import scalars as X
from vigil.operators import corpus as M
from vigil.operators import cubes as C
from vigil.operators import profile as P
from vigil.operators import quality as Q
from vigil.operators import risk as R
from vigil.operators import windows as WN
from vigil.plans.catalog import ORACLE, register
from vigil.plans import q_corpus  # noqa: F401 - registers the manifests
from vigil.plans.q_events import W
from vigil.plans.q_quality import NAMES, VALID, WD, WQ, iln, sides
from vigil.plans.q_sources import _write_csv, se
from vigil.plans.sql_inputs import DANGER, WS, with_
from vigil.schema import SAFETY_EVENT
from vigil.session import scratch_path
from vigil.sources import files as I


# ---- reports -----------------------------------------------------------------------
TYPES = "VALUES " + ", ".join(f"({i}, '{f.name}', '{f.dataType.simpleString()}')" for i, f in enumerate(SAFETY_EVENT.fields))


@register("schema_report", f'SELECT position, "column", type FROM ({TYPES}) t(position, "column", type)')
def q_schema_report(spark, d):
    return P.schema_report(se(spark, d))


FACTS = " UNION ALL ".join(f"""SELECT {i} AS position, '{f.name}' AS "column", '{f.dataType.simpleString()}' AS type, count(*) AS rows, count("{f.name}") AS filled FROM se"""
                          for i, f in enumerate(SAFETY_EVENT.fields))


@register("schema_facts", W + FACTS)
def q_schema_facts(spark, d):
    """Schema of the event table as it is read, with the filled values of each column."""
    return P.schema_facts(se(spark, d))


TEXT = ("id", "source", "emotion", "risk_level", "model_version", "device_id", "mqtt_signal")


@register("describe_text", W + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, avg(TRY_CAST({c} AS DOUBLE)) AS mean,
stddev_samp(TRY_CAST({c} AS DOUBLE)) AS stddev, min({c}) AS min, max({c}) AS max, CAST(min(length({c})) AS INTEGER) AS shortest, CAST(max(length({c})) AS INTEGER) AS longest FROM se""" for c in TEXT))
def q_describe_text(spark, d):
    """Statistics of the event table's text columns."""
    return P.describe_text(se(spark, d))


@register("column_diff_facts", WQ + """SELECT 'extra' AS kind, 'clock' AS "column", count(*) AS rows, count("time") AS filled FROM iln
UNION ALL SELECT 'extra', 'note', count(*), count(*) FROM iln
UNION ALL SELECT 'missing', 'time', count(*), CAST(0 AS BIGINT) FROM iln""")
def q_column_diff_facts(spark, d):
    """Columns that a log written as a file lacks or has besides, and how many
    of its rows fill them."""
    log = iln(spark, d).withColumnRenamed("time", "clock").withColumn("note", F.lit("n"))
    return Q.column_diff_facts(I.read_log_csv(spark, _write_csv(log, scratch_path(spark, "log-columns"))))


@register("column_diff", """SELECT * FROM (VALUES ('missing', 'time'), ('extra', 'clock'), ('extra', 'note')) t(kind, "column")""")
def q_column_diff(spark, d):
    """Required log columns that a log lacks, and columns it has besides."""
    log = iln(spark, d).withColumnRenamed("time", "clock").withColumn("note", F.lit(1))
    missing, extra = Q.column_diff(log)
    return spark.createDataFrame([("missing", c) for c in missing] + [("extra", c) for c in extra], "kind string, `column` string")


@register("report_json", W + f"SELECT count(*) AS total_events, count_if(risk_level = '{DANGER}') AS danger_events FROM se")
def q_report_json(spark, d):
    """A one-row report written as JSON and read back."""
    path = I.write_report_json(R.danger_rate(se(spark, d)).select("total_events", "danger_events"), scratch_path(spark, "report-json"))
    return spark.read.schema("total_events long, danger_events long").json(path)


@register("size_report", "SELECT true AS csv_larger, true AS ratio_matches")
def q_size_report(spark, d):
    """The events as CSV and as Parquet: which is larger, and the ratio."""
    csv, pq = scratch_path(spark, "size-csv"), I.write_parquet(se(spark, d), scratch_path(spark, "size-pq"))
    se(spark, d).write.option("header", True).csv(csv)
    r = I.size_report(spark, csv, pq)
    return r.select((F.col("csv_bytes") > F.col("parquet_bytes")).alias("csv_larger"),
                    (F.abs(F.col("ratio") - F.col("csv_bytes") / F.col("parquet_bytes")) < 1e-9).alias("ratio_matches"))


@register("stamp_events_facts", W + f"""SELECT count(*) AS n, count(*) AS ids, 'live' AS source, '{K.MODEL_VERSION}' AS model_version,
'{K.DEVICE_ID}' AS device_id, true AS now FROM se""")
def q_stamp_events_facts(spark, d):
    """What is the same in every run of the stamping: one new id per event, the
    provenance, and a time that is the query's."""
    x = X.stamp_events(se(spark, d), "live")
    recent = F.abs(F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.current_timestamp())) < 3600
    return x.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.max("source").alias("source"),
                 F.max("model_version").alias("model_version"), F.max("device_id").alias("device_id"), recent.alias("now"))


@register("summary_with_stream", W + """
SELECT count(*) AS total_events, count(*) AS streaming_events FROM se""")
def q_summary_with_stream(spark, d):
    """The summary with the live side's event table."""
    return R.summary_report(se(spark, d), stream_df=se(spark, d)).select("total_events", "streaming_events")


# ---- stored cubes ------------------------------------------------------------------
def stored(spark, d, name):
    out = scratch_path(spark, "stored-cubes")
    C.build_cubes(se(spark, d), out)
    return C.read_cube(spark, out, name)


@register("stored_cube_peak_hours", ORACLE["cube_peak_hours"])
def q_stored_cube_peak_hours(spark, d):
    return C.cube_peak_hours(stored(spark, d, "hour_risk_cube"))


@register("stored_cube_geo_hotspots", ORACLE["cube_geo_hotspots"])
def q_stored_cube_geo_hotspots(spark, d):
    return C.cube_geo_hotspots(stored(spark, d, "geographic_cube"))


@register("stored_cube_top_risk", ORACLE["cube_top_risk"])
def q_stored_cube_top_risk(spark, d):
    return C.cube_top_risk(stored(spark, d, "risk_score_cube"))


@register("stored_cube_explorer", ORACLE["cube_explorer"])
def q_stored_cube_explorer(spark, d):
    out = scratch_path(spark, "stored-cubes")
    paths = C.build_cubes(se(spark, d), out)
    return C.cube_explorer(spark, paths["hour_emotion_risk_cube"])


CUBES = ("hour_risk_cube", "emotion_risk_cube", "geographic_cube", "hour_emotion_risk_cube", "risk_score_cube")
for cube_name in CUBES:  # every cell of each stored cube
    register(f"stored_{cube_name}", ORACLE[cube_name])(lambda spark, d, name=cube_name: stored(spark, d, name))


# ---- validation report -------------------------------------------------------------
INV = f"inv AS (SELECT *, CAST(id AS BIGINT) AS n FROM iln WHERE NOT coalesce(inference_of_emotion IN ({VALID}), false))"


@register("validate_files_parts", WQ + f""", {INV},
top AS (SELECT inference_of_emotion AS name, count(*) AS c FROM inv GROUP BY 1 ORDER BY c DESC, name LIMIT 20),
smp AS (SELECT id, inference_of_emotion FROM inv ORDER BY n LIMIT 15)
SELECT 'column' AS part, name, '' AS value FROM (VALUES ('id'), ('time'), ('inference_of_emotion')) t(name)
UNION ALL SELECT 'top_label', name, CAST(c AS VARCHAR) FROM top
UNION ALL SELECT 'sample', id, inference_of_emotion FROM smp""")
def q_validate_files_parts(spark, d):
    """Columns, common invalid labels and first invalid rows of a validated file."""
    log = A.inference_log(spark, d).orderBy(F.col("id").cast("long"))
    runs, _ = Q.validate_all(spark, [_write_csv(log, scratch_path(spark, "log-parts"))])
    part = lambda name, items, key, value: F.transform(items, lambda x: F.struct(F.lit(name).alias("part"), key(x).alias("name"), value(x).alias("value")))
    rows = F.concat(
        part("column", F.col("columns"), lambda x: x, lambda x: F.lit("")),
        part("missing", F.col("missing_columns"), lambda x: x, lambda x: F.lit("")),
        part("extra", F.col("extra_columns"), lambda x: x, lambda x: F.lit("")),
        part("top_label", F.col("top_invalid_labels"), lambda x: x["label"], lambda x: x["count"].cast("string")),
        part("sample", F.col("sample_invalid_rows"), lambda x: x["id"], lambda x: x["inference_of_emotion"]))
    return runs.select(F.inline(rows))


# ---- drift report, flattened -------------------------------------------------------
@register("drift_report_facts", WD + f"""SELECT CAST((SELECT sum(count) FROM da) AS BIGINT) AS n_a, CAST((SELECT sum(count) FROM db) AS BIGINT) AS n_b,
(SELECT js_divergence FROM js) AS js, (SELECT round(sum(abs(p - q)), 12) FROM al) AS l1, (SELECT abs_drift FROM unk2) AS unknown,
CAST(coalesce((SELECT sum(count) FROM da WHERE label NOT IN ({VALID})), 0) AS BIGINT) AS other_a,
round((SELECT max(abs_drift) FROM dr), 12) AS largest""")
def q_drift_report_facts(spark, d):
    """The figures inside the one-row drift report."""
    from vigil.operators import drift as D

    a, b = sides(spark, d)
    r = D.drift_report(a, b, "inference_of_emotion", "emotion", names=NAMES)
    return r.select(F.col(f"sizes.{NAMES[0]}_n").alias("n_a"), F.col(f"sizes.{NAMES[1]}_n").alias("n_b"), F.col("metrics.js_divergence").alias("js"),
                    F.col("metrics.l1_distance").alias("l1"), F.col("unknown_share.abs_drift").alias("unknown"),
                    F.coalesce(F.col(f"{NAMES[0]}_label_counts")["(other)"], F.lit(0)).alias("other_a"),
                    F.round(F.array_max(F.map_values("per_label_abs_drift")), 12).alias("largest"))


# ---- chains ------------------------------------------------------------------------
@register("report_verdicts", with_(WS) + f""", w AS (SELECT *, CAST(date_trunc('hour', window_start) AS TIMESTAMP) AS report FROM ws),
v AS (SELECT clip_id, report, max(p_fear + p_angry) AS max_threat, max(p_fear + p_angry) > {K.THREAT_THRESHOLD}::DOUBLE AS danger FROM w GROUP BY 1, 2)
SELECT clip_id, count(*) AS reports, count_if(danger) AS danger_reports, bool_or(danger) AS alarm FROM v GROUP BY 1""")
def q_report_verdicts(spark, d):
    """Window scores -> a verdict per clip and report -> the clip's alarm."""
    scores = A.window_scores(spark, d).withColumn("report", F.date_trunc("hour", F.col("window_start")))
    return WN.clip_alarm(WN.threat_verdict(scores, key=["clip_id", "report"]))


MANIFEST = ORACLE["corpus_manifest_binary"]
TEST_ROWS = "CAST(floor(n * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT)"


@register("split_label_counts", f"""WITH m AS ({MANIFEST}), c AS (SELECT label, count(*) AS n FROM m GROUP BY label)
SELECT label, 'test' AS split, {TEST_ROWS} AS n FROM c UNION ALL SELECT label, 'train', n - {TEST_ROWS} FROM c""")
def q_split_label_counts(spark, d):
    """Labelled paths -> split: rows per label and side."""
    return _split(spark, d).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


def _split(spark, d):
    return M.stratified_split(M.corpus_manifest_binary(A.corpus_paths(spark, d), "/corpus"))


@register("training_chain", f"""WITH c AS (SELECT CAST(vec_id % 4 = 0 AS INTEGER) AS label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT 'train' AS split, label, 'orig' AS variant, n - {TEST_ROWS} AS n, true AS finite FROM c
UNION ALL SELECT 'train', label, 'noise', n - {TEST_ROWS}, true FROM c WHERE label = 1
UNION ALL SELECT 'test', label, 'orig', {TEST_ROWS}, true FROM c""")
def q_training_chain(spark, d):
    """Binary manifest -> split -> noisy copies of the minority on the training
    side only -> scaler fitted on the training rows -> scaled rows per side."""
    clips = A.signals(spark, d).withColumn("path", F.concat(F.lit("/corpus/clip_"), F.col("clip_id").cast("string")))
    labelled = clips.withColumn("label", (F.col("clip_id") % 4 == 0).cast("int"))
    split = M.stratified_split(labelled)
    train = M.augment_minority(split.where("split = 'train'"))
    both = train.unionByName(split.where("split = 'test'").withColumn("variant", F.lit("orig")))
    feature = both.withColumn("peak", F.array_max("samples"))
    scaled = M.scale(feature, M.fit_scaler(feature.where("split = 'train'"), ["peak"]), ["peak"])
    return scaled.groupBy("split", "label", "variant").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.abs("peak_scaled") < 1e6).alias("finite"))
