"""Round trips through the readers and writers, and the keyed event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import adapters as A
from vigil.operators import quality as Q
from vigil.plans.catalog import register
from vigil.plans.q_logs import ILH_SQL, REF_DATE
from vigil.plans.q_quality import CHECKS_CTE, WQ
from vigil.plans.sql_inputs import HL, IL, SE, with_
from vigil.schema import SAFETY_EVENT_COLUMNS
from vigil.session import scratch_path
from vigil.sources import files as I

W = with_(SE)
ALL = ", ".join(f'"{c}"' for c in SAFETY_EVENT_COLUMNS)
CUTOFF = "2024-01-10 00:00:00"


def se(spark, d):
    return A.safety_events(spark, d)


@register("read_events_csv", W + f"SELECT {ALL} FROM se")
def q_read_events_csv(spark, d):
    """Events written as CSV with a header, read back with the fixed schema."""
    path = scratch_path(spark, "events-csv")
    (se(spark, d).write.mode("overwrite").option("header", True)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))
    return I.read_events_csv(spark, path).select(*SAFETY_EVENT_COLUMNS)


@register("read_events", W + f"SELECT {ALL} FROM se")
def q_read_events(spark, d):
    """Events written as snappy Parquet, read back."""
    path = I.write_parquet(se(spark, d), scratch_path(spark, "events-parquet"))
    return I.read_events(spark, path).select(*SAFETY_EVENT_COLUMNS)


@register("sql_row_count", W + "SELECT count(*) AS total_rows FROM se")
def q_sql_row_count(spark, d):
    return I.sql_row_count(spark, se(spark, d))


@register("new_events", W + f"""SELECT {ALL} FROM se WHERE "timestamp" >= TIMESTAMP '{CUTOFF}'""")
def q_new_events(spark, d):
    """A batch holding every event twice against a log that already holds the
    events before the cut-off: first row per id, ids on disk refused."""
    events = se(spark, d)
    log = I.write_parquet(events.filter(F.col("timestamp") < F.lit(CUTOFF).cast("timestamp")),
                          scratch_path(spark, "log"))
    batch = events.unionByName(events)
    return I.new_events(batch, spark.read.parquet(log)).select(*SAFETY_EVENT_COLUMNS)


@register("append_events", W + f"SELECT {ALL} FROM se")
def q_append_events(spark, d):
    """Two appends (early events, then all events twice) to a keyed log; the
    log read back holds every id once."""
    events = se(spark, d)
    path = scratch_path(spark, "event-log")
    I.append_events(events.filter(F.col("timestamp") < F.lit(CUTOFF).cast("timestamp")), path)
    I.append_events(events.unionByName(events), path)
    return I.read_log(spark, path).select(*SAFETY_EVENT_COLUMNS)


REFUSED_SQL = W + """
SELECT 'no id' AS reason, CAST(NULL AS VARCHAR) AS id, CAST(1 AS BIGINT) AS "rows", device_id FROM se WHERE CAST(id AS BIGINT) % 97 = 0
UNION ALL SELECT 'no id', NULL, CAST(1 AS BIGINT), device_id FROM se WHERE CAST(id AS BIGINT) % 97 = 0
UNION ALL SELECT 'repeated id', id, CAST(1 AS BIGINT), NULL FROM se WHERE CAST(id AS BIGINT) % 97 <> 0"""


def nameless(events):
    """Some events without id."""
    return events.withColumn("id", F.when(F.col("id").cast("long") % 97 != 0, F.col("id")))


@register("refused_events", REFUSED_SQL)
def q_refused_events(spark, d):
    """Every event twice, some without id: what a keyed log refuses of them."""
    events = nameless(se(spark, d))
    return I.refused_events(events.unionByName(events), None).select("reason", "id", "rows", F.col("event.device_id").alias("device_id"))


@register("append_refused", REFUSED_SQL)
def q_append_refused(spark, d):
    """The reject table of a keyed log after two appends of the same events,
    some of them without id."""
    events = nameless(se(spark, d))
    path = scratch_path(spark, "event-log-refused")
    for _ in range(2):
        I.append_events(events, path)
    return I.read_refused(spark, path).select("reason", "id", "rows", F.col("event.device_id").alias("device_id"))


# ---- file-based log readers: files written from the test tables, read back by the library ----------


def _write_csv(df, path, sep=",", encoding="UTF-8", mode="overwrite"):
    (df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))
    return path


@register("read_log_csv", with_(IL) + 'SELECT id, "time", inference_of_emotion FROM il')
def q_read_log_csv(spark, d):
    """The inference log written as ';'-separated Latin-1 CSV with blanks
    around the header names, read back with delimiter and encoding sniffing."""
    il = A.inference_log(spark, d)
    raw = il.toDF(" id ", "time ", " inference_of_emotion")
    path = _write_csv(raw, scratch_path(spark, "log-latin1"), sep=";", encoding="ISO-8859-1")
    return I.read_log_csv(spark, path)


@register("read_log_csv_mixed", with_(IL) + """SELECT CASE WHEN CAST(id AS BIGINT) % 3 = 2 THEN NULL ELSE id END AS id, "time",
  CASE WHEN CAST(id AS BIGINT) % 3 = 1 THEN inference_of_emotion || 'é' ELSE inference_of_emotion END AS inference_of_emotion,
  CASE WHEN CAST(id AS BIGINT) % 3 = 1 THEN 'n' END AS note FROM il""")
def q_read_log_csv_mixed(spark, d):
    """One folder with files of three shapes: commas and UTF-8; semicolons,
    Latin-1, another column order and one column more; tabs, blanks around the
    names and no id."""
    il, n = A.inference_log(spark, d), F.pmod(F.col("id").cast("long"), F.lit(3))
    path = scratch_path(spark, "log-mixed")
    _write_csv(il.where(n == 0), path)
    other = il.withColumn("inference_of_emotion", F.concat("inference_of_emotion", F.lit("é"))).withColumn("note", F.lit("n"))
    _write_csv(other.where(n == 1).select("inference_of_emotion", "note", "time", "id"), path, sep=";", encoding="ISO-8859-1", mode="append")
    _write_csv(il.where(n == 2).select(F.col("time").alias(" time"), F.col("inference_of_emotion").alias("inference_of_emotion ")), path, sep="\t", mode="append")
    return I.read_log_csv(spark, path).select("id", "time", "inference_of_emotion", "note")


@register("ingest_logs", with_(SE, HL, IL) + f""", ilh AS ({ILH_SQL})
SELECT id, "timestamp", inference FROM ilh
UNION ALL SELECT id, "timestamp", upper(substr(lower(inference), 1, 1)) || substr(lower(inference), 2) FROM hl""")
def q_ingest_logs(spark, d):
    """Two log files with different headers (bare times and counter ids;
    device ids with full timestamps and upper-case labels) plus one
    unreadable path, harmonised into one (id, timestamp, inference) table."""
    il = A.inference_log(spark, d)
    hl = A.harmonised_log(spark, d).select(F.col("id").alias("ID"), F.col("timestamp").alias("Timestamp"),
                                           F.upper("inference").alias("Inference_Of_Emotion"))
    p1 = _write_csv(il, scratch_path(spark, "log-a"))
    p2 = _write_csv(hl, scratch_path(spark, "log-b"), sep="\t")
    return I.ingest_logs(spark, [p1, p2, scratch_path(spark, "missing")], ref_date=REF_DATE)


@register("convert_folder", W + f"SELECT {ALL} FROM se")
def q_convert_folder(spark, d):
    """CSV files in a folder converted one by one to Parquet, read back."""
    folder = scratch_path(spark, "csv-folder")
    se(spark, d).write.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(folder)
    outs = I.convert_folder(spark, folder, out=scratch_path(spark, "converted"), infer=False)
    back = spark.read.parquet(*outs)  # text columns, as converted without inference
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in se(spark, d).schema.fields])


@register("convert_folder_shapes", W + """SELECT id, emotion, confidence, CAST(NULL AS VARCHAR) AS device_id FROM se WHERE CAST(id AS BIGINT) % 2 = 0
UNION ALL SELECT id, emotion, NULL, device_id FROM se WHERE CAST(id AS BIGINT) % 2 = 1""")
def q_convert_folder_shapes(spark, d):
    """A folder with CSV files of two header shapes, converted file by file."""
    folder, events = scratch_path(spark, "csv-shapes"), se(spark, d)
    even = F.col("id").cast("long") % 2 == 0
    for part, columns in ((even, ("id", "emotion", "confidence")), (~even, ("device_id", "id", "emotion"))):
        events.where(part).select(*columns).repartition(3).write.mode("append").option("header", True).csv(folder)
    outs = I.convert_folder(spark, folder, out=scratch_path(spark, "converted-shapes"))
    frames = [spark.read.parquet(p) for p in outs]
    shapes = [[p for p, f in zip(outs, frames) if c in f.columns] for c in ("confidence", "device_id")]
    a, b = (spark.read.parquet(*paths) for paths in shapes)
    both = a.unionByName(b, allowMissingColumns=True)
    return both.select(F.col("id").cast("string").alias("id"), "emotion", F.col("confidence").cast("double").alias("confidence"), "device_id")


@register("list_corpus", W + """SELECT row_number() OVER (ORDER BY emotion) AS id, 'emotion=' || emotion AS folder FROM (SELECT DISTINCT emotion FROM se WHERE emotion IS NOT NULL)""")
def q_list_corpus(spark, d):
    """A corpus folder with one recording per emotion, listed and turned into
    its inference log (M9)."""
    from vigil.operators.corpus import corpus_log

    root, events = scratch_path(spark, "corpus"), se(spark, d)
    events.where("emotion IS NOT NULL").select("id", "emotion").repartition(1, "emotion").write.partitionBy("emotion").text(root)
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = paths(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.globStatus(paths(root + "/emotion=*/part-*")):
        fs.rename(st.getPath(), paths(st.getPath().getParent(), "clip.wav"))
    listed = I.list_corpus(spark, root)
    return corpus_log(listed).select("id", F.col("inference_of_emotion").alias("folder"))


@register("validate_files", WQ + CHECKS_CTE + 'SELECT "check", ok FROM checks')
def q_validate_files(spark, d):
    """The inference log written as a CSV file and validated from the file
    (strict mode); one row per check of the run."""
    path = _write_csv(A.inference_log(spark, d), scratch_path(spark, "log-validate"))
    runs, _ = Q.validate_all(spark, [path], strict=True)
    return runs.select(F.inline("checks"))


SUMMARY_SCHEMA = ("total_events long, danger_events long, danger_rate double, top_emotion string, "
                  "peak_danger_hour int, streaming_events long")


def _summary_sql():
    from vigil.plans.catalog import ORACLE
    from vigil.plans import q_events  # noqa: F401 - registers summary_report

    return ORACLE["summary_report"]


@register("summary_csv", _summary_sql())
def q_summary_csv(spark, d):
    """The one-row summary report written as a CSV file and read back."""
    from vigil.operators.risk import summary_report

    path = I.write_summary_csv(summary_report(se(spark, d)), scratch_path(spark, "summary-csv"))
    return spark.read.option("header", True).schema(SUMMARY_SCHEMA).csv(path)


NOW = "2026-03-01 12:00:00"


@register("ingest_logs_defaults", with_(SE) + f"""
SELECT 'Device_1' AS id, strptime('{REF_DATE} ' || strftime("timestamp", '%H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS "timestamp",
       'Unknown' AS inference FROM se
UNION ALL
SELECT 'Device_1', TIMESTAMP '{NOW}' - to_minutes(CAST(row_number() OVER (ORDER BY CAST(id AS BIGINT)) - 1 AS BIGINT)),
       upper(substr(emotion, 1, 1)) || lower(substr(emotion, 2)) FROM se""")
def q_ingest_logs_defaults(spark, d):
    """Logs missing columns: one with only a ``time_log`` column (synonym;
    default id and inference), one with only labels (no id, no time: rows are
    stamped ``now`` minus i minutes in file order)."""
    ev = se(spark, d).orderBy(F.col("id").cast("long"))
    tl = ev.select(F.date_format("timestamp", "HH:mm:ss").alias("Time_Log"))
    nt = ev.select(F.col("emotion").alias("inference"))
    p1 = _write_csv(tl, scratch_path(spark, "log-timeonly"))
    p2 = _write_csv(nt, scratch_path(spark, "log-labels-only"))  # part files in order: file order is row order
    return I.ingest_logs(spark, [p1, p2], ref_date=REF_DATE, now=NOW)
