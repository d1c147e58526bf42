"""Scans and sinks.

Readers use fixed schemas (no inference pass over the data) unless the
caller asks for inference. Listings use the ``binaryFile`` source with the
``content`` column pruned, so files are listed, never read, on the cluster.
Sinks write with Spark's own committers; a single output file is opt-in
(``files=1``) because it funnels the whole write into one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import scalars as X
from vigil.schema import INFERENCE_LOG, SAFETY_EVENT, SAFETY_EVENT_CSV, SAFETY_EVENT_COLUMNS
from vigil.sources import keyed

DELIMITERS = [",", ";", "\t", "|"]


# I1
def read_events_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Safety events from CSV with a header; timestamps parsed leniently."""
    reader = spark.read.option("header", True)
    if infer:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.schema(SAFETY_EVENT_CSV).option("mode", "PERMISSIVE").csv(path)
    if "timestamp" in df.columns:
        df = df.withColumn("timestamp", X.parse_timestamp("timestamp", df.schema["timestamp"].dataType))
    return df


# I4
def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# I2
def sniff_delimiter(header: str) -> str:
    counts = [(header.count(d), -i, d) for i, d in enumerate(DELIMITERS)]
    best = max(counts)
    return best[2] if best[0] > 0 else ","


def encoded(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Paths by their form in ``_metadata.file_path`` (a blank is %20 there)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return {hadoop(f).toUri().toString(): f for f in files}


def sniff_files(spark: SparkSession, files: Sequence[str]) -> dict[str, tuple[str, str, str]]:
    """(separator, encoding, header line) of delimited text files, by path, from
    one scan of all of them; a file without any line is left out."""
    text = spark.read.text(list(files)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                               F.monotonically_increasing_id().alias("at"))
    place, plain = F.struct("block", "at"), encoded(spark, files)
    found = text.groupBy("file").agg(F.min_by("value", place).alias("header"), F.bool_or(~F.is_valid_utf8("value")).alias("bad"))
    return {plain[r["file"]]: (sniff_delimiter(r["header"]), "ISO-8859-1" if r["bad"] else "UTF-8", r["header"])
            for r in found.collect()}  # one row per listed file


def files_of(spark: SparkSession, path: str) -> list[str]:
    """Files that a path names: itself, what its pattern matches, or the files
    right below a folder (names that start with ``_`` or ``.`` left out)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.globStatus(p) or []:
        for f in fs.listStatus(st.getPath()) if st.isDirectory() else [st]:
            if not f.isDirectory() and f.getPath().getName()[0] not in "_.":
                out.append(f.getPath().toString())
    return sorted(out)


def _read_csv(spark: SparkSession, paths, sep: str, enc: str) -> DataFrame:
    df = (spark.read.option("header", True).option("sep", sep).option("encoding", enc)
          .option("inferSchema", False).csv(paths))
    return df.toDF(*[c.strip() for c in df.columns])


def by_shape(sniffed: dict[str, tuple[str, str, str]]) -> dict[tuple[str, str, str], list[str]]:
    """Files of each shape: separator, encoding and header line."""
    shapes: dict[tuple[str, str, str], list[str]] = {}
    for f in sorted(sniffed):
        shapes.setdefault(sniffed[f], []).append(f)
    return shapes


def read_log_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tolerant CSV: a file or a folder of files, each with its own separator
    (from its header line), encoding (UTF-8, else Latin-1) and columns (names
    stripped). Every shape is one scan by Spark's CSV source; the scans are put
    together by column name, and a file without a column has nulls there."""
    shapes = by_shape(sniff_files(spark, files_of(spark, path) or [path]))
    if not shapes:
        return _read_csv(spark, path, ",", "UTF-8")
    frames = [_read_csv(spark, files, sep, enc) for (sep, enc, _), files in shapes.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# I3
def harmonise_log(df: DataFrame, ref_date: str | None = None, now: str | None = None, by: str | None = None,
                  order: Sequence[str] | None = None) -> DataFrame:
    """One log of any header shape -> (id, timestamp, inference).

    ``by`` names a column that tells several logs apart: rules that hold per log
    (counter ids, day/month order, generated times) are taken per value of it.
    ``order`` names the columns that give the input order of the rows."""
    df = X.rename_synonyms(X.normalize_columns(df, lower=True, strip=False))
    if "inference" in df.columns:
        df = df.withColumn("inference", X.title_label("inference"))
    df = X.parse_log_time(df, ref_date=ref_date, now=now, order=order, by=by)
    if "id" in df.columns:
        df = X.collapse_counter_ids(df, by=by)
    df = X.fill_log_defaults(df)
    return df.select(F.col("id").cast("string").alias("id"), F.col("timestamp").cast("timestamp").alias("timestamp"),
                     F.col("inference").cast("string").alias("inference"))


def log_scans(spark: SparkSession, paths: Sequence[str], skipped: list | None = None) -> list[tuple[DataFrame, list[int]]]:
    """One scan per header shape over the files of many logs, with the numbers
    of its logs. Each row has its
    log's place in ``paths`` (``__log``), its file, the place of its split in the
    file and its own in the split (``__file``, ``__block``, ``__at``); a log listed twice comes twice.
    Paths that name no file or only empty files go to ``skipped``; any other
    failure is raised."""
    units = [(i, f) for i, p in enumerate(paths) for f in files_of(spark, p)]
    sniffed = sniff_files(spark, sorted({f for _, f in units})) if units else {}
    if skipped is not None:
        there = {i for i, f in units if f in sniffed}
        skipped += [p for i, p in enumerate(paths) if i not in there]
    out = []
    for (sep, enc, _), files in by_shape(sniffed).items():
        there = {f: e for e, f in encoded(spark, files).items()}
        own = [(i, there[f]) for i, f in units if f in there]
        logs = spark.createDataFrame(own, "__log int, __file string")
        raw = _read_csv(spark, files, sep, enc)
        raw = raw.withColumn("__file", F.col("_metadata.file_path")).withColumn("__block", F.col("_metadata.file_block_start"))
        raw = raw.withColumn("__at", F.monotonically_increasing_id())  # within one split
        out.append((raw.join(F.broadcast(logs), on="__file"), sorted({i for i, _ in own})))  # one row per listed file
    return out


def ingest_logs(spark: SparkSession, paths: Sequence[str], ref_date: str | None = None, now: str | None = None,
                skipped: list | None = None) -> DataFrame | None:
    """Harmonise many logs and bind their rows (None if no path can be read).

    Files are grouped by their shape (separator, encoding, header); each shape
    is one scan, so the number of jobs does not grow with the files. Missing
    paths and empty files are skipped and, if given, listed in ``skipped``."""
    from vigil.operators.logs import union_logs

    frames = [harmonise_log(raw, ref_date=ref_date, now=now, by="__log", order=["__log", "__file", "__block", "__at"])
              for raw, _ in log_scans(spark, paths, skipped)]
    return union_logs(frames) if frames else None


# I5
def write_parquet(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> str:
    w = df.coalesce(files) if files else df
    w.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


# I6
def list_files(spark: SparkSession, root: str, glob: str, recursive: bool = True) -> DataFrame:
    """Paths and sizes below ``root`` (file content is not read)."""
    r = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
         .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return r.select("path", "length")


def convert_folder(spark: SparkSession, folder: str, out: str | None = None, infer: bool = True,
                   files: int | None = None) -> list[str]:
    """Every ``*.csv`` in ``folder`` -> ``<name>.parquet`` (snappy), the paths
    in order. Files with the same header line are one scan, one inference (so
    one schema) and one write that is partitioned by source file, so the number
    of jobs does not grow with the files. Files without any line are left out."""
    out = (out or folder).rstrip("/")
    found = [f for f in files_of(spark, folder) if f.endswith(".csv")]
    headers = spark.read.text(found).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
                                            F.col("_metadata.file_block_start").alias("block")) if found else None
    plain = encoded(spark, found)
    first = {} if headers is None else {plain[r["file"]]: r["header"] for r in headers.where("block = 0").groupBy("file").agg(
        F.min_by("value", "at").alias("header")).collect()}  # one row per listed file
    shapes: dict[str, list[str]] = {}
    for f in sorted(first):
        shapes.setdefault(first[f], []).append(f)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = []
    for members in shapes.values():
        names = spark.createDataFrame(list(enumerate(encoded(spark, members))), "__n int, __file string")
        df = spark.read.option("header", True).option("inferSchema", infer).csv(members)
        numbered = df.withColumn("__file", F.col("_metadata.file_path")).join(F.broadcast(names), "__file").drop("__file")  # one row per file
        if files:
            numbered = numbered.repartition("__n", F.pmod(F.monotonically_increasing_id(), F.lit(files)))
        part = f"{out}/_converting-{uuid.uuid4().hex[:12]}"
        numbered.write.partitionBy("__n").option("compression", "snappy").parquet(part)
        for n, f in enumerate(members):
            target = f"{out}/{f.rsplit('/', 1)[1][:-len('.csv')]}.parquet"
            fs.delete(hadoop(target), True)
            rows = hadoop(f"{part}/__n={n}")
            if fs.exists(rows):
                fs.rename(rows, hadoop(target))
            else:  # a header alone
                write_parquet(spark.createDataFrame([], df.schema), target)
            done.append(target)
        fs.delete(hadoop(part), True)
    return sorted(done)


# I7
def size_report(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """Bytes of each format and the CSV/Parquet ratio, from file listings only."""
    c = list_files(spark, csv_path, "*.csv").agg(F.sum("length").alias("csv_bytes"))
    p = list_files(spark, parquet_path, "*.parquet").agg(F.sum("length").alias("parquet_bytes"))
    return c.crossJoin(p).withColumn("ratio", F.try_divide(F.col("csv_bytes").cast("double"), F.col("parquet_bytes")))


# I8 / J5 (the log itself: sources/keyed.py)
def first_per_id(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per id, the first by ``order_col`` (default: input order: by
    file and place in it where the rows come straight from files).

    A grouped ``min_by`` aggregates partially before the shuffle, so an id
    repeated in a third of the rows still ships one row per task.
    """
    cols = [c for c in df.columns if c != "id"]
    tagged = df.withColumn("_ord", F.col(order_col) if order_col else keyed.place_in_input(df))
    first = tagged.groupBy("id").agg(F.min_by(F.struct(*cols), F.col("_ord")).alias("_r"))
    return first.select("id", *[F.col(f"_r.{c}").alias(c) for c in cols]).select(*df.columns)


def _decided(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    return keyed.decide(keyed.candidates(batch), None if existing is None else existing.select("id"))


def new_events(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` that may be appended: first row per id, ids among the
    existing ones refused. Rows without id are refused too, as a key column
    would; ``refused_events`` lists what is left out.

    Existing ids are reduced to the batch's first, so a small batch (by
    Spark's own size limit) never shuffles them."""
    return keyed.accepted(_decided(batch, existing))


def refused_events(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """What ``new_events`` leaves out: (reason, id, rows, event)."""
    return keyed.refusals(_decided(batch, existing))


def append_events(batch: DataFrame, path: str, writer: str | None = None, epoch: int | None = None) -> DataFrame:
    """Append to the keyed event log; the rows that were written (readable
    until its next append). It reads the ids in the buckets that the batch
    touches, not the log. Refused rows go to the log's reject table."""
    return keyed.append_batch(batch.select(*SAFETY_EVENT_COLUMNS), path, writer, epoch)


def read_refused(spark: SparkSession, path: str) -> DataFrame:
    """The reject table of a keyed event log."""
    return keyed.read_refused(spark, path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


# I9 / I10
def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SAFETY_EVENT).parquet(path)


def sql_row_count(spark: SparkSession, df: DataFrame, view: str = "safety_events") -> DataFrame:
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT COUNT(*) AS total_rows FROM {view}")


# I11 / I12
def write_summary_csv(df: DataFrame, path: str) -> str:
    """A one-row report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report_json(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


# I13
def list_corpus(spark: SparkSession, root: str) -> DataFrame:
    """All ``*.wav`` below ``root``, recursively (paths only)."""
    return list_files(spark, root, "*.wav").select("path")


def read_inference_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(INFERENCE_LOG).csv(path)
