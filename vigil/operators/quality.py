"""Data validation of inference logs.

All data checks and diagnostics of one input come from a single
aggregation (one scan,
partial aggregation; the distinct-id count is Spark's two-phase distinct
aggregate), reshaped to one row per check with ``inline``. Schema checks
look at the schema only and touch no data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.scalars import canonical_label, parse_log_time_column

LABEL = "inference_of_emotion"


def normalize_log(df: DataFrame) -> DataFrame:
    """Header names stripped; labels canonical (null -> 'nan', trim, lower, synonyms)."""
    df = df.toDF(*[c.strip() for c in df.columns])
    if LABEL in df.columns:
        df = df.withColumn(LABEL, canonical_label(LABEL))
    return df


def _valid(c: Column) -> Column:
    return c.isin(*K.VALID_LABELS)


# U2 / V2 (schema only)
def column_diff(df: DataFrame, required: Sequence[str] = K.REQUIRED_LOG_COLUMNS) -> tuple[list[str], list[str]]:
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if c not in required]
    return missing, extra


def column_diff_facts(df: DataFrame, required: Sequence[str] = K.REQUIRED_LOG_COLUMNS) -> DataFrame:
    """(kind, column, rows, filled): missing and extra columns of a log, and
    how many of its rows have a value there (none where it is missing)."""
    missing, extra = column_diff(df, required)
    n = F.count(F.lit(1)).alias("rows")
    rows = [F.struct(F.lit("missing").alias("kind"), F.lit(c).alias("column"), n, F.lit(0).cast("long").alias("filled")) for c in missing]
    rows += [F.struct(F.lit("extra").alias("kind"), F.lit(c).alias("column"), n, F.count(F.col(f"`{c}`")).alias("filled")) for c in extra]
    none = "array<struct<kind: string, column: string, rows: bigint, filled: bigint>>"
    return df.agg((F.array(*rows) if rows else F.array().cast(none)).alias("_r")).select(F.inline("_r"))


def check_columns(df: DataFrame, required: Sequence[str] = K.REQUIRED_LOG_COLUMNS, exact: bool = True) -> bool:
    missing, extra = column_diff(df, required)
    return not missing and (not extra if exact else True)


# V1, V3-V5 as data checks
def _check_exprs(df: DataFrame, required: Sequence[str]) -> list[tuple[str, Column]]:
    checks = [("row_count_nonzero", F.count(F.lit(1)) >= F.lit(1))]
    for c in required:
        if c in df.columns:
            checks.append((f"not_null_{c}", F.count_if(F.col(c).isNull()) == F.lit(0)))
    if "id" in df.columns:
        checks.append(("id_unique", F.count("id") == F.count_distinct("id")))
    if LABEL in df.columns:
        checks.append(("labels_valid", F.count_if(~F.coalesce(_valid(F.col(LABEL)), F.lit(False))) == F.lit(0)))
    return checks


def check_nonempty(df: DataFrame) -> DataFrame:
    """V1: one row, ``ok`` when the table has at least one row."""
    return df.agg((F.count(F.lit(1)) >= F.lit(1)).alias("ok"))


def check_not_null(df: DataFrame, cols: Sequence[str] = K.REQUIRED_LOG_COLUMNS) -> DataFrame:
    """V3: one row per present column, ``ok`` when it has no null."""
    rows = [F.struct(F.lit(c).alias("column"), (F.count_if(F.col(c).isNull()) == F.lit(0)).alias("ok"))
            for c in cols if c in df.columns]
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def check_unique(df: DataFrame, col: str = "id") -> DataFrame:
    """V4: ``ok`` when the non-null values of ``col`` are distinct."""
    return df.agg((F.count(col) == F.count_distinct(col)).alias("ok"))


def check_labels(df: DataFrame) -> DataFrame:
    """V5: ``ok`` when every (normalised) label is in the valid set; false
    when the label column is absent."""
    if LABEL not in df.columns:
        return df.agg(F.lit(False).alias("ok"))
    return df.agg((F.count_if(~F.coalesce(_valid(F.col(LABEL)), F.lit(False))) == F.lit(0)).alias("ok"))


def _check_structs(df: DataFrame, allow_extra: bool, required: Sequence[str]) -> list[Column]:
    schema_ok = check_columns(df, required, exact=not allow_extra)
    checks = _check_exprs(df, required)
    if LABEL not in df.columns:
        checks.append(("labels_valid", F.lit(False)))
    rows = [F.struct(F.lit("schema_ok").alias("check"), F.lit(schema_ok).alias("ok"))]
    return rows + [F.struct(F.lit(name).alias("check"), expr.alias("ok")) for name, expr in checks]


def validation_checks(df: DataFrame, allow_extra: bool = False,
                      required: Sequence[str] = K.REQUIRED_LOG_COLUMNS) -> DataFrame:
    """(check, ok) rows for one normalised log: schema, non-empty, not-null,
    unique id, labels in the valid set (false when the label column is absent)."""
    return df.agg(F.array(*_check_structs(df, allow_extra, required)).alias("_c")).select(F.inline("_c"))


def validation_verdict(checks: DataFrame) -> DataFrame:
    """strict: every check passes; lenient: schema and labels only."""
    lenient_rows = F.col("check").isin("schema_ok", "labels_valid")
    return checks.agg(
        F.bool_and("ok").alias("strict_ok"),
        (F.coalesce(F.bool_and(F.when(lenient_rows, F.col("ok"))), F.lit(False))
         & (F.count_if(lenient_rows) == F.lit(2))).alias("lenient_ok"),
    )


# V7
def time_unparseable(c: str = "time") -> Column:
    return parse_log_time_column(c, "1970-01-01").isNull()


def _metric_structs(df: DataFrame, required: Sequence[str]) -> list[Column]:
    m: list[tuple[str, Column]] = [("row_count", F.count(F.lit(1)))]
    if LABEL in df.columns:
        m.append(("invalid_label_count", F.count_if(~F.coalesce(_valid(F.col(LABEL)), F.lit(False)))))
    if "time" in df.columns:
        m.append(("time_unparseable_count", F.count_if(time_unparseable("time"))))
    if "id" in df.columns:
        distinct = F.count_distinct("id") + F.coalesce(F.max(F.col("id").isNull().cast("long")), F.lit(0))
        m.append(("duplicate_id_count", F.count(F.lit(1)) - distinct))
    for c in required:
        if c in df.columns:
            m.append((f"null_{c}_count", F.count_if(F.col(c).isNull())))
    return [F.struct(F.lit(k).alias("metric"), v.cast("long").alias("value")) for k, v in m]


def diagnostics(df: DataFrame, required: Sequence[str] = K.REQUIRED_LOG_COLUMNS) -> DataFrame:
    """(metric, value) rows: rows, invalid labels, unparseable times,
    duplicate ids (a null id is a value), nulls per required column."""
    return df.agg(F.array(*_metric_structs(df, required)).alias("_m")).select(F.inline("_m"))


# J4 / W4 / L3 / L4
def invalid_labels(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(_valid(F.col(LABEL)), F.lit(False)))


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Ids that occur more than once and how many extra rows they have
    (a grouped count: partial aggregation keeps hot ids cheap)."""
    return (df.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
              .select("id", (F.col("_n") - 1).alias("extra_rows")))


def top_invalid_labels(df: DataFrame, n: int = 20) -> DataFrame:
    """The n most common invalid labels (a top-k report)."""
    return (invalid_labels(df).groupBy(LABEL).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(LABEL)).limit(n))


def sample_invalid_rows(df: DataFrame, n: int = 15, order: Sequence[Column] | None = None) -> DataFrame:
    """First n invalid rows in ``order`` (a sample report)."""
    order = list(order) if order else [F.col(c) for c in df.columns]
    return invalid_labels(df).orderBy(*order).limit(n)


# V8
TECHNICAL = ["__log", "__file", "__block", "__at"]


def _report_parts(df: DataFrame, columns: Sequence[str], top: int, sample: int) -> DataFrame:
    """Per log: its most common invalid labels and its first invalid rows."""
    if LABEL not in columns:
        return df.select("__log").distinct().select("__log", F.array().cast("array<struct<label:string,count:bigint>>").alias("top_invalid_labels"),
                                                    F.array().cast("array<map<string,string>>").alias("sample_invalid_rows"))
    bad = invalid_labels(df)
    counts = bad.groupBy("__log", F.col(LABEL).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    common = Window.partitionBy("__log").orderBy(F.desc("count"), "label")
    tops = counts.withColumn("_r", F.row_number().over(common)).where(F.col("_r") <= top).groupBy("__log").agg(
        F.sort_array(F.collect_list(F.struct("_r", "label", "count"))).alias("_t"))
    tops = tops.select("__log", F.transform("_t", lambda t: F.struct(t["label"].alias("label"), t["count"].alias("count"))).alias("top_invalid_labels"))
    early = Window.partitionBy("__log").orderBy("__file", "__block", "__at")
    row = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("string") for c in columns]))
    rows = (bad.withColumn("_r", F.row_number().over(early)).where(F.col("_r") <= sample)
            .select("__log", "_r", row.alias("row")).groupBy("__log").agg(F.collect_list(F.struct("_r", "row")).alias("_s")))
    rows = rows.select("__log", F.transform(F.array_sort("_s", lambda x, y: x["_r"] - y["_r"]), lambda x: x["row"]).alias("sample_invalid_rows"))
    return tops.join(rows, "__log", "full")


def validate_scan(df: DataFrame, logs: Sequence[int], strict: bool = True, allow_extra: bool = False,
                  required: Sequence[str] = K.REQUIRED_LOG_COLUMNS, top: int = 20, sample: int = 15) -> DataFrame:
    """One row per log of a scan (numbers ``logs``) with verdict, checks,
    diagnostics, column lists, common invalid labels and first invalid rows.

    Checks and diagnostics come from one aggregation per log; a log without
    rows gets those of an empty table."""
    df = normalize_log(df)
    columns = [c for c in df.columns if c not in TECHNICAL]
    plain = df.select(*columns)  # the schema that the checks look at
    facts = [F.array(*_check_structs(plain, allow_extra, required)).alias("checks"), F.array(*_metric_structs(plain, required)).alias("diagnostics")]
    found = df.groupBy("__log").agg(*facts)
    listed = df.sparkSession.createDataFrame([(i,) for i in logs], "__log int")
    nothing = plain.limit(0).agg(*facts)  # one row
    per = found.unionByName(listed.join(found.select("__log"), "__log", "left_anti").crossJoin(nothing))
    oks = F.transform("checks", lambda c: c["ok"])
    lenient = F.filter("checks", lambda c: c["check"].isin("schema_ok", "labels_valid"))
    every = lambda a: F.forall(a, lambda ok: ok)
    verdict = every(oks) if strict else (F.size(lenient) == 2) & every(F.transform(lenient, lambda c: c["ok"]))
    missing, extra = column_diff(plain, required)
    names = lambda cs: F.array(*[F.lit(c) for c in cs]).cast("array<string>")
    return per.join(_report_parts(df, columns, top, sample), "__log", "left").select(
        "__log", verdict.alias("success"), F.lit(None).cast("string").alias("error"), "checks", "diagnostics",
        names(columns).alias("columns"), names(missing).alias("missing_columns"), names(extra).alias("extra_columns"),
        F.coalesce("top_invalid_labels", F.array()).alias("top_invalid_labels"), F.coalesce("sample_invalid_rows", F.array()).alias("sample_invalid_rows"))


RUN_SCHEMA = ("__log int, success boolean, error string, checks array<struct<check:string,ok:boolean>>, "
              "diagnostics array<struct<metric:string,value:bigint>>, columns array<string>, missing_columns array<string>, "
              "extra_columns array<string>, top_invalid_labels array<struct<label:string,count:bigint>>, sample_invalid_rows array<map<string,string>>")


def validate_all(spark: SparkSession, paths: Sequence[str], strict: bool = True,
                 allow_extra: bool = False) -> tuple[DataFrame, DataFrame]:
    """One row per input path and the overall verdict; a missing or empty file
    is a failed row. Files of one header shape are validated by one plan,
    grouped by log."""
    from vigil.sources.files import log_scans

    runs, seen = None, set()
    for scan, logs in log_scans(spark, paths):
        rows = validate_scan(scan, logs, strict, allow_extra)
        runs = rows if runs is None else runs.unionByName(rows)
        seen |= set(logs)
    lost = [(i, False, K.FILE_MISSING.format(path=p), *[None] * 7) for i, p in enumerate(paths) if i not in seen]
    absent = spark.createDataFrame(lost, RUN_SCHEMA)
    runs = absent if runs is None else runs.unionByName(absent)
    named = spark.createDataFrame(list(enumerate(paths)), "__log int, file string")
    runs = named.join(runs, "__log").orderBy("__log").drop("__log")
    return runs, runs.agg(F.bool_and("success").alias("overall_success"))
