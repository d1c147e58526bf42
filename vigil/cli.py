"""Command-line jobs: ``python -m vigil.cli <job> ...`` (or spark-submit).

validate  validation gate over log files: JSON report, exit code 0 / 1
drift     label drift between two logs: JSON report
cubes     the five OLAP cubes from an event table (CSV or Parquet)
convert   every CSV of a folder to Parquet
summary   one-row summary report as CSV (streaming total read if present)
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vigil import constants as K


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("vigil").getOrCreate()
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true",
                 "spark.sql.adaptive.skewJoin.enabled": "true"}.items():
        spark.conf.set(k, v)  # cleaning of checkpoint files is the cluster's own setting
    from vigil.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return spark


def _events(spark: SparkSession, path: str):
    from vigil.sources import files as I

    return I.read_events_csv(spark, path) if path.endswith(".csv") else I.read_events(spark, path)


def cmd_validate(a) -> int:
    from vigil.operators import quality as Q
    from vigil.sources.files import write_report_json

    spark = _session()
    runs, overall = Q.validate_all(spark, a.paths, strict=not a.non_strict, allow_extra=a.allow_extra_columns)
    as_objects = runs.select(  # checks and diagnostics as name -> value objects in the JSON
        "file", "success", "error", F.map_from_entries("checks").alias("checks"),
        F.map_from_entries("diagnostics").alias("diagnostics"), "columns", "missing_columns", "extra_columns",
        "top_invalid_labels", "sample_invalid_rows")
    report = as_objects.agg(F.collect_list(F.struct(*as_objects.columns)).alias("runs")).crossJoin(overall).select(
        F.lit(a.suite).alias("suite"), F.lit(not a.non_strict).alias("strict"),
        F.lit(bool(a.allow_extra_columns)).alias("allow_extra_columns"), "runs", "overall_success")
    report = report.persist()
    if a.out:
        write_report_json(report, a.out)
    for r in runs.select("file", "success", "error").collect():  # one row per input file
        print(f"{'PASSED' if r.success else 'FAILED'}: {r.file}" + (f" ({r.error})" if r.error else ""))
    return 0 if report.first()["overall_success"] else 1


def cmd_drift(a) -> int:
    from vigil.operators import drift as D
    from vigil.sources.files import read_log_csv, write_report_json

    spark = _session()
    x, y = read_log_csv(spark, a.first), read_log_csv(spark, a.second)
    rep = D.drift_report(x, y, per_label=a.per_label, js_threshold=a.js, min_rows=a.min_rows, names=tuple(a.names))
    paths = F.struct(*[F.lit(p).alias(f"{name}_path") for p, name in zip((a.first, a.second), a.names)])
    rep = rep.select(paths.alias("inputs"), "*").persist()
    if a.out:
        write_report_json(rep, a.out)
    row = rep.first()
    print(row.asDict(recursive=True)["alerts"])
    return 0


def cmd_cubes(a) -> int:
    from vigil.operators.cubes import build_cubes

    spark = _session()
    for name, path in build_cubes(_events(spark, a.events), a.out, files=a.files).items():
        print(f"{name}: {path}")
    return 0


def cmd_convert(a) -> int:
    from vigil.sources.files import convert_folder

    spark = _session()
    for p in convert_folder(spark, a.folder, out=a.out, infer=not a.no_infer, files=a.files):
        print(p)
    return 0


def cmd_summary(a) -> int:
    from vigil.operators.risk import summary_report
    from vigil.sources.files import _exists, write_summary_csv

    spark = _session()
    stream = None
    if a.stream_total and _exists(spark, a.stream_total):
        from vigil.streaming.jobs import read_recent

        stream = read_recent(spark, a.stream_total)
    rep = summary_report(_events(spark, a.events))
    if stream is not None:  # the streaming job keeps a one-row running total
        rep = rep.drop("streaming_events").crossJoin(stream.select(F.col("streaming_events").cast("long")))
    write_summary_csv(rep, a.out)
    print(a.out)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="vigil")
    sub = p.add_subparsers(dest="job", required=True)
    v = sub.add_parser("validate")
    v.add_argument("paths", nargs="+")
    v.add_argument("--out", default="validation_report")
    v.add_argument("--allow-extra-columns", action="store_true")
    v.add_argument("--non-strict", action="store_true")
    v.add_argument("--suite", default="integrity_suite")
    v.set_defaults(fn=cmd_validate)
    d = sub.add_parser("drift")
    d.add_argument("first")
    d.add_argument("second")
    d.add_argument("--names", nargs=2, default=["first", "second"])
    d.add_argument("--per-label", type=float, default=K.DRIFT_PER_LABEL)
    d.add_argument("--js", type=float, default=K.DRIFT_JS)
    d.add_argument("--min-rows", type=int, default=K.DRIFT_MIN_ROWS)
    d.add_argument("--out", default="drift_report")
    d.set_defaults(fn=cmd_drift)
    c = sub.add_parser("cubes")
    c.add_argument("events")
    c.add_argument("--out", default="olap_cubes")
    c.add_argument("--files", type=int, default=None)
    c.set_defaults(fn=cmd_cubes)
    k = sub.add_parser("convert")
    k.add_argument("folder")
    k.add_argument("--out", default=None)
    k.add_argument("--no-infer", action="store_true")
    k.add_argument("--files", type=int, default=None)
    k.set_defaults(fn=cmd_convert)
    s = sub.add_parser("summary")
    s.add_argument("events")
    s.add_argument("--stream-total", default=None)
    s.add_argument("--out", default="summary_report")
    s.set_defaults(fn=cmd_summary)
    a = p.parse_args(argv)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
