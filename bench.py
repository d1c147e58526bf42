"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3 measured runs after one warm-up).
Each query is timed to full materialisation (a ``noop`` write, so nothing
is collected to the driver); the reported figure is the median per query
and ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def sf_of(path: str) -> float | str:
    name = os.path.basename(path.rstrip("/"))
    try:
        return float(name[2:]) if name.startswith("sf") else name
    except ValueError:
        return name


def main() -> None:
    from vigil import adapters as A
    from vigil.functions import scalars as X
    from vigil.operators import cubes as C
    from vigil.operators import drift as D
    from vigil.operators import hotspots as H
    from vigil.operators import logs as L
    from vigil.operators import risk as R
    from vigil.operators import windows as WN
    from vigil.operators import corpus as M
    from vigil.session import local_session, scratch_path
    from vigil.sources.files import write_parquet

    spark = local_session(CPUS, CPUS)
    se = A.safety_events(spark, SF_DIR)

    # inputs of the format comparison (setup, not timed)
    csv, pq = scratch_path(spark, "bench-csv"), scratch_path(spark, "bench-parquet")
    se.write.mode("overwrite").option("header", True).csv(csv)
    write_parquet(se, pq)
    reader = spark.read.option("header", True).option("inferSchema", True)

    def materialise(df):
        df.write.format("noop").mode("overwrite").save()

    def drift_js():
        a, b = A.inference_log(spark, SF_DIR), X.danger(A.safety_events(spark, SF_DIR))
        materialise(D.drift_frames(a, b, "inference_of_emotion", "emotion", names=("log", "events"))["js"])

    from vigil.operators.risk import row_count
    from vigil.sources.files import convert_folder, size_report, sql_row_count

    log = spark.read.parquet(pq)
    jobs = {
        # BASELINE rows: CSV / Parquet load + count, DataFrame / SQL count, CSV -> Parquet conversion
        "csv_load_count": lambda: reader.csv(csv).count(),
        "parquet_load_count": lambda: spark.read.parquet(pq).count(),
        "dataframe_count": lambda: row_count(log).first(),
        "sql_count": lambda: sql_row_count(spark, log).first(),
        "csv_to_parquet": lambda: convert_folder(spark, csv, out=scratch_path(spark, "bench-converted")),
        "risk_score_by_emotion": lambda: materialise(R.risk_score_by_emotion(se)),
        "summary_report": lambda: materialise(R.summary_report(se)),
        "build_cubes": lambda: C.build_cubes(se, scratch_path(spark, "bench-cubes")),
        "transition_matrix": lambda: materialise(L.transition_matrix(X.classify(A.harmonised_log(spark, SF_DIR)))),
        "js_divergence": drift_js,
        "geo_hotspots": lambda: H.geo_hotspots(se, 10, 1).collect(),
        "threat_verdict": lambda: materialise(WN.threat_verdict(A.window_scores(spark, SF_DIR))),
        "corpus_manifest": lambda: materialise(M.corpus_manifest(A.corpus_paths(spark, SF_DIR), "/corpus")),
        "previous_class_rows": lambda: materialise(L.with_previous_class(X.classify(A.harmonised_log(spark, SF_DIR)))),
        "corpus_log": lambda: materialise(M.corpus_log(A.corpus_paths(spark, SF_DIR))),
        "report_windows": lambda: materialise(WN.report_windows(A.signals(spark, SF_DIR))),
        "half_windows": lambda: materialise(WN.half_windows(A.signals(spark, SF_DIR))),
    }

    medians = {}
    for name, job in jobs.items():
        job()  # warm-up
        times = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            job()
            times.append(time.perf_counter() - t0)
        medians[name] = round(statistics.median(times), 4)

    sizes = size_report(spark, csv, pq).first()
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(medians.values()), 4),
        "unit": "sec",
        "queries": medians,
        "sf": sf_of(SF_DIR),
        "cpus": CPUS,
        "runs": RUNS,
        "rows": log.count(),
        "sizes": {"csv_bytes": sizes.csv_bytes, "parquet_bytes": sizes.parquet_bytes,
                  "csv_parquet_ratio": round(sizes.ratio, 3)},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
