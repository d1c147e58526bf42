"""The README's usage example, on local paths."""

import os

import pandas as pd

from vigil import adapters as A
from vigil.functions import scalars as X
from vigil.operators import cubes as C
from vigil.operators import drift as D
from vigil.operators import logs as L
from vigil.operators import risk as R
from vigil.sources import files as I


def test_readme_example(spark, tmp):
    I.write_parquet(A.safety_events(spark, "/root/testdata/sf0.001"), os.path.join(tmp, "safety_events"))
    pd.DataFrame({"id": ["a", "a", "b"], "time": ["10:00:00", "10:01:00", "10:02:00"],
                  "inference_of_emotion": ["fear", "sad", "happy"]}).to_csv(os.path.join(tmp, "a.csv"), index=False)
    pd.DataFrame({"id": ["c"] * 3, "time": ["11:00:00", "11:01:00", "11:02:00"],
                  "inference_of_emotion": ["angry", "angry", "sad"]}).to_csv(os.path.join(tmp, "b.csv"), index=False)
    events = I.read_events(spark, os.path.join(tmp, "safety_events"))
    assert R.risk_score_by_emotion(events).count() == 5
    assert R.summary_report(events).count() == 1
    C.build_cubes(events, os.path.join(tmp, "olap_cubes"))
    assert C.cube_peak_hours(C.read_cube(spark, os.path.join(tmp, "olap_cubes"), "hour_risk_cube")).count() > 0
    logs = I.ingest_logs(spark, [os.path.join(tmp, "a.csv"), os.path.join(tmp, "b.csv")], ref_date="2026-03-01")
    assert L.transition_matrix(X.classify(logs)).count() > 0
    rep = D.drift_report(I.read_log_csv(spark, os.path.join(tmp, "a.csv")),
                         I.read_log_csv(spark, os.path.join(tmp, "b.csv")), names=("tess", "synth")).first()
    assert rep.sizes.tess_n == 3 and rep.sizes.synth_n == 3
