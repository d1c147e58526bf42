"""Write PLANS.md: the physical plans of the headline queries on a stored
event log (python tests/show_plans.py [sf_dir])."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from vigil import adapters as A
    from vigil.functions import scalars as X
    from vigil.operators import cubes as C
    from vigil.operators import drift as D
    from vigil.operators import logs as L
    from vigil.operators import risk as R
    from vigil.operators import corpus as M
    from vigil.operators import windows as WN
    from vigil.operators.ordered import global_position
    from vigil.session import local_session, scratch_path
    from vigil.sources.files import read_events, write_parquet

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    log = read_events(spark, write_parquet(A.safety_events(spark, sf), scratch_path(spark, "plans-log")))
    hl = X.classify(A.harmonised_log(spark, sf))
    f = D.drift_frames(A.inference_log(spark, sf), X.danger(log), "inference_of_emotion", "emotion", names=("log", "events"))
    cases = {
        "danger events, two columns (X1)": X.danger(log).select("id", "latitude"),
        "risk score by emotion (J1)": R.risk_score_by_emotion(log),
        "summary report (A11)": R.summary_report(log),
        "cube cells, one pass (C6)": C.cube_aggregate(log),
        "transition matrix (W2)": L.transition_matrix(hl),
        "drift alerts (D5)": f["alerts"],
        "threat verdict (W8)": WN.threat_verdict(A.window_scores(spark, sf)),
        "corpus manifest, no shuffle (M1)": M.corpus_manifest(A.corpus_paths(spark, sf)),
        "positions by fixed ranges (M9)": global_position(hl.select("id", "timestamp", "inference", "class"), ["id", "timestamp", "inference"]),
    }
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tests/show_plans.py` on `{sf}` (local[8]); file locations shortened.", ""]
    for title, df in cases.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"Location: [^,]+\[[^\]]*\]", "Location: ...", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {title}", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
