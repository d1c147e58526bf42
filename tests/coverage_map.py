"""Write COVERAGE.md: SURVEY §2 operator id -> library function -> registered
query (SQL-checked or rows-checked) or unit test."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# id, function (module.name), registered queries, unit test file
MAP = [
    ("I1", "sources.files.read_events_csv", ["read_events_csv"], "test_sources_streams"),
    ("I2", "sources.files.read_log_csv", ["read_log_csv", "read_log_csv_mixed"], "test_readers_layout"),
    ("I3", "sources.files.ingest_logs / harmonise_log", ["ingest_logs", "ingest_logs_defaults", "harmonise_log"], ""),
    ("I4", "sources.files.read_events", ["read_events"], ""),
    ("I5", "sources.files.write_parquet", ["read_events", "build_cubes"], "test_sources_streams"),
    ("I6", "sources.files.convert_folder", ["convert_folder", "convert_folder_shapes"], "test_readers_layout"),
    ("I7", "sources.files.size_report", ["size_report"], "test_sources_streams"),
    ("I8", "sources.files.append_events / new_events (sources.keyed)", ["append_events", "new_events", "append_refused", "refused_events"], "test_keyed_log"),
    ("I9", "sources.files.read_log", ["append_events"], "test_sources_streams"),
    ("I10", "sources.files.sql_row_count", ["sql_row_count", "api_sql_counts"], ""),
    ("I11", "sources.files.write_summary_csv", ["summary_csv"], "test_sources_streams"),
    ("I12", "sources.files.write_report_json", ["report_json"], "test_quality_drift"),
    ("I13", "sources.files.list_corpus", ["list_corpus"], "test_sources_streams"),
    ("X1", "functions.scalars.danger", ["danger"], ""),
    ("X2-X4", "functions.scalars.with_timestamp / with_hour / with_date", ["with_time_parts"], "test_scalars"),
    ("X5-X6", "functions.scalars.with_geo_bucket / bucket_center", ["with_geo_bucket", "cube_geo_hotspots"], "test_scalars"),
    ("X7", "functions.scalars.normalize_columns", ["ingest_logs"], "test_scalars"),
    ("X8", "functions.scalars.rename_synonyms", ["ingest_logs", "ingest_logs_defaults"], "test_scalars"),
    ("X9", "functions.scalars.title_label", ["title_label", "harmonise_log"], "test_scalars"),
    ("X10", "functions.scalars.canonical_label", ["canonical_label"], "test_scalars"),
    ("X11", "functions.scalars.parse_log_time", ["harmonise_log", "ingest_logs_defaults"], "test_scalars"),
    ("X12", "functions.scalars.fill_log_defaults", ["ingest_logs_defaults"], "test_scalars"),
    ("X13", "functions.scalars.collapse_counter_ids", ["collapse_counter_ids", "harmonise_log"], "test_scalars"),
    ("X14", "functions.scalars.with_risk", ["with_risk_strict", "with_risk_no_threshold", "stream_risk_log"], "test_scalars"),
    ("X15", "functions.scalars.with_safety_status", ["with_safety_status"], "test_scalars"),
    ("X16", "functions.scalars.with_top_class", ["with_top_class"], "test_scalars"),
    ("X17", "functions.scalars.with_alert_colour", ["with_alert_colour"], "test_scalars"),
    ("X18", "functions.scalars.classify", ["classify"], "test_scalars"),
    ("X19", "functions.scalars.last_days", ["last_days"], "test_scalars"),
    ("X20", "functions.scalars.for_device", ["for_device"], "test_profile"),
    ("X21", "functions.scalars.to_numeric", ["to_numeric", "cube_explorer"], "test_profile"),
    ("X22", "functions.scalars.stamp_events", ["stamp_events", "stamp_events_facts"], "test_profile"),
    ("X23", "functions.scalars.within_radius", ["within_radius"], "test_scalars"),
    ("X24", "functions.scalars.fill_measures", ["fill_measures"], ""),
    ("X25", "functions.scalars.class_probabilities", ["class_probabilities"], "test_scalars"),
    ("J1", "operators.risk.risk_score_by_emotion", ["risk_score_by_emotion"], "test_risk_cubes"),
    ("J2", "operators.risk.risk_score_cube", ["risk_score_cube"], "test_risk_cubes"),
    ("J3", "operators.drift.aligned_distributions / aligned_counts", ["aligned_distributions"], "test_quality_drift"),
    ("J4", "operators.quality.invalid_labels", ["invalid_labels"], ""),
    ("J5", "sources.files.new_events / refused_events", ["new_events", "refused_events"], "test_keyed_log"),
    ("A1", "operators.risk.row_count", ["row_count"], ""),
    ("A2", "operators.risk.risk_distribution", ["risk_distribution"], ""),
    ("A3", "operators.risk.danger_rate", ["danger_rate"], "test_risk_cubes"),
    ("A4", "operators.risk.emotion_distribution", ["emotion_distribution"], ""),
    ("A5", "operators.risk.emotion_risk", ["emotion_risk"], ""),
    ("A6", "operators.risk.emotion_risk_pivot", ["emotion_risk_pivot"], "test_risk_cubes"),
    ("A7", "operators.risk.hourly_risk", ["hourly_risk"], ""),
    ("A8", "operators.risk.hourly_risk_pivot", ["hourly_risk_pivot"], "test_risk_cubes"),
    ("A9", "operators.risk.peak_danger_hour", ["peak_danger_hour"], "test_risk_cubes"),
    ("A10", "operators.risk.top_emotion", ["top_emotion"], "test_risk_cubes"),
    ("A11", "operators.risk.summary_report", ["summary_report", "summary_csv", "summary_with_stream"], "test_risk_cubes"),
    ("A12", "operators.profile.null_counts", ["null_counts"], "test_profile"),
    ("A13", "operators.profile.describe_table / describe_text", ["describe_table", "describe_text"], "test_profile"),
    ("A14", "operators.profile.schema_report / schema_facts", ["schema_report", "schema_facts"], "test_profile"),
    ("A15", "operators.cubes.hour_emotion_pivot", ["hour_emotion_pivot"], ""),
    ("A16", "operators.logs.class_distribution", ["class_distribution"], ""),
    ("A17", "operators.logs.daily_trend", ["daily_trend"], ""),
    ("A18", "operators.logs.activity_heatmap", ["activity_heatmap"], ""),
    ("A19", "operators.logs.timeline_histogram", ["timeline_histogram"], "test_logs"),
    ("A20", "operators.logs.log_status", ["log_status"], "test_logs"),
    ("A21", "operators.logs.device_ids", ["device_ids"], ""),
    ("A22", "operators.drift.label_distribution", ["label_distribution"], ""),
    ("A23", "operators.corpus.class_balance", ["class_balance"], ""),
    ("C1", "operators.cubes.hour_risk_cube", ["hour_risk_cube"], ""),
    ("C2", "operators.cubes.emotion_risk_cube", ["emotion_risk_cube"], ""),
    ("C3", "operators.cubes.geographic_cube", ["geographic_cube"], ""),
    ("C4", "operators.cubes.hour_emotion_risk_cube", ["hour_emotion_risk_cube"], ""),
    ("C5", "operators.cubes.risk_score_cube / risk_score_from", ["risk_score_cube"], "test_risk_cubes"),
    ("C6", "operators.cubes.build_cubes", ["build_cubes", "stored_hour_risk_cube", "stored_emotion_risk_cube", "stored_geographic_cube", "stored_hour_emotion_risk_cube", "stored_risk_score_cube"], "test_risk_cubes"),
    ("C7", "operators.cubes.cube_peak_hours", ["cube_peak_hours", "stored_cube_peak_hours"], "test_risk_cubes"),
    ("C8", "operators.cubes.cube_geo_hotspots", ["cube_geo_hotspots", "stored_cube_geo_hotspots"], "test_risk_cubes"),
    ("C9", "operators.cubes.cube_top_risk", ["cube_top_risk", "stored_cube_top_risk"], ""),
    ("C10", "operators.cubes.cube_explorer / cube_explorer_status", ["cube_explorer", "stored_cube_explorer"], "test_risk_cubes"),
    ("W1", "operators.logs.with_previous_class (ordered.lag_by_group)", ["with_previous_class"], "test_logs"),
    ("W2", "operators.logs.transition_matrix (ordered.lag_pair_counts)", ["transition_matrix"], "test_logs"),
    ("W3", "operators.logs.device_class_share", ["device_class_share"], "test_logs"),
    ("W4", "operators.quality.duplicate_ids", ["duplicate_ids"], "test_quality_drift"),
    ("W5", "operators.windows.chunk_signal / clip_verdict", ["chunk_signal", "clip_verdict"], "test_signals_corpus"),
    ("W6", "operators.windows.report_windows / report_subwindows", ["report_windows", "report_subwindows"], "test_signals_corpus"),
    ("W7", "operators.windows.half_windows", ["half_windows"], "test_signals_corpus"),
    ("W8", "operators.windows.threat_verdict", ["threat_verdict", "report_verdicts"], "test_signals_corpus"),
    ("L1", "operators.profile.sample_records", ["sample_records"], "test_profile"),
    ("L2", "operators.profile.recent_events", ["recent_events"], "test_profile"),
    ("L3", "operators.quality.top_invalid_labels", ["top_invalid_labels"], "test_quality_drift"),
    ("L4", "operators.quality.sample_invalid_rows", ["sample_invalid_rows"], "test_quality_drift"),
    ("U1", "operators.logs.union_logs", ["union_logs", "ingest_logs"], "test_logs"),
    ("U2", "operators.quality.column_diff / column_diff_facts", ["column_diff", "column_diff_facts"], "test_quality_drift"),
    ("U3", "operators.corpus.corpus_manifest (one pass over the four corpora)", ["corpus_manifest"], ""),
    ("V1", "operators.quality.check_nonempty", ["validation_checks"], "test_quality_drift"),
    ("V2", "operators.quality.check_columns", ["validation_checks"], "test_quality_drift"),
    ("V3", "operators.quality.check_not_null", ["validation_checks"], "test_quality_drift"),
    ("V4", "operators.quality.check_unique", ["validation_checks"], "test_quality_drift"),
    ("V5", "operators.quality.check_labels", ["validation_checks"], "test_quality_drift"),
    ("V6", "operators.quality.validation_verdict", ["validation_verdict"], "test_quality_drift"),
    ("V7", "operators.quality.diagnostics", ["diagnostics"], "test_quality_drift"),
    ("V8", "operators.quality.validate_all", ["validate_files", "validate_files_parts"], "test_quality_drift"),
    ("D1", "operators.drift.label_drift", ["label_drift"], ""),
    ("D2", "operators.drift.unknown_share", ["unknown_share"], "test_quality_drift"),
    ("D3", "operators.drift.js_divergence", ["js_divergence"], "test_properties_plans"),
    ("D4", "operators.drift.l1_distance", ["l1_distance"], "test_properties_plans"),
    ("D5", "operators.drift.drift_alerts", ["drift_alerts"], "test_quality_drift"),
    ("D6", "operators.drift.drift_report", ["drift_report", "drift_report_facts"], "test_quality_drift"),
    ("G1", "functions.signals.with_rms / drop_silent", ["with_rms", "drop_silent"], "test_signals_corpus"),
    ("G2", "functions.signals.with_clip_stats", ["with_clip_stats"], "test_signals_corpus"),
    ("G3", "functions.signals.fix_length", ["fix_length"], "test_signals_corpus"),
    ("G4", "functions.signals.normalize_vector", ["normalize_vector"], "test_signals_corpus"),
    ("G5", "functions.signals.drop_short", ["drop_short"], "test_signals_corpus"),
    ("M1", "operators.corpus.corpus_manifest", ["corpus_manifest"], "test_signals_corpus"),
    ("M2", "operators.corpus.corpus_manifest_binary", ["corpus_manifest_binary"], "test_signals_corpus"),
    ("M3", "operators.corpus.corpus_manifest_safety", ["corpus_manifest_safety"], "test_signals_corpus"),
    ("M4", "operators.corpus.encode_labels", ["encode_labels"], "test_signals_corpus"),
    ("M5", "operators.corpus.stratified_split", ["stratified_split", "split_label_counts"], "test_signals_corpus"),
    ("M6", "operators.corpus.augment_minority", ["augment_minority", "training_chain"], "test_signals_corpus"),
    ("M7", "operators.corpus.fit_scaler / scale", ["scale_features", "training_chain"], "test_signals_corpus"),
    ("M8", "operators.corpus.evaluate_predictions", ["evaluate_predictions"], "test_signals_corpus"),
    ("M9", "operators.corpus.corpus_log", ["corpus_log"], "test_signals_corpus"),
    ("K1", "operators.hotspots.geo_features", ["geo_features"], ""),
    ("K2", "operators.hotspots.geo_hotspots", ["geo_hotspots", "geo_hotspots_fixed_point"], "test_sources_streams"),
    ("P1", "operators.layout.partition_sizes", ["partition_sizes", "partition_sizes_facts"], "test_sources_streams"),
    ("P2", "operators.layout.repartition_report", ["repartition_report", "partition_sizes_facts"], "test_sources_streams"),
    ("P3", "operators.layout.format_counts / compare_formats", ["format_counts"], "test_sources_streams"),
    ("P4", "operators.layout.api_sql_counts / compare_api_sql", ["api_sql_counts"], "test_sources_streams"),
    ("S1", "streaming.jobs.stream_risk_log", ["stream_risk_log", "stream_risk_log_refused"], "test_sources_streams"),
    ("S2", "streaming.jobs.stream_danger_alerts", ["stream_danger_alerts"], "test_sources_streams"),
    ("S3", "streaming.jobs.stream_event_total", ["stream_event_total"], "test_sources_streams"),
    ("S4", "streaming.jobs.stream_recent", ["stream_recent"], "test_sources_streams"),
    ("S5", "streaming.jobs.stream_rolling_rms", ["stream_rolling_rms"], "test_sources_streams"),
    ("S6", "streaming.jobs.stream_dedup", ["stream_dedup"], "test_sources_streams"),
    ("S7", "streaming.jobs.stream_hotspots", ["stream_hotspots"], "test_sources_streams"),
]


def main() -> None:
    import importlib

    import __spark_entry__ as E

    own = lambda found: {n: q for n, q in found.items() if not n.startswith("op") and n != "pipeline"}
    qs, sql = own(E.queries()), own(E.oracle_sql())
    used = set()
    lines = ["# Operator coverage (SURVEY §2)", "",
             "Generated by `tests/coverage_map.py`. Check: SQL = the registered query is compared with DuckDB; "
             "rows = rows-only (non-deterministic or layout-dependent); unit = pytest on hand-written fixtures.", "",
             "| id | function (`vigil.`) | registered queries | checks |", "|---|---|---|---|"]
    for oid, fn, names, unit in MAP:
        path = fn.split(" (")[0]
        mod, _, first = path.split(" / ")[0].rpartition(".")
        module = importlib.import_module("vigil." + mod)
        for name in [first] + [x.strip() for x in path.split(" / ")[1:]]:
            assert hasattr(module, name), (mod, name)  # every named function exists
        for n in names:
            assert n in qs, n
            used.add(n)
        kinds = sorted({"SQL" if n in sql else "rows" for n in names})
        checks = ", ".join(kinds + ([f"unit ({unit})"] if unit else []))
        lines.append(f"| {oid} | `{fn}` | {', '.join(f'`{n}`' for n in names) or '-'} | {checks or '-'} |")
    lines += ["", f"{len(qs)} registered queries, {len(sql)} with SQL; every registered query appears above: "
              f"{'yes' if used == set(qs) else 'no: ' + ', '.join(sorted(set(qs) - used))}.", ""]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "COVERAGE.md"), "w") as fh:
        fh.write("\n".join(lines))


if __name__ == "__main__":
    main()
