import math

from pyspark.sql import functions as F

from conftest import rows
from vigil import constants as K
from vigil.functions import signals as G
from vigil.operators import corpus as M
from vigil.operators import windows as WN

SIG = "clip_id long, sample_rate int, samples array<double>"


def sig(spark, data):
    return spark.createDataFrame(data, SIG)


def test_rms_and_silence_edge_cases(spark):
    df = sig(spark, [(1, 10, []), (2, 10, [0.0] * 5), (3, 10, [0.5] * 4), (4, 10, [0.005, -0.02])])
    got = {r.clip_id: r.rms for r in G.with_rms(df).collect()}
    assert got[1] is None and got[2] == 0.0 and got[3] == 0.5
    assert math.isclose(got[4], math.sqrt((0.005 ** 2 + 0.02 ** 2) / 2))
    assert rows(G.drop_silent(df), "clip_id") == [(3,), (4,)]
    st = {r.clip_id: (r.duration, r.silence_ratio) for r in G.with_clip_stats(df).collect()}
    assert st[2] == (0.5, 1.0) and st[4] == (0.2, 0.5) and st[1] == (0.0, None)


def test_fix_length_and_short_clips(spark):
    df = sig(spark, [(1, 10, [1.0, 2.0]), (2, 10, [1.0, 2.0, 3.0]), (3, 10, [1.0, 2.0, 3.0, 4.0])])
    got = {r.clip_id: r.samples for r in G.fix_length(df, 3).collect()}
    assert got == {1: [1.0, 2.0, 0.0], 2: [1.0, 2.0, 3.0], 3: [1.0, 2.0, 3.0]}
    short = sig(spark, [(1, 100, [0.1] * 9), (2, 100, [0.1] * 10)])
    assert rows(G.drop_short(short), "clip_id") == [(2,)]


def test_normalisations(spark):
    df = sig(spark, [(1, 10, [1.0, -2.0, 3.0]), (2, 10, [0.0, 0.0])])
    peak = {r.clip_id: r.samples for r in G.normalize_vector(df, "peak").collect()}
    assert peak[1] == [1 / 3, -2 / 3, 1.0] and peak[2] == [0.0, 0.0]
    mm = G.normalize_vector(df, "minmax").filter("clip_id = 1").first().samples
    assert [round(x, 6) for x in mm] == [round(3 / (5 + 1e-6), 6), 0.0, round(5 / (5 + 1e-6), 6)]
    z = G.normalize_vector(df, "z").filter("clip_id = 1").first().samples
    mean = 2 / 3
    sd = math.sqrt(sum((x - mean) ** 2 for x in [1, -2, 3]) / 3)
    assert all(math.isclose(a, (x - mean) / (sd + 1e-6)) for a, x in zip(z, [1, -2, 3]))


def test_chunks_reports_and_half_windows_at_10hz(spark):
    df = sig(spark, [(1, 10, [0.5] * 9), (2, 10, [0.5] * 10), (3, 10, [0.5] * 45), (4, 10, [])])
    ch = rows(WN.chunk_signal(df), "clip_id", "chunk_index", "start_s", "end_s")
    assert ch == [(1, 0, 0.0, 0.9), (2, 0, 0.0, 1.0), (3, 0, 0.0, 3.0), (3, 1, 3.0, 4.5)]
    assert all(len(r.chunk) == 30 for r in WN.chunk_signal(df).collect())
    rep = rows(WN.report_windows(df), "clip_id", "report_index", "context_start", "context_len", "n_sub")
    # 0.9 s context is shorter than a sub-window -> skipped
    assert rep == [(2, 0, 0, 10, 1), (3, 0, 0, 40, 7), (3, 1, 20, 25, 4)]
    hw = rows(WN.half_windows(df), "clip_id", "window_index", "start")
    # 1.0 s: no window (the last full window is not taken); 4.5 s: starts 0..30 step 5
    assert hw == [(3, i, 5 * i) for i in range(7)]
    subs = WN.report_subwindows(df).filter("clip_id = 3 AND report_index = 1").collect()
    assert [r.sub_start for r in sorted(subs, key=lambda r: r.sub_index)] == [20, 25, 30, 35]


def test_threat_verdict_edges(spark):
    ws = spark.createDataFrame([
        (1, "2026-03-01 00:00:00", 0.5, 0.25, 0.25),   # exactly 0.50 -> not danger
        (2, "2026-03-01 00:00:00", 0.2, 0.3, 0.5), (2, "2026-03-01 00:00:01", 0.2, 0.6, 0.2),  # tied maxima
        (3, "2026-03-01 00:00:00", 0.0, 0.5, 0.5),    # p_fear = p_angry
        (4, "2026-03-01 00:00:00", 1.0, 0.0, 0.0)],
        "clip_id long, ts string, p_safe double, p_fear double, p_angry double").withColumn(
        "window_start", F.to_timestamp("ts"))
    got = {r.clip_id: (r.max_threat, r.dominant, r.danger) for r in WN.threat_verdict(ws).collect()}
    assert got[1] == (0.5, K.VERDICT_DANGER_FEAR, False) or got[1] == (0.5, K.VERDICT_DANGER_ANGRY, False)
    assert got[1][1] == K.VERDICT_DANGER_ANGRY  # p_fear == p_angry -> angry
    assert got[2] == (0.8, K.VERDICT_DANGER_ANGRY, True)  # first window reaching the max
    assert got[3] == (1.0, K.VERDICT_DANGER_ANGRY, True)
    assert got[4] == (0.0, K.VERDICT_SAFE, False)


def test_clip_verdict(spark):
    ch = spark.createDataFrame([(1, "sad"), (1, "angry"), (2, "disgust"), (2, None)], "clip_id long, emotion string")
    assert rows(WN.clip_verdict(ch)) == [(1, 2, 1, True), (2, 2, 0, False)]


NAMES = ["/c/ravdess/Actor_01/03-01-06-01.wav", "/c/cremad/1001_DFA_ANG_XX.wav", "/c/tess/OAF_fear/OAF_beg_fear.wav",
         "/c/tess/YAF_ps/YAF_x_ps.wav", "/c/savee/sa01.wav", "/c/savee/a01.wav", "/c/savee/x.wav",
         "/c/ravdess/bad.wav", "/c/cremad/sub/1001_DFA_ANG_XX.wav"]


def test_manifests(spark):
    paths = spark.createDataFrame([(p,) for p in NAMES], "path string")
    m1 = dict((r.path, r.label) for r in M.corpus_manifest(paths, "/c").collect())
    assert m1 == {NAMES[0]: "fear", NAMES[1]: "angry", NAMES[2]: "fear", NAMES[3]: "surprise", NAMES[4]: "sad",
                  NAMES[5]: "angry"}
    m2 = dict((r.path, r.label) for r in M.corpus_manifest_binary(paths, "/c").collect())
    assert m2 == {NAMES[0]: 1, NAMES[1]: 1, NAMES[2]: 1, NAMES[5]: 1}
    m3 = dict((r.path, r.label) for r in M.corpus_manifest_safety(paths).collect())
    assert m3 == {NAMES[2]: 1}
    enc = rows(M.encode_labels(M.corpus_manifest(paths, "/c")).select("label", "label_id").distinct())
    assert enc == [("angry", 0), ("fear", 1), ("sad", 2), ("surprise", 3)]


def test_corpus_log_walk_order(spark):
    paths = ["/r/z.wav", "/r/b_x/2.wav", "/r/b_x/1.wav", "/r/a_sad/9.wav", "/r/a_sad/deep_fear/1.wav", "/r/n.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [tuple(r) for r in M.corpus_log(df).orderBy("id").collect()]
    assert got == [(1, "09:00:00", "r"), (2, "09:00:03", "sad"), (3, "09:00:06", "fear"),
                   (4, "09:00:09", "x"), (5, "09:00:12", "x")]


def test_stratified_split_exact_shares(spark):
    df = spark.createDataFrame([("p%d" % i, i % 2 if i < 900 else 1) for i in range(1000)], "path string, label int")
    out = M.stratified_split(df, 0.2, 7)
    by = {(r.label, r.split): r.n for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert by[(0, "test")] == 90 and by[(1, "test")] == 110 and by[(0, "train")] == 360
    again = M.stratified_split(df, 0.2, 7)
    assert rows(out, "path", "split") == rows(again, "path", "split")


def test_augment_and_scaler(spark):
    df = spark.createDataFrame([(1, 1, [0.1, 0.2]), (2, 0, [0.3, 0.4])], "clip_id long, label int, samples array<double>")
    aug = M.augment_minority(df, seed=3)
    assert rows(aug, "clip_id", "variant") == [(1, "noise"), (1, "orig"), (2, "orig")]
    noisy = aug.filter("variant = 'noise'").first().samples
    assert noisy != [0.1, 0.2] and all(abs(a - b) < 0.035 * 0.2 * 6 for a, b in zip(noisy, [0.1, 0.2]))
    tr = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    sc = M.scale(tr, M.fit_scaler(tr, ["x", "y"]), ["x", "y"])
    assert rows(sc, "x_scaled", "y_scaled") == [(-1.0, 0.0), (1.0, 0.0)]


def test_evaluate_predictions(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1)], "label int, prediction int")
    r = M.evaluate_predictions(df).first()
    assert (r.accuracy, r.recall, r.n) == (0.5, 0.5, 4)


def test_manifest_without_root(spark):
    paths = spark.createDataFrame([(p,) for p in NAMES], "path string")
    with_root = sorted(map(tuple, M.corpus_manifest(paths, "/c").collect()))
    assert sorted(map(tuple, M.corpus_manifest(paths).collect())) == with_root
    assert sorted(map(tuple, M.corpus_manifest_binary(paths).collect())) == \
        sorted(map(tuple, M.corpus_manifest_binary(paths, "/c").collect()))


def test_threat_verdict_per_report_window(spark):
    ws = spark.createDataFrame([(1, 0, "2026-03-01 00:00:00", 0.1, 0.7), (1, 1, "2026-03-01 00:00:03", 0.1, 0.1)],
                               "clip_id long, report_index int, ts string, p_fear double, p_angry double")
    ws = ws.withColumn("window_start", F.to_timestamp("ts"))
    got = rows(WN.threat_verdict(ws, ["clip_id", "report_index"]), "clip_id", "report_index", "danger")
    assert got == [(1, 0, True), (1, 1, False)]
