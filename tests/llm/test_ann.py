"""Learned-partition search: recall, exact scores, ties, odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, k=20):
    """{query id: [(score, id)]} over the rows that take part."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and i % 20 == 0:
            out[i] = sorted(((float((v * w).sum()), j) for m, (j, w) in enumerate(rows) if m != n), key=lambda x: (-x[0], x[1] is None, x[1]))[:k]
    return out


def test_recall_and_scores(spark):
    for sf in ("sf0.01", "sf0.1"):
        table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
        x, ids = np.array([v for _, v in rows], np.float64), np.array([i for i, _ in rows])
        got = {}
        for r in A.op1_learned_partitions(spark, f"/root/testdata/{sf}").collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        asked = np.flatnonzero(ids % 20 == 0)
        hit = 0
        for q in asked:
            mine = sorted(got[ids[q]])
            assert [m[0] for m in mine] == list(range(1, 21))
            s = x @ x[q]
            assert np.allclose([m[2] for m in mine], s[[np.flatnonzero(ids == m[1])[0] for m in mine]], atol=1e-12)
            s[q] = -9
            hit += len({m[1] for m in mine} & set(ids[np.argsort(-s)[:20]].tolist()))
        assert hit / len(asked) / 20 >= .9, (sf, hit / len(asked) / 20)


def test_odd_rows_and_ties(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(30)]
    good += [(100 + i, good[0][1]) for i in range(40)] + [(None, good[0][1]), (20, good[20][1]), (0, good[0][1])]
    bad = [(40, None), (60, []), (80, [0.0] * 8), (200, [None] + [1.0] * 7), (220, [float("nan")] + [1.0] * 7), (240, [float("inf")] + [1.0] * 7), (260, [1.0] * 3)]
    df = spark.createDataFrame([(*r, 1) for r in good + bad], SCHEMA)
    got = {}
    for r in A.nearest(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = {}
    for n, (i, v) in enumerate(good):  # a repeated query row has neighbours of its own
        if i is not None and i % 20 == 0:
            own = brute([(0 if m == n else 1 if j == 0 else 1 if j is None else 3, w) for m, (j, w) in enumerate(good)])  # scores only
            want.setdefault(i, []).extend(round(s, 5) for s, _ in own[0])
    assert set(got) == set(want)
    for i, rows in got.items():
        assert sorted(round(s, 5) for _, s, _ in rows) == sorted(want[i])
    first = [(s, j) for _, s, j in sorted(got[100], key=lambda x: x[0])]
    assert all(a[0] > b[0] or (a[0] == b[0] and (b[1] is None or (a[1] is not None and a[1] <= b[1]))) for a, b in zip(first, first[1:]))


def test_split_parts_give_the_same(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    a = sorted(map(tuple, A.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()))
    monkeypatch.setattr(A, "BLOCK", 40)
    assert sorted(map(tuple, A.nearest(table, F.col("vec_id") % 20 == 0, 20).collect())) == a


def test_parts_are_balanced():
    x = np.random.default_rng(2).normal(size=(2000, 16)).astype(np.float32)
    label = A.balanced_parts(x, A.top_inner(x, x, 10, np.arange(2000)), 16)
    assert np.bincount(label, minlength=16).max() <= 1.11 * 125 and np.bincount(label, minlength=16).min() >= .88 * 125


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert A.nearest(df, F.col("vec_id") % 20 == 0, 20).collect() == []
    one = spark.createDataFrame([(20, [1.0, 2.0], 1), (21, [1.0, 0.0], 1)], SCHEMA)
    assert [tuple(r) for r in A.nearest(one, F.col("vec_id") % 20 == 0, 20).collect()] == [(20, 1, 21, 1.0)]


def test_products_beyond_single_precision():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(60, 8)).astype(np.float32)
    rows[:25] *= np.float32(1e20)
    q, q_row, row = rows[[0, 30]], np.array([0, 30]), np.arange(60)
    qi, ri, score = A.best_of(q, q_row, rows, row, row, 10)
    for i in range(2):
        exact = rows.astype(np.float64) @ q[i].astype(np.float64)
        exact[q_row[i]] = -np.inf
        assert ri[qi == i].tolist() == np.argsort(-exact)[:10].tolist()
        assert np.allclose(score[qi == i], np.sort(exact)[::-1][:10], rtol=1e-9)
