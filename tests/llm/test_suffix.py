"""Suffix-array dedup against a plain dictionary of byte windows."""

import functools
import random

import numpy as np
import pytest

from vigil.llm import repeats as R
from vigil.llm import suffix as S


def brute(rows, width):
    texts = [(i if i is not None else 1 << 70, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for k in range(len(b) - width + 1):
            g = b[k:k + width]
            first[g] = min(first.get(g, (1 << 71, 0)), (i, k))
    out = []
    for (i, _), (n, b) in zip(rows, texts):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - width + 1):
            if first[b[k:k + width]] < (n, k):
                gone[k:k + width] = True
        gone[-1] = False
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone, prepend=False) & gone).sum()), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed, n=50):
    r = random.Random(seed)
    text = lambda k: "".join(r.choice("abcé \n\0") for _ in range(k))
    passages = [text(r.randint(5, 60)) for _ in range(6)] + ["a" * 70, "ab" * 40, "xyz" * 20, "\0" * 50]
    out = []
    for i in range(n):
        t = text(r.randint(0, 30))
        for _ in range(r.randint(0, 4)):
            p = r.choice(passages)
            if r.random() < .4:
                k = r.randrange(len(p))
                p = p[:k] + "Q" + p[k + 1:]
            t += p + text(r.randint(0, 6))
        out.append((i, t))
    return out + [(100, None), (101, ""), (102, out[3][1]), (None, out[4][1]), (None, out[5][1] + "tail"), (7, out[7][1]), (8, out[3][1] + "x")]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, key int")
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), bytes(r["kept"])) for r in S.remove_repeats(df.repartition(4), **kw).collect()), key=str)


@pytest.mark.parametrize("seed,width,inner,pieces", [(1, 10, 3, 512), (2, 12, 1, 512), (3, 8, 8, 3), (4, 20, 4, 0)])
def test_against_brute_force(spark, monkeypatch, seed, width, inner, pieces):
    monkeypatch.setattr(R, "FLUSH", 700)
    monkeypatch.setattr(S, "CHUNK", 300)
    rows = corpus(seed)
    assert run(spark, rows, width=width, inner=inner, max_pieces=pieces) == brute(rows, width)


def test_long_documents_and_long_runs(spark, monkeypatch):
    monkeypatch.setattr(R, "segments", functools.partial(R.segments, limit=90))
    monkeypatch.setattr(S, "MAX_RUN", 25)
    rows = corpus(9, 30) + [(200, "k" * 400), (201, "k" * 150 + "m" + "k" * 90)]
    assert run(spark, rows, width=10, inner=3) == brute(rows, 10)


def test_production_width_and_empty(spark):
    r = random.Random(1)
    p = "".join(r.choice("abcdefgh ") for _ in range(100))
    rows = [(2, "x" + p + "y"), (1, p), (3, p[:99]), (4, p + p)]
    assert run(spark, rows) == brute(rows, 100)
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_longest_previous():
    text = np.frombuffer(b"abcabcabdabc", np.uint8)
    order, same = S.suffix_order(text, np.arange(10), 3)
    found, least = S.longest_previous(order, same, np.arange(10))
    assert sorted(order[found].tolist()) == [3, 4, 5, 9] and all(order[least[np.flatnonzero(order == i)[0]]] == j for i, j in ((3, 0), (4, 1), (5, 2), (9, 0)))


def test_repeated_rows_meet_once(spark, monkeypatch):
    rows = corpus(5, 20)
    rows += [rows[3]] * 30 + [(None, rows[4][1])] * 30
    met, meet = [], S.contested_repeats

    def counted(open_, width):
        met.append((open_.count(), open_.select("key").distinct().count(), max(len({tuple(s) for s in r["spans"]}) - len(r["spans"]) for r in open_.collect())))
        return meet(open_, width)

    monkeypatch.setattr(S, "contested_repeats", counted)
    assert run(spark, rows, width=10, inner=3) == brute(rows, 10)
    assert met[0][0] == met[0][1] > 0 and met[0][2] == 0
