"""Relative Lempel-Ziv dedup against a plain dictionary of windows."""

import random
import re

import pytest

from vigil.llm import repeats as R
from vigil.llm import rlz as Z


def brute(rows, width):
    words = [(i if i is not None else 1 << 70, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            g = tuple(w[k:k + width])
            first[g] = min(first.get(g, 1 << 71), i)
    out = []
    for (i, _), (n, w) in zip(rows, words):
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < n:
                gone |= set(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    vocab = ["a", "b", "C", "é", "漢", "x1", "--"]
    text = lambda k: [r.choice(vocab) for _ in range(k)]
    passages = [text(r.randint(5, 60)) for _ in range(6)] + [["z"] * 40, ["p", "q"] * 25]
    out = []
    for i in range(n):
        w = text(r.randint(0, 30))
        for _ in range(r.randint(0, 4)):
            p = list(r.choice(passages))
            if r.random() < .4:
                p[r.randrange(len(p))] = "changed"
            w += p + text(r.randint(0, 6))
        out.append((i, "".join(x + r.choice([" ", "\n", "\t ", "  "]) for x in w)))
    return out + [(100, None), (101, ""), (102, out[3][1]), (None, out[4][1]), (None, out[5][1]), (7, out[7][1]), (8, out[3][1])]


@pytest.mark.parametrize("seed,width,inner", [(1, 10, 3), (2, 10, 1), (3, 6, 6), (4, 20, 4)])
def test_against_brute_force(spark, monkeypatch, seed, width, inner):
    monkeypatch.setattr(R, "FLUSH", 500)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, key int")
    got = Z.parse_documents(df.repartition(5), width=width, inner=inner).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, width)
    text = {}
    for i, t in rows:
        text.setdefault(R.NULL_ID if i is None else i, []).append((t or "").split())
    for r in got:  # a factor is a copy of its reference
        for f in r["factors"]:
            own = [w[f["start"]:f["start"] + f["length"]] for w in text[R.NULL_ID if r["doc_id"] is None else r["doc_id"]]]
            assert f["length"] >= width and f["ref_id"] < (R.NULL_ID if r["doc_id"] is None else r["doc_id"])
            assert any(w[f["ref_start"]:f["ref_start"] + f["length"]] in own for w in text[f["ref_id"]])


def test_long_documents_are_cut_into_segments(spark, monkeypatch):
    import functools

    monkeypatch.setattr(R, "segments", functools.partial(R.segments, limit=70))
    rows = corpus(9, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Z.parse_documents(df, width=10, inner=3).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, 10)


def test_production_width_and_empty(spark):
    r = random.Random(3)
    p = " ".join(f"w{r.randint(0, 99)}" for _ in range(50))
    rows = [(1, "x " + p + " y"), (2, p), (3, p.rsplit(" ", 1)[0]), (4, "q " + p + " " + p)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"], r["kept"]) for r in Z.parse_documents(df).collect()) == [
        (1, 0, "x " + p + " y"), (2, 50, ""), (3, 0, rows[2][1]), (4, 100, "q")]
    assert Z.parse_documents(df.limit(0)).collect() == []


def test_repeated_rows_meet_once(spark, monkeypatch):
    rows = corpus(5, 20)
    rows += [rows[3]] * 30 + [(None, rows[4][1])] * 30
    met, table, single = [], R.block_table, R.single_windows

    def counted(which):
        def call(rows, *args, **kw):
            met.append((rows.count(), rows.select("key").distinct().count()))
            return which(rows, *args, **kw)
        return call

    monkeypatch.setattr(R, "block_table", counted(table))
    monkeypatch.setattr(R, "single_windows", counted(single))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Z.parse_documents(df.repartition(5), width=10, inner=3).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, 10)
    assert len(met) == 2 and all(n == keys > 0 for n, keys in met)


def test_lookups_compare_words():
    import numpy as np

    words, ref = np.arange(100, 160), np.concatenate([[1, 2, 3], np.arange(110, 140), [7], np.arange(141, 150)])
    assert Z.longest(words, 12, ref, 5, 10) == [(10, 40)]  # beyond the seed on both sides
    assert Z.longest(words, 12, ref, 5, 9) == [(10, 40), (41, 50)]
    assert Z.longest(words, 12, ref, 6, 10) == []  # a false seed
    assert Z.longest(words, 55, ref, 0, 10) == [] and Z.longest(words[:5], 0, ref, 3, 10) == []


def test_removal_follows_the_factors(spark, monkeypatch):
    p = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, "a " + p), (2, "b " + p + " c"), (3, "d e f")], "doc_id long, text string")
    right, shorter = Z.longest, lambda *a: [(s, e - 7) for s, e in right(*a)]
    removed = lambda: {r["doc_id"]: r["n_removed"] for r in Z.parse_documents(df, width=20).collect()}
    assert removed() == {1: 0, 2: 60, 3: 0}
    monkeypatch.setattr(Z, "longest", shorter)
    assert removed() == {1: 0, 2: 53, 3: 0}
    monkeypatch.setattr(Z, "longest", lambda *a: [])
    assert removed() == {1: 0, 2: 0, 3: 0}


def test_ids_whose_hashes_clash(spark, monkeypatch):
    from pyspark.sql import functions as F

    keyed = R.keyed
    monkeypatch.setattr(R, "keyed", lambda *a: keyed(*a).withColumn("key", F.lit(5).cast("long")))
    rows = [r for r in corpus(6, 30)[:30]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Z.parse_documents(df, width=10, inner=3).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, 10)
