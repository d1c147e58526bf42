"""Importance resampling against a plain loop."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from vigil.llm import resample as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, least, longest, buckets, seed=2024):
    b = lambda f: zlib.crc32(f.encode()) % buckets
    feats = [runs(t, longest) for _, t in docs]
    s = Counter(b(f) for _, fs in feats for f in fs)
    t = Counter(b(f) for x in target for f in runs(x, longest)[1])
    S_, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (S_ + buckets) / ((s[i] + 1) * (T + buckets)))) for i in range(buckets)]
    rows = []
    for (d, _), (n, fs) in zip(docs, feats):
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b(f)] for f in fs) // len(fs) if fs else 0
        rows.append((d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = Counter()
    for i, r in enumerate(fit[:len(fit) * percent // 100]):
        ranks[r, i + 1] += 1
    rest = Counter(rows) - Counter(r for r, _ in ranks.elements())
    return sorted([(*r, k) for r, k in ranks.elements()] + [(*r, None) for r in rest.elements()], key=str)


def table(n=300):
    words = ["alpha", "Beta", "gamma", "DELTA", "x1", "漢字", "é", "zeta", "eta9", "theta"]
    docs = [(i, " ".join(words[(i * 7 + j * j) % len(words)] for j in range(i % 40)) + "!?" * (i % 3)) for i in range(n)]
    return docs + [(None, "lone words " * 12), (None, None), (n, None), (n + 1, ""), (n + 2, " \n\x00-"), (5, docs[39][1]), (5, docs[39][1]), (n + 3, "é" * 50)]


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (3, 100, 1), (2, 37, 5)])
def test_draw_is_the_plain_loop(spark, longest, percent, least):
    docs, target = table(), ["alpha beta gamma", None, "", "Zeta zeta x1"]
    df = spark.createDataFrame([(d, t, "q", i) for i, (d, t) in enumerate(docs)], "doc_id long, text string, score string, rank int")
    got = S.importance_draw(df, spark.createDataFrame([(t,) for t in target], "text string"), percent, least, longest, 50)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, percent, least, longest, 50)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_slices_put_words_together(size):
    split = S.splitter()
    text = "ab  cde f漢字g\x00hh é é1-ijklmnop, z"
    pairs = [p for part in S.word_offsets(text, split, size) for p in part]
    assert [text[s:e] for s, e in pairs] == WORD.findall(text)
    for longest in (1, 2, 4):
        found = [r for _, rs in S.features(text, split, longest, size) for r in rs]
        assert Counter(found) == Counter(runs(text, longest)[1])


def test_very_long_texts():
    split, n = S.splitter(), 0
    for k, found in S.features("a" * 3_000_000 + " b" * 500_000, split, 1):
        n += k
    assert n == 500_001


def test_ties_and_repeated_rows_hold_places_each(spark):
    df = spark.createDataFrame([(7, "one two three")] * 40 + [(8, "one two three")] * 3, "doc_id long, text string")
    got = S.importance_draw(df, df.limit(1), 50, 1).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 22)) and len(got) == 43


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert S.importance_draw(none, some).collect() == []
    row = S.importance_draw(some, none, 100, 1).first()
    assert row["rank"] == 1 and row["n_features"] == 3
