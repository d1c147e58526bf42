"""Subword quality classifier: held-out accuracy, and scores against a plain sum."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import quality as Q
from vigil.llm.text import Powers, byte_values

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = Q.op4_quality_subword(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out and quality is not null")
    rows = out.select("quality", "predicted").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert sum(r["predicted"] == 1 for r in good) / len(good) > .97, len(good)
    assert sum(r["predicted"] == 0 for r in bad) / len(bad) > .9, len(bad)


def test_scores_are_sums_of_means_over_features():
    rng = np.random.default_rng(1)
    odds, bias, table = rng.normal(size=Q.BUCKETS), .3, byte_values(4)
    texts = ["", "a", "ab", "é漢 xyz", "w " * 50, "", "one two three\tfour", "漢" * 9, "漢漢", "last last", "last", "last"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = Q.score_slice(data, offsets, odds, bias, table, Powers())
    for t, s in zip(texts, got):
        ids, weight = Q.bag(t, table, Powers())
        w = t.split()
        want = bool(w) + sum(a == b for a, b in zip(w, w[1:])) / max(1, len(w)) + sum(len(t) >= k for k in Q.GRAMS)
        assert np.isclose(weight.sum(), want)
        assert np.isclose(s, 1 / (1 + np.exp(-((odds[ids] * weight).sum() + bias))))


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(["good text here", "b%%% a### d$$$", None, "", "x" * 10 ** 6])] + [(None, "good text", 1), (0, "good text here", 7)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (3, None), (None, 1)], "doc_id long, quality int")
    out = Q.quality_scores(docs, Q.fit_quality(docs, labels)).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= .7) for r in out)
    assert [r["held_out"] for r in out] == [r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in out]
    assert len({r["score"] for r in out if r["doc_id"] == 0}) == 1
    only = Q.quality_scores(docs, Q.fit_quality(docs, labels.where("quality = 1"))).collect()
    assert all(r["score"] > .99 for r in only)
    assert Q.quality_scores(docs.limit(0), Q.fit_quality(docs, labels.limit(0))).collect() == []
    assert Q.quality_scores(docs.where("doc_id = 0"), Q.fit_quality(docs, labels.limit(0))).first()["score"] == .5


def test_training_leaves_the_fold_out(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    from vigil.llm.labelled import labelled_sample

    n = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))
    assert len(labelled_sample(docs, labels, "quality", 4, 2, 1000, 10_000)) == n
    assert len(labelled_sample(docs, labels, "quality", 4, 2, 50, 10_000)) == 50
    assert len(labelled_sample(docs, labels, "quality", 4, 2, 50, 10)) == 10


def test_texts_of_any_length_are_learned_from(spark):
    from vigil.llm.labelled import labelled_sample

    docs = spark.createDataFrame([(i, ("%%% x### " if i % 2 else f"plain words {i} here ") * (15_000 if i < 8 else 3)) for i in range(16)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2 = 0) AS quality")
    sample = labelled_sample(docs, labels, "quality", 4, 2, 100, 10**7, piece_chars=1000, pieces=4)
    kept = {i for i in range(16) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len(sample) == len(kept) and max(len(t) for t, _ in sample) == 4003  # four pieces, three line breaks
    model = Q.train(labelled_sample(docs, labels, "quality", 4, 2, 100, 10**7))
    assert {r["doc_id"]: r["predicted"] for r in Q.quality_scores(docs, model).collect()} == {i: int(i % 2 == 0) for i in range(16)}


def test_flat_bags_are_the_bags():
    sample = [("one two two", 1), ("", 0), ("é漢 " * 40, 1)]
    ids, part, first = Q.bags(sample)
    for i, (t, _) in enumerate(sample):
        own, weight = Q.bag(t, byte_values(4), Powers())
        assert (ids[first[i]:first[i + 1]] == own).all() and np.allclose(part[first[i]:first[i + 1]], weight)
