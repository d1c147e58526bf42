"""Recurrent toxicity network: gradients, windows, held-out accuracy, cases."""

import zlib

import numpy as np

from vigil.llm import toxicity as T
from vigil.llm.text import Powers, byte_values

SF = "/root/testdata/sf0.1"


def parsed(texts):
    blobs = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(blobs), np.uint8)
    return T.parse(data, np.concatenate([[0], np.cumsum([len(b) for b in blobs])]), byte_values(9, lower=True), Powers())


def test_windows_overlap_and_cover_all_words():
    sizes = [0, 1, 31, 32, 33, 48, 49, 500]
    first = np.concatenate([[0], np.cumsum(sizes)])
    doc, start, size = T.windows(first)
    for d, n in enumerate(sizes):
        own = [(s - first[d], k) for x, s, k in zip(doc, start, size) if x == d]
        assert own[-1][0] + own[-1][1] == n and set().union(*(range(a, a + k) for a, k in own)) == set(range(n))
        assert all(b[0] - a[0] <= T.STRIDE for a, b in zip(own, own[1:]))


def test_gradients_match_differences():
    words, doc, start, size = parsed(["a bad word here é", "x " * 40, "", "one"])
    net = {k: v.astype(np.float64) for k, v in T.new_network(3).items()}
    y, weight = np.array([1.0, 0, 1, 0, 1])[:len(start)], np.linspace(.5, 1, len(start))

    def loss():
        z = T.logits(net, words, start, size).astype(np.float64)
        return float((weight * (np.log1p(np.exp(-z)) + (1 - y) * z)).sum())

    dense, rows = T.gradients(net, words, start, size, y, weight)
    for name, (at, g) in rows.items():
        dense[name] = np.zeros_like(net[name])
        np.add.at(dense[name], at, g)
    rng = np.random.default_rng(1)
    for name, g in dense.items():
        busy = np.argwhere(np.abs(g) > 1e-4)
        for at in busy[rng.permutation(len(busy))[:6]]:
            at, old = tuple(at), net[name][tuple(at)]
            net[name][at] = old + 1e-2
            up = loss()
            net[name][at] = old - 1e-2
            down = loss()
            net[name][at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 1e-3 + .05 * abs(g[at]), (name, at)


def test_held_out_accuracy(spark):
    out = T.op9_toxicity_gru(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out and toxic is not null")
    rows = out.select("toxic", "predicted").collect()
    bad, clean = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in bad) / len(bad) > .8, len(bad)  # about 300 toxic documents to learn from here
    assert sum(r["predicted"] for r in clean) / len(clean) < .03, len(clean)


def test_score_is_the_worst_window_and_batches_do_not_matter():
    net = T.new_network(2)
    texts = ["", "alpha beta", "w1 w2 " * 60, "", "z" * 5000]
    one = [T.score_slice(net, np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), byte_values(9, lower=True), Powers())[0] for t in texts]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    many = T.score_slice(net, data, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]), byte_values(9, lower=True), Powers())
    assert np.allclose(one, many, atol=1e-5)
    words, _, start, size = parsed([texts[2]])
    z = T.logits(net, words, start, size).max()
    assert np.isclose(one[2], 1 / (1 + np.exp(-float(z))), atol=1e-5)


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(["fine text here", "idiot idiot", None, "", "x" * 10 ** 6])] + [(None, "fine", 1), (0, "fine text here", 7)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0), (None, 1)], "doc_id long, toxic int")
    out = T.toxicity_scores(docs, T.fit_toxicity(docs, labels)).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= .5) for r in out)
    assert [r["held_out"] for r in out] == [r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in out]
    assert T.toxicity_scores(docs.limit(0), T.fit_toxicity(docs, labels.limit(0))).collect() == []
    assert T.toxicity_scores(docs, T.fit_toxicity(docs, labels.where("toxic = 0"))).first()["score"] < .01


def test_long_toxic_documents_are_learned_from(spark):
    rows = [(i, "nice calm words about gardens " * 20 if i % 2 else "stupid idiot hate you fool " * 960) for i in range(40)]  # toxic ones of over 24,000 characters
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2 = 0) AS toxic")
    out = T.toxicity_scores(docs, T.fit_toxicity(docs, labels)).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 2 == 0) for r in out)


def test_forward_pass_is_the_plain_loop():
    """Scores of windows by the equations, one word at a time."""
    net = {k: v.astype(np.float64) for k, v in T.new_network(5).items()}
    words, doc, start, size = parsed(["a bad word é here", "x yy zzz x", ""])
    sig = lambda v: 1 / (1 + np.exp(-v))

    def vector(i):
        grams = words.grams[words.first[i]:words.first[i + 1]]
        chars = net["gram"][grams].sum(0) / max(1, len(grams)) if len(grams) else np.zeros(T.SIDE)
        return np.concatenate([net["word"][words.ids[i]], chars])

    def layer(xs, d):
        h, out = np.zeros(T.SIDE), []
        for x in xs:
            g = x @ net[f"in_{d}"] + net[f"bias_{d}"]
            u = h @ net[f"state_{d}"]
            z, r = sig(g[:T.SIDE] + u[:T.SIDE]), sig(g[T.SIDE:2 * T.SIDE] + u[T.SIDE:2 * T.SIDE])
            n = np.tanh(g[2 * T.SIDE:] + r * u[2 * T.SIDE:])
            h = (1 - z) * h + z * n
            out.append(h)
        return out

    got = T.logits(net, words, start, size)
    for s, k, logit in zip(start, size, got):
        xs = [vector(words.index[s + j]) for j in range(k)]
        if not k:
            continue
        states = [np.concatenate([f, b]) for f, b in zip(layer(xs, "f"), layer(xs[::-1], "b")[::-1])]
        e = np.array([np.tanh(st @ net["look"] + net["look_bias"]) @ net["look_at"] for st in states])
        a = np.exp(e - e.max())
        pooled = (a / a.sum()) @ np.array(states)
        assert abs(pooled @ net["out"] + float(net["out_bias"].sum()) - logit) < 1e-4
