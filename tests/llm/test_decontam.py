"""Containment search against a plain set computation."""

import random
import re

from vigil.llm import decontam as D


def words(t):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]


def brute(docs, items):
    out = []
    for d, t in docs:
        w = words(t)
        for i, q in items:
            v = words(q)
            if not v:
                continue
            n = min(5, len(v))
            a, b = ({tuple(x[k:k + n]) for k in range(len(x) - n + 1)} for x in (w, v))
            if 100 * len(a & b) >= 80 * len(b):
                out.append((d, i, len(a & b), len(b)))
    return sorted(out, key=str)


def case(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["É", "Zz", "漢", " ", "a b"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", "\n", "\t\x0b", "  "]) for _ in range(n))
    items = [(i, text(r.choice([1, 3, 5, 9, 30, 80]))) for i in range(25)] + [(50, ""), (51, None), (3, "w1 w2 w3 w4 w5 w6"), (3, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for d in range(60):
        t = text(r.choice([0, 2, 10, 200]))
        for _ in range(r.randint(0, 3)):
            q = words(r.choice(items)[1])
            if q and r.random() < .5:
                q[r.randrange(len(q))] = "changed"
            t += " " + " ".join(q).upper() + " " + text(3)
        docs.append((d, t))
    return docs + [(100, None), (None, items[4][1]), (7, docs[7][1])], items


def test_against_brute_force(spark):
    docs, items = case(1)
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    it = spark.createDataFrame(items, "item_id long, text string")
    for block_chars in (10 ** 6, 400):
        got = sorted((tuple(r) for r in D.contained_items(df, it, block_chars=block_chars).collect()), key=str)
        assert got == brute(docs, items)


def test_short_item_in_a_very_long_document(spark):
    r = random.Random(2)
    item = " ".join(f"q{i}" for i in range(30))
    text = " ".join(f"x{r.random()}" for _ in range(60000)) + " " + item + " " + "y" * 10 ** 6
    got = D.contained_items(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [tuple(x) for x in got] == [(1, 1, 26, 26)]


def test_empty(spark):
    df, it = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contained_items(df.limit(0), it).collect() == [] and D.contained_items(df, it.limit(0)).collect() == []
    assert D.contained_items(df, it).count() == 1
