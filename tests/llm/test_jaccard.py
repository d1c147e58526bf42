"""Jaccard join against all pairs, and components against a plain search."""

import random
import re

import pytest

from vigil.llm import graph
from vigil.llm import jaccard as J
from vigil.llm.graph import components


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text, n):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n=4, percent=85):
    sets = [shingle_set(t, n) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    root = union_find(range(len(rows)), edges)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return sorted(((d, len(s), least.get(root[i], d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, families=8, size=12, extra=40):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "漢", "UP"]
    line = [r.choice(vocab) for _ in range(12)]
    text = lambda k: [r.choice(vocab) for _ in range(k)]
    out = []
    for _ in range(families):
        base = text(r.choice([5, 30, 80, 200])) + line
        for _ in range(r.randint(1, size)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = r.choice(vocab)
            out.append(w + text(r.choice([0, 0, 2])))
    out += [text(r.randint(0, 40)) + line for _ in range(extra)] + [["a"], ["A"], ["a", "b", "c"], ["a", "b", "C"], []]
    r.shuffle(out)
    rows = [(i, "".join(x + r.choice([" ", "\n ", "\t"]) for x in w)) for i, w in enumerate(out)]
    return rows + [(500, None), (501, "  "), (502, rows[3][1].upper()), (None, rows[4][1]), (None, "alone in the world here"), (7, rows[7][1]), (8, rows[9][1])]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, size int")
    return sorted((tuple(r)[:3] for r in J.jaccard_components(df.repartition(4), **kw).collect()), key=str)


@pytest.mark.parametrize("seed,sets,asking,frequent", [(1, 1024, 8, 5), (2, 3, 1, 2), (3, 1, 0, 1)])
def test_against_all_pairs(spark, monkeypatch, seed, sets, asking, frequent):
    monkeypatch.setattr(J, "BLOCK_SETS", sets)
    monkeypatch.setattr(J, "ASKING", asking)
    monkeypatch.setattr(J, "FREQUENT", frequent)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_other_parameters_and_empty(spark):
    rows = corpus(6, 4, 6, 10)
    assert run(spark, rows, words=2, percent=60) == brute(rows, 2, 60)
    assert run(spark, rows[:1]) == brute(rows[:1])
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5), (400, 400)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()}
    nodes = {n for e in edges for n in e} | {3}
    assert got == union_find(nodes, edges)


def test_repeated_rows_meet_once(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    near = words[:-1] + ["other"]
    rows = [(1, " ".join(words))] * 40 + [(None, " ".join(near))] * 30 + [(2, " ".join(near[1:])), (3, "alone in the world here")]
    met, meet = [], J.meet_groups

    def counted(members, *args, **kw):
        met.append(members.count())
        return meet(members, *args, **kw)

    monkeypatch.setattr(J, "meet_groups", counted)
    assert run(spark, rows) == brute(rows)
    assert max(met) <= 3


def test_one_of_each_takes_repeated_rows_once(spark):
    rows = [(1, "a b c d e f")] * 9 + [(2, "a b c d e f"), (None, "x y z u v w"), (None, "x y z u v w"), (4, " "), (4, " ")]
    got = J.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a b c d e f"), (4, " "), (4, " "), (None, "x y z u v w")]
    # the repeats go within each task, before rows are dealt
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftSemi") < plan.index("Aggregate [id")


def test_few_edges_need_few_rounds(spark, monkeypatch):
    # each round's plans weigh on the driver; a path of 400 nodes used to take nine tables
    tables = []
    monkeypatch.setattr(graph, "saved", lambda df, free=False, save=graph.saved: tables.append(1) or save(df, free))
    nodes = list(range(400))
    random.Random(3).shuffle(nodes)
    edges = list(zip(nodes, nodes[1:]))
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long").coalesce(1)).collect()}
    assert got == dict.fromkeys(nodes, 0)
    assert len(tables) <= 3


@pytest.mark.parametrize("chunk", [1, 7, 50])
def test_components_whose_edges_fill_many_chunks(spark, chunk):
    rng = random.Random(chunk)
    edges = [(rng.randrange(-150, 150), rng.randrange(-150, 150)) for _ in range(170)] + [(5, 5), (900, 900)] + [(999, k) for k in range(400, 460)]
    want = union_find({n for e in edges for n in e}, edges)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges * 2, "a long, b long"), chunk=chunk).collect()}
    assert got == want
