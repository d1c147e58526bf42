"""Merkle manifest against a plain loop."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vigil.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, place int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves, fan=3):
    """(root, siblings of each leaf by level as (left, right))"""
    paths, level, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for k, q in enumerate(at):
            first = q - q % fan
            paths[k].append((level[first:q], level[q + 1:first + fan]))
        level = [H(*level[i:i + fan]) for i in range(0, len(level), fan)]
        at = [q // fan for q in at]
    return level[0], paths


def brute(rows):
    groups = {}
    for d, t, lang, src, n, *_ in rows:
        leaf = H(field(d), field(src), field(lang), field(n), field(t))
        cut = t is not None and d is not None and zlib.crc32(str(d).encode()) % 2 == 0
        shown = H(field(d), field(src), field(lang), field(n), field(t.replace("\n", ""))) if cut else leaf
        groups.setdefault(src, []).append((d, leaf, shown))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: tree([x[1] for x in groups[s]]) for s in names}
    root, ups = tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, ups):
        for (d, leaf, shown), path in zip(groups[s], trees[s][1]):
            fold, proof = shown, ""
            for left, right in path + up:
                fold, proof = H(*left, fold, *right), proof + "".join(left + right)
            out.append((d, leaf, trees[s][0], root, H(proof), fold, fold == root))
    return sorted(out, key=str)


def manifest(df):
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf, cut = (M.leaf_hash(*before, t) for t in (F.col("text"), F.translate("text", "\n", "")))
    change = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return M.merkle_manifest(df, leaf, F.when(change, cut).otherwise(leaf))


def rows(sizes):
    out = [(None, None, None, None, None, "z", 1), (None, "a\nb", "en", "s1", 3, "z", 1), (10**6, "é\n漢", None, "é", None, "z", 1), (5, "", "", "", 0, "z", 1)]
    for s, n in sizes.items():
        out += [(i * 13 % 1009, f"text {i}\nof {s}" if i % 3 else None, "en", s, i, "z", 1) for i in range(n)]
    return out + [(3, "same\n", "en", "s1", 5, "z", 1)] * 7


@pytest.mark.parametrize("hop", [1, 2, 6])
def test_manifest_is_the_plain_loop(spark, hop, monkeypatch):
    monkeypatch.setattr(M, "HOP", hop)
    monkeypatch.setattr(M, "BLOCK", 3**hop)
    monkeypatch.setattr(M.level_paths, "__defaults__", (3, hop))
    sizes = {"s1": 82, "s2": 27, "s3": 1, "S": 4} if hop < 6 else {"s1": 1500, "s2": 729, "s3": 730, "one": 1, "S": 3}
    given = rows(sizes)
    df = spark.createDataFrame(given, SCHEMA)
    got = [tuple(r) for r in manifest(df).collect()]
    assert sorted(got, key=str) == brute(given)
    assert {r[-1] for r in got} == {True, False}


def test_one_row_is_its_own_root(spark):
    r = manifest(spark.createDataFrame([(1, "a", "en", "s", 1, "z", 1)], SCHEMA)).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["verified"] and r["proof_sha256"] == H("")


def test_many_groups(spark):
    given = [(i, "x\n", "en", f"s{i:05d}", 1, "z", 1) for i in range(1000)]
    got = sorted(map(tuple, manifest(spark.createDataFrame(given, SCHEMA)).collect()), key=str)
    assert got == brute(given)


def test_limit_of_the_session_is_restored(spark):
    before = spark.conf.get(M.ROW_LIMIT)
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    manifest(spark.createDataFrame(rows({"s1": 3}), SCHEMA)).collect()
    assert spark.conf.get(M.ROW_LIMIT) == before
