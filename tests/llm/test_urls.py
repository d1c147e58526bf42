"""Temporal URL lists against a plain per-capture reading."""

import random
from datetime import date, datetime, timedelta

from vigil.llm import urls as U

D0 = date(2024, 1, 1)


def active(entries, pattern, lst, day):
    seen = {}
    for l, p, a, d in entries:
        if l == lst and p == pattern and a in ("add", "remove") and d and d <= day:
            seen[d] = seen.get(d, False) or a == "add"
    return bool(seen) and seen[max(seen)]


def keys(host, path):
    labels, seg = host.split("."), [s for s in path.split("/") if s]
    return [".".join(labels[i:]) for i in range(len(labels))] + [host + "/" + "/".join(seg[:i]) for i in range(1, len(seg) + 1)]


def test_against_brute_force(spark):
    r = random.Random(5)
    hosts, paths = ["a.example.com", "example.com", "b.org", "x.y.b.org"], ["", "/", "/p", "/p/q", "/q//p"]
    pats = ["example.com", "b.org", "y.b.org", "a.example.com/p", "b.org/p/q", "com", "b.org/q"]
    entries = [(r.choice(["ads", "allow", "mal"]), r.choice(pats), r.choice(["add", "remove", "add", "other"]), D0 + timedelta(r.randint(0, 20))) for _ in range(80)]
    entries += [(None, "b.org", "add", D0), ("ads", None, "add", D0), ("ads", "b.org", None, D0), ("ads", "b.org", "add", None)] + entries[:5]
    caps = [(i, r.choice(hosts), r.choice(paths), D0 + timedelta(r.randint(-2, 22))) for i in range(150)]
    rows = [(i, f"HTTPS://u@{h.upper()}{'.' if i % 3 == 0 else ''}:8080{p}?x=/z", datetime(d.year, d.month, d.day, 23, 59), "k") for i, h, p, d in caps]
    rows += [(900, None, datetime(2024, 1, 5), "k"), (901, "http://b.org/", None, "k"), (902, "no url", datetime(2024, 1, 5), "k"), (None, "", datetime(2024, 1, 5), "k"), rows[0]]
    got = U.judge_captures(spark.createDataFrame(rows, "page_id long, url string, at timestamp, lists string"),
                           spark.createDataFrame(entries, "list string, pattern string, action string, entry_date date"), "page_id", "url", "at").collect()
    assert len(got) == len(rows)
    by = {x["id"]: x for x in got}
    for i, h, p, d in caps:
        lists = sorted({l for l in ("ads", "allow", "mal") for k in keys(h, p) if active(entries, k, l, d)})
        assert (by[i]["lists"], by[i]["allowed"], by[i]["blocked"]) == (",".join(lists), "allow" in lists, bool(set(lists) - {"allow"}) and "allow" not in lists), (i, h, p, d)
    assert all(by[i]["lists"] == "" and not by[i]["blocked"] and not by[i]["allowed"] for i in (900, 901, 902, None))


def test_intervals(spark):
    e = [("l", "p", "add", D0), ("l", "p", "add", D0 + timedelta(1)), ("l", "p", "remove", D0 + timedelta(3)), ("l", "p", "remove", D0 + timedelta(4)), ("l", "p", "add", D0 + timedelta(9))]
    out = sorted((r["valid_from"], r["valid_to"]) for r in U.validity_intervals(spark.createDataFrame(e, "list string, pattern string, action string, entry_date date")).collect())
    assert out == [(D0, D0 + timedelta(3)), (D0 + timedelta(9), None)]


def test_empty(spark):
    caps = spark.createDataFrame([(1, "http://b.org/", datetime(2024, 1, 5))], "page_id long, url string, at timestamp")
    none = spark.createDataFrame([], "list string, pattern string, action string, entry_date date")
    out = U.judge_captures(caps, none, "page_id", "url", "at").collect()
    assert [(r["lists"], r["blocked"]) for r in out] == [("", False)]
    assert U.judge_captures(caps.limit(0), none, "page_id", "url", "at").collect() == []


def test_patterns_are_read_like_urls(spark):
    patterns = ["Example.com", "example.com.", "example.com:443", "u@example.com", "EXAMPLE.com:80//a/", "example.com/a/b/", "example.com/A", "example.com/a?x", "http://example.com", "other.org"]
    caps = spark.createDataFrame([(1, "https://Example.COM.:8080/a//b/c", datetime(2024, 1, 5))], "page_id long, url string, at timestamp")
    entries = spark.createDataFrame([(f"l{i}", p, "add", D0) for i, p in enumerate(patterns)], "list string, pattern string, action string, entry_date date")
    assert U.judge_captures(caps, entries, "page_id", "url", "at").collect()[0]["lists"] == "l0,l1,l2,l3,l4,l5"
    # two spellings are one pattern
    both = spark.createDataFrame([("l", "Example.com", "add", D0), ("l", "example.com.", "remove", D0 + timedelta(2))], entries.schema)
    assert [tuple(r) for r in U.validity_intervals(both).collect()] == [("l", "example.com", D0, D0 + timedelta(2))]
