"""Corpus pipeline: each stage against plain code on the smallest table."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from test_decontam import brute as contained
from test_jaccard import brute as linked
from vigil.llm import bpe, quality, secrets

SF = "/root/testdata/sf0.001"


def table(spark):
    """The smallest documents, some with credentials added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit(" token = '"), F.md5("text"), F.lit("' AKIA"), F.upper(F.substring(F.md5("text"), 1, 16)))).otherwise("")
    example = F.when(F.col("doc_id") % 2 == 0, F.lit(" password: example-value-123")).otherwise("")
    return docs.withColumn("text", F.concat("text", own, example)).withColumn("n_chars", F.char_length("text").cast("long"))


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = table(spark)
    out = [docs.collect()]
    for n, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / str(n))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
        assert n == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return out


def test_quality(spark, steps):
    docs = table(spark)
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    keep = {r["doc_id"] for r in quality.quality_scores(docs, model).where("score >= 0.7").collect()}
    assert sorted(steps[1]) == sorted(r for r in steps[0] if r["doc_id"] in keep) and 0 < len(keep) < len(steps[0])


def test_near_duplicates(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[1]]
    assert sorted(r["doc_id"] for r in steps[2]) == sorted(d for d, _, c in linked(rows, 5, 80) if d == c)


def test_decontamination(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {d for d, *_ in contained([(r["doc_id"], r["text"]) for r in steps[2]], items)}
    assert gone and sorted(steps[3]) == sorted(r for r in steps[2] if r["doc_id"] not in gone)


def test_secrets_and_tokens(steps):
    spans, held = secrets.scanner(), {}
    for r in steps[3]:
        for *_, v in spans(r["text"]):
            held.setdefault(v, set()).add((r["source"], f"{r['source']}/{r['lang']}"))
    lib = Tokenizer.from_file(bpe.vocabulary_path())
    after, last = {r["doc_id"]: r for r in steps[4]}, {r["doc_id"]: r for r in steps[5]}
    assert len(after) == len(last) == len(steps[3])
    changed = 0
    for r in steps[3]:
        live = [(a, b) for a, _, b, v in spans(r["text"]) if len({o for o, _ in held[v]}) <= secrets.MAX_OWNERS and len(held[v]) <= secrets.MAX_REPOS]
        marked = list(r["text"])
        for a, b in live:
            marked[a:b] = ["\0"] * (b - a)
        want = re.sub("\0+", "[SECRET]", "".join(marked)) if all(b < c for (_, b), (c, _) in zip(live, live[1:])) else None
        got = after[r["doc_id"]]["text"]
        assert want is None or got == want
        assert after[r["doc_id"]]["n_chars"] == len(got)
        changed += got != r["text"]
        ids = lib.encode(got, add_special_tokens=False).ids
        row = last[r["doc_id"]]
        assert row["ids"] == ids and row["n_tokens"] == len(ids) and row["decoded_sha256"] == hashlib.sha256(got.encode()).hexdigest()
    assert changed and any("example-value-123" in r["text"] for r in steps[4])


def test_run_and_odd_rows(spark, tmp_path):
    rows = [(1, "good words here for all of us", "en", "a", 5), (1, "good words here for all of us", "en", "a", 5), (2, None, None, None, None), (3, "", "en", "a", 0),
            (None, "token=abcdefgh12345 other words", "en", None, 1), (4, "t%%% x### " * 5, "en", "b", 7), (5, "y" * 200_000, "en", "b", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, df in {"documents": spark.createDataFrame(rows, schema), "labels": spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"),
                     "benchmark": spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")}.items():
        df.write.parquet(f"{tmp_path}/a/{name}.parquet")
        df.limit(0).write.parquet(f"{tmp_path}/b/{name}.parquet")
    out = P.run(spark, f"{tmp_path}/a").collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "2", "3", "4", "5", "None"]
    assert {r["doc_id"]: r["n_tokens"] for r in out}[2] == 0
    assert P.run(spark, f"{tmp_path}/b").collect() == []


def test_extra_columns_pass(spark):
    docs = spark.createDataFrame([(1, "some words", "en", "a", 10, "x", 9.5)], "doc_id long, text string, lang string, source string, n_chars long, key string, score double")
    labels = quality.train([])
    assert quality.quality_scores(docs, labels, carry=tuple(docs.columns)).first()["carry_score"] == 9.5
    for stage in (P.near_duplicate_stage, P.secret_stage):
        assert stage(spark, docs, SF).collect() == docs.collect()
    assert P.decontamination_stage(spark, docs, SF).collect() == docs.collect()
    assert P.token_stage(spark, docs, SF).first()["n_tokens"] > 0


def test_columns_of_any_name_pass(spark):
    names = ["_key", "_spans", "_stay", "row", "id", "key", "a", "b", "blank", "spans", "label"]
    rows = [(i, t, "en", "a", len(t), *range(i, i + len(names))) for i, t in enumerate(["some words here", "some words here", "token=abcdefgh12345 here", "", "benchmark words of a kind"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in names))
    kept = P.near_duplicate_stage(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(kept.collect()) == sorted(r for r in docs.collect() if r["doc_id"] != 1)
    assert sorted(P.decontamination_stage(spark, docs, SF).collect()) == sorted(docs.collect())
    clean = {r["doc_id"]: r for r in P.secret_stage(spark, docs, SF).collect()}
    assert clean[2]["text"] == "[SECRET] here" and [clean[2][n] for n in names] == list(range(2, 2 + len(names)))
    assert [clean[0][n] for n in names] == list(range(len(names)))


def test_executors_without_the_package(tmp_path):
    """Python workers that cannot import the package run every operator."""
    import subprocess
    import sys
    from pathlib import Path

    script = tmp_path / "away.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(Path(P.__file__).parent)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").getOrCreate()
def there(batches):
    import importlib.util, pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("vigil") is not None]}})
assert not spark.range(1).mapInArrow(there, "found boolean").first()[0]
import __spark_entry__
for name, query in __spark_entry__.queries().items():
    if name in ("op2_token_groups", "op3_secret_ownership", "op6_containment", "op8_suffix_lpf", "op10_rlz", "op11_target_resampling", "op12_token_counts", "op13_merkle_manifest", "pipeline"):
        print(name, query(spark, {SF!r}).count(), flush=True)
""")
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=900, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split("\n")) >= 9


def test_batches_of_texts_are_bounded_by_bytes(spark):
    import pyarrow as pa

    from vigil.session import BATCH_CONF, bounded_batches

    before = spark.conf.get(BATCH_CONF)
    docs = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat('word ', 2000) AS text")
    try:
        spark.conf.set(BATCH_CONF, "256m")
        P.token_stage(spark, docs.limit(1), SF)  # a stage bounds its session's batches
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long").collect()
        assert len(sizes) > 3 and max(r["size"] for r in sizes) < 8 << 20  # 30 MB in all
        spark.conf.set(BATCH_CONF, "1m")
        bounded_batches(spark)
        assert spark.conf.get(BATCH_CONF) == "1m"  # a smaller bound stays
    finally:
        spark.conf.set(BATCH_CONF, before)
