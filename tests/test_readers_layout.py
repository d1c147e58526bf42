"""Mixed folders, one-write conversion, partition reports, positions, drift plans."""

import os

from pyspark.sql import functions as F

from conftest import rows
from vigil.operators import drift as D
from vigil.operators import layout as P
from vigil.operators import profile as PF
from vigil.operators import quality as Q
from vigil.operators.ordered import _Dealt, global_position, lag_by_group, lag_pair_counts, position_by_cell
from vigil.sources import files as I


def put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_a_folder_of_mixed_logs(spark, tmp):
    folder = os.path.join(tmp, "logs")
    put(folder, "a.csv", "id,time,inference_of_emotion\n1,10:00:00,fear\n")
    put(folder, "b.csv", "id;time;inference_of_emotion\n2;11:00:00;sad\n")
    put(folder, "c.csv", "inference_of_emotion,id,time\nné,3,12:00:00\n", "latin-1")
    put(folder, "d.csv", " id ,note\n4,x\n")
    put(folder, "e.csv", "")
    put(folder, "f g.csv", "time|id|inference_of_emotion\n13:00:00|5|sad\n")
    got = I.read_log_csv(spark, folder)
    assert rows(got, "id", "time", "inference_of_emotion", "note") == [
        ("1", "10:00:00", "fear", None), ("2", "11:00:00", "sad", None), ("3", "12:00:00", "né", None), ("4", None, None, "x"), ("5", "13:00:00", "sad", None)]
    assert rows(I.read_log_csv(spark, os.path.join(folder, "b.csv"))) == [("2", "11:00:00", "sad")]


def jobs(spark, action):
    group = os.urandom(6).hex()
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_conversion_jobs_do_not_grow_with_files(spark, tmp):
    def folder_of(n):
        folder = os.path.join(tmp, f"in{n}")
        for i in range(n):
            put(folder, f"f {i}.csv", f"a,b\n{i},x\n{i},\n")
        put(folder, "only=header.csv", "a,c\n")
        put(folder, "other.csv", "c;d\n1;2\n")
        put(folder, "empty.csv", "")
        put(folder, "note.txt", "no,csv\n")
        return folder

    out = [os.path.join(tmp, f"out{n}") for n in (2, 20)]
    count = [jobs(spark, lambda n=n, o=o: I.convert_folder(spark, folder_of(n), o)) for n, o in zip((2, 20), out)]
    assert count[0] == count[1]
    names = sorted(os.listdir(out[0]))
    assert names == ["f 0.parquet", "f 1.parquet", "only=header.parquet", "other.parquet"]
    assert rows(spark.read.parquet(os.path.join(out[1], "f 7.parquet"))) == [(7, "x"), (7, None)]
    assert spark.read.parquet(os.path.join(out[0], "only=header.parquet")).columns == ["a", "c"]
    # again, over what is there
    again = I.convert_folder(spark, os.path.join(tmp, "in2"), out[0], infer=False, files=1)
    assert [os.path.basename(p) for p in again] == names
    assert rows(spark.read.parquet(again[1])) == [("1", "x"), ("1", None)]
    assert len([f for f in os.listdir(again[1]) if f.endswith(".parquet")]) == 1


def test_partition_reports_run_no_python(spark):
    df = spark.range(0, 100, numPartitions=7).where("id < 30")
    sizes = P.partition_sizes(df)
    assert "Python" not in sizes._jdf.queryExecution().toString() and "Arrow" not in sizes._jdf.queryExecution().toString()
    got = rows(sizes)
    assert [r[0] for r in got] == list(range(7)) and sum(r[1] for r in got) == 30 and got[-1][1] == 0
    assert rows(P.partition_sizes(df.repartition(3, "id").where("id = 5")))[0] is not None
    assert [r[1] for r in rows(P.partition_sizes(spark.range(0)))] in ([], [0], [0] * spark.range(0).rdd.getNumPartitions())
    five = [r[1] for r in rows(P.repartition_report(spark.range(3000), 5))]
    assert len(five) == 5 and sum(five) == 3000 and max(five) - min(five) <= spark.range(3000).rdd.getNumPartitions()


def test_text_and_schema_facts(spark):
    df = spark.createDataFrame([("a", "3", None, 1), ("é", None, None, None), ("", "x", None, 2)], "s string, n string, z string, i int")
    got = {r[0]: r[1:] for r in rows(PF.describe_text(df))}
    assert got["s"] == (3, None, None, "", "é", 0, 1) and got["n"][:2] == (2, 3.0) and got["z"][0] == 0
    assert PF.describe_text(df.select("i")).collect() == []
    assert rows(PF.schema_facts(df))[3] == (3, "i", "int", 3, 2)
    log = spark.createDataFrame([("1", None)], "id string, note string")
    assert rows(Q.column_diff_facts(log)) == [("extra", "note", 1, 0), ("missing", "inference_of_emotion", 1, 0), ("missing", "time", 1, 0)]
    assert Q.column_diff_facts(log.select("id"), ["id"]).collect() == []


def test_lag_deals_the_rows_once(spark, tmp):
    data = [(g, t, v) for g in ("a", "b", None) for t in range(40) for v in ("x", "y")] + [("a", 7, "x")] * 30
    path = os.path.join(tmp, "lag")
    spark.createDataFrame(data, "g string, t long, v string").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    bucket = F.floor(F.col("t") / 10)
    got = rows(lag_by_group(df, ["g"], ["t"], ["v"], bucket))
    want = []
    for g in ("a", "b", None):
        mine = sorted((t, v) for gg, t, v in data if gg == g)
        want += [(g, t, v, mine[i - 1][1] if i else None) for i, (t, v) in enumerate(mine)]
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    counts = lag_pair_counts(df, ["g"], ["t"], "v", bucket)
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = [line for line in plan.splitlines() if " Exchange " in line and "ReusedExchange" not in line]
    assert sum("REPARTITION_BY_COL" in line for line in exchanges) == 1 and "ReusedExchange" in plan, plan
    # the others: the count of equal rows, bucket edges by group, and pair counts (twice, and their sum)
    assert len(exchanges) <= 6 and plan.count("Scan parquet") == 1, plan
    assert _Dealt(df, ["g"], ["t"], ["v"], bucket).rows.where("_n > 1").first()["_n"] == 31


def test_positions_write_no_rows(spark, tmp):
    path = os.path.join(tmp, "pos")
    data = [(k % 17, f"r{k}") for k in range(500)] + [(3, "pile")] * 400 + [(None, "n")]
    spark.createDataFrame(data, "k int, v string").repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    for order in (["k"], ["v", "k"]):
        pos = global_position(df, order, out="p", partitions=9)
        got = sorted((r.p, *[(r[c] is not None, r[c] or 0) for c in order]) for r in pos.collect())
        assert [g[0] for g in got] == list(range(901)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    sizes = global_position(df, ["k"], out="p", partitions=9)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in sizes  # the rows come from the input, not from a checkpoint of them
    plain = [(r.p, r.v) for r in global_position(df, out="p").collect()]
    assert [v for _, v in sorted(plain)] == [r.v for r in df.collect()]
    cells = df.withColumn("f", F.col("k") % 3).withColumn("b", F.col("k") % 2).withColumn("at", F.monotonically_increasing_id()).where("k IS NOT NULL")
    got = position_by_cell(cells, ["f"], ["f", "b"], "at", "p").orderBy("f", "b", "at").collect()
    seen = {}
    for r in got:
        assert r.p == seen.get(r.f, 0)
        seen[r.f] = r.p + 1


def test_drift_reads_each_input_once_and_takes_many_labels(spark, tmp):
    a, b = os.path.join(tmp, "a"), os.path.join(tmp, "b")
    spark.range(200_000).select(F.concat(F.lit("label "), F.col("id").cast("string")).alias("inference_of_emotion")).write.parquet(a)
    spark.range(1000).select(F.when(F.col("id") % 2 == 0, "fear").otherwise("label 7").alias("inference_of_emotion")).write.parquet(b)
    aligned = D.aligned_counts(spark.read.parquet(a), spark.read.parquet(b))
    report = D.drift_report(spark.read.parquet(a), spark.read.parquet(b), names=("a", "b"))
    for df in (aligned, report):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" not in plan and "Window" not in plan  # what is left reads the checkpointed labels
    r = report.first()
    assert r.sizes.a_n == 200_000 and r.sizes.b_n == 1000 and abs(r.unknown_share.abs_drift - 0.5) < 1e-12
    shares = D.label_distribution(spark.read.parquet(a))
    assert shares.count() == 200_000 and abs(shares.agg(F.sum("share")).first()[0] - 1) < 1e-9
    assert "Window" not in shares._jdf.queryExecution().executedPlan().toString()
