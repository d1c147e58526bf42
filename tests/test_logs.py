from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from vigil.operators import logs as L
from vigil.operators.ordered import global_position, lag_by_group


def log(spark, data):
    df = spark.createDataFrame(data, "id string, ts string, inference string, class string")
    return df.select("id", F.to_timestamp("ts").alias("timestamp"), "inference", "class")


def test_previous_class_drops_first_row_per_id(spark):
    df = log(spark, [("solo", "2026-03-01 00:00:00", "Fear", "U"),
                     ("d", "2026-03-01 00:00:00", "Fear", "U"), ("d", "2026-03-01 00:01:00", "Calm", "S"),
                     ("d", "2026-03-01 00:02:00", "Fear", "U")])
    out = L.with_previous_class(df)
    assert rows(out, "id", "prev_class", "class") == [("d", "S", "U"), ("d", "U", "S")]


def test_equal_timestamps_break_on_inference(spark):
    df = log(spark, [("d", "2026-03-01 00:00:00", "B", "x"), ("d", "2026-03-01 00:00:00", "A", "y")])
    assert rows(L.with_previous_class(df), "prev_class", "class") == [("y", "x")]


def test_transition_rows_sum_to_one(spark):
    data = [("d%d" % (i % 3), "2026-03-01 00:%02d:00" % i, "L", "ABC"[(i * 7) % 3]) for i in range(60)]
    tm = L.transition_matrix(log(spark, data))
    sums = tm.groupBy("prev_class").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in sums)
    assert tm.agg(F.sum("n")).first()[0] == 57  # 60 rows, first row of 3 ids dropped


def test_lag_with_hot_key_matches_window(spark):
    # one id holds most rows; its windows are split by bucket
    data = [("hot" if i % 10 else "c%d" % (i % 7), i, "v%d" % (i % 4)) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, t long, v string")
    got = lag_by_group(df, ["g"], ["t"], ["v"], F.floor(F.col("t") / 50))
    want = df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("g").orderBy("t")))
    assert rows(got, "g", "t", "v", "prev_v") == rows(want, "g", "t", "v", "prev_v")


def test_lag_with_empty_partitions(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "g string, t long, v string")
    got = lag_by_group(df, ["g"], ["t"], ["v"], F.floor(F.col("t") / 50))
    assert rows(got, "t", "prev_v") == [(1, None), (2, "x")]


def test_global_position_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    pos = global_position(df, ["k"], out="p", partitions=9)
    assert [tuple(r) for r in pos.orderBy("k").select("k", "p").collect()] == [(i, i) for i in range(5000)]


def test_histogram_last_edge_in_last_bin(spark):
    df = log(spark, [("d", "2026-03-01 00:00:00", "A", "x"), ("d", "2026-03-01 00:00:50", "A", "x"),
                     ("d", "2026-03-01 00:01:40", "A", "y")])
    assert rows(L.timeline_histogram(df, 50), "bin", "class", "n") == [(0, "x", 1), (25, "x", 1), (49, "y", 1)]


def test_status_share_and_union(spark):
    df = log(spark, [("d", "2026-03-01 00:00:00", "A", "Unassigned"), ("d", "2026-03-02 00:00:00", "A", "x"),
                     ("e", "2026-03-02 00:00:00", "A", "x")])
    st = L.log_status(df).first()
    assert (st.rows, st.mapped) == (3, 2)
    assert rows(L.device_class_share(df, "d"), "class", "pct") == [("Unassigned", 50.0), ("x", 50.0)]
    u = L.union_logs([df.select("id", "timestamp"), df.select("id", "inference")])
    assert u.count() == 6 and set(u.columns) == {"id", "timestamp", "inference"}


def test_identical_copies_are_split_and_counted(spark):
    from vigil.operators.ordered import lag_pair_counts

    # a third of the rows are copies of one (group, time, value) row
    data = [("hot", 5, "x")] * 1500 + [("hot", i, "xy"[i % 2]) for i in range(1500) if i != 5] + \
           [("g%d" % (i % 5), i // 5, "yz"[i % 2]) for i in range(1500)]
    df = spark.createDataFrame(data, "g string, t long, v string")
    bucket = F.floor(F.col("t") / 100)
    got = lag_pair_counts(df, ["g"], ["t"], "v", bucket).filter("prev IS NOT NULL")
    want = (df.withColumn("prev", F.lag("v").over(Window.partitionBy("g").orderBy("t", "v")))
              .filter("prev IS NOT NULL").groupBy("prev", F.col("v").alias("cur")).agg(F.count("*").alias("n")))
    assert rows(got, "prev", "cur", "n") == rows(want, "prev", "cur", "n")
    each = lag_by_group(df, ["g"], ["t"], ["v"], bucket)
    assert each.count() == len(data)
    assert rows(each.filter("prev_v IS NOT NULL").groupBy("prev_v", "v").count(), "prev_v", "v", "count") == rows(want, "prev", "cur", "n")
    # a window holds one bucket of the hot group's distinct rows, not the group
    largest = df.distinct().groupBy("g", bucket.alias("b")).count().agg(F.max("count")).first()[0]
    assert largest <= 100


def test_copies_come_back_in_many_tasks(spark):
    n = 600_000  # equal rows, and one before them
    df = spark.range(n).select(F.lit("hot").alias("g"), F.lit(5).cast("long").alias("t"), F.lit("x").alias("v"))
    df = df.unionByName(spark.createDataFrame([("hot", 1, "y"), (None, 1, None), (None, 1, None)], "g string, t long, v string"))
    got = lag_by_group(df, ["g"], ["t"], ["v"], F.floor(F.col("t") / 100))
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == n + 3 and max(per_task) < .75 * n
    assert rows(got.groupBy("g", "t", "v", "prev_v").count()) == [("hot", 1, "y", None, 1), ("hot", 5, "x", "x", n - 1), ("hot", 5, "x", "y", 1), (None, 1, None, None, 2)]


def test_far_dates_and_null_times(spark):
    df = log(spark, [("d", "0001-01-01 00:00:00", "A", "x"), ("d", "9999-12-31 23:59:59", "B", "y"), ("d", None, "C", "z"),
                     (None, "2026-03-01 00:00:00", "A", "x"), (None, "2026-03-02 00:00:00", "A", "y")])
    assert rows(L.with_previous_class(df), "id", "prev_class", "class") == [("d", "x", "y"), ("d", "z", "x"), (None, "x", "y")]
    assert "Python" not in L.transition_matrix(df)._jdf.queryExecution().toString()


def test_lag_numeric_values_stay_null(spark):
    df = spark.createDataFrame([("a", 1, 1.5), ("a", 2, 2.5), ("b", 1, 7.0)], "g string, t long, v double")
    got = lag_by_group(df, ["g"], ["t"], ["v"], F.floor(F.col("t") / 50))
    assert rows(got, "g", "t", "prev_v") == [("a", 1, None), ("a", 2, 1.5), ("b", 1, None)]


def test_histogram_single_instant_and_empty_status(spark):
    df = log(spark, [("d", "2026-03-01 00:00:00", "A", "x"), ("e", "2026-03-01 00:00:00", "A", "y")])
    assert rows(L.timeline_histogram(df, 50), "bin", "class", "n") == [(0, "x", 1), (0, "y", 1)]
    st = L.log_status(df.filter(F.lit(False))).first()
    assert (st.rows, st.mapped, st.first_ts, st.last_ts) == (0, 0, None, None)
