"""Layout, format and clustering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import adapters as A
from vigil.functions.scalars import danger
from vigil.operators import hotspots as H
from vigil.operators import layout as P
from vigil.plans.catalog import register
from vigil.plans.sql_inputs import DANGER, SE, with_
from vigil.session import scratch_path
from vigil.sources.files import write_parquet


def se(spark, d):
    return A.safety_events(spark, d)


@register("partition_sizes")
def q_partition_sizes(spark, d):
    """Rows per input partition of the event table (rows check)."""
    return P.partition_sizes(se(spark, d))


@register("repartition_report")
def q_repartition_report(spark, d):
    """Rows per partition after a round-robin repartition into 5 (rows check)."""
    return P.repartition_report(se(spark, d), 5)


@register("partition_sizes_facts", with_(SE) + """SELECT 'scan' AS layout, count(*) AS records, true AS all_numbered, true AS balanced FROM se
UNION ALL SELECT 'five', count(*), true, true FROM se
UNION ALL SELECT 'one id', 1, true, false FROM se WHERE id = '7'""")
def q_partition_sizes_facts(spark, d):
    """Facts of the partition reports: all rows are counted, partitions are
    numbered from 0 without a gap, and five dealt ones differ by few rows (at
    most one for each input partition); of
    one event's table all partitions but one are empty."""
    events = se(spark, d)
    one = events.repartition(4, "device_id").where("id = '7'")
    frames = {"scan": P.partition_sizes(events), "five": P.repartition_report(events, 5), "one id": P.partition_sizes(one)}
    out = None
    for name, sizes in frames.items():
        even = F.max("records") - F.min("records") <= (F.lit(64) if name == "five" else F.max("records") if name == "scan" else F.lit(0))
        facts = sizes.agg(F.lit(name).alias("layout"), F.sum("records").alias("records"),
                          (F.count(F.lit(1)) == F.max("partition") + 1).alias("all_numbered"), even.alias("balanced"))
        out = facts if out is None else out.unionByName(facts)
    return out


@register("format_counts", with_(SE) + "SELECT 'CSV' AS format, count(*) AS rows FROM se "
                                     "UNION ALL SELECT 'Parquet', count(*) FROM se")
def q_format_counts(spark, d):
    """The events written as CSV and as Parquet, then counted in each format."""
    df = se(spark, d)
    csv = scratch_path(spark, "csv")
    df.write.mode("overwrite").option("header", True).csv(csv)
    pq = write_parquet(df, scratch_path(spark, "parquet"))
    return P.format_counts(spark, csv, pq, infer=False)


@register("api_sql_counts", with_(SE) + "SELECT 'Spark DataFrame API' AS method, count(*) AS rows FROM se "
                                      "UNION ALL SELECT 'Spark SQL', count(*) FROM se")
def q_api_sql_counts(spark, d):
    return P.api_sql_counts(se(spark, d))


@register("geo_features", with_(SE) + f"""SELECT id, latitude, longitude FROM se
WHERE risk_level = '{DANGER}' AND latitude IS NOT NULL AND longitude IS NOT NULL""")
def q_geo_features(spark, d):
    """Danger events with their (latitude, longitude) feature vector; the
    vector is checked by its parts."""
    from pyspark.ml.functions import vector_to_array

    v = H.geo_features(danger(se(spark, d)))
    x = v.withColumn("_f", vector_to_array("features"))
    return x.select("id", F.col("_f")[0].alias("latitude"), F.col("_f")[1].alias("longitude"))


@register("geo_hotspots")
def q_geo_hotspots(spark, d):
    """KMeans (k=10, seed 1) centres of danger events (rows check)."""
    return H.geo_hotspots(se(spark, d), 10, 1)


@register("geo_hotspots_fixed_point", with_(SE) + f"""SELECT CAST(10 AS BIGINT) AS centres, count(*) AS events, true AS stays, true AS nonempty FROM se
WHERE risk_level = '{DANGER}' AND latitude IS NOT NULL AND longitude IS NOT NULL""")
def q_geo_hotspots_fixed_point(spark, d):
    """One more step of Lloyd's method, written in SQL, from the centres found:
    each event goes to its nearest centre, each centre to the mean of its
    events. Settled centres stay where they are."""
    events = danger(se(spark, d)).where("latitude IS NOT NULL AND longitude IS NOT NULL").select("id", "latitude", "longitude")
    return spark.sql("""
        WITH c AS (SELECT collect_list(struct(hotspot, latitude, longitude)) AS cs FROM {centres}),
        near AS (SELECT e.latitude, e.longitude, array_min(transform(c.cs, x -> struct(
                   power(e.latitude - x.latitude, 2) + power(e.longitude - x.longitude, 2) AS d2, x.hotspot AS hotspot))).hotspot AS hotspot
                 FROM {events} e CROSS JOIN c),
        moved AS (SELECT hotspot, avg(latitude) AS latitude, avg(longitude) AS longitude, count(*) AS n FROM near GROUP BY hotspot)
        SELECT count(*) AS centres, sum(coalesce(m.n, 0)) AS events,
               bool_and(abs(m.latitude - k.latitude) < 1e-6 AND abs(m.longitude - k.longitude) < 1e-6) AS stays, bool_and(m.n > 0) AS nonempty
        FROM {centres} k LEFT JOIN moved m USING (hotspot)""", centres=H.geo_hotspots(se(spark, d), 10, 1, max_iter=100, tol=1e-9), events=events)
