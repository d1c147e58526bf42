"""Queries over harmonised inference logs (R dashboard side)."""

from __future__ import annotations

from vigil import adapters as A
from vigil.functions import scalars as X
from vigil.operators import logs as L
from vigil.plans.catalog import register
from vigil.plans.q_events import title_one
from vigil.plans.sql_inputs import HL, HLC, IL, SE, with_
from vigil.sources.files import harmonise_log

W = with_(SE, HL, HLC)
REF_DATE = "2026-03-01"
NOW = "2024-01-15 00:00:00"
DEVICE = "device_7"


def hlc(spark, d):
    return X.classify(A.harmonised_log(spark, d))


def il_harmonised(spark, d):
    return harmonise_log(A.inference_log(spark, d), ref_date=REF_DATE)


@register("classify", W + 'SELECT id, "timestamp", inference, "class" FROM hlc')
def q_classify(spark, d):
    return hlc(spark, d)


@register("class_distribution", W + 'SELECT "class", count(*) AS n FROM hlc GROUP BY 1')
def q_class_distribution(spark, d):
    return L.class_distribution(hlc(spark, d))


@register("daily_trend", W + 'SELECT CAST("timestamp" AS DATE) AS d, "class", count(*) AS n FROM hlc GROUP BY 1, 2')
def q_daily_trend(spark, d):
    return L.daily_trend(hlc(spark, d))


@register("activity_heatmap", W + '''SELECT CAST("timestamp" AS DATE) AS d, CAST(hour("timestamp") AS INTEGER) AS h,
count(*) AS n FROM hlc GROUP BY 1, 2''')
def q_activity_heatmap(spark, d):
    return L.activity_heatmap(hlc(spark, d))


@register("timeline_histogram", W + ''', b AS (SELECT epoch_us(min("timestamp")) AS lo, epoch_us(max("timestamp")) AS hi FROM hlc)
SELECT CAST(least(CASE WHEN hi = lo THEN 0 ELSE ((epoch_us("timestamp") - lo) * 50) // greatest(hi - lo, 1) END, 49)
            AS INTEGER) AS bin, "class", count(*) AS n
FROM hlc, b WHERE "timestamp" IS NOT NULL GROUP BY 1, 2''')
def q_timeline_histogram(spark, d):
    return L.timeline_histogram(hlc(spark, d), 50)


@register("log_status", W + '''SELECT count(*) AS "rows", count_if("class" <> 'Unassigned') AS mapped,
min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM hlc''')
def q_log_status(spark, d):
    return L.log_status(hlc(spark, d))


@register("device_ids", W + "SELECT DISTINCT id FROM hlc")
def q_device_ids(spark, d):
    return L.device_ids(hlc(spark, d))


@register("last_days", W + f'''SELECT id, "timestamp", inference, "class" FROM hlc
WHERE "timestamp" >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY''')
def q_last_days(spark, d):
    return X.last_days(hlc(spark, d), 7, NOW)


@register("for_device", W + f'''SELECT id, "timestamp", inference, "class" FROM hlc WHERE id = '{DEVICE}' ''')
def q_for_device(spark, d):
    return X.for_device(hlc(spark, d), DEVICE)


W1_SQL = '''SELECT id, "timestamp", prev_class, "class" FROM (
  SELECT id, "timestamp", "class", lag("class") OVER (PARTITION BY id ORDER BY "timestamp", inference) AS prev_class
  FROM hlc) t WHERE prev_class IS NOT NULL'''


@register("with_previous_class", W + W1_SQL)
def q_with_previous_class(spark, d):
    return L.with_previous_class(hlc(spark, d))


@register("transition_matrix", W + f''', p AS ({W1_SQL})
SELECT prev_class, "class", count(*) AS n,
       CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY prev_class) AS prob
FROM p GROUP BY 1, 2''')
def q_transition_matrix(spark, d):
    return L.transition_matrix(hlc(spark, d))


@register("device_class_share", W + f''', c AS (SELECT "class", count(*) AS n FROM hlc WHERE id = '{DEVICE}' GROUP BY 1)
SELECT "class", n, CAST(n AS DOUBLE) * 100.0::DOUBLE / sum(n) OVER () AS pct FROM c''')
def q_device_class_share(spark, d):
    return L.device_class_share(hlc(spark, d), DEVICE)


COLLAPSE = '''(SELECT count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) FROM {t})
              > (SELECT count(*) FROM {t}) * 0.9::DOUBLE'''

ILH_SQL = f'''SELECT CASE WHEN {COLLAPSE.format(t="il")} THEN 'Stream_1' ELSE id END AS id,
       coalesce(try_strptime(trim("time"), '%Y-%m-%dT%H:%M:%S.%f'), try_strptime(trim("time"), '%Y-%m-%d %H:%M'),
                try_strptime(trim("time"), '%d/%m/%Y %H:%M:%S'), try_strptime('{REF_DATE} ' || trim("time"), '%Y-%m-%d %H:%M:%S')) AS "timestamp",
       CASE WHEN inference_of_emotion IS NULL THEN NULL ELSE {title_one("inference_of_emotion")} END AS inference
FROM il'''


@register("harmonise_log", with_(IL) + ILH_SQL)
def q_harmonise_log(spark, d):
    """An inference log with a bare time column and counter ids, harmonised."""
    return il_harmonised(spark, d)


@register("collapse_counter_ids", W + f'''SELECT CASE WHEN {COLLAPSE.format(t="hl")} THEN 'Stream_1' ELSE id END AS id,
"timestamp", inference, CASE WHEN {COLLAPSE.format(t="hl")} THEN id END AS id_original FROM hl''')
def q_collapse_counter_ids(spark, d):
    return X.collapse_counter_ids(A.harmonised_log(spark, d))


@register("union_logs", with_(SE, HL, IL) + f''', ilh AS ({ILH_SQL})
SELECT id, "timestamp", inference FROM hl UNION ALL SELECT id, "timestamp", inference FROM ilh''')
def q_union_logs(spark, d):
    return L.union_logs([A.harmonised_log(spark, d), il_harmonised(spark, d)])
