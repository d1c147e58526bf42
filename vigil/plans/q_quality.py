"""Queries for validation (inference log) and drift (log vs danger events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import adapters as A
from vigil import constants as K
from vigil.functions import scalars as X
from vigil.operators import drift as D
from vigil.operators import quality as Q
from vigil.plans.catalog import register
from vigil.plans.sql_inputs import DANGER, HL, IL, SE, with_

VALID = ", ".join(f"'{x}'" for x in K.VALID_LABELS)


def canon(c: str) -> str:
    x = f"lower(trim(coalesce({c}, 'nan')))"
    return f"CASE WHEN {x} = 'surprised' THEN 'surprise' ELSE {x} END"


ILN = f"""iln AS (SELECT id, "time", {canon('inference_of_emotion')} AS inference_of_emotion FROM il)"""
WQ = with_(IL, ILN)


def iln(spark, d):
    return Q.normalize_log(A.inference_log(spark, d))


CHECKS_CTE = f""", a AS (SELECT count(*) >= 1 AS c_rows, count_if(id IS NULL) = 0 AS c_id,
  count_if("time" IS NULL) = 0 AS c_time, count_if(inference_of_emotion IS NULL) = 0 AS c_inf,
  count(id) = count(DISTINCT id) AS c_unique,
  count_if(NOT coalesce(inference_of_emotion IN ({VALID}), false)) = 0 AS c_labels FROM iln),
checks AS (
  SELECT 'schema_ok' AS "check", true AS ok
  UNION ALL SELECT 'row_count_nonzero', c_rows FROM a
  UNION ALL SELECT 'not_null_id', c_id FROM a
  UNION ALL SELECT 'not_null_time', c_time FROM a
  UNION ALL SELECT 'not_null_inference_of_emotion', c_inf FROM a
  UNION ALL SELECT 'id_unique', c_unique FROM a
  UNION ALL SELECT 'labels_valid', c_labels FROM a)
"""


@register("validation_checks", WQ + CHECKS_CTE + 'SELECT "check", ok FROM checks')
def q_validation_checks(spark, d):
    return Q.validation_checks(iln(spark, d))


@register("validation_verdict", WQ + CHECKS_CTE + """SELECT bool_and(ok) AS strict_ok,
coalesce(bool_and(CASE WHEN "check" IN ('schema_ok', 'labels_valid') THEN ok END), false)
  AND count_if("check" IN ('schema_ok', 'labels_valid')) = 2 AS lenient_ok FROM checks""")
def q_validation_verdict(spark, d):
    return Q.validation_verdict(Q.validation_checks(iln(spark, d)))


TIME_OK = " AND ".join(
    f"try_strptime(trim(\"time\"), '{f}') IS NULL" for f in
    ["%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y %H:%M:%S", "%m-%d-%Y %H:%M:%S",
     "%d/%m/%Y %H:%M:%S", "%d-%m-%Y %H:%M:%S", "%d.%m.%Y %H:%M:%S", "%H:%M:%S"])


@register("diagnostics", WQ + f""", a AS (SELECT count(*) AS n,
  count_if(NOT coalesce(inference_of_emotion IN ({VALID}), false)) AS inv,
  count_if({TIME_OK}) AS tu,
  count(*) - (count(DISTINCT id) + coalesce(max(CASE WHEN id IS NULL THEN 1 ELSE 0 END), 0)) AS dup,
  count_if(id IS NULL) AS n_id, count_if("time" IS NULL) AS n_time, count_if(inference_of_emotion IS NULL) AS n_inf
  FROM iln)
SELECT 'row_count' AS metric, CAST(n AS BIGINT) AS value FROM a
UNION ALL SELECT 'invalid_label_count', inv FROM a
UNION ALL SELECT 'time_unparseable_count', tu FROM a
UNION ALL SELECT 'duplicate_id_count', dup FROM a
UNION ALL SELECT 'null_id_count', n_id FROM a
UNION ALL SELECT 'null_time_count', n_time FROM a
UNION ALL SELECT 'null_inference_of_emotion_count', n_inf FROM a""")
def q_diagnostics(spark, d):
    return Q.diagnostics(iln(spark, d))


INVALID = f"SELECT id, \"time\", inference_of_emotion FROM iln WHERE NOT coalesce(inference_of_emotion IN ({VALID}), false)"


@register("invalid_labels", WQ + INVALID)
def q_invalid_labels(spark, d):
    return Q.invalid_labels(iln(spark, d))


@register("top_invalid_labels", WQ + f""", inv AS ({INVALID})
SELECT inference_of_emotion, count(*) AS count FROM inv GROUP BY 1 ORDER BY count DESC, inference_of_emotion LIMIT 20""")
def q_top_invalid_labels(spark, d):
    return Q.top_invalid_labels(iln(spark, d), 20)


@register("sample_invalid_rows", WQ + f""", inv AS ({INVALID})
SELECT * FROM inv ORDER BY TRY_CAST(id AS BIGINT), id LIMIT 15""")
def q_sample_invalid_rows(spark, d):
    return Q.sample_invalid_rows(iln(spark, d), 15, [F.col("id").try_cast("long"), F.col("id")])


@register("duplicate_ids", with_(SE, HL) + """SELECT id, count(*) - 1 AS extra_rows FROM hl GROUP BY id HAVING count(*) > 1""")
def q_duplicate_ids(spark, d):
    return Q.duplicate_ids(A.harmonised_log(spark, d))


# ---- drift: inference log (side a) vs emotions of danger events (side b) ----------------
NAMES = ("log", "events")


def alert_sql(text: str, **fields: str) -> str:
    """A fixed alert text as SQL, its fields replaced by SQL expressions."""
    out = "'" + text.replace("'", "''") + "'"
    for name, value in fields.items():
        out = f"replace({out}, '{{{name}}}', CAST({value} AS VARCHAR))"
    return out


def sides(spark, d):
    return A.inference_log(spark, d), X.danger(A.safety_events(spark, d))


def frames(spark, d):
    a, b = sides(spark, d)
    return D.drift_frames(a, b, "inference_of_emotion", "emotion", names=NAMES)


WD = with_(SE, IL) + f""", da AS (SELECT label, count(*) AS count FROM (SELECT {canon('inference_of_emotion')} AS label FROM il) GROUP BY 1),
db AS (SELECT label, count(*) AS count FROM (SELECT {canon('emotion')} AS label FROM se WHERE risk_level = '{DANGER}') GROUP BY 1),
das AS (SELECT label, count, CAST(count AS DOUBLE) / sum(count) OVER () AS share FROM da),
dbs AS (SELECT label, count, CAST(count AS DOUBLE) / sum(count) OVER () AS share FROM db),
al AS (SELECT coalesce(x.label, y.label) AS label, coalesce(x.count, 0) AS count_a, coalesce(y.count, 0) AS count_b,
              coalesce(x.share, 0.0) AS p, coalesce(y.share, 0.0) AS q
       FROM das x FULL OUTER JOIN dbs y ON x.label = y.label),
v AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(K.VALID_LABELS))}) t(label_order, label)),
dr AS (SELECT v.label, v.label_order, abs(coalesce(p, 0.0) - coalesce(q, 0.0)) AS abs_drift FROM v LEFT JOIN al ON v.label = al.label),
unk AS (SELECT 1.0 - coalesce(sum(CASE WHEN label IN ({VALID}) THEN p ELSE 0.0 END), 0.0) AS unknown_a,
               1.0 - coalesce(sum(CASE WHEN label IN ({VALID}) THEN q ELSE 0.0 END), 0.0) AS unknown_b FROM al),
unk2 AS (SELECT round(unknown_a, 12) AS unknown_a, round(unknown_b, 12) AS unknown_b,
                round(abs(unknown_a - unknown_b), 12) AS abs_drift FROM unk),
tt AS (SELECT sum(p + 1e-12) AS sp, sum(q + 1e-12) AS sq FROM al),
xx AS (SELECT (p + 1e-12) / sp AS pp, (q + 1e-12) / sq AS qq FROM al, tt),
js AS (SELECT round(0.5 * sum(pp * log2(pp / ((pp + qq) * 0.5))) + 0.5 * sum(qq * log2(qq / ((pp + qq) * 0.5))), 12)
              AS js_divergence FROM xx)
"""


@register("label_distribution", WD + "SELECT label, count, share FROM das")
def q_label_distribution(spark, d):
    return D.label_distribution(A.inference_log(spark, d))


@register("aligned_distributions", WD + "SELECT label, count_a, count_b, p, q FROM al")
def q_aligned_distributions(spark, d):
    return frames(spark, d)["aligned"]


@register("label_drift", WD + "SELECT label, label_order, abs_drift FROM dr")
def q_label_drift(spark, d):
    return frames(spark, d)["drift"]


@register("unknown_share", WD + "SELECT unknown_a, unknown_b, abs_drift FROM unk2")
def q_unknown_share(spark, d):
    return frames(spark, d)["unknown"]


@register("js_divergence", WD + "SELECT js_divergence FROM js")
def q_js_divergence(spark, d):
    return frames(spark, d)["js"]


@register("l1_distance", WD + "SELECT round(sum(abs(p - q)), 12) AS l1_distance FROM al")
def q_l1_distance(spark, d):
    return frames(spark, d)["l1"]


@register("drift_alerts", WD + f""", h AS (SELECT string_agg('''' || label || '''', ', ' ORDER BY label_order) AS hl,
                  count(*) AS hn FROM dr WHERE abs_drift > {K.DRIFT_PER_LABEL}::DOUBLE),
r AS (SELECT (SELECT sum(count) FROM da) AS na, (SELECT sum(count) FROM db) AS nb, hl, hn,
             (SELECT abs_drift FROM unk2) AS ud, (SELECT js_divergence FROM js) AS jsv FROM h),
al2 AS (
  SELECT 0 AS alert_index, CASE WHEN na < {K.DRIFT_MIN_ROWS} THEN {alert_sql(K.ALERT_FEW_ROWS, side=f"'{NAMES[0]}'", n="na")} END AS alert FROM r
  UNION ALL SELECT 1, CASE WHEN nb < {K.DRIFT_MIN_ROWS} THEN {alert_sql(K.ALERT_FEW_ROWS, side=f"'{NAMES[1]}'", n="nb")} END FROM r
  UNION ALL SELECT 2, CASE WHEN hn > 0 THEN {alert_sql(K.ALERT_LABELS, percent="'20%'", labels="hl")} END FROM r
  UNION ALL SELECT 3, CASE WHEN ud > {K.DRIFT_UNKNOWN}::DOUBLE THEN {alert_sql(K.ALERT_UNKNOWN)} END FROM r
  UNION ALL SELECT 4, CASE WHEN jsv > {K.DRIFT_JS}::DOUBLE THEN {alert_sql(K.ALERT_JS, js="printf('%.3f', jsv)", threshold="'0.100'")} END FROM r)
SELECT alert_index, alert FROM al2 WHERE alert IS NOT NULL""")
def q_drift_alerts(spark, d):
    return frames(spark, d)["alerts"]


@register("drift_report")
def q_drift_report(spark, d):
    """One-row drift report (sizes, counts, shares, metrics, alerts); rows check."""
    a, b = sides(spark, d)
    return D.drift_report(a, b, "inference_of_emotion", "emotion", names=NAMES)
