"""Queries over corpus listings, training tables and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import adapters as A
from vigil import constants as K
from vigil.operators import corpus as M
from vigil.plans.catalog import register
from vigil.plans.sql_inputs import CP, PR, SE, with_

ROOT = "/corpus"
WC = with_(CP) + """, pp AS (
  SELECT path, string_split(path, '/') AS full_parts,
         string_split(substr(path, 9), '/') AS rel FROM cp),
px AS (SELECT path, full_parts, CASE WHEN len(rel) >= 2 THEN rel[1] END AS scheme, len(rel) AS depth,
              full_parts[-1] AS base, full_parts[-2] AS parent FROM pp)
"""


def case_map(expr: str, mapping: dict, quote_values: bool = True) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN " + (f"'{v}'" if quote_values else str(v)) for k, v in mapping.items())
    return f"(CASE {whens} END)"


def rule(scheme: str, flat: bool) -> str:
    c = f"scheme = '{scheme}'"
    if flat:
        c += " AND depth = 2"
    return c + " AND suffix(base, '.wav')"


RAV = "CASE WHEN len(string_split(base, '-')) >= 3 THEN string_split(base, '-')[3] END"
CRE = "CASE WHEN len(string_split(base, '_')) >= 3 THEN string_split(base, '_')[3] END"
TESS_W = "lower(split_part(string_split(base, '_')[-1], '.', 1))"
SAV = "CASE WHEN substr(base, 2, 1) IN ('a', 'u') THEN substr(base, 1, 2) ELSE substr(base, 1, 1) END"

M1_LABEL = f"""CASE WHEN {rule('ravdess', False)} THEN {case_map(RAV, K.RAVDESS_LABELS)}
  WHEN {rule('cremad', True)} THEN {case_map(CRE, K.CREMAD_LABELS)}
  WHEN {rule('tess', False)} THEN coalesce({case_map(TESS_W, K.TESS_RENAMES)}, {TESS_W})
  WHEN {rule('savee', True)} THEN {case_map(SAV, K.SAVEE_LABELS)} END"""

M1_SQL = f""", m1 AS (SELECT path, {M1_LABEL} AS l0 FROM px),
manifest AS (SELECT path, coalesce({case_map('l0', K.FINAL_LABEL_RENAMES)}, l0) AS label FROM m1 WHERE l0 IS NOT NULL)
"""


def cp(spark, d):
    return A.corpus_paths(spark, d, ROOT)


def manifest(spark, d):
    return M.corpus_manifest(cp(spark, d), ROOT)


@register("corpus_manifest", WC + M1_SQL + "SELECT path, label FROM manifest")
def q_corpus_manifest(spark, d):
    return manifest(spark, d)


TESS_BIN = ("CASE WHEN contains(lower(base), 'angry') OR contains(lower(base), 'fear') THEN 1 "
            "WHEN contains(lower(base), 'neutral') OR contains(lower(base), 'happy') THEN 0 END")


@register("corpus_manifest_binary", WC + f""", m2 AS (SELECT path, CAST(CASE
  WHEN {rule('ravdess', False)} THEN {case_map(RAV, K.RAVDESS_BINARY, False)}
  WHEN {rule('tess', False)} THEN {TESS_BIN}
  WHEN {rule('savee', True)} THEN {case_map(SAV, K.SAVEE_BINARY, False)}
  WHEN {rule('cremad', True)} THEN {case_map(CRE, K.CREMAD_BINARY, False)} END AS INTEGER) AS label FROM px)
SELECT path, label FROM m2 WHERE label IN (0, 1)""")
def q_corpus_manifest_binary(spark, d):
    return M.corpus_manifest_binary(cp(spark, d), ROOT)


SAFETY = "CASE " + " ".join(
    f"WHEN contains(lower(coalesce(parent, '')), '{e}') OR contains(lower(base), '{e}') THEN {c}"
    for e, c in K.SAFETY_CLASS_ORDER) + " END"


@register("corpus_manifest_safety", WC + f""", m3 AS (SELECT path, CAST({SAFETY} AS INTEGER) AS label FROM px
WHERE suffix(path, '.wav'))
SELECT path, label FROM m3 WHERE label IS NOT NULL""")
def q_corpus_manifest_safety(spark, d):
    return M.corpus_manifest_safety(cp(spark, d))


@register("encode_labels", WC + M1_SQL + """, codes AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER)
  AS label_id FROM (SELECT DISTINCT label FROM manifest))
SELECT m.label, m.path, c.label_id FROM manifest m LEFT JOIN codes c ON m.label = c.label""")
def q_encode_labels(spark, d):
    return M.encode_labels(manifest(spark, d))


@register("class_balance", WC + M1_SQL + "SELECT label, count(*) AS files FROM manifest GROUP BY label")
def q_class_balance(spark, d):
    return M.class_balance(manifest(spark, d))


@register("stratified_split")
def q_stratified_split(spark, d):
    """80/20 split of the binary manifest, stratified by label (rows check)."""
    return M.stratified_split(M.corpus_manifest_binary(cp(spark, d), ROOT), 0.2, 42)


@register("augment_minority")
def q_augment_minority(spark, d):
    """Unsafe clips (embedding label 1) get a noisy copy (rows check)."""
    sig = A.signals(spark, d).join(
        A.table(spark, d, "embeddings").select(F.col("vec_id").alias("clip_id"), "label"), on="clip_id")
    out = M.augment_minority(sig.withColumn("label", (F.col("label") == 1).cast("int")), seed=42)
    return out.select("clip_id", "label", "variant", F.size("samples").alias("n"),
                      F.aggregate("samples", F.lit(0.0), lambda a, x: a + x * x).alias("energy"))


FEATURES = ["confidence", "latitude", "longitude"]
TRAIN_BEFORE = "2024-01-10 00:00:00"


@register("scale_features", with_(SE) + f""", st AS (SELECT {", ".join(f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in FEATURES)}
  FROM se WHERE "timestamp" < TIMESTAMP '{TRAIN_BEFORE}')
SELECT id, {", ".join(f"round(({c} - {c}_mean) / CASE WHEN {c}_std = 0 THEN 1.0 ELSE {c}_std END, 9) AS {c}_scaled" for c in FEATURES)}
FROM se, st""")
def q_scale_features(spark, d):
    """Standardise features with statistics fitted on the earlier events only."""
    se = A.safety_events(spark, d)
    stats = M.fit_scaler(se.filter(F.col("timestamp") < F.lit(TRAIN_BEFORE).cast("timestamp")), FEATURES)
    out = M.scale(se, stats, FEATURES)
    return out.select("id", *[F.round(c + "_scaled", 9).alias(c + "_scaled") for c in FEATURES])


@register("evaluate_predictions", with_(PR) + """SELECT avg(CAST(prediction = label AS DOUBLE)) AS accuracy,
CASE WHEN count_if(label = 1) = 0 THEN NULL
     ELSE CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) / count_if(label = 1) END AS recall,
count(*) AS n FROM pr""")
def q_evaluate_predictions(spark, d):
    return M.evaluate_predictions(A.predictions(spark, d))


@register("corpus_log", with_(CP) + """, w AS (
  SELECT path, string_split(path, '/') AS parts FROM cp WHERE suffix(lower(path), '.wav')),
k AS (SELECT path, parts, list_concat(list_transform(parts[1:len(parts) - 1], lambda x: '1' || x),
                                    ['0' || parts[-1]]) AS key FROM w),
r AS (SELECT path, parts, row_number() OVER (ORDER BY key, path) AS id FROM k)
SELECT id, strftime(TIMESTAMP '1900-01-01 09:00:00' + to_seconds(CAST((id - 1) * 3 AS BIGINT)), '%H:%M:%S') AS "time",
       string_split(parts[-2], '_')[-1] AS inference_of_emotion FROM r""")
def q_corpus_log(spark, d):
    return M.corpus_log(cp(spark, d))
