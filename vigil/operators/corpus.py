"""Labelled manifests of audio corpora and training-set table work
(M1-M9, A23, U3).

Input: a DataFrame with a ``path`` column (a listing from
``vigil.sources.files.list_corpus`` or any table of paths). Labels come
from file and folder names by the four naming schemes, as column
expressions in one pass over the listing: the four corpora are one union
by construction (U3), without four scans. Ordering operators (global file
order, stratified split) use the range-partitioned helpers of
``vigil.operators.ordered`` instead of a single-partition window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.operators.ordered import global_position


def _lookup(mapping: Mapping, key: Column) -> Column:
    """Fixed small table lookup as a CASE chain (null when the key is absent)."""
    items = list(mapping.items())
    out = F.when(key == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        out = out.when(key == F.lit(k), F.lit(v))  # one flat CASE, not nested ones
    return out


def _present(label: Column, name: str = "label") -> Column:
    """Rows with a null label vanish through a generator, not a Filter: a
    filter on the derived label would be pushed down through the name
    parsing with every column reference expanded in place."""
    return F.explode(F.array_compact(F.array(label))).alias(name)


SCHEMES = ["ravdess", "cremad", "tess", "savee"]


def path_parts(df: DataFrame, root: str | None = None, path: str = "path") -> DataFrame:
    """scheme (first folder below ``root``; without a root, the first folder
    named after one of the four corpora), depth below it, file and parent names."""
    p = F.col(path)
    full = F.split(p, "/")
    if root is not None:
        root = root.rstrip("/") + "/"
        rel = F.when(p.startswith(root), F.substring(p, len(root) + 1, 1 << 30))
        parts = F.split(rel, "/")
    else:
        at = F.array_position(F.transform(full, lambda x: x.isin(*SCHEMES)), F.lit(True))  # 1-based, 0 if none
        parts = F.when(at > 0, F.slice(full, F.greatest(at, F.lit(1)), F.size(full)))
    return df.withColumns({
        "_scheme": F.when(F.size(parts) >= 2, F.get(parts, 0)),
        "_depth": F.size(parts),
        "_base": F.element_at(full, -1),
        "_parent": F.try_element_at(full, F.lit(-2)),
    })


def _tess_word(base: Column) -> Column:
    last = F.element_at(F.split(base, "_"), -1)
    return F.lower(F.get(F.split(last, r"\."), 0))


def _savee_code(base: Column) -> Column:
    two = F.substring(base, 2, 1).isin("a", "u")
    return F.when(two, F.substring(base, 1, 2)).otherwise(F.substring(base, 1, 1))


def _field(base: Column, sep: str, i: int) -> Column:
    """i-th (0-based) field of ``base`` split on ``sep``; null when missing."""
    return F.get(F.split(base, sep), i)


def _scheme_rule(scheme: str, flat: bool) -> Column:
    c = F.col("_scheme") == F.lit(scheme)
    if flat:
        c = c & (F.col("_depth") == F.lit(2))
    return c & F.col("_base").endswith(".wav")


def _scheme_fields(paths: DataFrame, root: str | None) -> DataFrame:
    """One column per naming-scheme field, so the label rules below refer to
    plain columns (keeps the generated code small)."""
    x = path_parts(paths, root)
    base = F.col("_base")
    x = x.withColumns({
        "_rav": F.when(_scheme_rule("ravdess", False), F.when(F.size(F.split(base, "-")) >= 3, _field(base, "-", 2))),
        "_cre": F.when(_scheme_rule("cremad", True), _field(base, "_", 2)),
        "_tess": F.when(_scheme_rule("tess", False), _tess_word(base)),
        "_sav": F.when(_scheme_rule("savee", True), _savee_code(base)),
        "_low": F.when(_scheme_rule("tess", False), F.lower(base)),
    })
    return x.select("path", "_rav", "_cre", "_tess", "_sav", "_low")


# M1 / U3
def corpus_manifest(paths: DataFrame, root: str | None = None) -> DataFrame:
    """(path, label) over the four corpora; unmatched files dropped (TESS is
    always kept, as in the reference), then fearful -> fear, calm -> neutral."""
    x = _scheme_fields(paths, root)
    tess = F.coalesce(_lookup(K.TESS_RENAMES, F.col("_tess")), F.col("_tess"))
    label = F.coalesce(_lookup(K.RAVDESS_LABELS, F.col("_rav")), _lookup(K.CREMAD_LABELS, F.col("_cre")),
                       tess, _lookup(K.SAVEE_LABELS, F.col("_sav")))
    y = x.select("path", _present(label, "_l"))
    final = F.coalesce(_lookup(K.FINAL_LABEL_RENAMES, F.col("_l")), F.col("_l"))
    return y.select("path", final.alias("label"))


# M2
def corpus_manifest_binary(paths: DataFrame, root: str | None = None) -> DataFrame:
    """(path, label) with 1 = unsafe, 0 = safe; every other file dropped."""
    x = _scheme_fields(paths, root)
    low = F.col("_low")
    tess = (F.when(F.exists(F.array(*[F.lit(w) for w in K.TESS_BINARY_UNSAFE]), lambda w: F.instr(low, w) > 0), F.lit(1))
            .when(F.exists(F.array(*[F.lit(w) for w in K.TESS_BINARY_SAFE]), lambda w: F.instr(low, w) > 0), F.lit(0)))
    label = F.coalesce(_lookup(K.RAVDESS_BINARY, F.col("_rav")), tess, _lookup(K.SAVEE_BINARY, F.col("_sav")),
                       _lookup(K.CREMAD_BINARY, F.col("_cre")))
    keep = F.when(label.isin(0, 1), label.cast("int"))
    return x.select("path", _present(keep))


# M3
def corpus_manifest_safety(paths: DataFrame) -> DataFrame:
    """(path, label) 0 safe / 1 danger / 2 caution: the first emotion name,
    in map order, found in the folder or file name (lower case)."""
    full = F.split(F.col("path"), "/")
    base, parent = F.lower(F.element_at(full, -1)), F.lower(F.try_element_at(full, F.lit(-2)))
    out = None
    for emotion, cls in K.SAFETY_CLASS_ORDER:  # first match in map order wins
        hit = (F.instr(F.coalesce(parent, F.lit("")), emotion) > 0) | (F.instr(base, emotion) > 0)
        out = F.when(hit, F.lit(cls)) if out is None else out.when(hit, F.lit(cls))
    wav = F.col("path").endswith(".wav")
    return paths.select("path", _present(F.when(wav, out)))


# M4
def encode_labels(df: DataFrame, label: str = "label", out: str = "label_id") -> DataFrame:
    """label -> 0-based id in alphabetical order: the distinct labels get
    their position in sorted order (a range-partitioned ranking, no single
    task), and the code table goes back to the rows by a join that Spark
    broadcasts if its bytes are few."""
    codes = df.select(label).distinct().filter(F.col(label).isNotNull())
    codes = global_position(codes, [label], out="_pos").select(label, F.col("_pos").cast("int").alias(out))
    return df.join(codes, on=label, how="left")


# A23
def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("files"))


# M5
def stratified_split(df: DataFrame, test_share: float = 0.2, seed: int = 42, label: str = "label",
                     key: str = "path") -> DataFrame:
    """Repeatable split with round(test_share * n) rows of every label in
    'test': the rows with the smallest seeded hashes of their key.

    No order over the table is needed: rows are counted per label and bucket
    of the hash (the top 12 bits), the bucket where the cut falls is found from
    those counts, and only the rows of that bucket are ranked."""
    h = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))).withColumn("_b", F.shiftright(F.col("_h"), 52))
    counts = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # <= 4096 rows a label
    everything = Window.partitionBy(label)
    cuts = counts.select(label, "_b", "_n", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"),
                         F.floor(F.sum("_n").over(everything) * F.lit(float(test_share)) + F.lit(0.5)).alias("_k"))
    cuts = cuts.select(F.col(label).alias("_l"), F.col("_b").alias("_c"), F.greatest(F.col("_k") - F.col("_before"), F.lit(0)).alias("_take"), "_n")
    j = h.join(cuts, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_c"))).drop("_l", "_c")
    cut_bucket = (F.col("_take") > 0) & (F.col("_take") < F.col("_n"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", key))
    ranked = j.where(cut_bucket).withColumn("split", F.when(rank <= F.col("_take"), F.lit("test")).otherwise(F.lit("train")))
    whole = j.where(~cut_bucket).withColumn("split", F.when(F.col("_take") > 0, F.lit("test")).otherwise(F.lit("train")))
    return whole.unionByName(ranked).drop("_h", "_b", "_take", "_n")


# M6
def _uniform(*cols: Column) -> Column:
    """Deterministic uniform in (0, 1) from a hash of ``cols``."""
    h = F.xxhash64(*cols)
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def augment_minority(df: DataFrame, seed: int = 42, label: str = "label", minority=1, key: str = "clip_id",
                     samples: str = "samples") -> DataFrame:
    """Original rows plus, for the minority label only, one noisy copy:
    x + 0.035 * u * max(x) * N(0, 1), u uniform per clip, N per sample
    (Box-Muller on seeded hashes, so the copy is repeatable and needs no
    shuffle)."""
    variants = F.when(F.col(label) == F.lit(minority), F.array(F.lit("orig"), F.lit("noise"))).otherwise(
        F.array(F.lit("orig")))
    x = df.withColumn("variant", F.explode(variants))
    s = F.col(samples)
    u = _uniform(F.col(key), F.lit(seed), F.lit("amp"))
    amp = F.lit(0.035) * u * F.array_max(s)

    def normal(i):
        u1 = _uniform(F.col(key), F.lit(seed), i, F.lit("a"))
        u2 = _uniform(F.col(key), F.lit(seed), i, F.lit("b"))
        return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)

    from vigil.functions.signals import let

    noisy = let(amp, lambda a: F.transform(s, lambda v, i: v + a * normal(i)))
    return x.withColumn(samples, F.when(F.col("variant") == F.lit("noise"), noisy).otherwise(s))


# M7
def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean and population std per feature (fitted on training rows)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return train.agg(*aggs)


def scale(df: DataFrame, stats: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / std with a zero std treated as 1, as scikit-learn does."""
    j = df.crossJoin(F.broadcast(stats))
    for c in cols:
        sd = F.col(f"{c}_std")
        j = j.withColumn(c + suffix, (F.col(c) - F.col(f"{c}_mean")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd))
    return j.drop(*[f"{c}_mean" for c in cols], *[f"{c}_std" for c in cols])


# M8
def evaluate_predictions(df: DataFrame, label: str = "label", prediction: str = "prediction",
                         positive: int = 1) -> DataFrame:
    hit = (F.col(prediction) == F.col(label)).cast("double")
    pos = F.col(label) == F.lit(positive)
    return df.agg(F.avg(hit).alias("accuracy"),
                  F.try_divide(F.count_if(pos & (F.col(prediction) == F.lit(positive))).cast("double"),
                               F.count_if(pos)).alias("recall"),
                  F.count(F.lit(1)).alias("n"))


# M9
def corpus_log(paths: DataFrame, start: str = K.CORPUS_LOG_START, gap: int = K.CORPUS_LOG_GAP_SECONDS) -> DataFrame:
    """Inference log of a corpus: files in walk order (a folder's files
    before its sub-folders, names sorted), id 1..n, time = start + gap*(id-1)
    as HH:mm:ss, label = last '_' part of the parent folder."""
    wav = paths.filter(F.lower(F.col("path")).endswith(".wav"))
    full = F.split(F.col("path"), "/")
    dirs = F.slice(full, 1, F.size(full) - 1)
    # folders sort after the files beside them: prefix folders with '1', the file with '0'
    key = F.concat(F.transform(dirs, lambda d: F.concat(F.lit("1"), d)),
                   F.array(F.concat(F.lit("0"), F.element_at(full, -1))))
    x = wav.withColumn("_key", key)
    pos = global_position(x, ["_key", "path"], out="_row")
    t0 = F.to_timestamp(F.lit(f"1900-01-01 {start}"))
    ts = t0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_row") * F.lit(gap)).cast("decimal(18,6)"))
    label = F.element_at(F.split(F.try_element_at(full, F.lit(-2)), "_"), -1)
    return pos.select((F.col("_row") + 1).alias("id"), F.date_format(ts, "HH:mm:ss").alias("time"),
                      label.alias("inference_of_emotion"))
