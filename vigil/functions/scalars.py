"""Row-level projections, filters and scalar rules.

All of these are narrow transformations built from Spark's own expressions,
so they stay inside whole-stage codegen and never cause a shuffle. The one
exception is ``collapse_counter_ids`` (X13), which needs two table-wide
counts: it computes them in one aggregation and attaches the single result
row by a broadcast cross join (a one-row frame is a proven size bound).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import constants as K


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# X1 -------------------------------------------------------------------------
def danger(df: DataFrame, col: str = "risk_level") -> DataFrame:
    """Rows whose risk level is DANGER (equality, pushed to the scan)."""
    return df.filter(F.col(col) == F.lit(K.DANGER))


# X2 / X3 / X4 ----------------------------------------------------------------
def parse_timestamp(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Text -> timestamp without failing on bad values (null instead)."""
    c = _col(c)
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c
    return F.try_to_timestamp(c.cast("string"))


def with_timestamp(df: DataFrame, src: str = "timestamp", out: str = "timestamp_parsed") -> DataFrame:
    dtype = df.schema[src].dataType
    return df.withColumn(out, parse_timestamp(src, dtype))


def with_hour(df: DataFrame, src: str = "timestamp", out: str = "hour") -> DataFrame:
    dtype = df.schema[src].dataType
    return df.withColumn(out, F.hour(parse_timestamp(src, dtype)))


def with_date(df: DataFrame, src: str = "timestamp", out: str = "date") -> DataFrame:
    dtype = df.schema[src].dataType
    return df.withColumn(out, F.to_date(parse_timestamp(src, dtype)))


# X5 / X6 ---------------------------------------------------------------------
def geo_bucket(c: str | Column, scale: int = K.GEO_BUCKET_SCALE) -> Column:
    """coordinate * scale truncated toward zero (Spark's double->int cast)."""
    return (_col(c) * F.lit(float(scale))).cast("int")


def with_geo_bucket(df: DataFrame, scale: int = K.GEO_BUCKET_SCALE) -> DataFrame:
    return df.withColumns({"lat_bucket": geo_bucket("latitude", scale), "lon_bucket": geo_bucket("longitude", scale)})


def bucket_center(df: DataFrame, scale: int = K.GEO_BUCKET_SCALE) -> DataFrame:
    """Bucket back to a display coordinate."""
    return df.withColumns({"lat": F.col("lat_bucket") / F.lit(float(scale)),
                           "lon": F.col("lon_bucket") / F.lit(float(scale))})


# X7 / X8 ---------------------------------------------------------------------
def normalize_columns(df: DataFrame, lower: bool = True, strip: bool = True) -> DataFrame:
    names = []
    for c in df.columns:
        n = c.strip() if strip else c
        names.append(n.lower() if lower else n)
    return df.toDF(*names)


SYNONYMS = {"inference_of_emotion": "inference", "time_log": "time"}


def rename_synonyms(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in SYNONYMS.items() if k in df.columns})


# X9 / X10 ---------------------------------------------------------------------
def title_label(c: str | Column) -> Column:
    """Title case that also starts a new word after any non-letter (e.g. '-').

    Spark's ``initcap`` only breaks words at blanks; a blank is inserted after
    every other separator, ``initcap`` runs, and the inserted blanks go again.
    A text without other separators needs ``initcap`` alone.
    """
    low = F.lower(_col(c).cast("string"))
    spaced = F.regexp_replace(low, r"([^\p{L}\p{N}'_])", "$1 ")
    titled = F.regexp_replace(F.initcap(spaced), r"([^\p{L}\p{N}'_]) ", "$1")
    return F.when(low.rlike(r"[^\p{L}\p{N}'_ ]"), titled).otherwise(F.initcap(low))


def canonical_label(c: str | Column) -> Column:
    """null -> 'nan', trim, lower, 'surprised' -> 'surprise'."""
    x = F.lower(F.trim(F.coalesce(_col(c).cast("string"), F.lit("nan"))))
    out = x
    for k, v in K.LABEL_NORMALIZE.items():
        out = F.when(x == F.lit(k), F.lit(v)).otherwise(out)
    return out


# X11 ---------------------------------------------------------------------------
# one-letter fields take one or two digits (9:05:07, 3/4/2026), as R's parser does
CLOCKS = [" H:m:s", " H:m", ""]
YEAR_FIRST = ["yyyy/M/d" + t for t in CLOCKS]
MONTH_FIRST = [d + t for d in ("M/d/yyyy", "M-d-yyyy") for t in CLOCKS]
DAY_FIRST = [d + t for d in ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy") for t in CLOCKS]
ISO_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}([T ].+)?$"  # a date, with or without time, fraction and zone
TIME_TEXT = r"^\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?$"  # a bare time of day
# what a layout's field can be in a text that Spark's parser (not its LEGACY one) reads
FIELDS = {"yyyy": r"[+-]?\d{4,}", "M": r"0*([1-9]|1[0-2])", "d": r"0*([1-9]|[12]\d|3[01])", "H": r"0*(\d|1\d|2[0-3])",
          "m": r"0*[0-5]?\d", "s": r"0*[0-5]?\d"}


def layout_shape(layout: str) -> str:
    """Pattern that every text beginning with a value of ``layout`` matches (a
    date that is not in the calendar may match it too)."""
    return "^" + "".join(FIELDS.get(part) or re.escape(part) for part in re.findall(r"[A-Za-z]+|[^A-Za-z]+", layout))


def _first_layout(c: Column, layouts: Sequence[str]) -> Column:
    """The first of ``layouts`` that reads the text. Only layouts of its shape
    are tried, as a try that fails costs an exception."""
    by_date: dict[str, list[Column]] = {}
    for fmt in layouts:
        by_date.setdefault(fmt.split(" ")[0], []).append(F.when(c.rlike(layout_shape(fmt) + "$"), F.try_to_timestamp(c, F.lit(fmt))))
    return F.coalesce(*[F.when(c.contains(date.strip("yMd")[0]) & c.rlike(layout_shape(date)), F.coalesce(*tries)) for date, tries in by_date.items()])


def parse_log_time_column(c: str | Column, ref_date: str | None, day_first: Column | None = None) -> Column:
    """Text -> timestamp: ISO text, then year-first, then month-first or (where
    ``day_first``) day-first layouts, each with the other order as a last
    resort; a bare time of day is placed on ``ref_date``."""
    return _parse_trimmed(F.trim(_col(c).cast("string")), ref_date, day_first)


def _parse_trimmed(c: Column, ref_date: str | None, day_first: Column | None = None) -> Column:
    # every layout adds to the method that Spark generates for a row, and Java compiles none of over 8000 bytes: so few are listed twice
    tries = [F.when(c.rlike(ISO_TEXT), F.try_to_timestamp(c)), _first_layout(c, YEAR_FIRST)]
    month, day = _first_layout(c, MONTH_FIRST), _first_layout(c, DAY_FIRST)
    tries += [month, day] if day_first is None else [F.when(~F.coalesce(day_first, F.lit(False)), month), day, month]
    if ref_date is not None:
        tries.append(F.when(c.rlike(TIME_TEXT), F.try_to_timestamp(F.concat(F.lit(ref_date + " "), c))))
    return F.coalesce(*tries)


def with_day_first(df: DataFrame, col: str, by: str | None = None, out: str = "_day_first") -> DataFrame:
    """Whether more values of ``col`` can be read day first than month first,
    over the whole column or per value of ``by`` (e.g. the source file): one
    order for each log, not one per row."""
    c = F.trim(F.col(col).cast("string"))
    counts = df.groupBy(*([by] if by else [])).agg(
        (F.count(_first_layout(c, DAY_FIRST)) > F.count(_first_layout(c, MONTH_FIRST))).alias(out))
    # one row per log, so no row of the logs is moved
    return df.join(F.broadcast(counts), on=by, how="left") if by else df.crossJoin(F.broadcast(counts))


def parse_log_time(df: DataFrame, ref_date: str | None = None, now: str | None = None,
                   order: Sequence[str] | None = None, by: str | None = None) -> DataFrame:
    """Harmonised ``timestamp`` column from whatever the log carries.

    * a ``timestamp`` column is kept (text is parsed as below);
    * else ``time`` is parsed: ISO text or the layouts above, with one
      day/month order per log (``by``), or a bare time on ``ref_date``;
    * else rows get ``now`` minus i minutes, i = 0, 1, ... in the order of
      the columns ``order`` (default: input order). With ``by``, they are
      counted per value of it; the last column of ``order`` then tells the
      rows of a file's split apart, and those before it the splits.
    """
    for name, date in (("timestamp", None), ("time", ref_date)):
        if name in df.columns:
            if not isinstance(df.schema[name].dataType, T.StringType):
                return df.withColumnRenamed(name, "timestamp")
            known = with_day_first(df.withColumn("__text", F.trim(name)), name, by)  # trimmed once, not for every layout
            parsed = _parse_trimmed(F.col("__text"), date, F.col("_day_first"))
            return known.withColumn("timestamp", parsed).drop("_day_first", "__text")
    from vigil.operators.ordered import global_position, position_by_cell

    if now is None:
        raise ValueError("a log without time columns needs `now`")
    if by and order:
        ordered = position_by_cell(df, [by], list(order)[:-1], list(order)[-1])
    else:
        ordered = global_position(df, list(order) if order else None)
    day = 24 * 60  # minutes; an interval's minutes field alone would overflow past 2**31 rows
    back = F.make_dt_interval((F.col("_row") / day).cast("int"), F.lit(0), (F.col("_row") % day).cast("int"))
    return ordered.withColumn("timestamp", F.to_timestamp(F.lit(now)) - back).drop("_row")


# X12 / X13 -----------------------------------------------------------------------
def fill_log_defaults(df: DataFrame) -> DataFrame:
    if "id" not in df.columns:
        df = df.withColumn("id", F.lit(K.DEFAULT_LOG_ID))
    if "inference" not in df.columns:
        df = df.withColumn("inference", F.lit(K.UNKNOWN_INFERENCE))
    return df


def collapse_counter_ids(df: DataFrame, share: float = K.COUNTER_ID_SHARE, by: str | None = None) -> DataFrame:
    """If more than ``share`` of the rows have distinct ids, the id is a row
    counter: keep it as ``id_original`` and use one stream id instead.

    A null id counts as one more distinct value, as R's ``n_distinct`` does.
    With ``by`` (e.g. the source file) the decision is taken per value of
    that column; the decision table has one row per value.
    """
    keys = [by] if by else []
    stats = df.groupBy(*keys).agg(
        (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("_nd"),
        F.count(F.lit(1)).alias("_n"),
    )
    flag = stats.select(*keys, (F.coalesce(F.col("_nd"), F.lit(0)) > F.col("_n") * F.lit(share)).alias("_counter"))
    # one row without ``by``; with it, one row per log, so no row of the logs is moved
    j = df.join(F.broadcast(flag), on=by, how="left") if by else df.crossJoin(F.broadcast(flag))
    return (j.withColumn("id_original", F.when(F.col("_counter"), F.col("id").cast("string")))
             .withColumn("id", F.when(F.col("_counter"), F.lit(K.STREAM_LOG_ID)).otherwise(F.col("id").cast("string")))
             .drop("_counter"))


# X14 ------------------------------------------------------------------------------
def risk_columns(emotion: str | Column = "emotion", confidence: str | Column = "confidence",
                 threshold: float | None = K.CONFIDENCE_THRESHOLD, strict: bool = False) -> tuple[Column, Column]:
    """(risk_level, mqtt_signal) by the emotion rule.

    ``threshold=None`` drops the confidence condition; ``strict`` uses ``>``.
    """
    e, c = _col(emotion), _col(confidence)
    risk = sig = None
    for emo, (lvl, s) in K.EMOTION_RISK.items():
        cond = e == F.lit(emo)
        if threshold is not None:
            cond = cond & ((c > F.lit(float(threshold))) if strict else (c >= F.lit(float(threshold))))
        risk = F.when(cond, F.lit(lvl)) if risk is None else risk.when(cond, F.lit(lvl))
        sig = F.when(cond, F.lit(s)) if sig is None else sig.when(cond, F.lit(s))
    risk, sig = risk.otherwise(F.lit(K.SAFE)), sig.otherwise(F.lit(K.SIGNAL_SAFE))
    # a null comparison must still fall through to SAFE
    return F.coalesce(risk, F.lit(K.SAFE)), F.coalesce(sig, F.lit(K.SIGNAL_SAFE))


def with_risk(df: DataFrame, threshold: float | None = K.CONFIDENCE_THRESHOLD, strict: bool = False,
              emotion: str = "emotion", confidence: str = "confidence") -> DataFrame:
    r, s = risk_columns(emotion, confidence, threshold, strict)
    return df.withColumns({"risk_level": r, "mqtt_signal": s})


# X15 -------------------------------------------------------------------------------
def with_safety_status(df: DataFrame, emotion: str = "emotion") -> DataFrame:
    e = F.col(emotion)
    unsafe = F.coalesce(e.isin(*K.UNSAFE_EMOTIONS), F.lit(False)) & F.coalesce(e != F.lit("disgust"), F.lit(True))
    status = (F.when(e == F.lit("disgust"), F.lit(K.STATUS_FILTERED))
              .when(unsafe, F.lit(K.STATUS_UNSAFE)).otherwise(F.lit(K.STATUS_SAFE)))
    return df.withColumns({"is_unsafe": unsafe, "status": status})


# X16 / X25 ---------------------------------------------------------------------------
def with_top_class(df: DataFrame, probs: str = "probs", classes: Sequence[str] = K.MODEL_CLASSES,
                   prefix: str = "top") -> DataFrame:
    """Arg-max of a probability vector (first index on ties), its label and p*100."""
    p = F.col(probs)
    pmax = F.array_max(p)
    idx = F.array_position(p, pmax)  # 1-based, first occurrence
    labels = F.array(*[F.lit(c) for c in classes])
    return df.withColumns({
        f"{prefix}_index": (idx - F.lit(1)).cast("int"),
        f"{prefix}_label": F.try_element_at(labels, idx.cast("int")),
        f"{prefix}_confidence": pmax * F.lit(100.0),
    })


def class_probabilities(df: DataFrame, probs: str = "probs", classes: Sequence[str] = K.MODEL_CLASSES,
                        keys: Sequence[str] = ()) -> DataFrame:
    """One row per class with its probability; labels title-cased."""
    labels = F.array(*[F.lit(c) for c in classes])
    z = F.arrays_zip(labels.alias("c"), F.col(probs).alias("p"))
    out = df.select(*keys, F.posexplode(z).alias("class_index", "cp"))
    return out.select(*keys, F.col("class_index").cast("int").alias("class_index"),
                      title_label(F.col("cp.c")).alias("class"),
                      F.col("cp.p").cast("double").alias("probability"))


# X17 ---------------------------------------------------------------------------------
def alert_colour(c: str | Column = "risk_level") -> Column:
    c = _col(c)
    return (F.when(c.contains("DANGER"), F.lit(K.COLOUR_DANGER))
            .when(c.contains("CAUTION"), F.lit(K.COLOUR_CAUTION))
            .otherwise(F.lit(K.COLOUR_SAFE)))


def with_alert_colour(df: DataFrame, col: str = "risk_level") -> DataFrame:
    return df.withColumn("colour", alert_colour(col))


# X18 / X19 / X20 -----------------------------------------------------------------------
def class_of(c: str | Column, mapping: Sequence[tuple[str, Iterable[str]]]) -> Column:
    """Label -> class; unmatched 'Unassigned'; a later class overrides an earlier one."""
    c = _col(c)
    out = None
    for name, labels in reversed(list(mapping)):  # a later class overrides an earlier one
        labels = list(labels)
        if labels:
            hit = F.coalesce(c.isin(*labels), F.lit(False))
            out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return F.lit(K.UNASSIGNED) if out is None else out.otherwise(F.lit(K.UNASSIGNED))


def classify(df: DataFrame, mapping: Sequence[tuple[str, Iterable[str]]] = K.DEFAULT_CLASS_MAP,
             col: str = "inference") -> DataFrame:
    return df.withColumn("class", class_of(col, mapping))


def last_days(df: DataFrame, days: int, now: str, col: str = "timestamp") -> DataFrame:
    bound = F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(int(days)))
    return df.filter(F.col(col) >= bound)


def for_device(df: DataFrame, device: str, col: str = "id") -> DataFrame:
    return df.filter(F.col(col) == F.lit(device))


# X21 / X22 / X23 / X24 -------------------------------------------------------------------
def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def stamp_events(df: DataFrame, source: str, model_version: str = K.MODEL_VERSION,
                 device_id: str = K.DEVICE_ID) -> DataFrame:
    """New events get a uuid, the current UTC instant and their provenance."""
    return df.withColumns({
        "id": F.expr("uuid()"),
        "timestamp": F.current_timestamp(),
        "source": F.lit(source),
        "model_version": F.lit(model_version),
        "device_id": F.lit(device_id),
    })


def within_radius(df: DataFrame, lat: float, lon: float, km: float = 1.5) -> DataFrame:
    """Planar distance in degrees, <= km / 111."""
    d = F.sqrt(F.pow(F.col("latitude") - F.lit(float(lat)), 2) + F.pow(F.col("longitude") - F.lit(float(lon)), 2))
    return df.filter(d <= F.lit(km / K.KM_PER_DEGREE))


def fill_measures(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """fillna(0) restricted to the measures (a null key stays null)."""
    return df.fillna(0, subset=list(cols))
