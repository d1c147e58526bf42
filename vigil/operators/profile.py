"""Table profiling (A12-A14) and record samples (L1, L2).

Null counts and the numeric summary are single aggregations over all
columns at once (one scan, partial aggregation), reshaped to one row per
column with ``inline``; the schema report reads only the schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_SUMMARY = "column string, count long, mean double, stddev double, min string, max string, shortest int, longest int"
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# A12
def null_counts(df: DataFrame) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in df.columns]
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


# A13
def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def describe_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column, typed (not
    the strings of ``DataFrame.describe``)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    rows = []
    for c in cols:
        x = F.col(c).cast("double")
        rows.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("stddev"), F.min(x).alias("min"), F.max(x).alias("max")))
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def describe_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, min, max of the text and shortest and longest length per text
    column; the mean and deviation that ``DataFrame.describe`` gives for text
    that reads as a number stand in ``mean`` and ``stddev``. One aggregation."""
    cols = list(cols) if cols is not None else text_columns(df)
    rows = []
    for c in cols:
        x, n = F.col(c), F.col(c).try_cast("double")
        rows.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(n).alias("mean"), F.stddev_samp(n).alias("stddev"),
                             F.min(x).alias("min"), F.max(x).alias("max"), F.min(F.char_length(x)).alias("shortest"), F.max(F.char_length(x)).alias("longest")))
    if not rows:
        return df.sparkSession.createDataFrame([], TEXT_SUMMARY)
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


# A14
def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type) and, through ``count()``, the column count."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def schema_facts(df: DataFrame) -> DataFrame:
    """The schema report of the table that was given, with facts of its rows:
    (position, column, type, rows, filled), ``filled`` being the values that
    are not null. One aggregation over all columns."""
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.count(F.lit(1)).alias("rows"), F.count(F.col(f"`{f.name}`")).alias("filled")) for i, f in enumerate(df.schema.fields)]
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


# L1 / L2
def sample_records(df: DataFrame, n: int = 10, order: str = "id") -> DataFrame:
    """The first n rows in a fixed order (a sample report)."""
    return df.orderBy(F.asc_nulls_last(order)).limit(n)


def recent_events(df: DataFrame, n: int = 10) -> DataFrame:
    """The n latest events (ties: larger id first); a top-k report."""
    return df.orderBy(F.desc_nulls_last("timestamp"), F.desc_nulls_last("id")).limit(n)
