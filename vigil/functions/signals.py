"""Signal measures on ``array<double>`` sample columns.

All are higher-order array expressions (``aggregate``, ``transform``,
``filter``, ``slice``), evaluated in the JVM row by row (Spark interprets
lambdas, outside generated code); one clip is one row, so nothing here
shuffles. Sums run in index order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import constants as K


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_sq(samples: str | Column) -> Column:
    return F.aggregate(_c(samples), F.lit(0.0), lambda acc, x: acc + x * x)


def rms(samples: str | Column) -> Column:
    """sqrt(mean(x^2)); null for an empty signal."""
    s = _c(samples)
    return F.sqrt(F.try_divide(sum_sq(s), F.size(s).cast("double")))


# G1
def with_rms(df: DataFrame, samples: str = "samples", out: str = "rms") -> DataFrame:
    return df.withColumn(out, rms(samples))


def drop_silent(df: DataFrame, samples: str = "samples", threshold: float = K.SILENCE_RMS) -> DataFrame:
    """Keep signals whose RMS is at least the silence threshold."""
    return df.filter(rms(samples) >= F.lit(threshold))


# G2
def with_clip_stats(df: DataFrame, samples: str = "samples", rate: str = "sample_rate") -> DataFrame:
    s = _c(samples)
    quiet = F.size(F.filter(s, lambda x: F.abs(x) < F.lit(K.SILENCE_RMS)))
    return df.withColumns({
        "duration": F.try_divide(F.size(s).cast("double"), F.col(rate).cast("double")),
        "silence_ratio": F.try_divide(quiet.cast("double"), F.size(s).cast("double")),
    })


# G3
def fixed_length(samples: str | Column, n: int | Column) -> Column:
    s = _c(samples)
    n = F.lit(n) if isinstance(n, int) else n
    pad = F.array_repeat(F.lit(0.0), F.greatest(n - F.size(s), F.lit(0)))
    return F.when(F.size(s) >= n, F.slice(s, 1, n)).otherwise(F.concat(s, pad))


def fix_length(df: DataFrame, n: int, samples: str = "samples", out: str | None = None) -> DataFrame:
    return df.withColumn(out or samples, fixed_length(samples, n))


# G4
def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    A statistic referenced from inside a ``transform`` lambda would be
    re-evaluated for every element (and Catalyst inlines a pre-computed
    column back into the lambda), turning O(n) into O(n^2) per array.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def normalized(samples: str | Column, how: str = "peak") -> Column:
    """peak: x / max|x| (unchanged if 0); minmax: (x-min)/(max-min+1e-6);
    z: (x-mean)/(population std + 1e-6)."""
    s = _c(samples)
    eps = F.lit(K.NORMALIZE_EPS)
    if how == "peak":
        return let(F.array_max(F.transform(s, lambda v: F.abs(v))),
                   lambda p: F.when(p > 0, F.transform(s, lambda v: v / p)).otherwise(s))
    if how == "minmax":
        return let(F.struct(F.array_min(s).alias("lo"), F.array_max(s).alias("hi")),
                   lambda st: F.transform(s, lambda v: (v - st["lo"]) / (st["hi"] - st["lo"] + eps)))
    if how == "z":
        n = F.size(s).cast("double")
        return let(F.aggregate(s, F.lit(0.0), lambda a, v: a + v) / n,
                   lambda m: let(F.sqrt(F.aggregate(s, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)) / n),
                                 lambda sd: F.transform(s, lambda v: (v - m) / (sd + eps))))
    raise ValueError(f"unknown normalisation {how}")


def normalize_vector(df: DataFrame, how: str = "peak", samples: str = "samples", out: str | None = None) -> DataFrame:
    return df.withColumn(out or samples, normalized(samples, how))


# G5
def drop_short(df: DataFrame, samples: str = "samples", rate: str = "sample_rate",
               seconds: float = K.SHORT_CLIP_SECONDS) -> DataFrame:
    return df.filter(F.size(samples).cast("double") >= F.lit(seconds) * F.col(rate).cast("double"))
