"""Skew-safe ordered scans: lag by group and global position.

A window ``partitionBy(key).orderBy(t)`` sends every row of a key to one task;
a key that holds a third of the rows makes that task hold a third of the table.

*Lag.* Equal rows are counted first (partially in each task), so a pile of
copies is one row. The distinct rows are dealt once by (key, time bucket),
which splits a hot key over its buckets; the window and each bucket's first and
last row run on that one exchange. Only those edges, one row per (key, bucket),
go to the key's own window, which finds what precedes a bucket. The copies come
back in pieces of bounded size that are dealt over all tasks. The input is read
once, and everything is built-in Spark functions.

*Global position.* Range bounds are picked once from a bounded sample of the
sort keys; a row's range is then a column, found by binary search. Rows are
dealt by range and numbered there, and the ranges' sizes, counted by the same
column, give the offsets: nothing but the bounds is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

TIE = "__tie"
COPIES = 1 << 16  # equal rows brought back at once
RANGES = 512  # at most; bounds are picked from SAMPLE rows a range
SAMPLE = 64


# --- lag ------------------------------------------------------------------------
class _Dealt:
    """Distinct (group, order, value) rows with their number ``_n``, dealt by
    group and bucket, and what is read from them without another exchange."""

    def __init__(self, df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str], bucket: Column) -> None:
        self.group = list(group_cols)
        self.columns = [*self.group, *order_cols, *[v for v in value_cols if v not in order_cols]]
        self.values = F.struct(*[F.col(v).alias(v) for v in value_cols])
        distinct = df.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_n"))
        self.rows = distinct.withColumn("_bucket", bucket).repartition(*self.group, "_bucket")
        self.place = [*order_cols, *[v for v in value_cols if v not in order_cols]]

    def inner(self) -> DataFrame:
        """Rows but the first of each bucket, with ``_prev``, the values before."""
        w = Window.partitionBy(*self.group, "_bucket").orderBy(*[F.asc_nulls_first(c) for c in self.place])
        return self.rows.withColumn("_prev", F.lag(self.values).over(w)).where(F.col("_prev").isNotNull())

    def edges(self) -> DataFrame:
        """The first row of each bucket, with ``_prev``, the last values of the
        group's bucket before it; null on a group's first row."""
        place = F.struct(*self.place)
        whole = F.struct(*self.columns, "_n")
        ends = self.rows.groupBy(*self.group, "_bucket").agg(F.min_by(whole, place).alias("_first"), F.max_by(self.values, place).alias("_last"))
        before = Window.partitionBy(*self.group).orderBy(F.asc_nulls_first("_bucket"))  # one row per group and bucket
        return ends.withColumn("_prev", F.lag("_last").over(before)).select("_first.*", "_prev")


def lag_by_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str],
                 bucket: Column, prefix: str = "prev_") -> DataFrame:
    """Group, order and value columns of every row, and ``prev_<v>``: the value
    of the row before it in the same group by ``order_cols`` (nulls first;
    ties by the values), null on a group's first row.

    ``bucket`` is any expression over ``order_cols`` that never falls along
    their order (e.g. the hour of a time); it only spreads the work."""
    dealt = _Dealt(df, group_cols, order_cols, value_cols, bucket)
    columns, values = dealt.columns, list(value_cols)
    found = [d.select(*columns, *[F.col(f"_prev.{v}").alias(prefix + v) for v in values]) for d in (dealt.inner(), dealt.edges())]
    # the other rows of a pile come after an equal one; the number of parts keeps Spark from joining the small pieces again
    more, parts = F.col("_n") - 1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (dealt.rows.where("_n > 1")
              .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((more - 1) / COPIES))))
              .repartition(parts, *columns, "_piece"))
    others = pieces.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), more - F.col("_piece") * COPIES))))
    return found[0].unionByName(found[1]).unionByName(others.select(*columns, *[F.col(v).alias(prefix + v) for v in values]))


def lag_pair_counts(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], value_col: str, bucket: Column) -> DataFrame:
    """Counts of (previous value, value) over consecutive rows of the same
    group: the aggregate of ``lag_by_group`` without its rows."""
    dealt = _Dealt(df, group_cols, order_cols, [value_col], bucket)
    cur, prev = F.col(value_col), F.col(f"_prev.{value_col}")
    one = F.when(F.col("_prev").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    pairs = F.array(F.struct(prev.alias("prev"), cur.alias("cur"), one.alias("n")),
                    F.struct(cur.alias("prev"), cur.alias("cur"), (F.col("_n") - 1).alias("n")))
    counts = [d.select(F.inline(pairs)).where("n > 0").groupBy("prev", "cur").agg(F.sum("n").alias("n")) for d in (dealt.inner(), dealt.edges())]
    return counts[0].unionByName(counts[1]).groupBy("prev", "cur").agg(F.sum("n").alias("n"))


# --- global position --------------------------------------------------------------
def _bounds(df: DataFrame, key: Column, ranges: int) -> DataFrame:
    """One row with the ordered bounds of up to ``ranges`` ranges of ``key``
    that hold about as many rows each, from a sample of ``SAMPLE`` rows a
    range; written once, so that every use sees the same."""
    n = df.count()
    share = min(1.0, ranges * SAMPLE / max(n, 1))
    picked = df.select(key.alias("_k")) if share == 1.0 else df.select(key.alias("_k")).sample(share, seed=1)
    sample = picked.agg(F.sort_array(F.collect_list("_k")).alias("_s"))  # about ranges * SAMPLE keys
    step = F.size("_s") / ranges
    at = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("_s", F.floor(i * step).cast("int")))
    none = F.slice("_s", 1, 0)
    ensure_checkpoint_dir(df.sparkSession)
    return sample.select(F.when((F.size("_s") > 0) & F.lit(ranges > 1), F.array_distinct(at)).otherwise(none).alias("_bounds")).checkpoint(eager=True)


def _range_of(key: Column, ranges: int) -> Column:
    """How many of the ordered ``_bounds`` do not exceed ``key``."""
    steps = [1 << b for b in reversed(range(max(ranges - 1, 1).bit_length()))]
    bounds = F.col("_bounds")
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0),
                       lambda at, s: F.when((at + s <= F.size(bounds)) & (F.get(bounds, at + s - 1) <= key), at + s).otherwise(at))


def _offsets(sizes: DataFrame, place: str) -> DataFrame:
    """Rows before each place, from one row per place."""
    w = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(place, F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))


def global_position(df: DataFrame, order_cols: Sequence[str] | None = None, out: str = "_row",
                    partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order_cols``, rows
    with equal keys in input order, without a single-partition window. Without
    ``order_cols`` the order is that of the input: of the scan's partitions
    and the rows in them. Both read the input twice (sizes, then rows), so it
    must give the same rows in the same places, as a scan of files does."""
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    if not order_cols:
        part = tied.withColumn("__part", F.shiftright(TIE, 33))  # its upper bits number the partition
        sizes = part.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
        res = part.join(F.broadcast(_offsets(sizes, "__part")), on="__part")  # one row per partition
        return res.withColumn(out, F.col("__off") + F.col(TIE) - F.shiftleft("__part", 33)).drop("__part", "__off", TIE)
    ranges = partitions or min(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*order_cols, TIE)
    spread = tied.crossJoin(F.broadcast(_bounds(tied, key, ranges))).withColumn("__range", _range_of(key, ranges)).drop("_bounds")  # one row
    sizes = spread.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__range").orderBy(*[F.asc_nulls_first(c) for c in order_cols], TIE)
    numbered = spread.withColumn("__pos", F.row_number().over(w) - 1)
    res = numbered.join(F.broadcast(_offsets(sizes, "__range")), on="__range")  # one row per range
    return res.withColumn(out, F.col("__off") + F.col("__pos")).drop("__range", "__pos", "__off", TIE)


def position_by_cell(df: DataFrame, by: Sequence[str], cells: Sequence[str], at: str, out: str = "_row") -> DataFrame:
    """0-based position of every row among those of equal ``by``, in the order
    of ``cells`` and then ``at``, where a cell (the split of a file, say) has a
    bounded number of rows: rows are dealt by cell and numbered there, and the
    cells' sizes, one row each, give the offsets."""
    keys = [*by, *[c for c in cells if c not in by]]
    numbered = df.withColumn("__pos", F.row_number().over(Window.partitionBy(*keys).orderBy(at)) - 1)
    w = Window.partitionBy(*by).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(*keys, F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return numbered.join(offsets, on=keys).withColumn(out, F.col("__off") + F.col("__pos")).drop("__pos", "__off")
