"""Exact bucketed rank: row_number() without putting a whole group in a task.

rank(row) = offset(group, bucket) + row_number() over (group, bucket order by key, tie)

where bucket is a hex prefix of the (uniform md5) order key and offset is the
running count of rows in the group's earlier buckets.  The count table has at
most groups x 16^h rows, independent of the data, so it can be broadcast
behind a size check; beyond the check the join goes through the same
(group, bucket) hash partitioning the window needs, so it costs no extra
exchange.  A hot group (a third of all rows) is spread over 16^h buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Aim for about a million narrow rows per (group, bucket) window partition.
TARGET_ROWS_PER_BUCKET = 1 << 20
MAX_BUCKET_CHARS = 5
# Broadcast the count/offset table only under this many rows (~40 B/row).
BROADCAST_ROW_LIMIT = 1 << 20

BKT = "_bkt"
CNT = "_cnt"
OFF = "_off"


def bucket_chars_for(max_group_rows: int, target: int = TARGET_ROWS_PER_BUCKET) -> int:
    h = 1
    while h < MAX_BUCKET_CHARS and max_group_rows > target * (16 ** h):
        h += 1
    return h


def _maybe_broadcast(small: DataFrame, row_bound: int) -> DataFrame:
    return F.broadcast(small) if row_bound <= BROADCAST_ROW_LIMIT else small


def bucket_offsets(df: DataFrame, group_cols: list[str], key_col: str, bucket_chars: int) -> DataFrame:
    """(group.., _bkt, _cnt, _off): rows per bucket and rows in earlier buckets."""
    d = df.select(*group_cols, F.substring(F.col(key_col), 1, bucket_chars).alias(BKT))
    counts = d.groupBy(*group_cols, BKT).agg(F.count(F.lit(1)).alias(CNT))
    # One partition per group, at most 16^h count rows each.
    w = Window.partitionBy(*group_cols).orderBy(BKT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn(OFF, F.sum(CNT).over(w) - F.col(CNT))


def _unique_guard(w, tie_col: str) -> Column:
    """NULL, or a runtime error when the row's id equals the previous id in
    the window order (duplicate ids share a key, so they are adjacent): an
    exact rank needs unique ids.  Rides on the window's sort, no extra pass."""
    prev = F.lag(F.col(tie_col)).over(w)
    return F.when(prev == F.col(tie_col),
                  F.raise_error(F.concat(F.lit("duplicate id in exact rank: "), F.col(tie_col).cast("string"))))


def exact_rank(df: DataFrame, group_cols: list[str], key_col: str, tie_col: str, *,
               bucket_chars: int = 3, n_groups: int = 1, rank_col: str = "rank") -> DataFrame:
    """Add `rank_col` (1-based) equal to row_number() over (partition by group
    order by key, tie), computed per (group, bucket)."""
    offsets = bucket_offsets(df, group_cols, key_col, bucket_chars).select(*group_cols, BKT, OFF)
    bound = n_groups * 16 ** bucket_chars
    d = df.withColumn(BKT, F.substring(F.col(key_col), 1, bucket_chars))
    d = d.join(_maybe_broadcast(offsets, bound), [*group_cols, BKT], "inner")
    w = Window.partitionBy(*group_cols, BKT).orderBy(F.col(key_col), F.col(tie_col))
    return (d.withColumn(rank_col, F.col(OFF) + F.row_number().over(w))
            .withColumn("_dup", _unique_guard(w, tie_col)).where(F.col("_dup").isNull())
            .drop(BKT, OFF, "_dup"))


def nth_row(df: DataFrame, group_cols: list[str], key_col: str, tie_col: str, limits: DataFrame,
            bucket_chars: int) -> DataFrame:
    """The n-th row (key, tie) of each group, n from `limits` (group.., n): at
    most one row per group, with _want, how many of the rows equal to it are
    among the first n, and _equal, how many there are.  Only the bucket that
    holds it is looked at, with one row for each distinct (key, tie), counted
    before anything moves; which bucket that is is one row per group, so the
    broadcast is config-sized.  Groups with n = 0, or absent from `limits`,
    give no row; n beyond the group's size gives its last row."""
    offsets = bucket_offsets(df, group_cols, key_col, bucket_chars)
    last = Window.partitionBy(*group_cols)
    offsets = offsets.withColumn("_all", F.sum(CNT).over(last)).join(F.broadcast(limits.select(*group_cols, "n")), group_cols)
    at = F.least(F.col("n"), F.col("_all"))
    holder = (offsets.where((F.col(OFF) < at) & (at <= F.col(OFF) + F.col(CNT)))
              .select(*group_cols, BKT, (at - F.col(OFF)).alias("_in")))
    d = df.withColumn(BKT, F.substring(F.col(key_col), 1, bucket_chars)).join(F.broadcast(holder), [*group_cols, BKT])
    d = d.groupBy(*group_cols, BKT, "_in", key_col, tie_col).agg(F.count(F.lit(1)).alias("_equal"))
    w = (Window.partitionBy(*group_cols, BKT).orderBy(F.col(key_col), F.col(tie_col))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_want", F.col("_in") - F.sum("_equal").over(w) + F.col("_equal"))
    return d.where((F.col("_want") > 0) & (F.col("_want") <= F.col("_equal"))).select(
        *group_cols, key_col, tie_col, "_want", "_equal")


def group_sizes(df: DataFrame, group_cols: list[str]) -> dict:
    """Row count per group, collected.  The result has one row per group
    (sources, epochs: config-sized), never per data row."""
    if not group_cols:
        return {(): df.count()}
    rows = df.groupBy(*group_cols).count().collect()
    return {tuple(r[c] for c in group_cols): r["count"] for r in rows}

