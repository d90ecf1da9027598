"""G1 exact dedup keeping the first occurrence, G2 duplicate report.

Identity is md5 of the stripped text.  Survivors are found on a narrow index
that holds no text: min(struct(ord_key, id, other columns)) per hash, with
partial aggregation absorbing hot duplicate groups before the one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_exact(index: DataFrame, hash_col: str = "text_hash", order_col: str = "ord_key",
                id_col: str = "sample_id") -> DataFrame:
    """Rows of `index` that are the first of their hash in (order, id) order."""
    lead = [order_col, id_col, hash_col]
    rest = [c for c in index.columns if c not in lead]
    first = index.groupBy(hash_col).agg(F.min(F.struct(*lead[:2], *rest)).alias("_first"))
    return first.select(hash_col, "_first.*").select(*index.columns)


def dedup_report(before: DataFrame, hash_col: str = "text_hash") -> DataFrame:
    """total, unique, removed and removed_pct (one decimal, 0.0 on empty input)."""
    agg = before.agg(F.count(F.lit(1)).alias("total"),
                     F.count_distinct(F.col(hash_col)).alias("unique_texts"))
    removed = F.col("total") - F.col("unique_texts")
    pct = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(
        F.round(removed.cast("double") * F.lit(100.0) / F.col("total").cast("double"), 1))
    return agg.select("total", "unique_texts", removed.alias("removed"), pct.alias("removed_pct"))
