"""O1 global shuffle: a seeded permutation materialised as (ord_key, pos).

ord_key = md5(seed:shuffle:id); pos = 0-based exact rank over all rows,
computed with the bucketed rank (no single-partition window on rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.keys import order_key
from corpusmill.operators.ranking import bucket_chars_for, exact_rank


def with_ord_key(df: DataFrame, seed: int, id_col: str = "sample_id") -> DataFrame:
    return df.withColumn("ord_key", order_key(seed, "shuffle", F.col(id_col)))


def global_positions(df: DataFrame, n_rows: int, id_col: str = "sample_id",
                     key_col: str = "ord_key", fixed_prefix: int = 0, n_groups: int = 1) -> DataFrame:
    """Add pos = row_number() over (order by key, id) - 1, bucketed.

    The key must be uniform hex after `fixed_prefix` characters.  A fixed
    prefix (one value per source) is a group of its own: rows are ranked inside
    it, and the groups' running totals, one row per source, are added."""
    h = bucket_chars_for(n_rows)
    if not fixed_prefix:
        ranked = exact_rank(df, [], key_col, id_col, bucket_chars=h, rank_col="_r")
        return ranked.withColumn("pos", F.col("_r") - F.lit(1)).drop("_r")
    keyed = df.withColumns({"_group": F.substring(key_col, 1, fixed_prefix),
                            "_hash": F.expr(f"substring({key_col}, {fixed_prefix + 1})")})
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).select(
        "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = exact_rank(keyed, ["_group"], "_hash", id_col, bucket_chars=h, n_groups=n_groups, rank_col="_r")
    return (ranked.join(F.broadcast(totals), "_group")
            .withColumn("pos", F.col("_before") + F.col("_r") - F.lit(1)).drop("_group", "_hash", "_before", "_r"))


ORD_PREFIX = 11  # '%010d:' of source_ord


def with_source_order_key(df: DataFrame, seed: int, id_col: str = "sample_id") -> DataFrame:
    """Order without shuffling: sources in config order, each in its mix
    order (md5(seed:mix:id), i.e. mix_rank order)."""
    return df.withColumn("ord_key", F.concat(F.format_string("%010d:", F.col("source_ord")),
                                             order_key(seed, "mix", F.col(id_col))))


def global_shuffle(df: DataFrame, seed: int, id_col: str = "sample_id",
                   n_rows: int | None = None) -> DataFrame:
    keyed = with_ord_key(df, seed, id_col)
    if n_rows is None:
        n_rows = df.count()
    return global_positions(keyed, n_rows, id_col)
