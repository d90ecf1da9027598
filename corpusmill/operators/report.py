"""R1 preparation funnel, S5 corpus stats and G2 numbers from per-source counts.

Every stage count is one row per source (config-sized): the counts that
selection already needed are collected anyway, the rest are single narrow
aggregates.  The reports are assembled from them without further jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FUNNEL_SCHEMA = T.StructType([T.StructField(c, T.StringType() if c == "source" else T.LongType(), False)
                              for c in ("source", "total", "sampled", "kept", "selected", "after_dedup")])
STATS_SCHEMA = T.StructType([T.StructField("source", T.StringType(), False),
                             T.StructField("kept", T.LongType(), False),
                             T.StructField("total_samples", T.LongType(), False)])


def per_source(df: DataFrame, name: str = "n") -> dict[str, int]:
    """Row count per source, collected (one row per source)."""
    return {r["source"]: int(r[name]) for r in df.groupBy("source").agg(F.count(F.lit(1)).alias(name)).collect()}


def funnel_rows(sources: list[str], stages: dict[str, dict[str, int]]) -> list[tuple]:
    """One row per configured source, in config order, zeros where a stage
    has no rows.  `stages` maps total/sampled/kept/selected/after_dedup to
    per-source counts."""
    cols = ("total", "sampled", "kept", "selected", "after_dedup")
    return [(s, *(int(stages[c].get(s, 0)) for c in cols)) for s in sources]


def funnel_df(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FUNNEL_SCHEMA)


def stats_df(spark: SparkSession, kept: dict[str, int], total_samples: int) -> DataFrame:
    """(source, kept, total_samples): kept before mixing; sources with no
    survivor do not appear, as in the reference's stats."""
    return spark.createDataFrame([(s, int(k), int(total_samples)) for s, k in kept.items() if k > 0],
                                 STATS_SCHEMA)


def dedup_numbers(before: int, after: int) -> dict:
    """G2 from two counts: removed and its percentage (0.0 when empty)."""
    removed = before - after
    pct = round(removed * 100.0 / before, 1) if before else 0.0
    return {"total": before, "unique_texts": after, "removed": removed, "removed_pct": pct}
