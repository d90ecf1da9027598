"""A1 exact-n sample per source and A2 retention-fraction mix.

Both are "first n rows in a seeded hash order" per source.  That is a filter:
the n-th row's (key, id) is found on a narrow projection, one threshold row
per source, and rows of any width compare themselves with their source's
threshold where they are scanned.  No text moves.  The per-source sizes are
one small collect (one row per source); n is computed on the driver with
Python int arithmetic so int(N * weight) truncates exactly like the reference.

Rows may repeat an id.  Where only some of the rows equal to the threshold fit,
the same is done once more among them, in the order of their content's hash,
and of rows equal in content too, which nothing tells apart, one stands for
the number wanted: no row is numbered, so nothing depends on partitions.

Rows with a NULL id take no part: they are not counted in N and never
selected, so n rows come back whenever n rows with ids are there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.keys import order_key
from corpusmill.operators.ranking import bucket_chars_for, exact_rank, group_sizes, nth_row

LIMIT_SCHEMA = T.StructType([T.StructField("source", T.StringType(), False),
                             T.StructField("n", T.LongType(), False)])


def fraction_count(n_rows: int, weight: float) -> int:
    """min(N, int(N * weight)): IEEE double product, truncated."""
    return min(n_rows, int(n_rows * float(weight)))


def _wanted(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    return df.sparkSession.createDataFrame([(k, int(v)) for k, v in limits.items()], LIMIT_SCHEMA)


def id_counts(df: DataFrame, id_col: str = "sample_id") -> dict[str, tuple[int, int]]:
    """{source: (rows, rows with an id)}, one row per source."""
    rows = df.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count(id_col).alias("ids")).collect()
    return {r["source"]: (r["rows"], r["ids"]) for r in rows}


class Selection:
    """The first n[source] ids in md5(seed:stage:id) order, as a filter."""

    def __init__(self, df: DataFrame, limits: dict[str, int], seed: int, stage: str, id_col: str = "sample_id",
                 sizes: dict[str, int] | None = None):
        self.seed, self.stage, self.id_col, self.limits = seed, stage, id_col, limits
        self.max_rows = max((sizes or limits).values(), default=0)
        narrow = df.where(F.col(id_col).isNotNull()).select("source", id_col).withColumn("_key", self._key())
        found = nth_row(narrow, ["source"], "_key", id_col, _wanted(df, limits), bucket_chars_for(self.max_rows))
        # one row per source, found once however often the filter is used
        rows = found.select("source", "_key", id_col, "_want", "_equal").collect()
        kind = df.schema[id_col].dataType
        self.thresholds = df.sparkSession.createDataFrame(
            [(r["source"], r["_key"], r[id_col]) for r in rows],
            T.StructType([T.StructField("_ts", T.StringType()), T.StructField("_tk", T.StringType()),
                          T.StructField("_ti", kind)]))
        #: Sources of which not all rows equal to the threshold fit: how many do, of how many.
        self.partly = {r["source"]: (r["_want"], r["_equal"]) for r in rows if r["_want"] < r["_equal"]}

    def _key(self):
        return order_key(self.seed, self.stage, F.col(self.id_col))

    def rows(self, wide: DataFrame) -> DataFrame:
        """The selected rows of `wide` (source and id columns wanted).  The
        broadcast side has one row per source."""
        d = wide.withColumn("_key", self._key()).join(F.broadcast(self.thresholds), F.col("source") == F.col("_ts"))
        before = (F.col("_key") < F.col("_tk")) | ((F.col("_key") == F.col("_tk")) & (F.col(self.id_col) < F.col("_ti")))
        equal = F.col(self.id_col) == F.col("_ti")
        if not self.partly:
            return d.where(before | equal).select(wide.columns)
        partly = F.col("source").isin(list(self.partly))
        whole = d.where(before | (equal & ~partly)).select(wide.columns)
        return whole.unionByName(self._some(d.where(equal & partly).select(wide.columns)))

    def _some(self, equal: DataFrame) -> DataFrame:
        """Of each source's rows `equal` to its threshold as many as are wanted:
        the first in the order of their content's hash."""
        keyed = equal.withColumn("_content", F.md5(F.to_json(F.struct(*equal.columns))))
        wanted = _wanted(equal, {s: n for s, (n, _) in self.partly.items()})
        most = max(n for _, n in self.partly.values())
        rows = nth_row(keyed.select("source", "_content", F.lit(0).alias("_none")), ["source"], "_content", "_none",
                       wanted, bucket_chars_for(most)).select("source", "_content", "_want", "_equal").collect()
        last = equal.sparkSession.createDataFrame(
            [(r["source"], r["_content"], r["_want"]) for r in rows], "_cs string, _last string, _copies long")
        near = keyed.join(F.broadcast(last), F.col("source") == F.col("_cs"))  # one row per source
        before = near.where(F.col("_content") < F.col("_last")).select(equal.columns)
        # rows alike in everything: one of them from each task meets the others
        copies = (near.where(F.col("_content") == F.col("_last")).groupBy("source", "_copies")
                  .agg(F.first(F.struct(*equal.columns)).alias("_row"))
                  .select(F.explode(F.array_repeat("_row", F.col("_copies").cast("int"))).alias("_row")))
        return before.unionByName(copies.select("_row.*"))

    def ranked(self, narrow: DataFrame, rank_col: str = "rank") -> DataFrame:
        """The selected rows with their exact rank; `narrow` should hold no text."""
        d = self.rows(narrow).withColumn("_key", self._key())
        return exact_rank(d, ["source"], "_key", self.id_col, bucket_chars=bucket_chars_for(self.max_rows),
                          n_groups=max(1, len(self.limits)), rank_col=rank_col).drop("_key")


def sample_exact_n(df: DataFrame, sample_sizes: dict[str, int | None], *, seed: int = 42,
                   id_col: str = "sample_id") -> tuple[DataFrame, dict]:
    """A1: exactly min(sample_size, N) raw rows per source, drawn before any
    formatting.  Returns (rows, report) with report[source] = (rows, n); the
    report is None when no source has a cap (no counting pass is needed)."""
    if all(sample_sizes.get(s) is None for s in sample_sizes):
        return df, None
    report, binding, sizes = {}, {}, {}
    for src, (n_rows, n_ids) in id_counts(df, id_col).items():
        cap = sample_sizes.get(src)
        if cap is not None and cap < n_ids:
            binding[src], sizes[src] = cap, n_ids
        report[src] = (n_rows, n_rows if cap is None else min(cap, n_ids))
    capped = [s for s in report if sample_sizes.get(s) is not None]
    if not capped:
        return df, report
    # capped sources lose rows without id, then those past the threshold
    free = df.where(~F.col("source").isin(list(binding)) & (
        F.col(id_col).isNotNull() | ~F.col("source").isin(capped)))
    if not binding:
        return free, report
    bound = df.where(F.col("source").isin(list(binding)))
    picked = Selection(bound, binding, seed, "sample", id_col, sizes).rows(bound)
    return picked.unionByName(free), report


def mix_limits(sizes: dict[str, int], weights: dict[str, float]) -> dict[str, int]:
    """A2 n per configured source that has rows; unconfigured sources are not mixed."""
    return {s: fraction_count(n, weights[s]) for s, n in sizes.items() if s in weights}


def mix_selection(samples: DataFrame, weights: dict[str, float], *, seed: int = 42,
                  id_col: str = "sample_id", sizes: dict[str, int] | None = None) -> tuple[Selection, dict[str, int]]:
    """A2: per source keep min(N, int(N*weight)) of the kept samples, N counted
    after the length band.  Returns the Selection and the per-source n."""
    if sizes is None:
        sizes = {k[0]: v for k, v in group_sizes(samples.select("source"), ["source"]).items()}
    limits = mix_limits(sizes, weights)
    return Selection(samples, limits, seed, "mix", id_col, sizes), limits


def mix_fraction(samples: DataFrame, weights: dict[str, float], **kw) -> tuple[DataFrame, dict[str, int]]:
    """The mixed rows of a narrow table with mix_rank, and n per source."""
    sel, limits = mix_selection(samples, weights, **kw)
    return sel.ranked(samples, "mix_rank"), limits
