"""Mixing sources to target weights in DataFrame functions only.

Targets come from weights and source sizes (sources hold a share of a
multiple of all words, at most `max_passes` times their own size).  Documents
fall into hashed blocks of their source; a source's blocks, in a permuted
order, are drawn once for each whole pass and as far as the target reaches in
the last pass, of which the one block on the edge is drawn document by
document.  The exact block quotas of all sources are split among the output
shards by a multivariate hypergeometric tree (halving the shards, drawing how
many blocks of each source go left), and every shard takes its own range of
each source's permuted draws.  Inside a shard documents stand in hash order.

Everything follows from the seed, so reruns agree.  The driver sees one row
for each source.  Null and empty texts have size 0 and are taken with their
block.  A null source is a source, ordered last.  Rows with equal id and size
are taken or left together.  Extra columns pass through `mix`.  An empty table
gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import WS, Stages, partitions


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)  # repeating over the sources
    share: float = 1.5  # of all sizes
    max_passes: int = 2
    block_docs: int = 2000
    seed: int = 42


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """Words for each source: by weight, stopped at max_passes times its size,
    the excess reshared by weight among the others until none is above."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    out: list[float | None] = [None] * len(sizes)
    rest = mix.share * sum(sizes)
    while open_ := [i for i, t in enumerate(out) if t is None]:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / total > mix.max_passes * sizes[i]]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / total
        for i in over:
            out[i] = float(mix.max_passes * sizes[i])
        rest -= sum(out[i] for i in over)
    return out


def splitting_tree(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """[shards, sources] block counts: rows sum to nearly equal capacities,
    columns to the quotas."""
    rng = np.random.default_rng(seed)
    total = sum(quotas)
    capacity = [total // shards + (i < total % shards) for i in range(shards)]
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    stack = [(0, shards, np.array(quotas, dtype=np.int64))]
    while stack:
        lo, hi, left = stack.pop()
        if hi - lo == 1:
            out[lo] = left
            continue
        mid = (lo + hi) // 2
        draw = rng.multivariate_hypergeometric(left, sum(capacity[lo:mid]), method="marginals")
        stack += [(mid, hi, left - draw), (lo, mid, draw)]
    return out


def n_words(text_col: str) -> Column:
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), f"[{WS}]+"), lambda x: x != "")
    return F.size(words).cast("long")


def draws(df: DataFrame, stages: Stages, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", shards: int | None = None) -> DataFrame:
    """(id, source, size, key, source_size, target, copies: array of (pass,
    shard)), a row for each row of `df`; `key` orders documents inside a shard."""
    spark = df.sparkSession
    shards = shards or partitions(spark)
    sized = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"))
    sized = stages.put("sizes", sized.withColumn("key", F.xxhash64(F.lit(mix.seed), "id", "size")))

    totals = sorted(((r["source"], r["words"], r["docs"]) for r in sized.groupBy("source").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")).collect()),  # a row for each source
        key=lambda r: (r[0] is None, r[0] or ""))
    if not totals:
        return sized.selectExpr("*", "0L as source_size", "0D as target",
                                "cast(array() as array<struct<pass:int,shard:int>>) as copies")
    goal = targets([t[1] for t in totals], mix)
    sources = []
    for (name, size, docs), target in zip(totals, goal):
        whole = min(int(target // size), mix.max_passes) if size else 0
        sources.append((name, size, target, whole, target - whole * size, max(1, -(-docs // mix.block_docs))))
    per_source = spark.createDataFrame(
        sources, "source string, source_size long, target double, whole int, rest double, n_blocks long")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    rows = (sized.join(per_source.withColumnRenamed("source", "s"), same("source", "s"), "left").drop("s")
            .withColumn("block", F.pmod(F.col("key"), F.col("n_blocks"))))

    # one row for each block: its place in the permuted order and the words before it
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(mix.seed + 1), "block"), "block")
    blocks = (rows.groupBy("source", "block", "whole", "rest", "n_blocks").agg(F.sum("size").alias("words"))
              .withColumns({"place": F.row_number().over(order) - 1,
                            "before": F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1))})
              .withColumn("before", F.coalesce("before", F.lit(0)))
              .withColumns({"full": (F.col("rest") > 0) & (F.col("before") + F.col("words") <= F.col("rest")),
                            "edge": (F.col("before") < F.col("rest"))
                            & (F.col("before") + F.col("words") > F.col("rest"))}))
    blocks = stages.put("blocks", blocks)
    counts = {r["source"]: r for r in blocks.groupBy("source").agg(  # a row for each source
        F.sum((F.col("full") | F.col("edge")).cast("long")).alias("drawn"), F.count(F.lit(1)).alias("present")).collect()}
    quotas = [whole * counts[name].present + counts[name].drawn for name, _, _, whole, _, _ in sources]
    ends = np.cumsum(splitting_tree(quotas, shards, mix.seed), axis=0)
    bounds = spark.createDataFrame([(s[0], ends[:, i].tolist(), counts[s[0]].present) for i, s in enumerate(sources)],
                                   "s string, ends array<long>, present long")
    # draw number of a block in a pass: whole passes first, then the last one; full blocks precede the edge
    shard_of = lambda number: F.size(F.filter("ends", lambda e: e <= number)).cast("int")
    passes = F.transform(F.sequence(F.lit(0), F.col("whole")), lambda p: F.struct(
        p.alias("pass"), shard_of(p * F.col("present") + F.col("place")).alias("shard")))
    passes = F.filter(passes, lambda c: (c["pass"] < F.col("whole")) | F.col("full") | F.col("edge"))
    plan = (blocks.join(bounds, same("source", "s")).select(
        F.col("source").alias("s"), F.col("block").alias("b"), "edge", "whole", (F.col("rest") - F.col("before")).alias("left"),
        passes.alias("copies")))
    rows = (rows.drop("whole", "rest", "n_blocks")
            .join(plan, same("source", "s") & (F.col("block") == F.col("b")), "left").drop("s", "b", "block"))
    rows = stages.put("rows", rows)

    # the edge block of each source, document by document; equal keys stand together
    inside = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = (rows.where("edge").groupBy("source", F.col("key").alias("k"), "left").agg(F.sum("size").alias("w"))
             .withColumn("upto", F.sum("w").over(inside))
             .where(F.col("upto") - F.col("w") / 2 <= F.col("left"))
             .select(F.col("source").alias("s"), "k", F.lit(True).alias("in")))
    edge = rows.where("edge").join(taken, same("source", "s") & (F.col("key") == F.col("k")), "left")
    edge = edge.withColumn("copies", F.when(F.col("in"), F.col("copies")).otherwise(
        F.filter("copies", lambda c: c["pass"] < F.col("whole"))))
    columns = ["id", "source", "size", "key", "source_size", "target", "copies"]
    return rows.where("not edge").select(columns).unionByName(edge.select(columns))


def mix_documents(df: DataFrame, stages: Stages, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", shards: int | None = None) -> DataFrame:
    """The mixed rows with all columns of `df` plus `mix_pass` and
    `mix_shard`, gathered by shard and in hash order inside it."""
    shards = shards or partitions(df.sparkSession)
    chosen = stages.put("chosen", draws(df, stages, mix, id_col, text_col, source_col, shards)
                        .where(F.size("copies") > 0)
                        .select(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
                                F.col("key").alias("_key"), F.col("copies").alias("_copies"))
                        .distinct())
    joined = df.join(chosen, F.col(id_col).eqNullSafe(F.col("_id")) & F.col(source_col).eqNullSafe(F.col("_source"))
                     & (n_words(text_col) == F.col("_size")))
    copies = joined.withColumn("_copy", F.explode("_copies")).withColumns(
        {"mix_pass": F.col("_copy.pass"), "mix_shard": F.col("_copy.shard")})
    return (copies.repartitionById(shards, F.col("mix_shard"))
            .sortWithinPartitions("mix_shard", F.xxhash64("_key", "mix_pass"))
            .select(*df.columns, "mix_pass", "mix_shard"))
