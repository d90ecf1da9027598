"""B1 epoch replication, B2 batch/step assignment, B3 length-grouped batches.

The training order is materialised as a table for any trainer.  Positions
per epoch come from the bucketed exact rank (group = epoch); B3 re-sorts
inside fixed-size mega-batches, so each window partition holds at most
batch_size * grad_accum * mega_batch_mult rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.config import TrainSpec
from corpusmill.operators.ranking import bucket_chars_for, exact_rank


def epoch_plan(rows: DataFrame, n_rows: int, spec: TrainSpec = TrainSpec(),
               carry: list[str] | None = None) -> DataFrame:
    """B1: (epoch, row_id, pos, *carry), every row once per epoch, a fresh
    seeded order per epoch: md5(seed:epoch:<e>:row_id)."""
    carry = carry or []
    rep = rows.select("row_id", *carry).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.lit(spec.num_epochs - 1))))
    rep = rep.withColumn("_key", F.md5(F.concat(F.lit(f"{spec.seed}:epoch:"), F.col("epoch").cast("string"),
                                                 F.lit(":"), F.col("row_id"))))
    ranked = exact_rank(rep, ["epoch"], "_key", "row_id", bucket_chars=bucket_chars_for(n_rows),
                        n_groups=spec.num_epochs, rank_col="_r")
    return ranked.select("epoch", "row_id", (F.col("_r") - 1).alias("pos"), *carry)


def batch_assign(plan: DataFrame, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """B2: micro_batch = pos div batch_size, step = pos div (batch * accum),
    both counted within the epoch."""
    return plan.select("epoch", "pos",
                       F.floor(F.col("pos") / spec.batch_size).cast("long").alias("micro_batch"),
                       F.floor(F.col("pos") / spec.rows_per_step).cast("long").alias("step"),
                       "row_id")


def length_grouped(plan: DataFrame, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """Cut each epoch's order into mega-batches of rows_per_step *
    mega_batch_mult rows, sort each by unpadded n_tokens desc (row_id asc
    on ties), then assign batches from the new positions."""
    size = spec.rows_per_step * spec.mega_batch_mult
    d = plan.withColumn("_mega", F.floor(F.col("pos") / size))
    w = Window.partitionBy("epoch", "_mega").orderBy(F.col("n_tokens").desc(), F.col("row_id"))
    d = d.withColumn("pos", F.col("_mega") * size + F.row_number().over(w) - 1).drop("_mega")
    return batch_assign(d, spec)
