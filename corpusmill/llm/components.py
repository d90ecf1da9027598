"""Connected components of a table of links, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import Stages


def components(links: DataFrame, stages: Stages, name: str) -> DataFrame:
    """(node, comp) for every node of `links` (a, b): comp is the smallest node
    reachable.  Labels fall to the smallest label among the neighbours and then
    jump to their label's own label, until none changes; a table is written
    for each round.  Null nodes are not linked.  No links give no rows."""
    both = (links.select(F.col("a").alias("u"), F.col("b").alias("v"))
            .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
            .where("u is not null and v is not null").distinct())
    both = stages.put(f"{name}-both", both)
    labels = stages.put(f"{name}-labels-0", both.groupBy(F.col("u").alias("node")).agg(
        F.least(F.min("v"), F.first("u")).alias("comp")))
    i = 0
    while True:
        i += 1
        # a label travels along each link; hot nodes meet in partial minima
        near = (both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("comp").alias("near")))
        own = labels.withColumnRenamed("comp", "old").join(near, F.col("node") == F.col("u")).select(
            "node", "old", F.least("old", "near").alias("low"))
        jump = labels.select(F.col("node").alias("at"), F.col("comp").alias("next"))
        new = stages.put(f"{name}-labels-{i}", own.join(jump, F.col("low") == F.col("at")).select(
            "node", F.col("next").alias("comp"), "old"))
        if new.where("comp <> old").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
