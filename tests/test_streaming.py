"""The streaming render/band stage: incremental over a growing folder."""

import os
import tempfile

from pyspark.sql import functions as F

from corpusmill.config import MixSpec, SourceSpec
from corpusmill.streaming import run_available_now, stream_samples
from tests.conftest import SF01


def test_stream_is_incremental_and_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="cm-stream-")
    inbox, out, ckpt = os.path.join(d, "in"), os.path.join(d, "out"), os.path.join(d, "ckpt")
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    first, second = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")  # two arrivals
    first.write.parquet(os.path.join(inbox, "batch=1"))
    spec = SourceSpec(name="documents", path=inbox, format="text", source_column="source", id_column="doc_id",
                      options=(("recursiveFileLookup", "true"),))
    run_available_now(stream_samples(spark, spec, docs.schema, MixSpec()), out, ckpt)
    n1 = spark.read.parquet(out).count()
    second.write.parquet(os.path.join(inbox, "batch=2"))
    run_available_now(stream_samples(spark, spec, docs.schema, MixSpec()), out, ckpt)
    got = spark.read.parquet(out)
    batch = docs.select(F.btrim("text").alias("t"), "doc_id").where(
        (F.length("t") > 50) & (F.length("t") < 8192))
    assert got.count() == batch.count() > n1 > 0
    assert got.select(F.count_distinct("sample_id")).first()[0] == got.count()  # nothing processed twice


def test_stream_over_a_table_of_part_files(spark):
    from corpusmill.plans.queries import QUERIES
    d = tempfile.mkdtemp(prefix="cm-folder-")
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    docs.repartition(3).write.parquet(os.path.join(d, "documents.parquet"))
    got, file = QUERIES["length_band_stream"](spark, d), QUERIES["length_band_stream"](spark, SF01)
    assert sorted(got.collect()) == sorted(file.collect()) and got.count() > 0
