"""Incremental render -> strip -> length band on a streaming source.

Rendering, stripping and the band are per-record, so they run unchanged on
a streaming DataFrame: new files under a source path become new samples
without reprocessing old ones.  Exact-n sampling, the fraction mix, the
global shuffle and keep-first dedup need the whole input and stay batch
stages that read the sink table this writes.

The sink is Parquet with a checkpoint under spark.checkpoint.dir, so a
restarted or failed query resumes exactly where it stopped.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.config import ConfigError, MixSpec, SourceSpec
from corpusmill.functions.keys import text_hash
from corpusmill.functions.templates import CHATML, ChatTemplate
from corpusmill.operators.filters import length_band
from corpusmill.operators.render import render_samples
from corpusmill.session import ensure_checkpoint_dir


def exact_listing(path: str) -> str:
    """`path` as the stream reader lists it: a table that is one file as well as a
    folder of part files, and nothing beside it.  The reader takes a single
    file only by a pattern, so the name's last letter becomes a class of that
    one letter; a path that is a pattern stays one."""
    if not path.rstrip("/") or any(c in path for c in "*?[]{}\\"):
        return path
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def stream_samples(spark: SparkSession, spec: SourceSpec, schema: T.StructType, mix: MixSpec | None = None,
                   template: ChatTemplate = CHATML, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (sample_id, source, text, text_hash, n_chars) of the
    records arriving under spec.path; the schema is given, never inferred."""
    mix = mix or MixSpec()
    if spec.id_column is None:
        raise ConfigError(f"{spec.name}: a streaming source needs id_column")
    reader = spark.readStream.format(spec.reader).schema(schema)
    if spec.options:
        reader = reader.options(**dict(spec.options))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(exact_listing(spec.path))
    if spec.subset is not None:
        df = df.where(F.col(spec.subset_column) == F.lit(spec.subset))
    if spec.source_column is not None:
        df = df.withColumn("source", F.col(spec.source_column))
    else:
        df = df.withColumn("source", F.lit(spec.name))
    df = df.withColumn("sample_id", F.concat(F.col("source"), F.lit("/"), F.col(spec.id_column).cast("string")))
    kept = length_band(render_samples(df, spec.format, mix, template, spec.text_column),
                       mix.min_chars, mix.max_chars)
    return kept.select("sample_id", "source", "text", text_hash("text").alias("text_hash"),
                       F.length("text").alias("n_chars"))


def run_available_now(stream: DataFrame, out_path: str, checkpoint: str | None = None) -> str:
    """Process everything available now into `out_path` (append), then stop."""
    spark = stream.sparkSession
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "corpusmill-stream", uuid.uuid4().hex)
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ckpt).option("path", out_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return out_path
