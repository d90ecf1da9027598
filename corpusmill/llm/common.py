"""Shared helpers of the operators: table access, stage tables, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import sys
import types
import uuid

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from corpusmill.session import ensure_checkpoint_dir

#: White space between words, as a character class body (Java and Python alike).
WS = r"\x20\x09-\x0D"
WORD = rf"[^{WS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Stages:
    """Written tables in the cluster's shared checkpoint folder.  `put` writes
    a frame and reads it back with its known schema, so that lineage is cut
    and a lost executor costs only the tasks that read the table."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/llm-{job}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(self.path(name))
        # shuffle files of finished stages go when the driver collects its garbage
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of at most so many rows from now on in this session:
    texts are long, and a batch is held several times on its way."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def per_worker(key: str, make):
    """What `make` gives, kept for the life of the Python worker, which Spark
    reuses from task to task."""
    home = sys.modules.setdefault("_corpusmill_worker", types.ModuleType("_corpusmill_worker"))
    if not hasattr(home, key):
        setattr(home, key, make())
    return getattr(home, key)


def clear_worker() -> None:
    """Drops what `per_worker` kept, for tasks that have no use for it."""
    sys.modules.pop("_corpusmill_worker", None)


def give_back() -> None:
    """What Arrow and the C library hold of freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(batches, id_name: str, text_name: str, max_bytes: int = 1_000_000, raw: bool = False,
                 keep: bool = False):
    """(ids, texts) lists of bounded text size out of Arrow batches, the texts
    as bytes if `raw`; a null text is read as empty.  What the worker holds
    from other tasks goes, unless `raw` or `keep`."""
    empty = b"" if raw else ""
    if not (raw or keep):
        clear_worker()
    for batch in batches:
        ids, texts = batch.column(id_name).to_pylist(), batch.column(text_name)
        if raw:
            texts = texts.cast(pa.binary())
        at, size = 0, 0
        lengths = pa.compute.binary_length(texts).to_pylist()
        for i, n in enumerate(lengths):
            size += n or 0
            if size >= max_bytes or i == len(lengths) - 1:
                yield ids[at:i + 1], [t or empty for t in texts.slice(at, i + 1 - at).to_pylist()]
                at, size = i + 1, 0
