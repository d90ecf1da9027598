"""Session helpers: a local session for tests/bench, and the shared stage
store under spark.checkpoint.dir for cutting lineage with written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "corpusmill",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.  Where none is configured a
    fresh local one is made for a local master; with any other master this
    raises, as executors would write to their own disks."""
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


class StageStore:
    """Writes intermediate DataFrames as Parquet tables in the shared
    checkpoint folder and reads them back: lineage is cut, recomputation
    after a lost executor starts from the table, and later stages read only
    the columns they need."""

    def __init__(self, spark: SparkSession, root: str | None = None, run_id: str | None = None):
        base = root or ensure_checkpoint_dir(spark)
        self.spark = spark
        self.root = os.path.join(base, "corpusmill", run_id or uuid.uuid4().hex)

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        p = self.path(name)
        with job_description(self.spark, f"corpusmill stage {name}"):
            df.write.mode("overwrite").parquet(p)
        # the schema is known: no footer reads to infer it again
        return self.spark.read.schema(df.schema).parquet(p)


class job_description:
    """Label the Spark jobs run inside the block (visible in event logs)."""

    def __init__(self, spark: SparkSession, text: str):
        self.sc, self.text = spark.sparkContext, text

    def __enter__(self):
        self.prev = self.sc.getLocalProperty("spark.job.description")
        self.sc.setJobDescription(self.text)

    def __exit__(self, *exc):
        self.sc.setJobDescription(self.prev)
