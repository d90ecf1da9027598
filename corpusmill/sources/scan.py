"""S1 source scan and S2 fault-isolated multi-source load.

Sources are files already in storage (the hub download is out of scope).
Specs that read the same path and name their source through a column share
one scan: the source filter and subset/split filters push down to the
reader, and only the columns a format reads survive column pruning.
"""

from __future__ import annotations

import logging
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import FORMATS, ConfigError, MixSpec, SourceSpec

log = logging.getLogger(__name__)


def _read(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.path is None:
        raise ConfigError(f"{spec.name}: no path and no DataFrame given")
    reader = spark.read.format(spec.reader)
    if spec.options:
        reader = reader.options(**dict(spec.options))
    return reader.load(spec.path)


def _filter_eq(df: DataFrame, column: str, value: str | None, what: str, spec: SourceSpec,
               missing: str) -> DataFrame:
    if value is None:
        return df
    if column not in df.columns:
        if missing == "empty":
            return df.where(F.lit(False))  # parity: a missing split yields no rows
        raise ConfigError(f"{spec.name}: {what} {value!r} requested but no column {column!r}")
    return df.where(F.col(column) == F.lit(value))


#: Copies of one row that a task puts out at once.
COPIES_PER_TASK = 100_000


def content_key(df: DataFrame) -> DataFrame:
    """`df` with _row_key, for rows without a key column: md5 of the whole row,
    and a number among equal rows.  It depends on nothing but the rows, so
    copied or re-split files, other partitions and recomputed tasks give the
    same keys.  No physical row is numbered: equal rows, which nothing tells
    apart, are counted (before anything moves) and one of them is put out
    again under each number.  A row that makes up much of the input is put out
    by many tasks, `COPIES_PER_TASK` numbers each."""
    counted = (df.withColumn("_hash", F.md5(F.to_json(F.struct(*df.columns)))).groupBy("_hash")
               .agg(F.first(F.struct(*df.columns)).alias("_row"), F.count(F.lit(1)).alias("_n")))
    numbers = lambda lo, hi: F.explode(F.sequence(lo, hi)).alias("_no")
    few = counted.where(F.col("_n") <= COPIES_PER_TASK).select("_row", "_hash", numbers(F.lit(0).cast("long"), F.col("_n") - 1))
    last = F.floor((F.col("_n") - 1) / COPIES_PER_TASK)
    parts = (counted.where(F.col("_n") > COPIES_PER_TASK)
             .select("_row", "_hash", "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_part"))
             .repartition("_hash", "_part"))
    first = F.col("_part") * COPIES_PER_TASK
    many = parts.select("_row", "_hash", numbers(first, F.least(first + COPIES_PER_TASK, F.col("_n")) - 1))
    key = F.concat("_hash", F.lit("#"), F.col("_no").cast("string"))
    return few.unionByName(many).select("_row.*", key.alias("_row_key"))


def with_sample_id(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Stable sample id: source + '/' + key.  The key is the id column when
    configured, else the row's content key."""
    if spec.id_column is None:
        df = content_key(df)
        key = F.col("_row_key")
    else:
        key = F.col(spec.id_column).cast("string")
    out = df.withColumn("sample_id", F.concat(F.col("source"), F.lit("/"), key))
    return out.drop("_row_key") if spec.id_column is None else out


def scan_source(spark: SparkSession, spec: SourceSpec, mix: MixSpec | None = None,
                frame: DataFrame | None = None, names: list[str] | None = None) -> DataFrame:
    """Raw records of one source (or of `names` sharing the scan) with
    `source` and `sample_id` columns added."""
    mix = mix or MixSpec()
    df = frame if frame is not None else _read(spark, spec)
    df = _filter_eq(df, spec.subset_column, spec.subset, "subset", spec, "error")
    df = _filter_eq(df, spec.split_column, spec.split, "split", spec, mix.on_missing_split)
    if spec.source_column is not None:
        if spec.source_column not in df.columns:
            raise ConfigError(f"{spec.name}: no source column {spec.source_column!r}")
        wanted = names or [spec.name]
        df = df.where(F.col(spec.source_column).isin(wanted))
        if spec.source_column != "source":
            df = df.withColumn("source", F.col(spec.source_column))
    else:
        df = df.withColumn("source", F.lit(spec.name))
    return with_sample_id(df, spec)


def _share_key(spec: SourceSpec):
    if spec.source_column is None or spec.path is None:
        return ("own", spec.name)
    return (spec.path, spec.reader, spec.options, spec.source_column, spec.format, spec.subset,
            spec.subset_column, spec.split, spec.split_column, spec.id_column, spec.text_column)


def _resolve_with_retry(build, retries: int, backoff_s: float) -> DataFrame:
    """Build a scan and resolve its schema, retrying transient failures with
    a growing pause (backoff * attempt).  Analysis errors (missing path,
    bad schema) are definitive and raised at once; task-level retries
    during execution are Spark's own."""
    for attempt in range(1, retries + 1):
        try:
            df = build()
            df.schema  # forces path and schema resolution now
            return df
        except (AnalysisException, ConfigError):
            raise
        except Exception as e:  # noqa: BLE001 - transient storage/network errors
            if attempt == retries:
                raise
            log.warning("attempt %d failed: %s; retrying", attempt, str(e).splitlines()[0][:200])
            time.sleep(backoff_s * attempt)
    raise AssertionError("unreachable")


def load_sources(spark: SparkSession, specs: list[SourceSpec], mix: MixSpec | None = None,
                 frames: dict[str, DataFrame] | None = None, retries: int = 3, backoff_s: float = 5.0
                 ) -> tuple[list[tuple[list[SourceSpec], DataFrame]], dict[str, str]]:
    """Build one scan per source group; a source whose read or schema
    analysis fails, or that lacks a column its spec asks for, is logged,
    reported and skipped, the rest go on.
    Failures at execution time (corrupt files) still fail the job; Spark's
    task retry covers lost executors."""
    mix = mix or MixSpec()
    frames = frames or {}
    groups: dict = {}
    for s in specs:
        groups.setdefault(_share_key(s), []).append(s)
    loaded, skipped = [], {}
    for members in groups.values():
        head = members[0]
        if head.format not in FORMATS:  # of the run, not of one source's data
            if mix.on_unknown_format != "skip":
                raise ConfigError(f"{head.name}: unknown format {head.format!r}")
            for m in members:
                skipped[m.name] = f"unknown format {head.format!r}"
            continue
        try:
            df = _resolve_with_retry(
                lambda: scan_source(spark, head, mix, frames.get(head.name), [m.name for m in members]),
                retries, backoff_s)
            loaded.append((members, df))
        except Exception as e:  # noqa: BLE001 - isolate one bad source
            log.error("failed to load %s: %s", [m.name for m in members], e)
            for m in members:
                skipped[m.name] = str(e).splitlines()[0][:300]
    return loaded, skipped
