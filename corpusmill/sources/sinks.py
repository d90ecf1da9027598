"""S3 corpus sink, S4 line scan, S5 stats sink, S6 line count.

The lossless corpus is Parquet (or JSON lines) in many part files; `pos`
carries the order, so no single-partition coalesce is needed.  The text
export reproduces the one-sample-per-line file: rows are placed by their pos
and sorted inside partitions, so part files concatenate in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import strip_ws


def write_corpus(corpus: DataFrame, path: str, fmt: str = "parquet") -> str:
    w = corpus.write.mode("overwrite")
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(f"unknown corpus format {fmt!r}")
    return path


# Rows per text part file when the file count follows the data (~0.5 GB at 1 KB/row).
ROWS_PER_TEXT_FILE = 500_000


def export_text(corpus: DataFrame, path: str, rows_per_file: int = ROWS_PER_TEXT_FILE,
                n_rows: int | None = None) -> str:
    """Samples as text lines in pos order (each sample + '\\n').  `pos` has no
    gaps, so a row's file is pos div rows_per_file: no sampling pass, and part
    files concatenate in order.  `n_rows` is the corpus size, counted if not given."""
    n = corpus.count() if n_rows is None else n_rows
    # small corpora still spread over the cluster
    rows_per_file = max(1, min(rows_per_file, -(-n // corpus.sparkSession.sparkContext.defaultParallelism)))
    (corpus.repartitionById(max(1, -(-n // rows_per_file)), F.floor(F.col("pos") / rows_per_file).cast("int"))
     .sortWithinPartitions("pos").select("text").write.mode("overwrite").option("lineSep", "\n").text(path))
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The text file read back line by line, stripped, blank lines dropped."""
    return (spark.read.text(path).select(strip_ws("value").alias("line"))
            .where(F.col("line") != F.lit("")))


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of line feeds of the exported text (the shell's `wc -l`); a
    carriage return inside a sample ends no line."""
    return spark.read.option("lineSep", "\n").text(path).agg(F.count(F.lit(1)).alias("text_lines"))


def corpus_size(corpus: DataFrame) -> Column:
    """Bytes of the one-sample-per-line text file, as a scalar subquery."""
    return corpus.agg(F.sum(F.octet_length("text") + F.lit(1))).scalar()


def write_stats(stats: DataFrame, path: str, corpus: DataFrame | None = None,
                config_json: str | None = None) -> str:
    """One JSON document {total_samples, datasets: {source: kept},
    size_mb, config}.  `stats` has one row per source, so the document is
    config-sized."""
    doc = stats.agg(
        F.max("total_samples").alias("total_samples"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "kept")))).alias("datasets"))
    fields = [F.col("total_samples"), F.col("datasets")]
    if corpus is not None:
        fields.append(F.round(F.coalesce(corpus_size(corpus), F.lit(0)) / F.lit(1048576.0), 2).alias("size_mb"))
    if config_json is not None:
        fields.append(F.parse_json(F.lit(config_json)).alias("config"))
    doc.select(F.to_json(F.struct(*fields)).alias("value")).write.mode("overwrite").text(path)
    return path
