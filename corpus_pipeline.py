"""The training-data pipeline over `documents`: five stages in a fixed order.

    quality classifier   documents scored under the limit go
    line dedup           repeated runs of two or more lines go from the texts
    near-dedup           one document of each group of near copies stays
    mixing               documents are drawn to their sources' target weights
    encoding             the texts as token ids, with the exact way back

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns the columns of `documents`; the last returns ids instead of
texts.  Rows may have nulls in any column; an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, classifier, line_dedup, mixing, near_dedup
from corpusmill.llm.common import Stages, table
from corpusmill.llm.queries import MIN_QUALITY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least the quality limit; the model learns from the
    labels of rows that are not held out."""
    model = classifier.train(docs, table(spark, sf_dir, "labels"), usable=~classifier.held_out(F.col("doc_id")))
    return classifier.score(docs, model).where(F.col("score") >= MIN_QUALITY).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without repeated runs of lines; n_chars follows the text."""
    left = line_dedup.dedup_runs(docs, Stages(spark, "lines"))
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest id."""
    return near_dedup.one_of_each(docs, Stages(spark, "near")).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to target weights, up to twice each, shuffled inside their output shards."""
    return mixing.mix_documents(docs, Stages(spark, "mix")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids as little-endian unsigned 32-bit integers,
    round_trip: decoding gives the text's bytes) of every drawn row."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    keyed = docs.select(F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256")).alias("key"), "text")
    # written in between: in one stage, encoder and decoder would each hold a Python worker for every core
    ids = Stages(spark, "encode").put("ids", bpe.encode(keyed, ranks, public_tokenizers.PATTERN, id_col="key"))
    back = bpe.decode(ids, ranks)
    return back.select("key.doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("key.sha256")).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_copies),
    ("mix_to_weights", mix),
    ("bpe_encode_decode", encode),
]

#: SQL cannot express the classifier, the sketches or the encoder.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each but the last written and read again."""
    docs, stages = table(spark, sf_dir, "documents"), Stages(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stages.put(name, docs)
    return docs
