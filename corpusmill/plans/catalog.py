"""Source configurations used by the registered queries, tests and bench.

All of them read the given tables (`documents`, `conversations`); only the
source list itself is written here.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from corpusmill.config import SourceSpec
from corpusmill.functions.templates import ChatTemplate
from corpusmill.sources.records import (alpaca_records, messages_records, openorca_records,
                                        sharegpt_records)

# The five retention weights of the reference's shipped mix,
# applied to source i as WEIGHTS[i % 5].
WEIGHTS = (0.3, 0.25, 0.2, 0.15, 0.1)
N_DOC_SOURCES = 20
SEED = 42

# A non-ChatML template for the custom-template path (per-role overrides,
# BOS marker).
CUSTOM_TEMPLATE = ChatTemplate(prefix="<|{role}|>\n", suffix="</s>\n", bos="<s>",
                               role_prefix={"system": "<<SYS>>\n"},
                               role_suffix={"system": "\n<</SYS>>\n\n"})


def table(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def doc_spec(sf_dir: str, i: int, weight: float, sample_size: int | None = None,
             name: str | None = None) -> SourceSpec:
    return SourceSpec(name=name or f"src{i}", sample_size=sample_size, weight=weight, format="text",
                      path=table(sf_dir, "documents"), source_column="source", id_column="doc_id",
                      source_ord=i)


def docs_mix(sf_dir: str) -> list[SourceSpec]:
    return [doc_spec(sf_dir, i, WEIGHTS[i % 5]) for i in range(N_DOC_SOURCES)]


def docs_capped(sf_dir: str, cap: int = 30) -> list[SourceSpec]:
    return [doc_spec(sf_dir, i, WEIGHTS[i % 5], cap) for i in range(N_DOC_SOURCES)]


def docs_odd(sf_dir: str) -> list[SourceSpec]:
    """Weights below and above 1 and zero; one configured source has no rows;
    the other documents sources are not configured at all."""
    return [doc_spec(sf_dir, 0, 0.29), doc_spec(sf_dir, 1, 1.5), doc_spec(sf_dir, 2, 0.0),
            doc_spec(sf_dir, 3, 0.5, name="src_missing")]


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table(sf_dir, "conversations"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table(sf_dir, "documents"))


def mixed_format(spark: SparkSession, sf_dir: str) -> tuple[list[SourceSpec], dict[str, DataFrame]]:
    """Four sources, one per record shape, all derived from `conversations`."""
    conv = conversations(spark, sf_dir)
    frames = {
        "chat_messages": messages_records(conv),
        "chat_sharegpt": sharegpt_records(conv),
        "alpaca": alpaca_records(conv),
        "orca": openorca_records(conv),
    }
    specs = [
        SourceSpec(name="chat_messages", format="chatml", id_column="conv_id", weight=0.3, source_ord=0),
        SourceSpec(name="chat_sharegpt", format="chatml", id_column="conv_id", weight=0.25, source_ord=1),
        SourceSpec(name="alpaca", format="alpaca", id_column="record_id", weight=0.2, source_ord=2),
        SourceSpec(name="orca", format="openorca", id_column="record_id", weight=0.15, source_ord=3),
    ]
    return specs, frames
