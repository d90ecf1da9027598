"""Typed run configuration and its validation.

Only the source list becomes a (tiny, config-sized) DataFrame; everything
else is driver-side plan-building input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("alpaca", "chatml", "openorca", "text")

# Fixed value: system prompt used when an openorca record has no
# system_prompt field at all (a present empty/NULL value is kept).
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class SourceSpec:
    """One configured source.

    name          unique source name (also the value of the `source` column)
    sample_size   exact number of raw rows to draw (None = all rows)
    weight        retention fraction applied after the length band
    format        alpaca | chatml | openorca | text
    path          file path/glob to read (None when a DataFrame is supplied)
    reader        parquet | json | csv | text | orc
    subset        optional subset (configuration) value, filtered on subset_column
    split         optional split value, filtered on split_column
    source_column when set, rows of this source are those whose column equals
                  `name`; several specs on one path share one scan
    id_column     stable key column, unique within the source (rows with a NULL id
                  are counted as malformed); otherwise a hash of the row's
                  content and its number among equal rows
    text_column   column read by format 'text'
    """

    name: str
    sample_size: int | None = None
    weight: float = 1.0
    format: str = "text"
    path: str | None = None
    reader: str = "parquet"
    subset: str | None = None
    subset_column: str = "subset"
    split: str | None = None
    split_column: str = "split"
    source_column: str | None = None
    id_column: str | None = None
    text_column: str = "text"
    source_ord: int = 0
    options: tuple = ()

    def __post_init__(self):
        if not isinstance(self.name, str) or not self.name:
            raise ConfigError("source name must be a non-empty string")
        if isinstance(self.weight, bool) or not isinstance(self.weight, (int, float)):
            # Decimal weights would change int(N*w) truncation; doubles only.
            raise ConfigError(f"{self.name}: weight must be a float, got {type(self.weight).__name__}")
        if math.isnan(float(self.weight)) or self.weight < 0:
            raise ConfigError(f"{self.name}: weight must be >= 0")
        if self.sample_size is not None and (isinstance(self.sample_size, bool)
                                             or not isinstance(self.sample_size, int)
                                             or self.sample_size < 0):
            raise ConfigError(f"{self.name}: sample_size must be a non-negative int or None")
        if not isinstance(self.source_ord, int) or self.source_ord < 0:
            raise ConfigError(f"{self.name}: source_ord must be a non-negative int")


@dataclass(frozen=True)
class MixSpec:
    seed: int = 42
    deduplicate: bool = True
    shuffle: bool = True
    min_chars: int = 50
    max_chars: int = 8192
    # How a present-but-NULL field prints: 'None' reproduces f-string output.
    null_as: str = "None"
    on_unknown_format: str = "error"  # or 'skip'
    strict_shape: bool = True
    on_missing_split: str = "error"   # or 'empty'


@dataclass(frozen=True)
class TrainSpec:
    max_seq_length: int = 2048
    pad_id: int = 0
    ignore_index: int = -100
    mask_by: str = "attention"        # or 'pad_id' (also hides real pad-valued ids)
    num_epochs: int = 3
    batch_size: int = 1
    grad_accum: int = 16
    group_by_length: bool = True
    mega_batch_mult: int = 50
    seed: int = 42

    @property
    def rows_per_step(self) -> int:
        return self.batch_size * self.grad_accum


def validate_sources(specs: list[SourceSpec], mix: MixSpec | None = None) -> list[SourceSpec]:
    mix = mix or MixSpec()
    seen = set()
    for s in specs:
        if s.name in seen:
            raise ConfigError(f"duplicate source name {s.name!r}")
        seen.add(s.name)
        if s.format not in FORMATS and mix.on_unknown_format != "skip":
            raise ConfigError(f"{s.name}: unknown format {s.format!r}")
    return list(specs)


SOURCE_CONFIG_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("subset", T.StringType(), True),
    T.StructField("sample_size", T.LongType(), True),
    T.StructField("weight", T.DoubleType(), False),
    T.StructField("format", T.StringType(), False),
    T.StructField("source_ord", T.IntegerType(), False),
])


def source_config_df(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    """The source list as a DataFrame; its size is the number of sources."""
    rows = [(s.name, s.subset, s.sample_size, float(s.weight), s.format, int(s.source_ord))
            for s in specs]
    return spark.createDataFrame(rows, SOURCE_CONFIG_SCHEMA)

