"""F1 length band and F2 malformed-row drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import DEFAULT_MAX_CHARS, DEFAULT_MIN_CHARS, in_length_band


def malformed(df: DataFrame) -> Column:
    """A row the renderer could not turn into text (NULL list, NULL turn...)."""
    return F.col("text").isNull()


def passes_band(df: DataFrame, min_chars: int = DEFAULT_MIN_CHARS,
                max_chars: int = DEFAULT_MAX_CHARS) -> Column:
    return F.coalesce(in_length_band("text", min_chars, max_chars), F.lit(False))


def length_band(df: DataFrame, min_chars: int = DEFAULT_MIN_CHARS,
                max_chars: int = DEFAULT_MAX_CHARS) -> DataFrame:
    return df.where(passes_band(df, min_chars, max_chars))


def stage_counts(rendered: DataFrame, min_chars: int = DEFAULT_MIN_CHARS,
                 max_chars: int = DEFAULT_MAX_CHARS) -> DataFrame:
    """Per source: rows rendered, malformed, kept by the band (one pass)."""
    return rendered.groupBy("source").agg(
        F.count(F.lit(1)).alias("rendered"),
        F.count_if(malformed(rendered)).alias("malformed"),
        F.count_if(passes_band(rendered, min_chars, max_chars)).alias("kept"))
