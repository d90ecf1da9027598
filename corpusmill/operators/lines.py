"""L1 line explosion: what writing samples one per line and reading them back
line by line does to them (multi-line samples shatter into lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import LINE_BREAK_REGEX, strip_ws


def line_explode(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per non-blank stripped line: (*keep, line_no, line)."""
    keep = keep or []
    parts = df.select(*keep, F.posexplode(F.split(F.col(text_col), LINE_BREAK_REGEX, -1)).alias("line_no", "_raw"))
    return (parts.select(*keep, "line_no", strip_ws("_raw").alias("line"))
            .where(F.col("line") != F.lit("")))
