"""Deterministic, engine-portable order keys.

Every random choice (sample, mix, shuffle, epoch order) is an order on
md5('<seed>:<stage>:<id>'), ties broken by the id.  The same string
hashes identically in Spark and in plain SQL engines, so selections are
checkable, and the order does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int, stage: str, id_col: Column | str) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:{stage}:"), c.cast("string")))


def text_hash(c: Column | str) -> Column:
    """Identity of a sample: md5 hex of its UTF-8 bytes, case sensitive."""
    return F.md5(F.col(c) if isinstance(c, str) else c)
