"""T1 tokenize + truncate, T2 pad + attention mask, T3 causal labels, U1
pluggable tokenizer.

Ids are stored unpadded (row_id, input_ids, n_tokens); padding to
max_seq_length multiplies bytes, so T2/T3 run at export time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.config import TrainSpec

TOKENIZED_SCHEMA = T.StructType([
    T.StructField("row_id", T.StringType(), False),
    T.StructField("input_ids", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("n_tokens", T.IntegerType(), False),
])


def codepoint_tokens(text: Column) -> Column:
    """Built-in tokenizer: the whole text split into Unicode code points
    (JVM-side; non-BMP characters stay whole)."""
    return F.split(text, "")


def codepoint_ids(tokens: Column) -> Column:
    """Token -> id: the code point.  (`transform` runs its lambda per element,
    so it is applied after truncation, to at most max_seq_length tokens.)"""
    return F.transform(tokens, lambda c: F.ascii(c))


def tokenize_truncate(rows: DataFrame, spec: TrainSpec = TrainSpec(), text_col: str = "text",
                      id_col: str = "row_id") -> DataFrame:
    """(row_id, input_ids[:max_seq_length], n_tokens); `text` is dropped.
    Rows must be non-blank (an empty string would give one token)."""
    ids = codepoint_ids(F.slice(codepoint_tokens(F.col(text_col)), 1, spec.max_seq_length))
    return (rows.select(F.col(id_col).alias("row_id"), ids.alias("input_ids"))
            .withColumn("n_tokens", F.size("input_ids").cast("int")))


def codepoint_tokenizer_factory() -> Callable[[list[str]], list]:
    """Default U1 factory; equals T1's built-in expression.  Each whole text
    is decoded to code points in one vectorised step (UTF-32 buffer)."""
    import numpy as np

    def encode(texts: list[str]) -> list:
        return [np.frombuffer(t.encode("utf-32-le"), dtype="<u4").astype(np.int32) for t in texts]
    return encode


def tokenize_with(rows: DataFrame, factory: Callable[[], Callable[[list[str]], list[list[int]]]],
                  spec: TrainSpec = TrainSpec(), text_col: str = "text", id_col: str = "row_id") -> DataFrame:
    """Any batch tokenizer through mapInArrow; the tokenizer is built once
    per task, never per row.  Its ids go out as one flat buffer with offsets,
    cut to max_seq_length each, so no Python object is made for an id or a row."""
    max_len = spec.max_seq_length

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        encode = factory()
        for batch in batches:
            ids = [np.asarray(x[:max_len], dtype=np.int32) for x in encode(batch.column(1).to_pylist())]
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), lists, pa.array(sizes)],
                                             names=["row_id", "input_ids", "n_tokens"])

    return rows.select(F.col(id_col).cast("string"), text_col).mapInArrow(run, TOKENIZED_SCHEMA)


def pad_and_mask(tok: DataFrame, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """Right-pad to max_seq_length; mask 1 on real tokens, 0 on padding."""
    n = F.col("n_tokens")
    pad = F.greatest(F.lit(spec.max_seq_length) - n, F.lit(0))
    ids = F.concat(F.col("input_ids"), F.array_repeat(F.lit(spec.pad_id).cast("int"), pad))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), pad))
    return tok.select("row_id", ids.alias("input_ids"), mask.alias("attention_mask"), "n_tokens")


def causal_labels(padded: DataFrame, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """labels = ids, ignored (ignore_index) where the mask is 0, or, with
    mask_by='pad_id', wherever the id equals the pad id."""
    ign = F.lit(spec.ignore_index)
    if spec.mask_by == "pad_id":
        labels = F.transform("input_ids", lambda i: F.when(i == F.lit(spec.pad_id), ign).otherwise(i))
    elif "n_tokens" in padded.columns:
        # T2 pads on the right, so the mask is n ones then zeros: no per-element lambda needed
        pad = F.greatest(F.size("input_ids") - F.col("n_tokens"), F.lit(0))
        labels = F.concat(F.slice("input_ids", 1, F.col("n_tokens")), F.array_repeat(ign, pad))
    else:
        labels = F.zip_with("input_ids", "attention_mask", lambda i, m: F.when(m == 1, i).otherwise(ign))
    return padded.select("row_id", "input_ids", "attention_mask", labels.alias("labels"), "n_tokens")
