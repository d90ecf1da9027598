"""Byte-level BPE encoding and decoding through a sentencepiece model.

The model is serialised directly from a rank vocabulary: every byte string
becomes a piece with one character for each byte, its score is the negative
rank (so the lowest rank merges first, leftmost among equals), and
normalisation is the identity.  Pre-tokens are encoded separately; decoding
maps ids back to byte strings.

Ids travel as binary columns of little-endian unsigned 32-bit integers.
Null texts count as empty; empty texts give no ids; rows with equal ids or
null ids are encoded like any other; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StructField, StructType

from corpusmill.llm.common import per_worker, small_batches, text_batches
from corpusmill.llm.pretokens import PretokenCoder

#: One character outside ASCII for each byte, so that no piece holds a space.
BYTE_BASE = 0x100
BYTE_CHARS = {b: chr(BYTE_BASE + b) for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 byte string and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: varint, 32-bit float or length-delimited."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model; piece i + 1 is the i-th byte string by rank."""
    # fixed values of the model format: piece types and field numbers
    unknown, bpe = 2, 2
    pieces = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))]
    for raw, rank in sorted(ranks.items(), key=lambda x: x[1]):
        name = raw.decode("latin-1").translate(BYTE_CHARS).encode()
        pieces.append(_field(1, _field(1, name) + _field(2, -float(rank))))
    trainer = _field(3, bpe) + _field(40, 0)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


def pretoken_encoder(proto: bytes, ranks: dict[bytes, int]):
    """A function from distinct pre-tokens to their ids as bytes."""
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    by_piece = np.array([0] + sorted(ranks.values()), dtype="<u4")

    def encode_many(pretokens: list[str]) -> list[bytes]:
        raw = [p.encode("utf-8", "surrogatepass") for p in pretokens]
        out = [struct.pack("<I", ranks[r]) if r in ranks else None for r in raw]
        rest = [i for i, x in enumerate(out) if x is None]
        coded = model.encode([raw[i].decode("latin-1").translate(BYTE_CHARS) for i in rest],
                             out_type=int, num_threads=1)
        for i, pieces in zip(rest, coded):
            out[i] = by_piece[pieces].tobytes()
        return out

    return encode_many


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text", cached: int = 50_000) -> DataFrame:
    """(id, n_tokens long, ids binary) of every row's whole text.  A worker
    keeps the ids of about `cached` fragments, twice over, in some 30 MB."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model_proto(ranks), ranks))  # size of the vocabulary
    key = f"bpe_{cached}_{zlib.crc32(repr((pattern, sorted(ranks.items()))).encode())}"
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        # what earlier tasks of this worker left in Arrow's pool goes back
        pa.default_memory_pool().release_unused()
        coder = per_worker(key, lambda: PretokenCoder(pattern, pretoken_encoder(*shared.value), max_entries=cached))
        for ids, texts in text_batches(batches, "id", "text", raw=True):
            coded = coder.code(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_arrow), pa.array([len(c) // 4 for c in coded], pa.int64()),
                 pa.array(coded, pa.binary())], names=["id", "n_tokens", "ids"])

    id_arrow = to_arrow_type(df.schema[id_col].dataType)
    return (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {id_type}, n_tokens long, ids binary")
            .withColumnRenamed("id", id_col))


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`df` with the byte string of its ids; null ids decode to null, unknown ids raise."""
    shared = df.sparkSession.sparkContext.broadcast({rank: raw for raw, rank in ranks.items()})
    schema = StructType([*df.schema.fields, StructField(out_col, BinaryType())])

    def run(batches):
        raw = shared.value.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [None if x is None else b"".join(map(raw, np.frombuffer(x, "<u4").tolist()))
                         for x in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())],
                                                 names=[*part.schema.names, out_col])

    return df.mapInArrow(run, schema)

