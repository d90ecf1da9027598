"""Token ids as length-delimited binary records with a separate offset index.

A shard file holds the documents of one range of ids, ascending.  A frame is
    length   uint64   bytes of the payload
    check    uint32   masked checksum of the eight length bytes
    payload  uint8 (1: the id is null), int64 id, then the token ids
    check    uint32   masked checksum of the payload
all little endian; token ids take 2 bytes where the vocabulary allows, else 4.
The checksum is CRC-32, rotated right by 15 bits plus a constant.  The index
file beside a shard has one entry for each frame (offset, ids before it in the
shard, number of ids), so frames can be read in any order.

A task writes files of its own attempt and returns their names; only names
returned by successful tasks reach the manifest, so retries leave no trace.

Texts are encoded as the tokenizer library does by default, without special
tokens of its own around them: the string of an added token inside a text
becomes that token's id.

Null texts count as empty: such a record holds the end id alone.  Null ids
come first.  Rows with equal ids are ordered by text.  Extra columns are
ignored.  An empty table gives no shard.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from corpusmill.llm.common import Stages, partitions, per_worker, small_batches, text_batches
from corpusmill.llm.pretokens import PretokenCoder

#: Fixed value of the checksum mask.
MASK_DELTA = 0xA282EAD8
INDEX_ENTRY = np.dtype([("offset", "<u8"), ("ids_before", "<u8"), ("n_ids", "<u4")])
#: The byte-level alphabet's character for a space.
SPACE = "Ġ"
#: Stands between words that are encoded in a row; no word of letters holds it.
MARK = "!"
MANIFEST = "shard int, path string, n_docs long, n_ids long"


#: Fragments kept in each of the two generations of a worker's cache.
CACHED = 600_000


class CorruptRecord(ValueError):
    pass


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, masked_crc(length).to_bytes(4, "little"), payload,
                     masked_crc(payload).to_bytes(4, "little")))


def read_frame(stream) -> bytes | None:
    """The next payload; None at the end of the file."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked_crc(head[:8]) != int.from_bytes(head[8:], "little"):
        raise CorruptRecord("length checksum")
    n = int.from_bytes(head[:8], "little")
    body = stream.read(n + 4)
    if len(body) < n + 4 or masked_crc(body[:n]) != int.from_bytes(body[n:], "little"):
        raise CorruptRecord("payload checksum")
    return body[:n]


def tokenizer_encoders(tokenizer_json: str, width: int):
    """Functions from distinct pre-tokens, and from distinct words of letters
    behind a space, to their ids as bytes of `width` each."""
    tokenizer, spelled = Tokenizer.from_str(tokenizer_json), Tokenizer.from_str(tokenizer_json)
    # words already spelled in the byte-level alphabet need no more than the merges
    spelled.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    between, mark = f" {MARK} ", tokenizer.token_to_id(MARK)
    letters = byte_letters()

    def encode_many(pretokens: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{width}").tobytes()
                for e in tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]

    def encode_words(words: list[str], prefix: str) -> list[bytes]:
        lead = SPACE if prefix else ""
        row = between.join([lead + (w if w.isascii() else w.encode().decode("latin-1").translate(letters)) for w in words])
        ids = np.array(spelled.encode_batch_fast([row], add_special_tokens=False)[0].ids, f"<u{width}")
        at = np.flatnonzero(ids == mark) * width
        data = ids.tobytes()
        return [data[lo:hi] for lo, hi in zip([0, *(at + width).tolist()], [*at.tolist(), len(data)])]

    return encode_many, encode_words


class TextCoder:
    """Whole texts to id bytes, as the library gives them.  Texts are split at
    the strings of added tokens, the longest first where several begin; what
    stands between goes through the fragments' cache.  A tokenizer whose added
    tokens look at their surroundings encodes texts that hold one itself."""

    def __init__(self, tokenizer_json: str, pattern: str, width: int, max_entries: int = CACHED):
        tokenizer = Tokenizer.from_str(tokenizer_json)
        added = {i: a for i, a in tokenizer.get_added_tokens_decoder().items() if a.content}
        self.kind = f"<u{width}"
        self.ids = {a.content.encode(): np.array([i], self.kind).tobytes() for i, a in added.items()}
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.ids, key=len, reverse=True))) + b")").split
        simple = not any(a.single_word or a.lstrip or a.rstrip or a.normalized for a in added.values())
        self.library = None if simple else tokenizer
        self.coder = PretokenCoder(pattern, *tokenizer_encoders(tokenizer_json, width), width, max_entries)

    def code(self, raw: list[bytes]) -> list[bytes]:
        """The id bytes of each text, given in UTF-8."""
        held = [any(s in r for s in self.ids) for r in raw]
        if not any(held):
            return self.coder.code(raw)
        parts = [self._parts(r) if h else [r] for r, h in zip(raw, held)]
        # every second part is coded already
        plain = iter(self.coder.code([p for ps in parts for p in ps[::2] if p]))
        return [b"".join(p if k % 2 else next(plain) if p else b"" for k, p in enumerate(ps)) for ps in parts]

    def _parts(self, raw: bytes) -> list[bytes]:
        if self.library is not None:
            ids = self.library.encode(raw.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
            return [b"", np.array(ids, self.kind).tobytes()]
        return [self.ids[p] if k % 2 else p for k, p in enumerate(self.cut(raw))]


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes of Latin-1 stand for themselves,
    the others for the characters from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


def arrow_uri(uri: str) -> str:
    """The name under which Arrow knows the file system of one of Hadoop's URIs."""
    scheme, mark, rest = uri.partition("://")
    return {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a URI that Spark's configuration names."""
    return pafs.FileSystem.from_uri(arrow_uri(uri))


def write_records(df: DataFrame, tokenizer_path: str, pattern: str, end_id: int, vocabulary: int,
                  stages: Stages, id_col: str = "doc_id", text_col: str = "text",
                  shards: int | None = None) -> DataFrame:
    """Writes the shards and returns their manifest, one row for each shard,
    with `base`, the number of token ids in all shards before it."""
    spark = df.sparkSession
    small_batches(spark)
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    shared = spark.sparkContext.broadcast(content)  # size of the vocabulary
    key = f"records_{zlib.crc32(repr((content, pattern, width)).encode())}"
    target, end = stages.path("records"), end_id.to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(target)
        context = TaskContext.get()
        shard = context.partitionId()
        name = f"shard-{shard:06d}-{context.taskAttemptId()}"
        coder, out, index, at, total = None, None, [], 0, 0
        for ids, texts in text_batches(batches, "id", "text", raw=True):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}.rec")
                coder = per_worker(key, lambda: TextCoder(shared.value, pattern, width))
            for doc, coded in zip(ids, coder.code(texts)):
                data = frame(b"".join((bytes([doc is None]), (doc or 0).to_bytes(8, "little", signed=True),
                                       coded, end)))
                out.write(data)
                index.append((at, total, len(coded) // width + 1))
                at, total = at + len(data), total + len(coded) // width + 1
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as f:
                f.write(np.array(index, INDEX_ENTRY).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(index)], pa.int64()),
                 pa.array([total], pa.int64())], names=["shard", "path", "n_docs", "n_ids"])

    ordered = (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange(shards or partitions(spark), "id", F.xxhash64("text"))
               .sortWithinPartitions("id", F.xxhash64("text"), "text"))
    manifest = stages.put("manifest", ordered.mapInArrow(run, MANIFEST))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return manifest.select("shard", F.concat(F.lit(f"{target}/"), "path").alias("path"), "n_docs", "n_ids",
                           F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"),
                           F.lit(width).alias("width"))


def read_records(manifest: DataFrame, shuffle_seed: int | None = None) -> DataFrame:
    """(id, start, n_tokens, ids binary as unsigned 32-bit integers) of every
    frame, checked; in file order, or by the index in a seeded random order
    within each shard."""
    schema = "id long, start long, n_tokens long, ids binary"

    def frames(fs, path: str):
        with fs.open_input_file(f"{path}.idx") as f:
            index = np.frombuffer(f.read(), INDEX_ENTRY)
        if shuffle_seed is None:
            with fs.open_input_stream(f"{path}.rec", buffer_size=1 << 20) as stream:
                for entry in index:
                    yield entry, read_frame(stream)
                if read_frame(stream) is not None:
                    raise CorruptRecord("more frames than index entries")
        else:
            seed = [shuffle_seed, *path.rpartition("/")[2].split("-")[1].encode()]
            with fs.open_input_file(f"{path}.rec") as stream:
                for entry in np.random.default_rng(seed).permutation(index):
                    stream.seek(int(entry["offset"]))
                    yield entry, read_frame(stream)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = file_system(row["path"])
                out, size = ([], [], [], []), 0
                for entry, payload in frames(fs, path):
                    if payload is None:
                        raise CorruptRecord("fewer frames than index entries")
                    ids = np.frombuffer(payload, f"<u{row['width']}", offset=9).astype("<u4").tobytes()
                    for column, x in zip(out, (None if payload[0] else int.from_bytes(payload[1:9], "little", signed=True),
                                               row["base"] + int(entry["ids_before"]), len(ids) // 4, ids)):
                        column.append(x)
                    size += len(ids)
                    if size >= 4_000_000:
                        yield arrays(out)
                        out, size = ([], [], [], []), 0
                yield arrays(out)

    def arrays(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
            names=["id", "start", "n_tokens", "ids"])

    spread = manifest.select("path", "base", "width").repartition(partitions(manifest.sparkSession))
    return spread.mapInArrow(run, schema)
