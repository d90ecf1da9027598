import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_helpers import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import bpe, records
from corpusmill.llm.common import Stages

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def round_trip(df):
    ranks = bpe.read_ranks(RANKS)
    return bpe.decode(bpe.encode(df, ranks, public_tokenizers.PATTERN), ranks).collect()


def agrees(rows, texts, library):
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text), text[:80]
        assert r.n_tokens == len(r.ids) // 4 and bytes(r.decoded) == text.encode()


def test_ids_equal_the_library(spark, edge_docs, edge_texts, small_docs, library):
    agrees(round_trip(edge_docs), dict(enumerate(edge_texts)), library)
    agrees(round_trip(small_docs), {r.doc_id: r.text for r in small_docs.collect()}, library)


def test_null_ids_repeated_rows_and_no_rows(spark, empty_docs):
    assert round_trip(empty_docs) == []
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert len({bytes(r.ids) for r in round_trip(df)}) == 1


def written(spark, df, shards=3):
    return records.write_records(df, JSON, public_tokenizers.PATTERN, 2, 50257, Stages(spark, "test"), shards=shards)


def test_records_in_id_order(spark, edge_docs, edge_texts):
    t = Tokenizer.from_file(JSON)
    rows = sorted(records.read_records(written(spark, edge_docs)).collect(), key=lambda r: r.id)
    start = 0
    for r, text in zip(rows, edge_texts, strict=True):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert (bytes(r.ids), r.start, r.n_tokens) == (ids, start, len(ids) // 4)
        start += r.n_tokens


def test_shuffled_read_gives_the_same_rows(spark, small_docs):
    manifest = written(spark, small_docs)
    plain, mixed = (records.read_records(manifest, seed).collect() for seed in (None, 7))
    assert sorted(plain) == sorted(mixed) and plain != mixed


def test_null_ids_and_no_rows(spark, empty_docs):
    assert records.read_records(written(spark, empty_docs)).collect() == []
    df = spark.createDataFrame([(5, "b"), (None, "a"), (-3, None), (5, "b")], "doc_id long, text string")
    got = sorted((r.start, r.id, r.n_tokens) for r in records.read_records(written(spark, df)).collect())
    assert got == [(0, None, 2), (2, -3, 1), (3, 5, 2), (5, 5, 2)]


def test_damage_is_found(spark, small_docs):
    import pyarrow.fs as pafs
    manifest = written(spark, small_docs, 1)
    fs, path = pafs.FileSystem.from_uri(manifest.first().path)
    data = bytearray(fs.open_input_file(path + ".rec").read())
    data[40] ^= 1
    with fs.open_output_stream(path + ".rec") as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="checksum"):
        records.read_records(manifest).collect()


def test_queries(spark, small):
    from corpusmill.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op1_bpe_roundtrip"](spark, small).collect():
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    got = QUERIES["op9_binary_records"](spark, small).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == sorted(docs)
    t = Tokenizer.from_file(JSON)
    assert got[3].ids_crc32 == zlib.crc32(np.array(t.encode(docs[got[3].doc_id]).ids + [2], "<u4").tobytes())
    assert F.crc32 is not None


def test_fragments_equal_the_whole_text():
    """Random texts of awkward pieces, through a cache that turns over."""
    import random

    from corpusmill.llm.pretokens import PretokenCoder
    t = Tokenizer.from_file(JSON)
    with open(JSON, encoding="utf-8") as f:
        coder = PretokenCoder(public_tokenizers.PATTERN, *records.tokenizer_encoders(f.read(), 2), 2, max_entries=300)
    rng, pieces = random.Random(1), [*"ab. ,;\n\n  \tA1é»… 's!?-_ñ  \x1c　漢<", "the", "Foo", "ing ", ".\n", " 'll"]
    for _ in range(60):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(40)]
        for text, got in zip(texts, coder.code([x.encode() for x in texts]), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == t.encode(text, add_special_tokens=False).ids, text


ADDED = ["<|endoftext|>", "a b <|endoftext|> c", "<|endoftext|>start", "in<|endoftext|>side", "end <|endoftext|>",
         "twice <|endoftext|><|endoftext|> over", " \n<|endoftext|>\n\n x", "<|endoftext|", "<|end<|endoftext|>oftext|>", "plain", ""]


def test_added_tokens_inside_texts(spark):
    t = Tokenizer.from_file(JSON)
    rows = sorted(records.read_records(written(spark, documents(spark, ADDED))).collect(), key=lambda r: r.id)
    start = 0
    for r, text in zip(rows, ADDED, strict=True):
        want = [*t.encode(text, add_special_tokens=False).ids, 2]
        assert (np.frombuffer(r.ids, "<u4").tolist(), r.start) == (want, start), text
        start += len(want)


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}])
def test_other_added_tokens(flags):
    from tokenizers import AddedToken
    t = Tokenizer.from_file(JSON)
    t.add_tokens([AddedToken(x, normalized=False, **flags) for x in ("<x>", "<x><y>", "é")])
    coder = records.TextCoder(t.to_str(), public_tokenizers.PATTERN, 4)
    texts = [*ADDED, "a <x> b", "<x><y><x>", "caf é café  é", " <x><y> <|endoftext|>"]
    for text, got in zip(texts, coder.code([x.encode() for x in texts]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def thue_morse(n):
    """Two different words of n letters whose sums of powers modulo 2^64 agree, whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_words_of_equal_power_sums(spark, library, n):
    s, t = thue_morse(n)
    texts = [f"x {s}", f"x {t}", f"x {s} {t} {s}", s, t]
    agrees(round_trip(documents(spark, texts).coalesce(1)), dict(enumerate(texts)), library)
    tokenizer = Tokenizer.from_file(JSON)
    for r in records.read_records(written(spark, documents(spark, texts), shards=1)).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == [*tokenizer.encode(texts[r.id], add_special_tokens=False).ids, 2]


def test_ranges_are_grouped_by_their_bytes(monkeypatch):
    import random

    from corpusmill.llm import shingles
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.choice((0, 1, 7, 8, 9, 70)))) for _ in range(300)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    kind = np.array([rng.randint(0, 1) for _ in words])
    want = [(w, k) for w, k in zip(words, kind.tolist())]
    for all_collide in (False, True):
        if all_collide:
            monkeypatch.setattr(shingles, "mix", lambda x: x * np.uint64(0))
        where, inverse = shingles.distinct_ranges(data, ends - [len(w) for w in words], ends, kind)
        assert [want[k] for k in where[inverse]] == want and len(where) == len(set(want))


def test_long_fragments_are_not_kept():
    from corpusmill.llm.pretokens import PretokenCoder
    with open(JSON, encoding="utf-8") as f:
        coder = PretokenCoder(public_tokenizers.PATTERN, *records.tokenizer_encoders(f.read(), 2), 2)
    t = Tokenizer.from_file(JSON)
    texts = ["ab " + "q1" * 5000 + " cd", "-" * 3000, "ab cd"]
    for text, ids in zip(texts, coder.code([x.encode() for x in texts])):
        assert np.frombuffer(ids, "<u2").tolist() == t.encode(text, add_special_tokens=False).ids
    assert max(map(len, [*coder.fragments, *coder.tokens])) <= 257


def test_names_of_storage():
    same = ("file:/x/y", "file:///x/y", "/x/y", "hdfs://host:8020/x", "gs://bucket/x", "s3://bucket/x")
    assert [records.arrow_uri(u) for u in same] == list(same)
    assert records.arrow_uri("s3a://bucket/a/b") == records.arrow_uri("s3n://bucket/a/b") == "s3://bucket/a/b"
    fs, path = records.file_system("file:///tmp/x")
    assert fs.type_name == "local" and path == "/tmp/x"
