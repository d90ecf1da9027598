import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from llm_helpers import documents
from pyspark.sql import functions as F

from corpusmill.llm import suffix_dedup as sd
from corpusmill.llm.common import Stages


def brute(texts, n=50):
    """{id: (n_bytes, [edges], kept)}; ids in order, equal ids never remove each other."""
    first = {}
    for i, t in texts:
        b = (t or "").encode()
        for k in range(len(b) - n + 1):
            w = b[k:k + n]
            if i < first.get(w, 1 << 62):
                first[w] = i
    out = {}
    for i, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - n + 1):
            if first[b[k:k + n]] < i:
                gone[k] += 1
                gone[k + n] -= 1
        mask = np.cumsum(gone)[:-1] > 0 if len(b) else np.zeros(0, bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).view(np.int8))).tolist()
        out[i] = (len(b), edges, bytes(x for x, m in zip(b, mask) if not m))
    return out


def check(spark, df, how=sd.Suffixes()):
    rows = sd.dedup_suffixes(df, Stages(spark, "t"), how).collect()
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert len(rows) == df.count()
    for r in rows:
        assert (r.n_bytes, list(r.edges), bytes(r.kept)) == want[r.id], r.id
    return want


def test_given_documents(spark, small_docs):
    want = check(spark, small_docs)
    assert sum(len(e) for _, e, _ in want.values()) > 20


def test_edge_texts(spark, edge_docs):
    check(spark, edge_docs)


def test_partial_overlaps_periods_and_hot_passages(spark, words):
    rng = random.Random(3)
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = some(60)
    texts = [some(40) + passage[rng.randrange(40):len(passage) - rng.randrange(40)] + some(rng.randrange(60)) for _ in range(120)]
    texts += ["ab" * 100, "ab" * 60, "ba" * 90, "a" * 49, "a" * 50, "a" * 51, "é" * 40, "x" + "é" * 40]
    base = texts[3]
    for cut in (1, 17, 18, 33, 34, 49, 50, 51):  # windows on either side of an anchor
        texts += [base[:len(base) - cut], base[cut:], some(3) + base[cut:cut + 50] + some(3), base[:cut] + "#" + base[cut:]]
    texts += [passage] * 30
    check(spark, documents(spark, texts))


def test_null_ids_repeats_and_no_rows(spark, words, empty_docs):
    assert sd.dedup_suffixes(empty_docs, Stages(spark, "t")).collect() == []
    long = " ".join(words[:40])
    df = spark.createDataFrame([(None, long), (None, long), (4, long), (4, long), (2, long + " x"), (9, None)],
                               "doc_id long, text string")
    got = {(r.id, bytes(r.kept)) for r in sd.dedup_suffixes(df, Stages(spark, "t")).collect()}
    assert got == {(None, b""), (4, b""), (2, (long + " x").encode()), (9, b"")}


def test_texts_without_id_are_told_apart(spark, words):
    passage, other = " ".join(words[:30]), " ".join(words[30:70])
    df = spark.createDataFrame([(1, passage), (None, "x " * 10 + passage + " tail"), (None, other), (None, other + " " + passage),
                                (None, None), ((1 << 63) - 1, other)], "doc_id long, text string")
    got = sorted((r.id or 0, r.n_bytes, list(r.edges), bytes(r.kept)) for r in sd.dedup_suffixes(df, Stages(spark, "t")).collect())
    p, q = len(passage.encode()), len(other.encode())
    # the passage goes from both rows without an id, the rest of each stays; equal order (null, largest id) removes nothing
    assert (0, q, [], other.encode()) in got and ((1 << 63) - 1, q, [], other.encode()) in got and (1, p, [], passage.encode()) in got
    assert (0, 20 + p + 5, [20, 20 + p], ("x " * 10 + " tail").encode()) in got
    assert (0, q + 1 + p, [q + 1, q + 1 + p], (other + " ").encode()) in got and (0, 0, [], b"") in got and len(got) == 6


def test_parts_agree_and_spread(spark):
    ids = [0, 1, -1, 64, 1 << 40, -(1 << 63), (1 << 63) - 2, *range(0, 64 * 4000, 64)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long").withColumn(
        "mark", F.when(F.col("id").isNull(), F.lit(12345678901)).otherwise(F.lit(0)))
    rows = df.select("id", "mark", sd.part_column(64).alias("part")).collect()
    doc = np.array([sd.NO_ID if r.id is None else r.id for r in rows], np.int64)
    want = sd.part_of(doc, np.array([r.mark for r in rows], np.int64), 64)
    assert [r.part for r in rows] == want.tolist()
    assert np.bincount(want, minlength=64).max() < 4 * len(ids) / 64  # ids of the partitions' stride


def test_small_ranges_give_the_same(spark, small_docs):
    check(spark, small_docs, sd.Suffixes(range_bytes=20_000))


def test_multikey_order():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 5, 500), rng.integers(0, 5, 500), rng.integers(0, 50, 500)]
    order = sd.multikey_order(*keys)
    assert [tuple(k[i] for k in keys) for i in order] == sorted(zip(*keys))


def test_query(spark, small):
    from corpusmill.llm.queries import QUERIES
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs])
    for r in QUERIES["op2_suffix_dedup"](spark, small).collect():
        n, edges, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            n, n - len(kept), len(edges) // 2, hashlib.sha256(kept).hexdigest())


def test_a_batch_takes_bounded_memory():
    rng = random.Random(9)
    texts = [bytes(rng.choices(range(97, 123), k=2000)) for _ in range(2000)]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([0] * n), pa.array(texts, pa.binary())], names=["id", "mark", "body"])
    tracemalloc.start()
    try:
        rows = 0
        for docs, marks, own in sd._texts(batch):
            sd.suffix_columns(sd.Prefixes(own), docs, marks, sd.Suffixes())
            rows += len(own)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        sd._power_cache.clear()
    assert rows == n and peak < 60_000_000, peak


def test_merged_columns_leave_no_pieces():
    pieces = [[np.arange(3), np.arange(3) + 10], [np.arange(2), np.arange(2) + 20]]
    a, b = sd.merged(pieces)
    assert a.tolist() == [0, 1, 2, 0, 1] and b.tolist() == [10, 11, 12, 20, 21] and not pieces
