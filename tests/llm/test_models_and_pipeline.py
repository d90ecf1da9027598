"""Classifier, multi-index, near-dedup and the pipeline."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import COLUMNS, documents
from pyspark.sql import functions as F
from test_native import brute_runs

from corpusmill.llm import classifier, components, multi_index, near_dedup, shingles
from corpusmill.llm.common import Stages
from corpusmill.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


# classifier

def test_held_out_accuracy(spark):
    rows = QUERIES["op8_quality_classifier"](spark, SF01).join(
        spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(r.predicted for r in held if r.quality)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_labels_are_never_seen(spark, small_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    out = classifier.held_out(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert classifier.train(small_docs, labels, usable=~out) == classifier.train(small_docs, flipped, usable=~out)


def test_features_are_distinct():
    features = classifier.featurizer(12)
    for text in ("", "a", "ab ab ab ab", "é" * 300):
        x = features(text)
        assert len(x) == len(set(x.tolist()))
    assert len(features("")) == 0


def test_classifier_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(12, 1), (12, 0), (None, 1), (15, None), (999, 0)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        rows = classifier.score(edge_docs, classifier.train(edge_docs, given)).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert [c for c in rows[0].asDict()] == [*edge_docs.columns, "score"]
    assert classifier.score(empty_docs, classifier.train(empty_docs, labels)).collect() == []


def test_labels_without_documents_use_up_no_rows(spark, words):
    texts = [" ".join(words[i:i + 20]) if i % 2 else "bad " * 20 for i in range(40)]
    docs = documents(spark, texts)
    own = [(i, i % 2) for i in range(40)]
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    few = classifier.Training(max_rows=40, bits=12)
    assert classifier.train(docs, labels(own + [(1000 + i, 0) for i in range(4000)]), few) == \
        classifier.train(docs, labels(own), few)


# multi-index

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def exact(data, k=20):
    """{query: [(score, id)]} by brute force."""
    ids = np.array([i for i, _ in data])
    x = np.array([v for _, v in data], dtype=np.float32).astype(float)
    out = {}
    for i, v in zip(ids, x):
        if i % 20 == 0:
            s = x @ v
            out[int(i)] = sorted((-float(a), int(b)) for a, b in zip(s, ids) if b != i)[:k]
    return out


def test_recall_and_order(spark):
    rows = QUERIES["op5_nearest_neighbours"](spark, SF01).collect()
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    want, found, got = exact(data), Counter(), {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    for q, near in got.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, 21))
        found[q] = len({n[1] for n in near} & {i for _, i in want[q]})
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(near, near[1:]))
    assert sum(found.values()) / (20 * len(want)) >= 0.9


def test_equal_vectors_and_unusable_ones(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(size=8).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=8).tolist(), 0) for i in range(300)]
    good = list(rows)
    rows += [(400, None, 0), (420, [0.0] * 8, 0), (440, [float("nan")] * 8, 0), (460, [1.0, None] * 4, 0),
             (480, [float("inf")] * 8, 0), (500, [1.0], 0), (None, hot, 0), (rows[7][0], rows[7][1], 0)]
    index = multi_index.MultiIndex(visit_share=1.0, centroids=5, block_rows=16)
    found = multi_index.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, Stages(spark, "t"), index).collect()
    want = exact([(i, v) for i, v, _ in good])
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.rank] = (r.id, r.score)
    assert set(got) == set(want)
    for q, near in want.items():
        assert [got[q][k + 1][0] for k in range(20)] == [i for _, i in near]
        assert [got[q][k + 1][1] for k in range(20)] == pytest.approx([-s for s, _ in near], abs=1e-12)


def test_few_or_no_vectors(spark):
    few = vectors(spark, [(0, [1.0, 2.0], 0), (3, [2.0, 1.0], 0), (20, [0.5, 0.0], 0)])
    found = multi_index.search(few, F.col("vec_id") % 20 == 0, Stages(spark, "t")).collect()
    assert Counter(r.query_id for r in found) == {0: 2, 20: 2}
    assert multi_index.search(few.limit(0), F.col("vec_id") % 20 == 0, Stages(spark, "t")).collect() == []


def test_walk_takes_cells_in_falling_order():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b, counts = rng.normal(size=6), rng.normal(size=5), rng.integers(0, 4, 30)
        bits = multi_index.visited(a, b, counts, 15)
        sums = (a[:, None] + b[None]).reshape(-1)
        assert sums[bits].min() >= sums[~bits].max(initial=-9) and counts[bits].sum() >= 15


# near-dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingle_set(text, width=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if 100 * min(len(sets[a]), len(sets[b])) < 75 * max(len(sets[a]), len(sets[b])):
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def check(spark, df):
    rows = near_dedup.near_duplicates(df, Stages(spark, "t")).collect()
    want = brute({r.doc_id: r.text for r in df.select("doc_id", "text").collect()})
    assert len(rows) == len(want)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == want[r.id], r.id
    return rows


def test_shingle_sets_and_sketches(edge_texts):
    texts = [t or "" for t in edge_texts]
    hashes, offsets = shingles.shingle_sets(texts)
    assert np.diff(offsets).tolist() == [len(shingle_set(t)) for t in texts]
    sketch = shingles.sketches(hashes, offsets)
    filled = (sketch != np.uint64(0xFFFFFFFFFFFFFFFF)).all(axis=1)
    assert filled.tolist() == (np.diff(offsets) > 0).tolist()  # every coordinate, however small the set


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for shared in (50, 300, 900):
        x = np.unique(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
        y = np.concatenate([x[:shared], rng.integers(1 << 62, 1 << 63, 1000 - shared).astype(np.uint64)])
        s = shingles.sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        assert abs((s[0] == s[1]).mean() - shared / (2000 - shared)) < 0.15


def test_near_copies(spark, words, small_docs, edge_docs):
    check(spark, small_docs)
    check(spark, edge_docs)
    rng = random.Random(9)
    base = [rng.choice(words) for _ in range(120)]

    def edited(w, n):
        w = list(w)
        for _ in range(n):
            w[rng.randrange(len(w))] = rng.choice(words)
        return w

    family = [edited(base, rng.randint(0, 4)) for _ in range(150)]
    chain = [base]
    for _ in range(25):
        chain.append(edited(chain[-1], 3))
    texts = [" ".join(w) for w in family + chain] + [" ".join(base)] * 40 + [" ".join(w[:30]) for w in family[:60]]
    rng.shuffle(texts)
    rows = check(spark, documents(spark, texts))
    assert max(Counter(r.component_id for r in rows).values()) > 150


def test_small_blocks_give_the_same(spark, small_docs):
    how = near_dedup.NearDedup(block=2, cell_pairs=2)
    plain = near_dedup.near_duplicates(small_docs, Stages(spark, "t")).collect()
    assert sorted(plain) == sorted(near_dedup.near_duplicates(small_docs, Stages(spark, "t"), how).collect())


def test_near_dedup_null_ids_repeats_and_no_rows(spark, words, empty_docs):
    assert near_dedup.near_duplicates(empty_docs, Stages(spark, "t")).collect() == []
    long = " ".join(words[:60])
    df = spark.createDataFrame([(None, long), (None, long), (7, long), (7, long), (3, long + " x"), (8, None)],
                               "doc_id long, text string")
    got = Counter((r.id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, Stages(spark, "t")).collect())
    assert got == {(None, None, True): 2, (7, 3, False): 2, (3, 3, True): 1, (8, 8, True): 1}
    left = near_dedup.one_of_each(df.union(df), Stages(spark, "t")).collect()
    assert Counter(r.doc_id for r in left) == {None: 4, 3: 1, 8: 1}


def test_reused_ids_lose_no_other_text(spark, words):
    a, b, c = (" ".join(words[i:i + 60]) for i in (0, 100, 200))
    rows = [(1, a), (5, a + " x"), (5, b), (5, b), (9, b + " y"), (7, c), (7, c + " z"), (7, a), (8, None), (8, ""), (None, a)]
    left = near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), Stages(spark, "t")).collect()
    got = Counter((r.doc_id, r.text) for r in left)
    assert {k: n for k, n in got.items() if k[0] != 7} == {(1, a): 1, (5, b): 1, (8, None): 1, (8, ""): 1, (None, a): 1}
    assert [(n, t in (c, c + " z")) for (i, t), n in got.items() if i == 7] == [(1, True)]


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 4)] + [(100 + i, 101 + i) for i in range(40)], "a long, b long")
    got = {r.node: r.comp for r in components.components(links, Stages(spark, "t"), "c").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 5: 5, **{100 + i: 100 for i in range(41)}}
    assert components.components(links.limit(0), Stages(spark, "t"), "c").collect() == []


# pipeline

def test_stages_do_what_they_say(spark, small):
    import corpus_pipeline as cp
    from corpusmill.llm import mixing
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages, kept = Stages(spark, "t"), []
    for i, (name, stage) in enumerate(cp.STAGES):
        docs = stages.put(name, stage(spark, docs, small))
        kept.append(docs.collect())
        assert docs.columns == (cp.COLUMNS if i < 4 else ["doc_id", "n_tokens", "ids", "round_trip"])
    quality = {r.doc_id: r.predicted for r in QUERIES["op8_quality_classifier"](spark, small).collect()}
    assert {r.doc_id for r in kept[0]} == {i for i, p in quality.items() if p}
    runs = brute_runs({r.doc_id: r.text for r in kept[0]})
    assert len(kept[1]) == len(kept[0]) and any(n for _, n in runs.values())
    for r in kept[1]:
        assert r.text == runs[r.doc_id][0] and r.n_chars == len(r.text)
    want = brute({r.doc_id: r.text for r in kept[1]})
    assert sorted(r.doc_id for r in kept[2]) == sorted(i for i, (_, _, k) in want.items() if k)
    words = {r.doc_id: len(WORD.findall(r.text)) for r in kept[2]}
    source = {r.doc_id: r.source for r in kept[2]}
    size, taken = Counter(), Counter()
    for i, n in words.items():
        size[source[i]] += n
    for r in kept[3]:
        taken[source[r.doc_id]] += words[r.doc_id]
    names = sorted(size)
    for name, goal in zip(names, mixing.targets([size[s] for s in names], mixing.Mix())):
        assert abs(taken[name] - goal) <= max(n for i, n in words.items() if source[i] == name)
    assert Counter(r.doc_id for r in kept[4]) == Counter(r.doc_id for r in kept[3]) and all(r.round_trip for r in kept[4])


def test_pipeline_on_nulls_repeats_and_clashing_columns(spark, small, edge_docs, words):
    import corpus_pipeline as cp
    same, other = "\n".join(words[:60]), "\n".join(words[100:160])
    more = spark.createDataFrame([(None, same), (None, same), (None, other), (7, None), (7, None), (3, "\n\n"), (200, same), (200, same)],
                                 "doc_id long, text string")
    docs = edge_docs.unionByName(more, allowMissingColumns=True).withColumns(
        {c: F.lit("clash") for c in ("score", "drop", "part", "n", "taken", "component_id", "ids", "n_tokens", "round_trip")})
    stages, kept = Stages(spark, "t"), [docs.collect()]
    for name, stage in cp.STAGES:
        docs = stages.put(name, stage(spark, docs, small))
        kept.append(docs.collect())
    of = lambda rows, *names: Counter(tuple(r[c] for c in names) for r in rows)
    assert of(kept[1], "doc_id", "text") <= of(kept[0], "doc_id", "text")
    assert of(kept[2], "doc_id") == of(kept[1], "doc_id")                  # line dedup loses no document
    whole = lambda rows: of([r for r in rows if r.doc_id is None], "text")
    assert whole(kept[2]) == whole(kept[1])                                # rows without an id stay as they are
    assert of(kept[3], "doc_id", "text") <= of(kept[2], "doc_id", "text")
    assert set(of(kept[4], "doc_id", "text")) <= set(of(kept[3], "doc_id", "text"))
    assert of(kept[5], "doc_id") == of(kept[4], "doc_id") and all(r.round_trip for r in kept[5])
    assert all(bytes(r.ids) == b"" for r in kept[5] if r.n_tokens == 0)


def test_pipeline_without_rows(spark, small, empty_docs):
    import corpus_pipeline as cp
    docs = empty_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, small)
    assert docs.collect() == []


def test_registered(spark, small):
    import __spark_entry__ as entry
    names = entry.queries()
    assert [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in names)] == [] and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
    assert names["pipeline"](spark, small).where("not round_trip").count() == 0


def test_words_of_equal_power_sums_are_no_near_copies(spark):
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    texts = ["".join(pair[b] for b in bits[:n]) for n in (1024, 2048) for pair in ("ab", "ba")]
    found = near_dedup.near_duplicates(documents(spark, texts), Stages(spark, "near"))
    assert sorted((r.id, r.n_shingles, r.component_id, r.kept) for r in found.collect()) == [(i, 1, i, True) for i in range(4)]


def test_fit_holds_its_rows_once(words):
    rng = random.Random(8)
    rows = [(" ".join(rng.choice(words) for _ in range(400)), k % 2) for k in range(200)]
    training = classifier.Training(bits=14, epochs=2)
    features = sum(len(classifier.featurizer(14)(text)) for text, _ in rows)
    tracemalloc.start()
    try:
        _, _, bias, slope, offset = classifier.fit(rows, training)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.isfinite([bias, slope, offset]).all()
    assert peak < 8 * features + 3_000_000, (peak, features)


def test_encoder_and_decoder_are_in_stages_of_their_own(spark, small, small_docs):
    import corpus_pipeline as cp

    encoded = cp.encode(spark, small_docs, small)
    assert encoded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert encoded.where("round_trip").count() == small_docs.count()
