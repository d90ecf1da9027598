import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import documents

from corpusmill.llm import lexical
from corpusmill.llm.common import Stages

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def spelled(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """{item: [(rank, id, score)]} from (id, text) rows, each pair of item and document scored on its own."""
    words = [(i, spelled(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = {}
    for item, text in items:
        scores = []
        for i, own in words:
            tf, m = Counter(own), 100 - 75 + 75 * len(own) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in spelled(text) if tf[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out[item] = [(r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return out


def got(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (str(r.item), r["rank"])):
        out.setdefault(r.item, []).append((r["rank"], r.id, r.score))
    return out


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def asked(words):
    rng = random.Random(3)
    common = words[:12]
    rows = [(k, " ".join(rng.sample(common, 6) + [rng.choice(words) for _ in range(8)])) for k in range(40)]
    return [*rows, (100, None), (101, ""), (102, "?!"), (103, "a A b x"), (104, "a a a"), (105, "emoji 😀 ÜNÏCODE line"), (106, "nowhere")]


def test_equals_every_pair_scored(spark, edge_docs, edge_texts, asked):
    want = {k: v for k, v in brute(list(enumerate(edge_texts)), asked).items() if v}
    found = lexical.rank(edge_docs, items_table(spark, asked), Stages(spark, "t"))
    assert got(found) == want


def test_item_groups_blocks_and_parts_change_nothing(spark, edge_docs, asked):
    plain = got(lexical.rank(edge_docs, items_table(spark, asked), Stages(spark, "t")))
    how = lexical.Ranking(item_bytes=900, cells=500, parts=2, shared_nodes=3, pair_nodes=2)
    assert got(lexical.rank(edge_docs.repartition(5), items_table(spark, asked), Stages(spark, "t"), how)) == plain


def test_ties_repeats_nulls(spark):
    texts = ["same words here"] * 30 + [None, "other"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "same words here"), (3, "same words here")], "doc_id long, text string")
    items = items_table(spark, [(1, "words"), (1, "words"), (2, "same"), (2, "other"), (None, "here")])
    found = got(lexical.rank(docs, items, Stages(spark, "t")))
    assert [(r, i) for r, i, _ in found[1]] == list(zip(range(1, 11), [0, 1, 2, 3, 3, 4, 5, 6, 7, 8]))
    assert [i for _, i, _ in found[None]] == [0, 1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert len(found[2]) == 11  # two items under one id
    few = lexical.rank(docs.where("doc_id is null or doc_id > 28"), items, Stages(spark, "t"))
    assert [i for _, i, _ in got(few)[1]] == [29, None]


def test_empty_tables(spark, empty_docs, small_docs):
    none = items_table(spark, [])
    assert lexical.rank(small_docs, none, Stages(spark, "t")).collect() == []
    assert lexical.rank(empty_docs, items_table(spark, [(1, "a")]), Stages(spark, "t")).collect() == []
    assert lexical.rank(documents(spark, [None, "", "?"]), items_table(spark, [(1, "a")]), Stages(spark, "t")).collect() == []


def expanded(graph, nodes, times):
    out = Counter()
    for node, k in zip(nodes, times):
        if node < graph.n_terms:
            out[node] += k
        else:
            part = graph.parts[node - graph.n_terms]
            assert max(part) < node
            out.update(expanded(graph, part, [k] * len(part)))
    return out


def test_shared_sums_are_the_items():
    rng = random.Random(9)
    topics = [rng.sample(range(60), 8) for _ in range(6)]
    items = [Counter(rng.choice(topics) + rng.choice(topics) + [int(rng.paretovariate(0.7)) % 60 for _ in range(5)]) for _ in range(50)]
    graph = lexical.share([dict(i) for i in items], 60)
    assert [expanded(graph, *s) for s in graph.sums] == items
    plain = sum(len(i) for i in items)
    shared = sum(len(p) for p in graph.parts) + sum(len(s[0]) for s in graph.sums)
    assert graph.parts and shared < 0.8 * plain  # each sum is added up once
    values = np.array([[rng.randint(0, 99) for _ in range(7)] for _ in range(60)])
    acc = np.zeros((60 + len(graph.parts), 7), np.int64)
    acc[:60] = values
    assert np.array_equal(lexical.accumulate(graph, acc), [sum(values[t] * k for t, k in i.items()) for i in items])


def test_query(spark, small):
    from corpusmill.llm.queries import QUERIES
    read = lambda name: [tuple(r) for r in spark.read.parquet(f"{small}/{name}.parquet").selectExpr(
        "doc_id" if name == "documents" else "item_id", "text").collect()]
    rows = QUERIES["op11_lexical_search"](spark, small).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.item_id, r["rank"])):
        found.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert found == {k: v for k, v in brute(read("documents"), read("benchmark")).items() if v}
