"""Ranked lexical search of many items at once over all documents.

Terms are maximal runs of ASCII letters and digits and of characters outside
ASCII, A-Z lower-cased.  A document's score for an item sums, over the item's
terms with repeats, weight * saturated frequency, all in 64-bit integers:

    weight      floor(1000 ln((2 N + 2) / (2 df + 1)))
    frequency   (10^9 tf) div (1000 tf + 8 m),  m = 25 + (75 n N) div L

with N documents that have a term, L terms in all of them, n in the document,
df documents that hold the term, tf places in the document.

Items share terms, so their sums share parts (multi-query common
subexpressions).  `share` mines them: terms that stand in the same items equally
often become one node, then the pair of nodes that most items hold equally often
becomes a node of its own, again and again.  The nodes form a graph without cycles; over
a block of documents each node's accumulators are added up once, from those of
its parts, and an item combines the few nodes that are left of it.

Pass one counts the items' terms in every document (a table of the matched
terms alone); Spark sums N, L and df from it.  Pass two scores blocks of
documents, keeps each item's best of a partition, and two ranked selections, the
first on hashed parts of the documents, leave `top` rows an item.  Items are
taken in groups of bounded text, so that their vocabulary and graph, which go to
every task, have a bound however many items there are.

Null texts and texts without terms have no terms: such documents count nowhere,
such items get no rows.  Rows that repeat an item's id and text are one item;
other texts under the id are items of their own.  Every row of the documents is
a document; equal scores go by ascending id, null ids last.  Extra columns
are ignored.  Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusmill.llm.common import Stages, small_batches, text_batches


@dataclass(frozen=True)
class Ranking:
    top: int = 10
    item_bytes: int = 2_000_000   # text of the items of one group, about
    shared_nodes: int = 20_000    # pairs of nodes that become nodes of their own, at most, in a group
    pair_nodes: int = 64          # nodes of an item whose pairs are looked at: those most items share
    cells: int = 4_000_000        # accumulators held at once
    parts: int = 64               # parts of the documents whose best rows are selected first


_KEEP = {b for b in range(0x80) if chr(b).isalnum()}
_TABLE = bytes((b | 0x20 if 0x41 <= b <= 0x5A else b) if b in _KEEP or b >= 0x80 else 0x20 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_TABLE).split()


@dataclass(frozen=True)
class Graph:
    """Nodes 0 .. n_terms - 1 are single terms; node n_terms + i adds up the
    nodes parts[i], all of them before it.  An item is sums[k]: (nodes, times)."""
    n_terms: int
    parts: list[list[int]]
    sums: list[tuple[list[int], list[int]]]


def share(items: list[dict[int, int]], n_terms: int, how: Ranking = Ranking()) -> Graph:
    """The graph of items given as {term: times}."""
    left = [dict(i) for i in items]
    parts: list[list[int]] = []
    owners: dict[int, set[int]] = defaultdict(set)
    for k, item in enumerate(left):
        for t in item:
            owners[t].add(k)
    # terms that the same items hold equally often
    alike = defaultdict(list)
    for t, own in owners.items():
        if len(own) > 1:
            alike[tuple((k, left[k][t]) for k in sorted(own))].append(t)
    for where, group in alike.items():
        if len(group) > 1:
            node = n_terms + len(parts)
            parts.append(sorted(group))
            for k, times in where:
                for t in group:
                    del left[k][t]
                left[k][node] = times
            owners[node] = {k for k, _ in where}
            for t in group:
                owners[t] = set()

    def most_shared(item: dict[int, int]) -> list[int]:
        several = [x for x in item if len(owners[x]) > 1]
        return sorted(sorted(several, key=lambda x: (-len(owners[x]), x))[:how.pair_nodes])

    pairs = Counter((x, y) for item in left for x, y in combinations(most_shared(item), 2) if item[x] == item[y])
    heap = [(-n, p) for p, n in pairs.items() if n > 1]
    heapq.heapify(heap)
    made = 0
    while heap and made < how.shared_nodes:
        n, (x, y) = heapq.heappop(heap)
        both = {k for k in owners[x] & owners[y] if left[k][x] == left[k][y]}
        if len(both) != -n:  # counted before one of them went into another node
            if len(both) > 1:
                heapq.heappush(heap, (-len(both), (x, y)))
            continue
        node, made = n_terms + len(parts), made + 1
        parts.append([x, y])
        owners[node] = both
        for k in both:
            left[k][node] = left[k].pop(x)
            del left[k][y]
        owners[x], owners[y] = owners[x] - both, owners[y] - both
        new = Counter((z, node) for k in both for z in most_shared(left[k]) if z != node and left[k][z] == left[k][node])
        for pair, m in new.items():
            if m > 1:
                heapq.heappush(heap, (-m, pair))
    return Graph(n_terms, parts, [([*i], [*i.values()]) for i in left])


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


def contributions(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """What a term adds to the score of a document of n terms."""
    m = 25 + 75 * n * n_docs // total
    return weight * (10 ** 9 * tf // (1000 * tf + 8 * m))


class Best:
    """The best documents of every item so far."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, np.int64)  # scores below cannot enter
        none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        self.rows = [none] * n_items

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """`scores` [items, documents]."""
        reached = np.flatnonzero(scores.max(axis=1, initial=0) >= self.least)
        for k in reached.tolist():
            at = np.flatnonzero(scores[k] >= self.least[k])
            s, u, d = (np.concatenate(c) for c in zip(self.rows[k], (scores[k][at], null[at], ids[at])))
            order = np.lexsort((d, u, -s))[:self.top]
            self.rows[k] = (s[order], u[order], d[order])
            if len(order) == self.top:
                self.least[k] = s[order[-1]]


def accumulate(graph: Graph, acc: np.ndarray) -> np.ndarray:
    """Scores [items, documents] from `acc` [nodes, documents], of which the
    terms' rows are filled in."""
    for i, own in enumerate(graph.parts):
        np.sum(acc[own], axis=0, out=acc[graph.n_terms + i])
    out = np.zeros((len(graph.sums), acc.shape[1]), np.int64)
    for k, (nodes, times) in enumerate(graph.sums):
        if nodes:
            rows = acc[nodes]
            if max(times) > 1:
                rows = rows * np.array(times, np.int64)[:, None]
            np.sum(rows, axis=0, out=out[k])
    return out


def term_table(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of the documents with a term: the number of terms,
    and the places and frequencies of those in the broadcast vocabulary."""
    id_type = docs.schema[id_col].dataType

    def run(batches):
        known = vocabulary.value
        for ids, texts in text_batches(batches, "id", "text", raw=True):
            words = list(map(terms, texts))
            n = np.fromiter(map(len, words), np.int64, len(words))
            place = np.fromiter(map(known.get, chain.from_iterable(words), repeat(-1)), np.int64, int(n.sum()))
            owner = np.repeat(np.arange(len(words)), n)[place >= 0]
            found, tf = np.unique(owner * max(len(known), 1) + place[place >= 0], return_counts=True)
            owner, place = np.divmod(found, max(len(known), 1))
            edges = np.searchsorted(owner, np.arange(len(words) + 1))
            some = n > 0
            lists = lambda x: pa.ListArray.from_arrays(
                pa.array(edges, pa.int32()), pa.array(x, pa.int32())).filter(pa.array(some))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, to_arrow_type(id_type)).filter(pa.array(some)), pa.array(n[some], pa.int64()), lists(place), lists(tf)],
                names=["id", "n", "terms", "tfs"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {id_type.simpleString()}, n long, terms array<int>, tfs array<int>"))


def scored(counted: DataFrame, graph, weight: np.ndarray, n_docs: int, total: int, how: Ranking) -> DataFrame:
    """(item, id, score): the best rows of each partition for each item of the broadcast graph."""
    def run(batches):
        g = graph.value
        best = Best(len(g.sums), how.top)
        n_nodes = g.n_terms + len(g.parts)
        width = max(1, how.cells // (n_nodes + len(g.sums)))
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                places, tfs = part.column("terms"), part.column("tfs")
                size = np.diff(np.asarray(places.offsets))
                term, tf = (np.asarray(x.flatten()).astype(np.int64) for x in (places, tfs))
                owner = np.repeat(np.arange(part.num_rows), size)
                n = np.asarray(part.column("n"))[owner]
                acc = np.zeros((n_nodes, part.num_rows), np.int64)
                acc[term, owner] = contributions(weight[term], tf, n, n_docs, total)
                ids = part.column("id")
                best.add(accumulate(g, acc), np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(ids.is_null()))
        sizes = [len(r[0]) for r in best.rows]
        if sum(sizes):
            s, null, d = (np.concatenate(c) for c in zip(*best.rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                 pa.array(d, pa.int64(), mask=null), pa.array(s, pa.int64())], names=["item", "id", "score"])

    return counted.mapInArrow(run, "item int, id long, score long")


def _best_rows(found: DataFrame, by: list, how: Ranking) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.top)


def rank(docs: DataFrame, items: DataFrame, stages: Stages, how: Ranking = Ranking(), id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank int, id, score long): each item's best documents, best first."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-size // how.item_bytes) or 1
    out, item_type = [], items.schema[item_col].dataType.simpleString()
    for g in range(groups):
        # a group of items, bounded by the groups' number
        own = asked.where(F.pmod(F.xxhash64("text"), F.lit(groups)) == g).collect()
        counts = [Counter(terms(r.text.encode("utf-8", "surrogatepass"))) for r in own]
        place = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        if not place:
            continue
        counted = stages.put(f"terms-{g}", term_table(docs, spark.sparkContext.broadcast(place), id_col, text_col))
        n_docs, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(place), np.int64)
        for t, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row for each term of the items
            df[t] = n
        graph = share([{place[t]: n for t, n in c.items()} for c in counts], len(place), how)
        found = scored(counted, spark.sparkContext.broadcast(graph), weights(n_docs, df), n_docs, total, how)
        first = _best_rows(found, ["item", F.pmod(F.xxhash64("id"), F.lit(how.parts))], how)
        best = _best_rows(first.drop("rank"), ["item"], how)
        names = spark.createDataFrame([(k, r.item) for k, r in enumerate(own)], f"k int, name {item_type}")
        out.append(best.join(F.broadcast(names), F.col("item") == F.col("k"))  # the group's items
                   .select(F.col("name").alias("item"), "rank", "id", "score"))
    if not out:
        return spark.createDataFrame([], f"item {item_type}, rank int, id long, score long")
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result
