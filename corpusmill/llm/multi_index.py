"""Nearest neighbours by inner product through an inverted multi-index.

Both halves of the vectors have centroids of their own, fitted on a bounded
sample; a vector's cell is the pair of its nearest centroids.  A query ranks
the centroids of each half by inner product and walks the pairs in falling
order of the two products' sum, with a heap, until the visited cells hold
`visit_share` of all vectors; these are ranked by the exact product.

Equal vectors are one entry that keeps its `k` + 1 smallest ids, enough for
any result, so a vector shared by many rows costs no more than another.
Entries lie in blocks of bounded size (large cells are split) and queries
stream past them, so no task holds more than a block and a batch of queries.

Vectors that are null, zero, or hold null or non-finite components take no
part; nor do rows with a null id or with a length other than the commonest
(the larger of two as common).  Rows that repeat an id and vector count once.
Ties go to the smaller id.  Extra columns are ignored.  With no vectors the
result is empty.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import Stages, partitions


@dataclass(frozen=True)
class MultiIndex:
    k: int = 20
    centroids: int = 64          # of each half
    sample_rows: int = 20_000    # the centroids are fitted on
    rounds: int = 10
    visit_share: float = 0.5
    block_rows: int = 4096
    seed: int = 42


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(data: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1) - 2 * data @ centres.T, axis=1)


def fit_half(sample: np.ndarray, index: MultiIndex, rng: np.random.Generator) -> np.ndarray:
    centres = sample[rng.choice(len(sample), min(len(sample), index.centroids), replace=False)].copy()
    for _ in range(index.rounds):
        own = nearest(sample, centres)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = sample[own == c].mean(axis=0)
    return centres


def visited(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """Cells (as bits over left x right) in falling order of the two products'
    sum, until they hold `wanted` vectors.  A pair enters the heap once both
    pairs before it, in its row and in its column, were taken."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    x, y = (-left[a]).tolist(), (-right[b]).tolist()
    n, m = len(x), len(y)
    held = counts.reshape(n, m)[a][:, b].tolist()
    taken = [0] * n  # pairs taken in each row: always a prefix
    heap, out = [(x[0] + y[0], 0, 0)], []
    while wanted > 0 and heap:
        _, i, j = heapq.heappop(heap)
        out.append(i * m + j)
        taken[i] = j + 1
        wanted -= held[i][j]
        if i + 1 < n and taken[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
        if j + 1 < m and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
    bits = np.zeros(n * m, dtype=bool)
    order = np.array(out, dtype=np.int64)
    bits[a[order // m] * m + b[order % m]] = True
    return bits


def entries(df: DataFrame, k: int, id_col: str, vector_col: str) -> DataFrame:
    """(v array<double>, rep, ids): one row for each distinct vector, with its k + 1 smallest ids."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("v") == (common["n"] if common else 0)).dropDuplicates(["id", "v"])
    smallest = rows.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("at") <= k + 1)
    return (smallest.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select("v", F.col("ids")[0].alias("rep"), "ids"))


def search(df: DataFrame, is_query: Column, stages: Stages, index: MultiIndex = MultiIndex(),
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank from 1, id, score) of each query's k nearest found."""
    spark = df.sparkSession
    n_parts = partitions(spark)
    distinct = stages.put("entries", entries(df, index.k, id_col, vector_col))
    sample = np.array([r.v for r in distinct.orderBy(F.xxhash64(F.lit(index.seed), "rep"), "rep")
                       .limit(index.sample_rows).select("v").collect()], dtype=np.float64)
    schema = f"query_id {df.schema[id_col].dataType.simpleString()}, rank int, id long, score double"
    if not len(sample):
        return spark.createDataFrame([], schema)
    half, rng = sample.shape[1] // 2, np.random.default_rng(index.seed)
    centres = [fit_half(sample[:, :half], index, rng), fit_half(sample[:, half:], index, rng)]
    n_right = len(centres[1])
    shared = spark.sparkContext.broadcast(centres)  # 2 x centroids vectors

    def place(batches):
        left, right = shared.value
        for batch in batches:
            v = matrix(batch.column("v"))
            cell = nearest(v[:, :half], left) * n_right + nearest(v[:, half:], right)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=[*batch.schema.names, "cell"])

    placed = stages.put("placed", distinct.mapInArrow(place, "v array<double>, rep long, ids array<long>, cell int"))
    counts = np.zeros(len(centres[0]) * n_right, dtype=np.int64)
    for r in placed.groupBy("cell").count().collect():  # at most centroids^2 rows
        counts[r["cell"]] = r["count"]
    # cells in order fill blocks; a cell beyond a block's size has blocks of its own
    base, pieces, at, room = [], [], 0, index.block_rows
    for n in counts.tolist():
        split = -(-n // index.block_rows)
        if split > 1 or n > room:
            at, room = at + (room < index.block_rows), index.block_rows
        base.append(at)
        pieces.append(max(1, split))
        at, room = (at + split, index.block_rows) if split > 1 else (at, room - n)
    block_of = np.array(base)
    cell_blocks = spark.sparkContext.broadcast((counts, block_of, np.array(pieces)))

    queries = (df.where(F.coalesce(is_query, F.lit(False))).select(F.col(id_col).alias("query_id"), F.col(vector_col).cast("array<double>").alias("v"))
               .where(F.col("query_id").isNotNull() & usable(F.col("v"))).distinct())
    owners = stages.put("owners", queries.join(distinct.select("v", "rep"), "v").select("query_id", "rep"))
    asked = placed.join(owners.select("rep").distinct(), "rep").select("rep", "v").repartition(n_parts)

    def walk(batches):
        left, right = shared.value
        held, first, split = cell_blocks.value
        for batch in batches:
            v, reps = matrix(batch.column("v")), batch.column("rep").to_pylist()
            for at in range(0, len(reps), 64):
                out = ([], [], [], [])
                for rep, q in zip(reps[at:at + 64], v[at:at + 64]):
                    bits = visited(left @ q[:half], right @ q[half:], held, int(np.ceil(index.visit_share * held.sum())) + index.k)
                    cells = np.flatnonzero(bits & (held > 0))
                    blocks = np.unique(np.concatenate([first[cells]] + [
                        np.arange(first[c], first[c] + split[c]) for c in cells[split[cells] > 1]]))
                    packed = np.packbits(bits).tobytes()
                    for column, x in zip(out, (blocks.tolist(), [rep] * len(blocks), [q.tolist()] * len(blocks), [packed] * len(blocks))):
                        column += x
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.binary()))],
                    names=["block", "rep", "v", "bits"])

    probes = asked.mapInArrow(walk, "block int, rep long, v array<double>, bits binary")
    mapping = spark.createDataFrame([(c, int(b), int(p)) for c, (b, p) in enumerate(zip(base, pieces))],
                                    "cell int, base int, pieces int")  # centroids^2 rows
    stored = placed.join(F.broadcast(mapping), "cell").select(
        (F.col("base") + F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int")).alias("block"), F.lit(0).alias("kind"),
        "rep", "v", "ids", "cell", F.lit(None).cast("binary").alias("bits"))
    asking = probes.select("block", F.lit(1).alias("kind"), "rep", "v", F.lit(None).cast("array<long>").alias("ids"),
                           F.lit(None).cast("int").alias("cell"), "bits")
    met = stored.unionByName(asking).repartition(n_parts, "block").sortWithinPartitions("block", "kind")

    def rank(batches):
        current, rows = None, []
        block = None  # (vectors, ids, cells) of the current block
        for batch in batches:
            kinds = np.array(batch.column("kind"))
            numbers = np.array(batch.column("block"))
            cuts = np.flatnonzero(np.diff(numbers) | np.diff(kinds)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(numbers)]):
                part = batch.slice(lo, hi - lo)
                if numbers[lo] != current:
                    current, rows, block = numbers[lo], [], None
                if kinds[lo] == 0:
                    rows.append(part)
                    continue
                if block is None:
                    if not rows:
                        continue
                    whole = pa.Table.from_batches(rows).combine_chunks()
                    block = (np.concatenate([matrix(r.column("v")) for r in rows]), whole.column("ids").to_pylist(),
                             whole.column("cell").to_numpy())
                yield from best(block, part)

    def best(block, part):
        vectors, ids, cells = block
        q, reps, bits = matrix(part.column("v")), part.column("rep").to_pylist(), part.column("bits").to_pylist()
        for at in range(0, len(reps), 128):
            scores = q[at:at + 128] @ vectors.T
            out = ([], [], [])
            for rep, row, packed in zip(reps[at:at + 128], scores, bits[at:at + 128]):
                allowed = np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8))[cells])
                row = row[allowed]
                if len(row) > index.k + 1:
                    least = np.partition(row, len(row) - index.k - 1)[len(row) - index.k - 1]
                    keep = np.flatnonzero(row >= least)  # ties included
                    allowed, row = allowed[keep], row[keep]
                pairs = sorted((-s, i) for s, entry in zip(row.tolist(), allowed) for i in ids[entry])[:index.k + 1]
                out[0].extend([rep] * len(pairs))
                out[1].extend(i for _, i in pairs)
                out[2].extend(-s for s, _ in pairs)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))],
                                             names=["rep", "id", "score"])

    found = met.mapInArrow(rank, "rep long, id long, score double")
    top = (found.withColumn("at", F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("score"), "id")))
           .where(F.col("at") <= index.k + 1)
           .groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("at", "id", "score"))).alias("found")))
    # a query's own row leaves; one more than k were kept for that
    own = owners.join(top, "rep").select("query_id", F.slice(
        F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, index.k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("id"), F.col("x.score").alias("score"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a two-dimensional array."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
