"""Near-duplicate documents by fast similarity sketches.

Every text becomes the set of its distinct five-word shingles and a fast
similarity sketch of it (see shingles.sketches).  Documents with equal sets
form a class, represented by its smallest id.  Representatives that agree in a
whole band of the sketch meet in a bucket; pairs of them are confirmed on
their full sets, and the links' connected components are the result.

A bucket's pairs are never spelled out.  First every member is checked
against the bucket's smallest id, which joins the bulk of a large group.  What
is left of a bucket, members outside its largest component, is compared in
blocks, within and against the rest, most similar pairs first; only pairs that
join different components leave a block, and they are confirmed too.  This is
repeated until no block finds a pair.  A pair is passed over only if it lies in
one component already, differs too much in size, has too few fingerprints of
shingles in common (an upper bound of the sets' intersection), or agrees in
fewer than `min_agree` of the `marks` coordinates of a longer sketch, which for
a pair at the threshold is five standard deviations away; two sets at the
threshold share no band with a probability of 5e-6.

Texts without words have no set and link with nothing; null texts likewise.
Rows with a null id link with nothing and are kept.  Rows that repeat an id
and text share their result; an id on different texts takes part with each.
Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import Stages, partitions, small_batches, text_batches
from corpusmill.llm.components import components
from corpusmill.llm.shingles import bands, shingle_sets, sketches


@dataclass(frozen=True)
class NearDedup:
    shingle_words: int = 5
    similarity: tuple[int, int] = (75, 100)  # at least, as a fraction
    coordinates: int = 128
    band_rows: int = 4
    marks: int = 512
    min_agree: int = 335
    block: int = 512        # members of a bucket compared at once
    cell_pairs: int = 512   # pairs confirmed against one set at once


def sketch_table(df: DataFrame, how: NearDedup, id_col: str, text_col: str) -> DataFrame:
    """(id, n, digest, bands): set size, digest of the set and band hashes; the
    last two null for empty sets."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for ids, texts in text_batches(batches, "id", "text"):
            hashes, offsets = shingle_sets(texts, how.shingle_words)
            sketch = sketches(hashes, offsets, how.coordinates)
            n = np.diff(offsets)
            digests = [xxhash.xxh3_128_digest(hashes[lo:hi].tobytes()) if hi > lo else None
                       for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            band = bands(sketch, how.band_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array([b.tolist() if k else None for b, k in zip(band, n)], pa.list_(pa.int64()))],
                names=["id", "n", "digest", "bands"])

    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, n long, digest binary, bands array<long>")
            .withColumn("id", F.col("id").cast(id_type)))


#: Larger sets have fingerprints of 4 bytes, others of 2.
SHORT_SET = 2048


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes.astype("<u2" if len(hashes) <= SHORT_SET else "<u4"))


def most_in_common(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """At least the size of two sets' intersection, from their fingerprints:
    those in common, and what the smaller loss by equal fingerprints may hide."""
    x, y = (np.frombuffer(p, "<u2" if n <= SHORT_SET else "<u4") for p, n in ((a, n_a), (b, n_b)))
    if x.dtype != y.dtype:
        x, y = (np.unique(v.astype("<u2")) for v in (x, y))
    return len(np.intersect1d(x, y, assume_unique=True)) + min(n_a - len(x), n_b - len(y))


def set_table(df: DataFrame, wanted: DataFrame, how: NearDedup, id_col: str, text_col: str) -> DataFrame:
    """(id, set binary, n, marks, prints) of the documents whose ids are wanted:
    marks holds one byte of each coordinate of the longer sketch, prints the
    distinct fingerprints of the set's elements."""
    def run(batches):
        for ids, texts in text_batches(batches, "id", "text"):
            hashes, offsets = shingle_sets(texts, how.shingle_words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.array([hashes[lo:hi].tobytes() for lo, hi in zip(offsets[:-1], offsets[1:])], pa.binary()),
                 pa.array(np.diff(offsets), pa.int64()),
                 pa.array([m.tobytes() for m in (sketches(hashes, offsets, how.marks) & np.uint64(0xFF)).astype(np.uint8)],
                          pa.binary()),
                 pa.array([fingerprints(hashes[lo:hi]).tobytes() for lo, hi in zip(offsets[:-1], offsets[1:])], pa.binary())],
                names=["id", "set", "n", "marks", "prints"])

    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return (texts.join(wanted.select("id").distinct(), "id").mapInArrow(run, "id long, set binary, n long, marks binary, prints binary")
            .dropDuplicates(["id", "set"]))


#: Hot ids are broadcast up to this number of them.
HOT_IDS = 100_000


def confirm(pairs: DataFrame, sets: DataFrame, how: NearDedup, stages: Stages, name: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.  Pairs with the
    same `a` share cells of bounded size, so a set needed often is sent once
    for each cell.  Only an `a` of more pairs than a cell holds has several;
    these few are counted, and the pairs themselves do not move by `a`."""
    spark = pairs.sparkSession
    hot = stages.put(f"{name}-hot", pairs.groupBy(F.col("a").alias("a_")).agg(F.count(F.lit(1)).alias("n_pairs"))
                     .where(F.col("n_pairs") > how.cell_pairs))
    sized = pairs.join(F.broadcast(hot) if hot.count() <= HOT_IDS else hot, F.col("a") == F.col("a_"), "left")
    cells = F.ceil(F.coalesce("n_pairs", F.lit(1)) / how.cell_pairs)
    celled = sized.withColumn("cell", F.pmod(F.xxhash64("b"), cells).cast("int"))
    need = (celled.select("a", "cell", F.lit(0).alias("kind"), F.col("a").alias("id")).distinct()
            .unionByName(celled.select("a", "cell", F.lit(1).alias("kind"), F.col("b").alias("id"))))
    least, of = how.similarity

    def run(batches):
        at, left = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a", "cell", "kind", "id", "set")]
            out = ([], [])
            for a, cell, kind, b, raw in zip(*columns):
                own = np.frombuffer(raw, "<u8")
                if kind == 0:
                    left = [*left, own] if at == (a, cell) else [own]
                    at = (a, cell)
                elif at == (a, cell):
                    for other in left:
                        both = len(np.intersect1d(other, own, assume_unique=True))
                        if of * both >= least * (len(other) + len(own) - both):
                            out[0].append(a)
                            out[1].append(b)
                            break
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])

    return (need.join(sets.select("id", "set"), "id").repartition(partitions(spark), "a", "cell")
            .sortWithinPartitions("a", "cell", "kind").select("a", "cell", "kind", "id", "set")
            .mapInArrow(run, "a long, b long"))


def leftover_pairs(members: DataFrame, labels: DataFrame, how: NearDedup, forest: bool) -> DataFrame:
    """Pairs (a < b) of a bucket's members in different components that may be
    similar enough; with `forest` only pairs that join components not joined by
    a more similar pair of the block."""
    spark = members.sparkSession
    m = members.join(labels, F.col("rep") == F.col("node"), "left").drop("node").withColumn(
        "comp", F.coalesce("comp", "rep"))
    by_comp = m.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    # the largest component of each bucket, in fixed-width aggregates
    largest = by_comp.groupBy("bucket").agg(F.max("c").alias("top"), F.sum("c").alias("total"))
    largest = (by_comp.join(largest, "bucket").where((F.col("c") == F.col("top")) & (F.col("total") > F.col("top")) & (F.col("total") > 2))
               .groupBy("bucket", "top", "total").agg(F.min("comp").alias("main")))
    blocks = lambda n: F.ceil(n / how.block).cast("int")
    m = m.join(largest, "bucket").withColumns({
        "other": (F.col("comp") != F.col("main")), "n_other": blocks(F.col("total") - F.col("top")),
        "n_main": blocks(F.col("top"))})
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("other"), F.col("n_other")).otherwise(F.col("n_main"))).cast("int")
    m = m.withColumn("own", own)
    every = lambda n: F.sequence(F.lit(0), n - 1)
    # cells: (main block, other block) and (other block, other block); main blocks count from -1 down
    cells = F.when(F.col("other"), F.concat(
        F.transform(every(F.col("n_main")), lambda k: F.struct((-1 - k).alias("i"), F.col("own").alias("j"))),
        F.transform(every(F.col("n_other")), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j"))))
    ).otherwise(F.transform(every(F.col("n_other")), lambda k: F.struct((-1 - F.col("own")).alias("i"), k.alias("j"))))
    dealt = (m.select("bucket", F.explode(F.array_distinct(cells)).alias("cell"), "other", "own", "rep", "comp", "n", "marks", "prints")
             .select("bucket", "cell.i", "cell.j", "other", "own", "rep", "comp", "n", "marks", "prints")
             .repartition(partitions(spark), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))
    least, of = how.similarity

    def run(batches):
        held, key = [], None
        for batch in batches:
            keys = np.stack([np.array(batch.column(c)) for c in ("bucket", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                now = tuple(keys[:, lo].tolist())
                if key is not None and now != key:
                    yield from compare(held, key)
                    held = []
                key = now
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from compare(held, key)

    def compare(held, key):
        t = pa.Table.from_batches(held)
        rep, comp, n, own = (t.column(c).to_numpy() for c in ("rep", "comp", "n", "own"))
        other = t.column("other").to_numpy(zero_copy_only=False)
        prints = t.column("prints").to_pylist()
        marks = np.frombuffer(b"".join(t.column("marks").to_pylist()), np.uint8).reshape(len(rep), -1)
        _, i, j = key
        right = np.flatnonzero(other & (own == j))
        left = np.flatnonzero(~other) if i < 0 else np.flatnonzero(other & (own == i))
        found = []
        for x in right:
            y = left[(comp[left] != comp[x]) & (of * np.minimum(n[left], n[x]) >= least * np.maximum(n[left], n[x]))]
            if i == j:
                y = y[y > x]
            agree = (marks[y] == marks[x]).sum(axis=1)
            for k in np.flatnonzero(agree >= how.min_agree):
                found.append((-int(agree[k]), int(x), int(y[k])))
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        kept = []
        for _, x, y in sorted(found):
            a, b = root(int(comp[x])), root(int(comp[y]))
            if forest and a == b:
                continue
            common = most_in_common(prints[x], int(n[x]), prints[y], int(n[y]))
            if of * common >= least * (int(n[x]) + int(n[y]) - common):
                parent[max(a, b)] = min(a, b)
                kept.append(sorted((int(rep[x]), int(rep[y]))))
        yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in kept], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, stages: Stages, how: NearDedup = NearDedup(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept), a row for each row of `df`."""
    small_batches(df.sparkSession)
    sketched = stages.put("sketches", sketch_table(df, how, id_col, text_col))
    sets_only = sketched.where("digest is not null and id is not null")
    classes = stages.put("classes", sets_only.groupBy("digest").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n_docs"), F.first("n").alias("n"),
        F.first("bands").alias("bands")))

    in_bucket = classes.select("rep", F.posexplode("bands").alias("band", "hash")).select(
        F.xxhash64("band", "hash").alias("bucket"), "rep")
    shared = in_bucket.groupBy("bucket").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1")
    members = stages.put("members", in_bucket.join(shared.drop("m"), "bucket"))
    involved = members.select(F.col("rep").alias("id")).distinct()
    sets = stages.put("sets", set_table(df, involved, how, id_col, text_col))
    sizes = sets.select(F.col("id").alias("rep"), "n", "marks", "prints")

    # each member against the smallest id of its bucket
    least, of = how.similarity
    small = sizes.select(F.col("rep").alias("id"), F.col("n").alias("n_"))
    similar_size = of * F.least("na", "nb") >= least * F.greatest("na", "nb")
    star = (members.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
            .join(small.withColumnsRenamed({"id": "ia", "n_": "na"}), F.col("a") == F.col("ia"))
            .join(small.withColumnsRenamed({"id": "ib", "n_": "nb"}), F.col("b") == F.col("ib"))
            .where(similar_size).select("a", "b"))
    tested = star = stages.put("star", star)
    links = stages.put("star-links", confirm(star, sets, how, stages, "star"))
    labels = components(links, stages, "star")

    # what is left of each bucket; a reported pair that was or is refused may have
    # hidden others in its block, and the blocks then report all their pairs
    members = stages.put("marked", members.select("bucket", "rep").join(sizes, "rep"))
    forest, i = True, 0
    while True:
        i += 1
        found = stages.put(f"found-{i}", leftover_pairs(members, labels, how, forest))
        pairs = stages.put(f"pairs-{i}", found.join(tested, ["a", "b"], "left_anti"))
        n_found, n_pairs, n_links = found.count(), pairs.count(), 0
        if n_pairs:
            tested = tested.unionByName(pairs)
            more = stages.put(f"links-{i}", confirm(pairs, sets, how, stages, f"round-{i}"))
            n_links = more.count()
            links = links.unionByName(more)
            labels = components(links, stages, f"round-{i}")
        elif not forest or not n_found:
            break
        forest = n_links == n_found

    # documents: through their class where it has several, by their own id else
    several = (classes.where("n_docs > 1").join(labels, F.col("rep") == F.col("node"), "left")
               .select(F.col("digest").alias("d"), F.coalesce("comp", "rep").alias("class_comp")))
    alone = labels.withColumnRenamed("comp", "own_comp")
    found = (sketched.select("id", F.col("n").alias("n_shingles"), "digest")
             .join(several, (F.col("digest") == F.col("d")) & F.col("id").isNotNull(), "left")
             .join(alone, (F.col("id") == F.col("node")) & F.col("digest").isNotNull(), "left"))
    component: Column = F.coalesce("class_comp", "own_comp", "id")
    return found.select("id", "n_shingles", component.alias("component_id"),
                        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _reused(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_reused_id): the ids that stand on different texts."""
    h = _text_hash(text_col)
    return (df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_reused_id"))
            .agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("_reused_id"))


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).isNull(), text_col)


def one_of_each(df: DataFrame, stages: Stages, how: NearDedup = NearDedup(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay: of each component the document of the
    smallest id, once; rows with a null id all stay.  Different texts of one id
    are different documents: their rows get hashes of id and text as keys."""
    reused = stages.put("reused", _reused(df, id_col, text_col))
    if reused.isEmpty():
        gone = near_duplicates(df, stages, how, id_col, text_col).where("not kept").select(
            F.col("id").alias("_gone")).distinct()
        return _one_of_each_key(df, gone, id_col, text_col, df.columns)
    keyed = df.join(reused, F.col(id_col) == F.col("_reused_id"), "left").withColumn(
        "_key", F.when(F.col("_reused_id").isNotNull(), F.xxhash64(id_col, _text_hash(text_col)))
        .otherwise(F.col(id_col).cast("long"))).drop("_reused_id")
    keyed = stages.put("keyed", keyed)
    found = stages.put("found", near_duplicates(keyed, stages, how, "_key", text_col).where("id is not null")
                       .select(F.col("id").alias("_gone"), "component_id").distinct())
    ids = keyed.where(F.col("_key").isNotNull()).select("_key", F.col(id_col).cast("long").alias("_of")).distinct()
    # keys do not rise with ids: the document that stays is found by the ids themselves, one row for each component
    of = found.join(ids, F.col("_gone") == F.col("_key")).select("component_id", "_of", "_gone")
    least = of.groupBy("component_id").agg(F.min("_of").alias("_of"))
    first = of.join(least, ["component_id", "_of"]).groupBy("component_id").agg(F.min("_gone").alias("_gone"))
    gone = found.select("_gone").join(first.select("_gone"), "_gone", "left_anti")
    return _one_of_each_key(keyed, gone, "_key", text_col, df.columns)


def _one_of_each_key(df: DataFrame, gone: DataFrame, key: str, text_col: str, columns: list[str]) -> DataFrame:
    stay = df.join(gone, F.col(key) == F.col("_gone"), "left_anti")
    # rows that repeat a kept key: one of them; repeats meet in partial results before anything moves
    one = (stay.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id"))
           .agg(F.min_by(F.struct(*columns), F.xxhash64(text_col)).alias("_row")))
    return one.select("_row.*").unionByName(stay.where(F.col(key).isNull()).select(columns))
