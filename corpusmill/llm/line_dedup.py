"""Removal of repeated multi-line passages in DataFrame functions only.

Lines are hashed, and a rolling hash covers each `WINDOW` consecutive line
hashes.  A local minimum of it puts a chunk boundary after its line, so
boundaries depend on nearby lines alone and come back after an insertion, and
no chunk of a text of several lines has only one.

`dedup_runs` takes as seeds the chunks that a document of a smaller id also
holds, and extends them line by line: two neighbouring lines outside of such
chunks, at their ends or in what has no whole repeated chunk, are looked up by
their rolling hash among all others that are left.  Seeds and pairs are then
compared on their bytes; should two different texts share a key, neither is
removed.  So a line goes exactly if it lies in a run of two or more lines that
also stands in a row in a document of a smaller id, or earlier in its own
without overlap.  The first place of every line stays, and so do runs of blank
lines alone: white space is no passage.

`dedup_lines` is the coarser form: whole repeated chunks go, what a repeated
passage has outside of them stays.  Equal chunk hashes are confirmed on the
bytes by grouping on the text itself.

Null texts stay null and empty ones stay empty.  Rows with a null id take no
part and stay as they are.  Rows that repeat an id count as one document: the
same verdict holds for each of them, provided their texts are equal.  Extra
columns pass through.  Documents of which nothing remains stay, with an empty
text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import WS, Stages

WINDOW = 2
MIN_LINES = 2


def spanned(df: DataFrame, text_col: str, window: int = WINDOW) -> DataFrame:
    """`df` with _lines, _rolled (the rolling hash at each line) and _spans:
    array of (a, n), the first line and the number of lines of each chunk."""
    lines = df.withColumn("_lines", F.split(F.col(text_col), "\n", -1))
    hashes = lines.withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x)))
    # the rolling hash at line i covers the lines i - window + 1 .. i
    rolled = F.col("_hashes")
    for back in range(1, window):
        rolled = F.zip_with(
            rolled, F.concat(F.array_repeat(F.lit(None).cast("long"), back), F.col("_hashes")),
            lambda a, b: F.xxhash64(a, b))
    n = F.size("_lines")
    hashes = hashes.withColumn("_rolled", F.slice(rolled, F.lit(1), n))
    # neither the first nor the last line is cut off alone
    least = lambda r, i: (
        (i > 0) & (i < n - 2) & (r < F.get("_rolled", i - 1)) & (r <= F.get("_rolled", i + 1)))
    ends = F.filter(F.transform("_rolled", lambda r, i: F.when(least(r, i) | (i == n - 1), i + 1)),
                    lambda x: x.isNotNull())
    cut = hashes.withColumn("_ends", F.when(n > 0, ends))
    starts = F.concat(F.array(F.lit(0)), F.slice("_ends", F.lit(1), F.size("_ends") - 1))
    spans = F.zip_with(starts, "_ends", lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    return cut.withColumn("_spans", F.when(F.col("_ends").isNotNull(), spans)).drop("_hashes", "_ends")


def _text_of(start: Column, n: Column) -> Column:
    return F.array_join(F.slice("_lines", start + 1, n), "\n")


def chunked(df: DataFrame, text_col: str, window: int = WINDOW) -> DataFrame:
    """`df` with _chunks: array of (n_lines, text), which joined by a line feed give the text."""
    return (spanned(df, text_col, window)
            .withColumn("_chunks", F.transform("_spans", lambda s: F.struct(
                s["n"].alias("n_lines"), _text_of(s["a"], s["n"]).alias("text"))))
            .drop("_lines", "_rolled", "_spans"))


def chunk_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, at, n_lines, h, h2, chunk) of every chunk with enough lines."""
    narrow = chunked(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"),
                                                                F.col(text_col).alias("_t")), "_t")
    return (narrow.select("id", F.posexplode_outer("_chunks").alias("at", "c"))
            .where(F.col("c.n_lines") >= MIN_LINES)
            .select("id", "at", F.col("c.n_lines").alias("n_lines"), *_hash_pair(F.col("c.text")),
                    F.col("c.text").alias("chunk")))


def _hash_pair(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2")]


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """(h, h2, first_id) of the chunks found more than once, each confirmed to
    be one text.  Equal texts meet in partial sums before anything moves."""
    texts = (rows.groupBy("h", "h2", "chunk").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .drop("chunk"))
    return (texts.groupBy("h", "h2")
            .agg(F.count(F.lit(1)).alias("texts"), F.min("first_id").alias("first_id"), F.sum("n").alias("n"))
            .where((F.col("texts") == 1) & (F.col("n") > 1)).select("h", "h2", "first_id"))


def removals(df: DataFrame, stages: Stages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, _drop: sorted places of the chunks to remove), for documents with any."""
    rows = chunk_rows(df, id_col, text_col)
    repeated = stages.put("repeated", repeated_chunks(rows))
    # narrow: hashes and places only; a hot chunk's rows are split by the skew join
    found = stages.put("found", rows.select("id", "at", "h", "h2").join(repeated, ["h", "h2"]).distinct())
    # several places in the first document: all but the earliest go
    later = found.where(F.col("id") > F.col("first_id")).select("id", "at")
    own = (found.where(F.col("id") == F.col("first_id")).groupBy("id", "h", "h2")
           .agg(F.sort_array(F.collect_list("at")).alias("ats"))
           .select("id", F.explode(F.slice("ats", F.lit(2), F.size("ats"))).alias("at")))
    return later.unionByName(own).groupBy("id").agg(F.sort_array(F.collect_list("at")).alias("_drop"))


def dedup_lines(df: DataFrame, stages: Stages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`df` with the remaining text, plus n_chunks, n_removed_chunks and
    n_removed_lines."""
    drop = stages.put("drop", removals(df, stages, id_col, text_col))
    joined = df.join(drop.withColumnRenamed("id", "_id"), F.col(id_col) == F.col("_id"), "left").drop("_id")
    cut = chunked(joined, text_col)
    gone = lambda c, i: F.coalesce(F.array_contains("_drop", i), F.lit(False))
    removed = F.when(F.col("_drop").isNotNull(), F.filter("_chunks", gone))
    lines = F.aggregate(removed, F.lit(0), lambda acc, c: acc + c["n_lines"])
    kept = F.array_join(F.transform(F.filter("_chunks", lambda c, i: ~gone(c, i)), lambda c: c["text"]), "\n")
    return (cut.withColumns({
        "n_chunks": F.when(F.col("_chunks").isNull(), 0).otherwise(F.size("_chunks")).cast("long"),
        "n_removed_chunks": F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long"),
        "n_removed_lines": F.coalesce(lines, F.lit(0)).cast("long"),
        text_col: F.when(F.col("_drop").isNull(), F.col(text_col)).otherwise(kept)})
        .drop("_chunks", "_drop"))


def seed_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, at, n, k, k2, pairs) of every chunk: its first line, number of
    lines and key, and the keys of the pairs of lines that start in it, the
    one across its end included.  No text: keys are 128 bits."""
    cut = spanned(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("_t")), "_t")
    n = F.size("_lines")
    second = F.zip_with(F.slice("_lines", F.lit(1), n - 1), F.slice("_lines", F.lit(2), n - 1),
                        lambda a, b: _second_key(F.concat(a, F.lit("\n"), b)))
    keys = F.zip_with(F.slice("_rolled", F.lit(2), n - 1), second, lambda k, k2: F.struct(k.alias("k"), k2.alias("k2")))
    row = lambda s: F.struct(
        s["a"].alias("at"), s["n"].alias("n"), F.xxhash64(_text_of(s["a"], s["n"])).alias("k"),
        _second_key(_text_of(s["a"], s["n"])).alias("k2"), F.slice("_keys", s["a"] + 1, s["n"]).alias("pairs"))
    return (cut.where(n >= MIN_LINES).withColumn("_keys", keys)
            .select("id", F.explode(F.transform("_spans", row)).alias("c")).select("id", "c.*"))


def _second_key(text: Column) -> Column:
    return F.xxhash64(F.lit(1), text)


def _different_texts(df: DataFrame, places: DataFrame, stages: Stages, id_col: str, text_col: str) -> DataFrame:
    """(k, k2) of the keys at (id, at, n, k, k2) that stand for more than one
    text.  Equal texts meet in partial sums before anything moves."""
    listed = stages.put("places", places.groupBy("id").agg(
        F.collect_list(F.struct("at", "n", "k", "k2")).alias("places")))
    lines = df.select(F.col(id_col).alias("_id"), F.split(F.col(text_col), "\n", -1).alias("_lines"))
    # the table grows with the documents: never broadcast
    texts = (lines.join(listed.hint("merge"), F.col("_id") == F.col("id"))
             .select("_lines", F.explode("places").alias("p"))
             .select("p.k", "p.k2", _text_of(F.col("p.at"), F.col("p.n")).alias("text"))
             # a place of another row of the id has another key
             .where(_second_key(F.col("text")) == F.col("k2")))
    return texts.distinct().groupBy("k", "k2").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("k", "k2")


def run_removals(df: DataFrame, stages: Stages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, _drop: sorted spans (lo, hi) of lines that go), for documents with any."""
    seeds = stages.put("seeds", seed_rows(df, id_col, text_col))
    shared = (seeds.groupBy("k", "k2").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
              .where("first_id < last_id").drop("last_id"))
    # a hot chunk's rows are split by the skew join
    seeds = stages.put("marked", seeds.join(stages.put("shared", shared), ["k", "k2"], "left"))
    later = F.coalesce(F.col("id") > F.col("first_id"), F.lit(False))
    # inside a seed of a smaller id every pair is settled; the one across its end is not
    pairs = (seeds.withColumn("start", F.when(later, F.col("at") + F.col("n") - 1).otherwise(F.col("at")))
             .withColumn("open", F.when(later, F.slice("pairs", F.col("n"), F.lit(1))).otherwise(F.col("pairs")))
             .select("id", "start", F.posexplode("open").alias("i", "key"))
             .select("id", (F.col("start") + F.col("i")).alias("at"), "key.k", "key.k2"))
    repeated = stages.put("repeated", pairs.groupBy("k", "k2").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"))
    # narrow: a hot pair's rows are split by the skew join
    found = stages.put("found", pairs.join(repeated, ["k", "k2"]).distinct().withColumn("n", F.lit(MIN_LINES)))
    place = ["id", "at", "n", "k", "k2"]
    # several places in the first document: all go that share no line with the earliest
    own = (found.where(F.col("id") == F.col("first_id")).groupBy("id", "n", "k", "k2")
           .agg(F.sort_array(F.collect_list("at")).alias("ats"))
           .withColumn("earliest", F.get("ats", F.lit(0)))
           .select("id", F.explode(F.filter("ats", lambda a: a >= F.col("earliest") + MIN_LINES)).alias("at"),
                   "n", "k", "k2"))
    gone = seeds.where(later).select(place).unionByName(found.where(later).select(place)).unionByName(own)
    either = seeds.where(F.col("first_id").isNotNull()).select(place).unionByName(found.select(place))
    unlike = stages.put("unlike", _different_texts(df, either, stages, id_col, text_col))
    return (gone.join(unlike, ["k", "k2"], "left_anti").groupBy("id")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("lo"), (F.col("at") + F.col("n")).alias("hi"))))
                 .alias("_drop")))


def _line_runs(drop: Column) -> Column:
    """Array of (lo, hi): the lines lo .. hi - 1 that the sorted spans cover, in maximal runs."""
    none = F.expr("cast(array() as array<struct<lo:int,hi:int>>)")
    run = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    state = lambda done, lo, hi: F.struct(
        done.alias("done"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    closed = lambda acc: F.when(acc["hi"] > 0, F.concat(acc["done"], F.array(run(acc["lo"], acc["hi"])))).otherwise(
        acc["done"])
    return F.aggregate(
        drop, state(none, F.lit(0), F.lit(-1)),
        lambda acc, s: F.when(s["lo"] <= acc["hi"], state(acc["done"], acc["lo"], F.greatest(acc["hi"], s["hi"]))).otherwise(
            state(closed(acc), s["lo"], s["hi"])), closed)


def dedup_runs(df: DataFrame, stages: Stages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`df` with the remaining text, plus n_chunks (maximal runs of lines that
    stay or go), n_removed_chunks (those that go) and n_removed_lines."""
    drop = stages.put("drop", run_removals(df, stages, id_col, text_col))
    # the table grows with the documents: never broadcast
    joined = df.join(drop.withColumnRenamed("id", "_id").hint("merge"), F.col(id_col) == F.col("_id"), "left").drop("_id")
    has_text = lambda r: F.exists(F.slice("_lines", r["lo"] + 1, r["hi"] - r["lo"]), lambda x: x.rlike(f"[^{WS}]"))
    cut = joined.withColumn("_lines", F.when(F.col("_drop").isNotNull(), F.split(F.col(text_col), "\n", -1))).withColumn(
        "_runs", F.when(F.col("_drop").isNotNull(), F.filter(_line_runs(F.col("_drop")), has_text)))
    cut = cut.withColumn("_runs", F.when(F.size("_runs") > 0, F.col("_runs")))
    starts = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["hi"]))
    ends = F.concat(F.transform("_runs", lambda r: r["lo"]), F.array(F.size("_lines")))
    cut = cut.withColumn("_kept", F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))),
                                           lambda s: s["hi"] > s["lo"]))
    kept = F.array_join(F.transform("_kept", lambda s: F.array_join(
        F.slice("_lines", s["lo"] + 1, s["hi"] - s["lo"]), "\n")), "\n")
    lines = F.aggregate("_runs", F.lit(0), lambda acc, r: acc + r["hi"] - r["lo"])
    whole = F.when(F.col(text_col).isNull(), 0).otherwise(1)
    return (cut.withColumns({
        "n_chunks": F.when(F.col("_runs").isNull(), whole).otherwise(F.size("_runs") + F.size("_kept")).cast("long"),
        "n_removed_chunks": F.when(F.col("_runs").isNull(), 0).otherwise(F.size("_runs")).cast("long"),
        "n_removed_lines": F.coalesce(lines, F.lit(0)).cast("long"),
        text_col: F.when(F.col("_runs").isNull(), F.col(text_col)).otherwise(kept)})
        .drop("_runs", "_lines", "_kept", "_drop"))
