"""Operator properties: exact sizes, determinism, dedup, lines, batches."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.config import MixSpec, SourceSpec, TrainSpec
from corpusmill.functions.text import WHITESPACE
from corpusmill.operators.batches import batch_assign, epoch_plan, length_grouped
from corpusmill.operators.dedup import dedup_exact, dedup_report
from corpusmill.operators.lines import line_explode
from corpusmill.operators.ranking import exact_rank
from corpusmill.operators.sampling import fraction_count, mix_fraction, sample_exact_n
from corpusmill.plans import catalog
from corpusmill.plans.prepare import prepare
from tests.conftest import SF01


def _docs_ids(spark, parts=None):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    if parts:
        d = d.repartition(parts)
    return d.select("source", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("sample_id"))


def test_fraction_truncates_like_python():
    assert fraction_count(100, 0.29) == 28 == int(100 * 0.29)
    assert fraction_count(100, 1.5) == 100
    assert fraction_count(100, 0.0) == 0


def test_mix_fraction_sizes(spark):
    df = spark.range(100).select(F.lit("a").alias("source"), F.col("id").cast("string").alias("sample_id"))
    df = df.unionByName(spark.range(40).select(F.lit("b").alias("source"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("sample_id")))
    df = df.unionByName(spark.range(10).select(F.lit("c").alias("source"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("sample_id")))
    sel, limits = mix_fraction(df, {"a": 0.29, "b": 1.5, "c": 0.0})
    counts = {r["source"]: r["count"] for r in sel.groupBy("source").count().collect()}
    assert limits == {"a": 28, "b": 40, "c": 0}
    assert counts == {"a": 28, "b": 40}


def test_exact_rank_equals_plain_window(spark):
    d = _docs_ids(spark).withColumn("k", F.md5(F.concat(F.lit("7:x:"), "sample_id")))
    w = Window.partitionBy("source").orderBy("k", "sample_id")
    plain = {r["sample_id"]: r["rn"] for r in d.withColumn("rn", F.row_number().over(w)).collect()}
    for h in (1, 2, 3):
        got = {r["sample_id"]: r["rank"] for r in exact_rank(d, ["source"], "k", "sample_id", bucket_chars=h, n_groups=20).collect()}
        assert got == plain


def test_sample_exact_n_sizes_and_partition_invariance(spark):
    caps = {f"src{i}": 30 for i in range(20)}
    a, rep = sample_exact_n(_docs_ids(spark, 3), caps)
    b, _ = sample_exact_n(_docs_ids(spark, 17), caps)
    ids_a = sorted(r[0] for r in a.select("sample_id").collect())
    ids_b = sorted(r[0] for r in b.select("sample_id").collect())
    assert len(ids_a) == 600 and ids_a == ids_b
    assert all(v == (50, 30) for v in rep.values())
    c, _ = sample_exact_n(_docs_ids(spark), caps, seed=7)
    assert sorted(r[0] for r in c.select("sample_id").collect()) != ids_a
    assert set(ids_a) <= {r[0] for r in _docs_ids(spark).select("sample_id").collect()}


def test_sample_before_band_differs_from_band_before_sample(spark):
    p = prepare(spark, catalog.docs_capped(SF01), MixSpec())
    # band after sampling (570 with source-qualified ids; the order is semantic)
    sampled, _ = sample_exact_n(spark.read.parquet(f"{SF01}/documents.parquet").withColumn(
        "sample_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))),
        {f"src{i}": 30 for i in range(20)})
    direct = sampled.where((F.length(F.btrim("text", F.lit(WHITESPACE))) > 50)
                           & (F.length(F.btrim("text", F.lit(WHITESPACE))) < 8192)).count()
    assert sum(p.kept_counts.values()) == direct < 600
    alt = spark.read.parquet(f"{SF01}/documents.parquet").where(
        (F.length(F.btrim("text")) > 50) & (F.length(F.btrim("text")) < 8192))
    w = Window.partitionBy("source").orderBy("doc_id")
    assert alt.withColumn("r", F.row_number().over(w)).where("r <= 30").count() == 600


def test_prepare_positions_gapless_and_dedup_idempotent(spark):
    p = prepare(spark, catalog.docs_mix(SF01), MixSpec())
    assert sum(p.mix_counts.values()) == 179
    pos = sorted(r[0] for r in p.index.select("pos").collect())
    assert pos == list(range(len(pos)))
    again = dedup_exact(p.index)
    assert again.count() == p.index.count()
    assert p.corpus.select(F.count_distinct(F.md5("text"))).first()[0] == p.corpus.count()
    rep = dedup_report(p.mixed).first()
    assert rep["total"] == 179 and rep["removed"] == 179 - len(pos)


def test_dedup_edge_rows(spark):
    rows = [("s1", "s1/1", "Same text here"), ("s2", "s2/1", "Same text here"),
            ("s1", "s1/2", "same text here"), ("s2", "s2/2", "Other  "), ("s1", "s1/3", "Other")]
    df = spark.createDataFrame(rows, "source string, sample_id string, text string") \
        .withColumn("text", F.btrim("text")).withColumn("text_hash", F.md5("text")) \
        .withColumn("ord_key", F.md5(F.concat(F.lit("42:shuffle:"), "sample_id")))
    kept = dedup_exact(df)
    assert kept.count() == 3  # one of the two copies, case kept distinct, stripped trailing space merges
    empty = dedup_report(df.limit(0)).first()
    assert empty["removed"] == 0 and empty["removed_pct"] == 0.0


def test_lines(spark):
    df = spark.createDataFrame([("x", "a\rb\r\nc\n\n  \nd"), ("y", "d e\u000bf")], "sample_id string, text string")
    got = [(r["sample_id"], r["line"]) for r in line_explode(df, keep=["sample_id"]).collect()]
    assert [l for s, l in got if s == "x"] == ["a", "b", "c", "d"]
    assert [l for s, l in got if s == "y"] == ["d e\u000bf"]


def test_batches_steps_of_16(spark):
    rows = spark.range(35).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("row_id"),
                                  (F.col("id") % 7).cast("int").alias("n_tokens"))
    spec = TrainSpec(num_epochs=3)
    plan = epoch_plan(rows, 35, spec, carry=["n_tokens"])
    b = batch_assign(plan, spec).collect()
    for e in range(3):
        steps = {}
        for r in b:
            if r["epoch"] == e:
                steps[r["step"]] = steps.get(r["step"], 0) + 1
        assert [steps[k] for k in sorted(steps)] == [16, 16, 3]
    orders = [[r["row_id"] for r in sorted((x for x in b if x["epoch"] == e), key=lambda x: x["pos"])] for e in range(3)]
    assert all(sorted(o) == sorted(orders[0]) and len(set(o)) == 35 for o in orders)
    assert orders[0] != orders[1] != orders[2]
    g = length_grouped(plan, spec).collect()
    assert sorted((r["epoch"], r["pos"]) for r in g) == sorted((r["epoch"], r["pos"]) for r in b)


def test_source_isolation_reports_bad_source(spark):
    from corpusmill.sources.scan import load_sources
    specs = [SourceSpec(name="ok", path=f"{SF01}/documents.parquet", id_column="doc_id"),
             SourceSpec(name="bad", path=f"{SF01}/nope.parquet")]
    loaded, skipped = load_sources(spark, specs)
    assert [m.name for m, _ in [(x[0][0], x[1]) for x in loaded]] == ["ok"] and "bad" in skipped


def test_content_ids_do_not_depend_on_files(spark):
    import tempfile

    from corpusmill.sources.scan import scan_source
    turns = spark.read.parquet(f"{SF01}/conversations.parquet").select("role", "text")
    turns = turns.unionByName(turns.limit(40)).unionByName(turns.limit(40))  # equal rows
    ids = []
    for reader, parts in (("json", 1), ("json", 5), ("csv", 3), ("parquet", 2)):
        path = tempfile.mkdtemp(prefix="cm-keyless-") + "/t"
        writer = turns.repartition(parts).write
        if reader == "csv":
            writer.option("header", "true").option("multiLine", "true").csv(path)
            options = (("header", "true"), ("multiLine", "true"))
        else:
            writer.format(reader).save(path)
            options = ()
        spec = SourceSpec(name="t", path=path, reader=reader, options=options)
        df = scan_source(spark, spec)
        rows = sorted(r[0] for r in df.select("sample_id").collect())
        assert len(set(rows)) == len(rows) == turns.count()
        ids.append(rows if reader != "csv" else None)
    assert ids[0] == ids[1] and sorted(x.split("#")[1] for x in ids[0])[-1] == "2"


def test_a_source_without_its_column_is_skipped_alone(spark):
    from corpusmill.sources.scan import load_sources
    specs = [SourceSpec(name="ok", path=f"{SF01}/documents.parquet", id_column="doc_id"),
             SourceSpec(name="bad", path=f"{SF01}/documents.parquet", id_column="doc_id", subset="x")]
    loaded, skipped = load_sources(spark, specs)
    assert [m[0].name for m, _ in loaded] == ["ok"] and set(skipped) == {"bad"}


def test_null_ids_leave_the_sample_whole(spark):
    rows = [("a", None if i % 5 < 2 else f"a/{i}", "t") for i in range(100)]
    df = spark.createDataFrame(rows, "source string, sample_id string, text string")
    got, rep = sample_exact_n(df, {"a": 50})
    assert got.count() == 50 and rep == {"a": (100, 50)}
    got, rep = sample_exact_n(df, {"a": 80})
    assert got.count() == 60 and rep == {"a": (100, 60)}


def test_no_shuffle_order_is_config_then_mix_rank(spark):
    p = prepare(spark, catalog.docs_mix(SF01), MixSpec(shuffle=False, deduplicate=False))
    rows = p.index.select("pos", "source_ord", "mix_rank").collect()
    by_pos = [(r["source_ord"], r["mix_rank"]) for r in sorted(rows, key=lambda r: r["pos"])]
    assert by_pos == sorted(by_pos) and [r["pos"] for r in rows] != [] \
        and sorted(r["pos"] for r in rows) == list(range(len(rows)))


def test_prepare_is_partition_count_invariant(spark):
    def run(parts, aqe):
        old = (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled"))
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            p = prepare(spark, catalog.docs_capped(SF01, cap=35), MixSpec(seed=9))
            return sorted(tuple(r) for r in p.corpus.select("pos", "sample_id", "mix_rank", F.md5("text")).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old[0])
            spark.conf.set("spark.sql.adaptive.enabled", old[1])
    assert run(3, "false") == run(37, "true")


def test_duplicate_ids_fail_loudly(spark):
    import pytest
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), ("a", "3")], "source string, sample_id string")
    sel, _ = mix_fraction(df, {"a": 1.0})
    with pytest.raises(Exception, match="duplicate id"):
        sel.collect()
