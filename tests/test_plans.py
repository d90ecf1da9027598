"""Plan checks, skew, entry smoke test and the SQL oracle at sf0.01."""

from contextlib import contextmanager

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.config import MixSpec
from corpusmill.operators.dedup import dedup_exact
from corpusmill.operators.ranking import exact_rank
from corpusmill.operators.sampling import mix_selection, sample_exact_n
from corpusmill.plans import catalog
from corpusmill.plans.prepare import prepare
from tests.conftest import SF01


@contextmanager
def static_plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def _nodes(df):
    root = df._jdf.queryExecution().executedPlan()
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        ch = n.children()
        stack.extend(ch.apply(i) for i in range(ch.size()))
    return out


def _names(node):
    o = node.output()
    return [o.apply(i).name() for i in range(o.size())]


@pytest.mark.parametrize("shuffle", [True, False])
def test_no_single_partition_exchange_on_rows(spark, shuffle):
    """Windows without a partition key, and the exchanges into one partition
    that feed them, hold counted rows only: at most one for each of 16 buckets
    (all rows as one group), or one for each source."""
    with static_plans(spark):
        p = prepare(spark, catalog.docs_mix(SF01), MixSpec(shuffle=shuffle))
        for df in (p.index, p.corpus, p.mixed):
            for n in _nodes(df):
                s = n.simpleString(50)
                if n.nodeName() == "Exchange" and "SinglePartition" in s:
                    below = n.children().apply(0)
                    while below.nodeName().startswith(("WholeStageCodegen", "InputAdapter", "Project")):
                        below = below.children().apply(0)
                    assert "Aggregate" in below.nodeName() and "partial_" not in below.simpleString(50), s
                    assert set(_names(n)) <= {"_bkt", "_cnt", "_group", "_n"}, s
                if n.nodeName() == "Window" and not set(_names(n)) & {"_bkt", "_group"}:
                    assert "epoch" in s or "source" in s, s


@pytest.mark.parametrize("stage", ["sample", "mix"])
def test_selection_moves_no_text(spark, stage):
    with static_plans(spark):
        docs = spark.read.parquet(f"{SF01}/documents.parquet").withColumn(
            "sample_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")))
        if stage == "sample":
            df, _ = sample_exact_n(docs, {f"src{i}": 30 for i in range(20)})
        else:
            df = mix_selection(docs, {f"src{i}": 0.3 for i in range(20)})[0].rows(docs)
        assert "text" in df.columns and df.count() in (600, 300)
        for n in _nodes(df):
            if "Exchange" in n.nodeName():
                assert "text" not in _names(n), n.simpleString(50)


def test_local_folder_needs_a_local_master():
    from corpusmill.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_config_join_is_broadcast_and_source_filter_pushed(spark):
    p = prepare(spark, catalog.docs_mix(SF01), MixSpec())
    plan = p.samples._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    txt = p.samples._jdf.queryExecution().toString()
    assert "PushedFilters: [In(source" in txt or "In(source" in txt


def test_dedup_uses_partial_aggregation(spark):
    with static_plans(spark):
        p = prepare(spark, catalog.docs_mix(SF01), MixSpec(deduplicate=True))
        plan = p.index._jdf.queryExecution().executedPlan().toString()
        assert "partial_min" in plan


def test_hot_source_and_hot_duplicate(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    # a third of all rows in one source, and a third carrying one identical text
    hot = docs.select(F.lit("hot").alias("source"), F.concat(F.lit("hot/"), F.col("doc_id").cast("string")).alias("sample_id"),
                      F.col("text"))
    rest = docs.select("source", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("sample_id"), "text")
    dup = docs.select(F.lit("dup").alias("source"), F.concat(F.lit("dup/"), F.col("doc_id").cast("string")).alias("sample_id"),
                      F.lit("the very same sample text " * 4).alias("text"))
    d = rest.unionByName(hot).unionByName(dup)
    d = d.withColumn("k", F.md5(F.concat(F.lit("42:mix:"), "sample_id"))) \
         .withColumn("ord_key", F.md5(F.concat(F.lit("42:shuffle:"), "sample_id"))) \
         .withColumn("text_hash", F.md5("text"))
    w = Window.partitionBy("source").orderBy("k", "sample_id")
    plain = {r[0]: r[1] for r in d.select("sample_id", F.row_number().over(w)).collect()}
    got = {r[0]: r[1] for r in exact_rank(d, ["source"], "k", "sample_id", bucket_chars=2, n_groups=22)
           .select("sample_id", "rank").collect()}
    assert got == plain
    kept = dedup_exact(d)
    dup_kept = kept.where("source = 'dup'").collect()
    assert len(dup_kept) == 1
    first = d.where("source = 'dup'").orderBy("ord_key", "sample_id").first()
    assert dup_kept[0]["sample_id"] == first["sample_id"]
    assert kept.count() == d.select(F.count_distinct("text_hash")).first()[0]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["sample_id", "source", "mix_rank", "ord_key", "pos"]
    assert df.count() > 0
    from corpusmill.plans.oracle import ORACLE_SQL
    from corpusmill.plans.queries import QUERIES
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("sf", [SF01])
def test_oracle_all_queries(spark, sf):
    from tools.oracle_check import compare
    from corpusmill.plans.queries import QUERIES
    res = compare(spark, sf, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad, bad


def test_entry_without_the_optional_part():
    """The core queries stay where libraries of the optional part are missing."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for blocked in ("public_tokenizers", "sentencepiece", "corpus_pipeline", "corpusmill.llm"):
        code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(len(e.queries()), *e.queries())"
        done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
        names = done.stdout.split()
        assert int(names[0]) >= 33 and "dedup_exact" in names and "pipeline" not in names
