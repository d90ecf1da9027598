"""Randomised properties (hypothesis) and job-level sinks."""

import json
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.functions.text import WHITESPACE, in_length_band, strip_ws
from corpusmill.operators.ranking import exact_rank
from tests.conftest import SF001

ALPHABET = st.sampled_from(list(WHITESPACE) + list("ab Z​\U0001F600é­"))
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.text(ALPHABET, max_size=70), min_size=1, max_size=30))
def test_strip_and_band_equal_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["s"], r["k"]) for r in df.select("i", strip_ws("t").alias("s"))
           .select("i", "s", in_length_band("s", 5, 40).alias("k")).collect()}
    for i, t in enumerate(texts):
        s = t.strip()
        assert got[i] == (s, 5 < len(s) < 40)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 10 ** 6)), min_size=1, max_size=200, unique=True),
       st.integers(1, 3))
def test_exact_rank_equals_row_number(spark, rows, h):
    df = spark.createDataFrame(rows, "g string, v long").withColumn("id", F.col("v").cast("string")) \
        .withColumn("k", F.md5(F.concat(F.lit("s:"), "id")))
    w = Window.partitionBy("g").orderBy("k", "id")
    plain = sorted(tuple(r) for r in df.select("g", "id", F.row_number().over(w)).collect())
    got = sorted(tuple(r) for r in exact_rank(df, ["g"], "k", "id", bucket_chars=h, n_groups=3)
                 .select("g", "id", "rank").collect())
    assert got == plain


def test_yaml_config_and_jobs(spark):
    from corpusmill.plans.jobs import load_yaml_config, run_prepare_job, run_train_input_job, train_rows_from_corpus
    d = tempfile.mkdtemp(prefix="cm-yaml-")
    cfg = os.path.join(d, "cfg.yaml")
    docs = f"{SF001}/documents.parquet"
    with open(cfg, "w") as f:
        f.write(f"""
datasets:
  massive_datasets:
    - {{name: src0, sample_size: 5, weight: 0.5, format: text, path: "{docs}", source_column: source, id_column: doc_id}}
    - {{name: src1, sample_size: 100000, weight: 1.0, format: text, path: "{docs}", source_column: source, id_column: doc_id}}
  mixing: {{shuffle: true, seed: 42, deduplicate: true, min_length: 50, max_length: 8192}}
training:
  hyperparameters: {{max_seq_length: 64, num_epochs: 2, batch_size: 2, gradient_accumulation_steps: 4}}
""")
    specs, mix, train = load_yaml_config(cfg)
    assert [s.name for s in specs] == ["src0", "src1"] and train.rows_per_step == 8
    res = run_prepare_job(spark, specs, os.path.join(d, "out"), mix)
    corpus = spark.read.parquet(res.paths["corpus"])
    n = corpus.count()
    funnel = {r["source"]: r.asDict() for r in res.prepared.funnel.collect()}
    assert funnel["src0"]["sampled"] == 5 and funnel["src1"]["sampled"] == funnel["src1"]["total"]
    assert n == sum(r["after_dedup"] for r in funnel.values())
    # text export concatenates in pos order
    lines = []
    for p in sorted(x for x in os.listdir(res.paths["text"]) if x.startswith("part-")):
        with open(os.path.join(res.paths["text"], p), encoding="utf-8") as fh:
            lines.extend(fh.read().split("\n")[:-1])
    ordered = [r["text"] for r in corpus.orderBy("pos").collect()]
    assert "\n".join(lines) == "\n".join(ordered)
    # stats document
    stat_files = [x for x in os.listdir(res.paths["stats"]) if x.startswith("part-")]
    doc = json.loads(open(os.path.join(res.paths["stats"], stat_files[0]), encoding="utf-8").read())
    assert doc["total_samples"] == n and set(doc["datasets"]) <= {"src0", "src1"}
    tt = run_train_input_job(spark, train_rows_from_corpus(corpus), os.path.join(d, "train"), train)
    b = spark.read.parquet(os.path.join(d, "train", "batches"))
    assert b.count() == 2 * n == 2 * tt["rows"]
    padded = spark.read.parquet(os.path.join(d, "train", "padded"))
    assert padded.select(F.min(F.size("input_ids")), F.max(F.size("input_ids"))).first() == (64, 64)
