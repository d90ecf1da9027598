"""Sources, record adapters and the job's edge behaviour."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusmill.config import ConfigError, MixSpec, SourceSpec
from corpusmill.operators.filters import length_band
from corpusmill.operators.render import render_samples
from corpusmill.plans import catalog
from corpusmill.sources.records import messages_records
from corpusmill.sources.scan import scan_source
from tests.conftest import SF001, SF01


def test_missing_split_errors_or_empties(spark):
    spec = SourceSpec(name="d", path=f"{SF001}/documents.parquet", id_column="doc_id", split="train")
    with pytest.raises(ConfigError):
        scan_source(spark, spec, MixSpec())
    assert scan_source(spark, spec, MixSpec(on_missing_split="empty")).count() == 0


def test_subset_filter_pushes_down(spark):
    spec = SourceSpec(name="d", path=f"{SF01}/documents.parquet", id_column="doc_id", subset="de",
                      subset_column="lang")
    df = scan_source(spark, spec)
    assert "EqualTo(lang,de)" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == spark.read.parquet(f"{SF01}/documents.parquet").where("lang = 'de'").count()


def test_duplicate_source_names_rejected(spark):
    from corpusmill.plans.prepare import prepare
    with pytest.raises(ConfigError):
        prepare(spark, [catalog.doc_spec(SF001, 0, 0.3), catalog.doc_spec(SF001, 0, 0.5)])


def test_no_source_loaded_writes_nothing(spark):
    from corpusmill.plans.jobs import run_prepare_job
    out = tempfile.mkdtemp(prefix="cm-none-")
    res = run_prepare_job(spark, [SourceSpec(name="x", path=f"{SF001}/missing.parquet", id_column="id")],
                          os.path.join(out, "o"))
    assert res.prepared is None and res.paths == {} and not os.path.exists(os.path.join(out, "o"))


def test_line_parity_rows_equal_text_roundtrip(spark):
    from corpusmill.plans.jobs import train_rows_from_lines
    from corpusmill.sources.sinks import export_text, read_lines
    from corpusmill.plans.prepare import prepare
    p = prepare(spark, catalog.docs_mix(SF01), MixSpec())
    rows = train_rows_from_lines(p.corpus)
    path = export_text(p.corpus, os.path.join(tempfile.mkdtemp(prefix="cm-lines-"), "t"))
    back = read_lines(spark, path)
    assert sorted(r[0] for r in rows.select("text").collect()) == sorted(r[0] for r in back.collect())
    assert rows.select(F.count_distinct("row_id")).first()[0] == rows.count()


def test_long_conversations_are_whole(spark):
    from corpusmill.plans.prepare import prepare
    long = spark.createDataFrame(
        [(1, 0, "user", "short question here " * 3), (1, 1, "assistant", "an answer " * 8),
         (2, 0, "user", "x" * 9000), (2, 1, "assistant", "y" * 1000)],
        "conv_id long, turn long, role string, text string")
    recs = messages_records(long)
    assert {r["conv_id"]: [len(m["content"]) for m in r["messages"]] for r in recs.collect()} == {1: [60, 80], 2: [9000, 1000]}
    spec = SourceSpec(name="c", format="chatml", id_column="conv_id")
    kept = {hi: prepare(spark, [spec], MixSpec(max_chars=hi), {"c": recs}).corpus.count() for hi in (8192, 20000)}
    assert kept == {8192: 1, 20000: 2}


def test_every_turn_is_in_some_record(spark):
    from corpusmill.sources.records import alpaca_records, openorca_records
    turns = [(1, 0, "system", "s0"), (1, 1, "user", "u1"), (1, 2, "assistant", "a2"), (1, 3, "user", "u3"),
             (1, 4, "user", "u4"), (1, 5, "assistant", "a5"), (1, 6, "assistant", "a6"), (1, 7, "system", "s7"),
             (1, 8, "tool", "t8"), (1, 9, None, "n9"), (2, 0, "system", "only"), (3, 0, "assistant", "first")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r["record_id"]: (r["instruction"], r["input"], r["output"]) for r in alpaca_records(df).collect()}
    assert got == {"1#1": ("u1", "s0", "a2"), "1#3": ("u3", "s0", None), "1#4": ("u4", "s0", "a5"), "1#6": (None, "s0", "a6"),
                   "1#7": (None, "s7", None), "1#8": ("t8", "s0", None), "1#9": ("n9", "s0", None),
                   "2#0": (None, "only", None), "3#0": (None, None, "first")}
    orca = {(r["question"], r["system_prompt"], r["response"]) for r in openorca_records(df).collect()}
    assert orca == set(got.values())
    conv = spark.read.parquet(f"{SF01}/conversations.parquet")
    found = {x for r in alpaca_records(conv).collect() for x in (r["instruction"], r["input"], r["output"])}
    assert {r["text"] for r in conv.collect()} <= found


def test_line_count_is_that_of_wc(spark):
    from corpusmill.sources.sinks import export_text, line_count
    df = spark.createDataFrame([(0, "a\rb"), (1, "c"), (2, "d\ne")], "pos long, text string")
    path = export_text(df, os.path.join(tempfile.mkdtemp(prefix="cm-wc-"), "t"))
    assert line_count(spark, path).first()["text_lines"] == 4


def test_text_export_keeps_the_order(spark):
    from corpusmill.sources.sinks import export_text
    path = os.path.join(tempfile.mkdtemp(prefix="cm-order-"), "t")
    df = spark.range(1000).select((999 - F.col("id")).alias("pos"), F.concat(F.lit("r"), 999 - F.col("id")).alias("text"))
    export_text(df.repartition(7), path, rows_per_file=30)
    parts = sorted(x for x in os.listdir(path) if x.startswith("part-"))
    lines = "".join(open(os.path.join(path, x)).read() for x in parts).split("\n")[:-1]
    assert lines == [f"r{i}" for i in range(1000)] and len(parts) == 34


def test_nothing_loaded_ends_with_a_code(spark, monkeypatch):
    from corpusmill.plans import jobs
    d = tempfile.mkdtemp(prefix="cm-cli-")
    with open(os.path.join(d, "c.yaml"), "w") as f:
        f.write(f"datasets: {{massive_datasets: [{{name: x, path: {d}/none.parquet, id_column: id}}]}}\n")
    assert jobs.main(["--config", os.path.join(d, "c.yaml"), "--output-dir", os.path.join(d, "o")]) == 1


def test_config_band_and_grouping(spark):
    from corpusmill.plans.jobs import load_yaml_config
    path = os.path.join(tempfile.mkdtemp(prefix="cm-band-"), "c.yaml")
    with open(path, "w") as f:
        f.write("datasets: {mixing: {min_length: 10, max_length: 2048}}\noptimization: {group_by_length: false}\n")
    _, mix, train = load_yaml_config(path)
    assert (mix.min_chars, mix.max_chars, train.group_by_length) == (50, 8192, False)
    with open(path, "w") as f:
        f.write("datasets: {mixing: {band_min_chars: 10, band_max_chars: 2048}}\n")
    _, mix, train = load_yaml_config(path)
    assert (mix.min_chars, mix.max_chars, train.group_by_length) == (10, 2048, True)


def test_jobs_with_factories_equal_the_built_in_ones(spark):
    from corpusmill.operators.render import chatml_template_factory
    from corpusmill.operators.tokens import codepoint_tokenizer_factory
    from corpusmill.plans.jobs import run_prepare_job, run_train_input_job, train_rows_from_corpus, train_rows_from_lines
    specs, frames = catalog.mixed_format(spark, SF001)
    d, out = tempfile.mkdtemp(prefix="cm-fact-"), []
    for i, (template, tokenizer) in enumerate(((None, None), (chatml_template_factory, codepoint_tokenizer_factory))):
        res = run_prepare_job(spark, specs, f"{d}/p{i}", MixSpec(), frames, template_factory=template)
        corpus = spark.read.parquet(res.paths["corpus"])
        for kind, rows in (("samples", train_rows_from_corpus(corpus)), ("lines", train_rows_from_lines(corpus))):
            run_train_input_job(spark, rows, f"{d}/{kind}{i}", tokenizer_factory=tokenizer, padded=False)
            out.append(sorted((r["row_id"], list(r["input_ids"])) for r in spark.read.parquet(f"{d}/{kind}{i}/tokenized").collect()))
            assert not os.path.exists(f"{d}/{kind}{i}/padded")
    assert out[0] == out[2] and out[1] == out[3] and len(out[1]) > len(out[0]) > 0


def test_json_alpaca_source_roundtrip(spark):
    from corpusmill.plans.prepare import prepare
    from corpusmill.sources.records import alpaca_records
    d = tempfile.mkdtemp(prefix="cm-json-")
    recs = alpaca_records(spark.read.parquet(f"{SF01}/conversations.parquet"))
    recs.write.mode("overwrite").json(os.path.join(d, "alpaca"))
    spec = SourceSpec(name="alp", format="alpaca", path=os.path.join(d, "alpaca"), reader="json",
                      id_column="record_id", weight=1.0)
    p = prepare(spark, [spec], MixSpec(deduplicate=False))
    # JSON drops NULL fields: an absent `input` renders the two-section form, as NULL does
    direct = render_samples(recs.withColumn("source", F.lit("alp"))
                            .withColumn("sample_id", F.concat(F.lit("alp/"), F.col("record_id"))), "alpaca")
    want = sorted(r[0] for r in length_band(direct).select("sample_id").collect())
    assert sorted(r[0] for r in p.corpus.select("sample_id").collect()) == want


def test_odd_config_funnel(spark):
    from corpusmill.plans.prepare import prepare
    p = prepare(spark, catalog.docs_odd(SF01), MixSpec())
    f = {r["source"]: r.asDict() for r in p.funnel.collect()}
    assert set(f) == {"src0", "src1", "src2", "src_missing"}
    assert f["src_missing"] == {"source": "src_missing", "total": 0, "sampled": 0, "kept": 0, "selected": 0,
                                "after_dedup": 0}
    assert f["src0"]["selected"] == int(f["src0"]["kept"] * 0.29)
    assert f["src1"]["selected"] == f["src1"]["kept"] and f["src2"]["selected"] == 0
    stats = {r["source"] for r in p.stats.collect()}
    assert "src_missing" not in stats


def test_transient_read_errors_are_retried(spark, monkeypatch):
    import corpusmill.sources.scan as S
    calls = {"n": 0}
    real = S._read

    def flaky(spark_, spec):
        calls["n"] += 1
        if calls["n"] < 3:
            raise OSError("transient storage error")
        return real(spark_, spec)

    monkeypatch.setattr(S, "_read", flaky)
    spec = SourceSpec(name="d", path=f"{SF001}/documents.parquet", id_column="doc_id")
    loaded, skipped = S.load_sources(spark, [spec], backoff_s=0.0)
    assert calls["n"] == 3 and len(loaded) == 1 and not skipped
    calls["n"] = -10  # keeps failing past the retries -> isolated as skipped
    monkeypatch.setattr(S, "_read", lambda *a: (_ for _ in ()).throw(OSError("down")))
    loaded, skipped = S.load_sources(spark, [spec], backoff_s=0.0)
    assert not loaded and "d" in skipped


def test_json_corpus_job(spark):
    from corpusmill.plans.jobs import run_prepare_job
    out = tempfile.mkdtemp(prefix="cm-jsoncorpus-")
    res = run_prepare_job(spark, catalog.docs_mix(SF001), os.path.join(out, "o"), corpus_format="json")
    back = spark.read.json(res.paths["corpus"])
    assert back.count() == sum(res.prepared.after_counts.values()) > 0
    lines = spark.read.text(res.paths["text"]).count()
    assert lines >= back.count()


def test_isolate_sources_skips_source_failing_at_execution(spark):
    from corpusmill.plans.prepare import prepare
    from corpusmill.session import StageStore
    d = tempfile.mkdtemp(prefix="cm-corrupt-")
    bad_dir = os.path.join(d, "bad")
    spark.read.parquet(f"{SF001}/documents.parquet").coalesce(1).write.parquet(bad_dir)
    with open(os.path.join(bad_dir, "part-zzzz-corrupt.parquet"), "wb") as f:
        f.write(b"PAR1" + os.urandom(4096) + b"PAR1")
    good = catalog.doc_spec(SF001, 0, 1.0)
    bad = SourceSpec(name="bad", format="text", path=bad_dir, id_column="doc_id", source_ord=1)
    with pytest.raises(Exception):
        prepare(spark, [good, bad], MixSpec(), store=StageStore(spark)).index.count()
    p = prepare(spark, [good, bad], MixSpec(), store=StageStore(spark), isolate_sources=True)
    assert "bad" in p.skipped
    assert {r["source"] for r in p.corpus.select("source").distinct().collect()} == {"src0"}
    f = {r["source"]: r["total"] for r in p.funnel.collect()}
    assert f["bad"] == 0 and f["src0"] > 0


def test_null_ids_are_malformed(spark):
    from corpusmill.operators.filters import stage_counts
    from corpusmill.plans.prepare import render_sources
    df = spark.createDataFrame([(1, "x" * 60), (None, "y" * 60), (3, "z" * 60)], "id long, text string")
    spec = SourceSpec(name="s", format="text", id_column="id")
    rendered, _, _ = render_sources(spark, [spec], MixSpec(), {"s": df})
    c = stage_counts(rendered).first()
    assert (c["rendered"], c["malformed"], c["kept"]) == (3, 1, 2)
