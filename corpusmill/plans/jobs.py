"""Runnable jobs: prepare (writes corpus, text export, stats, funnel) and
train input (tokenized rows and the batch order table).

Config can come from a YAML file shaped like the reference's
(`datasets.massive_datasets` list, `datasets.mixing`, `training.hyperparameters`)
plus our own keys for where each source's files are.
"""

from __future__ import annotations

import dataclasses
import importlib
import json
from concurrent.futures import ThreadPoolExecutor
import logging
import os
import sys
import time
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import ConfigError, MixSpec, SourceSpec, TrainSpec
from corpusmill.operators.batches import batch_assign, epoch_plan, length_grouped
from corpusmill.operators.tokens import causal_labels, pad_and_mask, tokenize_truncate, tokenize_with
from corpusmill.operators.report import dedup_numbers
from corpusmill.operators.lines import line_explode
from corpusmill.functions.templates import CHATML, ChatTemplate
from corpusmill.plans.prepare import NoSourceLoaded, Prepared, prepare
from corpusmill.session import StageStore, ensure_checkpoint_dir, job_description
from corpusmill.sources.sinks import export_text, write_corpus, write_stats

SPEC_KEYS = {f for f in SourceSpec.__dataclass_fields__}
log = logging.getLogger(__name__)


def load_yaml_config(path: str) -> tuple[list[SourceSpec], MixSpec, TrainSpec]:
    import yaml
    with open(path, encoding="utf-8") as f:
        cfg = yaml.safe_load(f)
    ds = cfg.get("datasets", {})
    specs = []
    for i, d in enumerate(ds.get("massive_datasets") or []):
        unknown = set(d) - SPEC_KEYS
        if unknown:
            raise ConfigError(f"unknown source keys {sorted(unknown)}")
        specs.append(SourceSpec(**{"source_ord": i, **d}))
    m = ds.get("mixing") or {}
    mix = MixSpec(seed=int(m.get("seed", 42)), deduplicate=bool(m.get("deduplicate", True)),
                  shuffle=bool(m.get("shuffle", True)), min_chars=int(m.get("band_min_chars", MixSpec.min_chars)),
                  max_chars=int(m.get("band_max_chars", MixSpec.max_chars)))
    h = (cfg.get("training") or {}).get("hyperparameters") or {}
    o = cfg.get("optimization") or {}
    train = TrainSpec(max_seq_length=int(h.get("max_seq_length", 2048)), num_epochs=int(h.get("num_epochs", 3)),
                      batch_size=int(h.get("batch_size", 1)),
                      grad_accum=int(h.get("gradient_accumulation_steps", 16)),
                      group_by_length=bool(o.get("group_by_length", True)), seed=mix.seed)
    return specs, mix, train


def load_template(path: str) -> ChatTemplate:
    """The chat template of a YAML file: `datasets.chat_template`, a mapping of
    ChatTemplate's fields; ChatML where there is none."""
    import yaml
    with open(path, encoding="utf-8") as f:
        spec = (yaml.safe_load(f).get("datasets") or {}).get("chat_template")
    return CHATML if spec is None else ChatTemplate.from_mapping(spec)


#: Folder of the table that lists an output folder's complete runs.
COMMITS = "commits"
COMMIT_SCHEMA = "run long, paths map<string,string>"


def committed_runs(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """(run, paths) of the complete runs under `out_dir`; None if there is none yet."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(os.path.join(out_dir, COMMITS))
    except AnalysisException:  # no such folder
        return None


def current_outputs(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Where the outputs of the last complete run under `out_dir` are; empty if
    there is none.  All of them come from one run, whatever a later run that
    failed or is still going on has written."""
    runs = committed_runs(spark, out_dir)
    last = None if runs is None else runs.orderBy(F.col("run").desc()).first()
    return dict(last["paths"]) if last else {}


def commit_run(spark: SparkSession, out_dir: str, run: int, paths: dict[str, str]) -> None:
    """Makes a run the current one: one row appended to the table of runs,
    which appears as a whole when its file is moved into place."""
    spark.createDataFrame([(run, paths)], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(out_dir, COMMITS))


@dataclass
class JobResult:
    prepared: Prepared
    paths: dict = field(default_factory=dict)
    timings: dict = field(default_factory=dict)


def run_prepare_job(spark: SparkSession, specs: list[SourceSpec], out_dir: str, mix: MixSpec | None = None,
                    frames: dict[str, DataFrame] | None = None, text_export: bool = True,
                    corpus_format: str = "parquet", template: ChatTemplate = CHATML, template_factory=None,
                    isolate_sources: bool = False) -> JobResult:
    """Chat sources render through `template`, or through `template_factory`
    (Python code, built once per task) when one is given.

    All outputs go to a folder of this run under `out_dir`; when all are
    there, a row that names them is added to the table of runs, last.  Readers ask
    `current_outputs`, so a run that fails leaves the set before it in place."""
    t = {}
    t0 = time.time()
    store = StageStore(spark)
    mix = mix or MixSpec()
    try:
        p = prepare(spark, specs, mix, frames, template, store=store, template_factory=template_factory,
                    isolate_sources=isolate_sources)
    except NoSourceLoaded as e:
        log.error("no dataset could be loaded, nothing written: %s", e)
        return JobResult(prepared=None, paths={}, timings={"total": time.time() - t0})
    t["select"] = time.time() - t0
    run = time.time_ns()
    run_dir = os.path.join(out_dir, "runs", str(run))
    paths = {"corpus": os.path.join(run_dir, "corpus"), "stats": os.path.join(run_dir, "dataset_stats"),
             "funnel": os.path.join(run_dir, "prep_funnel"), "store": store.root}
    t1 = time.time()
    with job_description(spark, "corpusmill write corpus"):
        write_corpus(p.corpus, paths["corpus"], corpus_format)
    # later outputs read the written corpus (selected rows only), not the join again
    corpus_out = (spark.read.parquet(paths["corpus"]) if corpus_format == "parquet"
                  else spark.read.schema(p.corpus.schema).json(paths["corpus"]))
    t["write_corpus"] = time.time() - t1
    if text_export:
        t1 = time.time()
        with job_description(spark, "corpusmill export text"):
            paths["text"] = export_text(corpus_out, os.path.join(run_dir, "training_data_txt"),
                                        n_rows=sum(p.after_counts.values()))
        t["export_text"] = time.time() - t1
    t1 = time.time()
    echo = json.dumps({"sources": [dataclasses.asdict(s) for s in specs], "mixing": dataclasses.asdict(mix)},
                      default=str)
    paths["dedup_report"] = os.path.join(run_dir, "dedup_report")
    rep = dedup_numbers(sum(p.mix_counts.values()), sum(p.after_counts.values()))
    # three small independent writes (one row per source at most): submitted together
    writes = [
        lambda: write_stats(p.stats, paths["stats"], corpus_out, echo),
        lambda: p.funnel.coalesce(1).write.mode("overwrite").json(paths["funnel"]),
        lambda: spark.createDataFrame([rep]).coalesce(1).write.mode("overwrite").json(paths["dedup_report"]),
    ]
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for f in [pool.submit(w) for w in writes]:
            f.result()
    commit_run(spark, out_dir, run, paths)
    t["reports"] = time.time() - t1
    for r in p.funnel_rows:
        log.info("source %s: total=%s sampled=%s kept=%s selected=%s after_dedup=%s", *r)
    log.info("removed %s duplicates (%.1f%%)", rep["removed"], rep["removed_pct"])
    t["total"] = time.time() - t0
    return JobResult(prepared=p, paths=paths, timings=t)


def train_rows_from_corpus(corpus: DataFrame) -> DataFrame:
    """Lossless train rows: one per sample (not per line), non-blank."""
    return corpus.where(F.col("text") != F.lit("")).select(F.col("sample_id").alias("row_id"), "text")


def train_rows_from_lines(corpus: DataFrame) -> DataFrame:
    """Parity path: one train row per non-blank stripped line, as reading the
    text export line by line gives; row ids stay stable (sample_id#line)."""
    lines = line_explode(corpus, keep=["sample_id"])
    return lines.select(F.concat("sample_id", F.lit("#"), F.col("line_no").cast("string")).alias("row_id"),
                        F.col("line").alias("text"))


def run_train_input_job(spark: SparkSession, rows: DataFrame, out_dir: str,
                        spec: TrainSpec | None = None, tokenizer_factory=None, padded: bool = True) -> dict:
    """T1 (+T2/T3 at export) and B1-B3: writes unpadded token ids, the batch
    order table and, with `padded`, the padded arrays with mask and labels;
    returns timings.  `tokenizer_factory` (built once per task) replaces the
    built-in code-point tokenizer."""
    spec = spec or TrainSpec()
    t = {}
    t0 = time.time()
    tok_path = os.path.join(out_dir, "tokenized")
    with job_description(spark, "corpusmill tokenize"):
        tokens = (tokenize_truncate(rows, spec) if tokenizer_factory is None
                  else tokenize_with(rows, tokenizer_factory, spec))
        tokens.write.mode("overwrite").parquet(tok_path)
    tok = spark.read.parquet(tok_path)
    t["tokenize"] = time.time() - t0
    t1 = time.time()
    n = tok.count()
    plan = epoch_plan(tok, n, spec, carry=["n_tokens"])
    batches = length_grouped(plan, spec) if spec.group_by_length else batch_assign(plan, spec)
    with job_description(spark, "corpusmill batches"):
        batches.write.mode("overwrite").parquet(os.path.join(out_dir, "batches"))
    t["batches"] = time.time() - t1
    t1 = time.time()
    if padded:
        with job_description(spark, "corpusmill pad and labels"):
            causal_labels(pad_and_mask(tok, spec), spec).write.mode("overwrite").parquet(os.path.join(out_dir, "padded"))
        t["pad_labels"] = time.time() - t1
    t["total"] = time.time() - t0
    t["rows"] = n
    return t


def named_factory(name: str | None):
    """The object that 'module:attribute' names."""
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def main(argv=None) -> int:
    import argparse
    from corpusmill.session import local_session
    ap = argparse.ArgumentParser(description="prepare an instruction corpus with Spark")
    ap.add_argument("--config", required=True)
    ap.add_argument("--output-dir", required=True)
    ap.add_argument("--local", action="store_true", help="run on a local[*] session (tests, laptops)")
    ap.add_argument("--isolate-sources", action="store_true", help="go on without sources that fail while being read")
    ap.add_argument("--template", help="YAML file whose datasets.chat_template renders chat messages, instead of the config's own")
    ap.add_argument("--template-factory", help="module:attribute, renders chat message lists")
    ap.add_argument("--tokenizer-factory", help="module:attribute, tokenizes batches of texts")
    ap.add_argument("--rows", choices=("samples", "lines"), default="samples",
                    help="train on whole samples, or on the lines of the text export")
    ap.add_argument("--no-padded", action="store_true", help="do not write the padded arrays")
    a = ap.parse_args(argv)
    specs, mix, train = load_yaml_config(a.config)
    if a.local:
        spark = local_session()
    else:  # spark-submit supplies master and cluster settings
        spark = SparkSession.builder.appName("corpusmill").getOrCreate()
        ensure_checkpoint_dir(spark)
    res = run_prepare_job(spark, specs, a.output_dir, mix, template=load_template(a.template or a.config), template_factory=named_factory(a.template_factory),
                          isolate_sources=a.isolate_sources)
    if res.prepared is None:
        return 1
    corpus = spark.read.parquet(res.paths["corpus"])
    rows = train_rows_from_corpus(corpus) if a.rows == "samples" else train_rows_from_lines(corpus)
    tt = run_train_input_job(spark, rows, a.output_dir, train, named_factory(a.tokenizer_factory), not a.no_padded)
    print(json.dumps({"prepare": res.timings, "train_input": tt, "skipped": res.prepared.skipped}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
