"""The registered queries: one per operator of the inventory.

Every query reads the given tables (`documents`, `conversations`) in full;
computed columns are aliased to the names the SQL oracle uses.  Arrays are
returned as md5 of their comma-joined values so results compare as scalars.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import MixSpec, SourceSpec, TrainSpec, source_config_df
from corpusmill.functions.keys import text_hash
from corpusmill.functions.templates import CHATML, render
from corpusmill.functions.text import in_length_band, strip_ws
from corpusmill.operators.batches import batch_assign, epoch_plan, length_grouped
from corpusmill.operators.dedup import dedup_report
from corpusmill.operators.filters import length_band, stage_counts
from corpusmill.operators.lines import line_explode
from corpusmill.operators.sampling import mix_fraction, sample_exact_n
from corpusmill.operators.shuffle import global_shuffle
from corpusmill.operators.tokens import (causal_labels, codepoint_tokenizer_factory, pad_and_mask,
                                         tokenize_truncate, tokenize_with)
from corpusmill.plans import catalog
from corpusmill.plans.prepare import Prepared, prepare, render_sources, union_all
from corpusmill.session import StageStore, ensure_checkpoint_dir
from corpusmill.sources.records import (alpaca_records, messages_records, openorca_records,
                                        sharegpt_records)
from corpusmill.sources.scan import load_sources, scan_source
from corpusmill.sources.sinks import export_text, line_count, read_lines, write_corpus

MIX = MixSpec(seed=catalog.SEED)
TRAIN = TrainSpec(seed=catalog.SEED)


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def _ids_md5(c: str) -> Column:
    return F.md5(F.array_join(F.col(c), ","))


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "corpusmill-out", uuid.uuid4().hex, name)


# ---------------------------------------------------------------- sources
def doc_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as stripped text samples: (sample_id, source, text)."""
    df = catalog.documents(spark, sf_dir)
    return df.select(F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("sample_id"),
                     "source", strip_ws("text").alias("text"))


def q_source_scan(spark, sf_dir):
    spec = SourceSpec(name="docs_en", path=catalog.table(sf_dir, "documents"), subset="en",
                      subset_column="lang", id_column="doc_id")
    df = scan_source(spark, spec, MIX)
    return df.select("source", "sample_id", _big(F.length(strip_ws("text"))).alias("n_chars"))


def q_source_isolation(spark, sf_dir):
    specs = [SourceSpec(name="docs", path=catalog.table(sf_dir, "documents"), id_column="doc_id"),
             SourceSpec(name="missing", path=catalog.table(sf_dir, "no_such_table")),
             SourceSpec(name="turns", path=catalog.table(sf_dir, "conversations"),
                        id_column=None)]
    loaded, skipped = load_sources(spark, specs, MIX)
    if "missing" not in skipped or len(loaded) != 2:
        raise RuntimeError(f"source isolation did not isolate the missing source: {skipped}")
    parts = [df.groupBy("source").agg(_big(F.count(F.lit(1))).alias("n_rows")) for _, df in loaded]
    return union_all(parts)


# -------------------------------------------------------------- templates
def _render_long(spark, sf_dir, kind: str, template=CHATML, strip: bool = True) -> DataFrame:
    conv = catalog.conversations(spark, sf_dir)
    recs = {"messages": messages_records, "sharegpt": sharegpt_records,
            "alpaca": alpaca_records, "orca": openorca_records}[kind](conv)
    fmt = {"messages": "chatml", "sharegpt": "chatml", "alpaca": "alpaca", "orca": "openorca"}[kind]
    text = render(recs, fmt, null_as=MIX.null_as, template=template)
    if strip:
        text = strip_ws(text)
    key = "record_id" if "record_id" in recs.columns else "conv_id"
    return recs.select(F.concat(F.lit(f"{kind}/"), F.col(key).cast("string")).alias("sample_id"), text.alias("text"))


def q_format_chatml(spark, sf_dir):
    return _render_long(spark, sf_dir, "messages")


def q_format_alpaca(spark, sf_dir):
    return _render_long(spark, sf_dir, "alpaca", strip=False)


def q_format_openorca(spark, sf_dir):
    conv = catalog.conversations(spark, sf_dir)
    with_sys = openorca_records(conv, with_system=True)
    no_sys = openorca_records(conv, with_system=False)
    a = with_sys.select(F.concat(F.lit("orca/"), F.col("record_id")).alias("sample_id"),
                        render(with_sys, "openorca", null_as=MIX.null_as).alias("text"))
    b = no_sys.select(F.concat(F.lit("orca_default/"), F.col("record_id")).alias("sample_id"),
                      render(no_sys, "openorca", null_as=MIX.null_as).alias("text"))
    return a.unionByName(b)


def q_sharegpt_to_messages(spark, sf_dir):
    from corpusmill.functions.templates import normalized_messages, render_messages
    recs = sharegpt_records(catalog.conversations(spark, sf_dir))
    msgs = normalized_messages(recs, MIX.null_as)
    return recs.select(F.concat(F.lit("sharegpt/"), F.col("conv_id").cast("string")).alias("sample_id"),
                       F.array_join(F.transform(msgs, lambda m: m["role"]), ",").alias("roles"),
                       _big(F.size(msgs)).alias("n_messages"),
                       render_messages(msgs).alias("text"))


def q_chat_template_custom(spark, sf_dir):
    df = _render_long(spark, sf_dir, "messages", template=catalog.CUSTOM_TEMPLATE)
    return df.select("sample_id", "text")


def q_chat_template_factory(spark, sf_dir):
    """A template given as Python code (here ChatML), run per Arrow
    batch; must equal the built-in ChatML rendering."""
    from corpusmill.operators.render import chatml_template_factory, render_with_factory
    recs = messages_records(catalog.conversations(spark, sf_dir))
    df = recs.withColumn("source", F.lit("messages")).withColumn(
        "sample_id", F.concat(F.lit("messages/"), F.col("conv_id").cast("string")))
    return render_with_factory(df, chatml_template_factory, MIX).select("sample_id", "text")


def q_format_dispatch(spark, sf_dir):
    specs, frames = catalog.mixed_format(spark, sf_dir)
    rendered, _, _ = render_sources(spark, specs, MIX, frames)
    return rendered.select("source", "sample_id", "text")


def q_strip_text(spark, sf_dir):
    d = doc_samples(spark, sf_dir)
    return d.select("sample_id", "text", _big(F.length("text")).alias("n_chars"))


def q_line_explode(spark, sf_dir):
    d = doc_samples(spark, sf_dir)
    return line_explode(d, keep=["sample_id"]).select("sample_id", _big("line_no").alias("line_no"), "line")


def q_length_band(spark, sf_dir):
    d = doc_samples(spark, sf_dir)
    return d.where(in_length_band("text")).select("sample_id", "source", _big(F.length("text")).alias("n_chars"))


def q_length_band_stream(spark, sf_dir):
    """F1 (with P7) run as an incremental streaming query over the documents
    files, then read back from its sink."""
    from corpusmill.streaming import run_available_now, stream_samples
    docs = catalog.documents(spark, sf_dir)
    spec = SourceSpec(name="documents", path=catalog.table(sf_dir, "documents"), format="text",
                      source_column="source", id_column="doc_id")
    out = run_available_now(stream_samples(spark, spec, docs.schema, MIX), _scratch(spark, "stream_band"))
    return spark.read.parquet(out).select("sample_id", "source", _big("n_chars").alias("n_chars"))


def q_malformed_drop(spark, sf_dir):
    specs, frames = catalog.mixed_format(spark, sf_dir)
    rendered, _, _ = render_sources(spark, specs, MIX, frames)
    c = stage_counts(rendered)
    return c.select("source", _big("rendered").alias("rendered"), _big("malformed").alias("malformed"),
                    _big("kept").alias("kept"))


# --------------------------------------------------- sampling and mixing
def _kept_docs(spark, sf_dir, specs: list[SourceSpec]) -> DataFrame:
    rendered, _, _ = render_sources(spark, specs, MIX)
    return length_band(rendered)


def q_sample_exact_n(spark, sf_dir):
    specs = catalog.docs_capped(sf_dir)
    raw = scan_source(spark, specs[0], MIX, names=[s.name for s in specs])
    picked, _ = sample_exact_n(raw, {s.name: s.sample_size for s in specs}, seed=MIX.seed)
    return picked.select("source", "sample_id", text_hash("text").alias("text_hash"))


def _mixed(spark, sf_dir, specs):
    """A2 over the kept samples; their narrow projection is written once
    (stage table) so counting, bucket offsets and the window read it."""
    kept = StageStore(spark).put("kept_ids", _kept_docs(spark, sf_dir, specs).select("source", "sample_id"))
    sel, limits = mix_fraction(kept, {s.name: s.weight for s in specs}, seed=MIX.seed)
    return sel, limits


def q_mix_fraction(spark, sf_dir):
    sel, _ = _mixed(spark, sf_dir, catalog.docs_mix(sf_dir))
    return sel.select("source", "sample_id", _big("mix_rank").alias("mix_rank"))


def q_global_shuffle(spark, sf_dir):
    sel, limits = _mixed(spark, sf_dir, catalog.docs_mix(sf_dir))
    out = global_shuffle(sel.select("source", "sample_id"), MIX.seed, n_rows=sum(limits.values()))
    return out.select("sample_id", "source", "ord_key", _big("pos").alias("pos"))


def q_config_join(spark, sf_dir):
    specs = catalog.docs_odd(sf_dir)
    cfg = source_config_df(spark, specs)
    samples = length_band(doc_samples(spark, sf_dir))
    joined = samples.join(F.broadcast(cfg.select("source", "source_ord")), "source", "inner")
    return joined.select("source", _big("source_ord").alias("source_ord"), "sample_id")


def q_source_union(spark, sf_dir):
    docs = length_band(doc_samples(spark, sf_dir)).withColumn("source_ord", F.lit(0))
    chats = length_band(_render_long(spark, sf_dir, "messages")) \
        .withColumn("source", F.lit("chat")).withColumn("source_ord", F.lit(1))
    u = union_all([docs.select("source", "source_ord", "sample_id", "text"),
                   chats.select("source", "source_ord", "sample_id", "text")])
    return u.select("source", _big("source_ord").alias("source_ord"), "sample_id",
                    text_hash("text").alias("text_hash"))


# ----------------------------------------------------- prepare (whole job)
def run_prepare(spark, sf_dir, specs=None, frames=None) -> Prepared:
    """The production path: stage tables are written under spark.checkpoint.dir."""
    return prepare(spark, specs or catalog.docs_mix(sf_dir), MIX, frames, store=StageStore(spark))


def q_dedup_exact(spark, sf_dir):
    p = run_prepare(spark, sf_dir)
    return p.index.select("sample_id", "source", _big("mix_rank").alias("mix_rank"), "ord_key",
                          _big("pos").alias("pos"))


def q_dedup_report(spark, sf_dir):
    p = run_prepare(spark, sf_dir)
    return dedup_report(p.mixed)


def q_prep_funnel(spark, sf_dir):
    p = prepare(spark, catalog.docs_capped(sf_dir), MIX, store=StageStore(spark))
    return p.funnel


def q_corpus_stats(spark, sf_dir):
    return run_prepare(spark, sf_dir).stats


def q_corpus_roundtrip(spark, sf_dir):
    p = run_prepare(spark, sf_dir)
    path = write_corpus(p.corpus, _scratch(spark, "corpus"))
    back = spark.read.parquet(path)
    return back.select("sample_id", "source", _big("pos").alias("pos"), text_hash("text").alias("text_hash"))


def q_line_scan(spark, sf_dir):
    p = run_prepare(spark, sf_dir)
    corpus = StageStore(spark).put("corpus", p.corpus)  # the join runs once
    path = export_text(corpus, _scratch(spark, "corpus_txt"), n_rows=sum(p.after_counts.values()))
    return read_lines(spark, path)


def q_corpus_line_count(spark, sf_dir):
    p = run_prepare(spark, sf_dir)
    corpus = StageStore(spark).put("corpus", p.corpus)
    path = export_text(corpus, _scratch(spark, "corpus_txt"), n_rows=sum(p.after_counts.values()))
    rows = corpus.agg(_big(F.count(F.lit(1))).alias("corpus_rows"))
    lines = line_count(spark, path)
    return rows.select("corpus_rows", lines.select(_big("text_lines")).scalar().alias("text_lines"))


# ------------------------------------------------------ training input
def train_rows(spark, sf_dir) -> DataFrame:
    """Lossless train rows: every non-blank stripped document."""
    d = doc_samples(spark, sf_dir)
    return d.where(F.col("text") != F.lit("")).select(F.col("sample_id").alias("row_id"), "text")


def q_tokenize_truncate(spark, sf_dir):
    tok = tokenize_truncate(train_rows(spark, sf_dir), TRAIN)
    return tok.select("row_id", _big("n_tokens").alias("n_tokens"), _ids_md5("input_ids").alias("ids_md5"))


def q_tokenize_udf(spark, sf_dir):
    tok = tokenize_with(train_rows(spark, sf_dir), codepoint_tokenizer_factory, TRAIN)
    return tok.select("row_id", _big("n_tokens").alias("n_tokens"), _ids_md5("input_ids").alias("ids_md5"))


def q_pad_and_mask(spark, sf_dir):
    padded = pad_and_mask(tokenize_truncate(train_rows(spark, sf_dir), TRAIN), TRAIN)
    return padded.select("row_id", _big("n_tokens").alias("n_tokens"), _ids_md5("input_ids").alias("ids_md5"),
                         _ids_md5("attention_mask").alias("mask_md5"),
                         _big(F.size("input_ids")).alias("padded_len"))


def q_causal_labels(spark, sf_dir):
    lab = causal_labels(pad_and_mask(tokenize_truncate(train_rows(spark, sf_dir), TRAIN), TRAIN), TRAIN)
    n_ign = F.size(F.filter("labels", lambda x: x == F.lit(TRAIN.ignore_index)))
    return lab.select("row_id", _ids_md5("labels").alias("labels_md5"), _big(n_ign).alias("n_ignored"))


def _plan(spark, sf_dir, carry=None):
    """B1 over the ids and token counts of the tokenized rows, written once."""
    rows = StageStore(spark).put("tokenized", tokenize_truncate(train_rows(spark, sf_dir), TRAIN)
                                 .select("row_id", "n_tokens"))
    n = rows.count()
    return epoch_plan(rows, n, TRAIN, carry=carry)


def q_epoch_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select(_big("epoch").alias("epoch"), "row_id", _big("pos").alias("pos"))


def q_batch_assign(spark, sf_dir):
    b = batch_assign(_plan(spark, sf_dir), TRAIN)
    return b.select(_big("epoch").alias("epoch"), "pos", "micro_batch", "step", "row_id")


def q_length_grouped_batches(spark, sf_dir):
    b = length_grouped(_plan(spark, sf_dir, carry=["n_tokens"]), TRAIN)
    return b.select(_big("epoch").alias("epoch"), _big("pos").alias("pos"), "micro_batch", "step", "row_id")


QUERIES = {
    "source_scan": q_source_scan,
    "source_isolation": q_source_isolation,
    "corpus_roundtrip": q_corpus_roundtrip,
    "line_scan": q_line_scan,
    "corpus_stats": q_corpus_stats,
    "corpus_line_count": q_corpus_line_count,
    "format_alpaca": q_format_alpaca,
    "format_chatml": q_format_chatml,
    "sharegpt_to_messages": q_sharegpt_to_messages,
    "format_openorca": q_format_openorca,
    "chat_template_custom": q_chat_template_custom,
    "chat_template_factory": q_chat_template_factory,
    "format_dispatch": q_format_dispatch,
    "strip_text": q_strip_text,
    "line_explode": q_line_explode,
    "length_band": q_length_band,
    "length_band_stream": q_length_band_stream,
    "malformed_drop": q_malformed_drop,
    "sample_exact_n": q_sample_exact_n,
    "mix_fraction": q_mix_fraction,
    "global_shuffle": q_global_shuffle,
    "config_join": q_config_join,
    "source_union": q_source_union,
    "dedup_exact": q_dedup_exact,
    "dedup_report": q_dedup_report,
    "prep_funnel": q_prep_funnel,
    "tokenize_truncate": q_tokenize_truncate,
    "pad_and_mask": q_pad_and_mask,
    "causal_labels": q_causal_labels,
    "epoch_plan": q_epoch_plan,
    "batch_assign": q_batch_assign,
    "length_grouped_batches": q_length_grouped_batches,
    "tokenize_udf": q_tokenize_udf,
}
