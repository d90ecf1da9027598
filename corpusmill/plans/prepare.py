"""The prepare job: sources -> exact-n sample -> render -> strip -> band ->
fraction mix -> shuffle -> exact dedup -> corpus, funnel and stats.

Stage order is semantic (sampling, band, mix and dedup do not commute), so
it is explicit here.  Selection work runs on a narrow index
(source, sample_id, text_hash, keys); the wide text is joined back once at
the end.  Driver work: config, schema checks and collected per-source
counts (one row per source).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import MixSpec, SourceSpec, source_config_df, validate_sources
from corpusmill.functions.keys import text_hash
from corpusmill.functions.templates import CHATML, ChatTemplate
from corpusmill.operators.dedup import dedup_exact
from corpusmill.operators.filters import length_band
from corpusmill.operators.render import render_samples, render_with_factory
from corpusmill.operators.report import funnel_df, funnel_rows, per_source, stats_df
from corpusmill.operators.sampling import mix_selection, sample_exact_n
from corpusmill.operators.shuffle import ORD_PREFIX, global_positions, with_ord_key, with_source_order_key
from corpusmill.session import StageStore


@dataclass
class Prepared:
    rendered: DataFrame   # sample_id, source, text (NULL = malformed)
    samples: DataFrame    # narrow: sample_id, source, source_ord, text_hash (kept by the band)
    mixed: DataFrame      # narrow: source, sample_id, mix_rank, source_ord, text_hash, ord_key
    index: DataFrame      # narrow corpus: mixed (deduplicated) + pos
    corpus: DataFrame     # sample_id, source, source_ord, text, mix_rank, ord_key, pos
    funnel: DataFrame
    stats: DataFrame
    raw_counts: dict = field(default_factory=dict)   # source -> (total, sampled)
    kept_counts: dict = field(default_factory=dict)  # source -> rows after the band
    mix_counts: dict = field(default_factory=dict)   # source -> rows selected by the mix
    skipped: dict = field(default_factory=dict)
    funnel_rows: list = field(default_factory=list)   # (source, total, sampled, kept, selected, after_dedup)
    after_counts: dict = field(default_factory=dict)  # source -> rows in the corpus


class NoSourceLoaded(RuntimeError):
    pass


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def render_groups(spark: SparkSession, specs: list[SourceSpec], mix: MixSpec,
                  frames: dict[str, DataFrame] | None = None, template: ChatTemplate = CHATML,
                  template_factory=None) -> tuple[list[tuple[list[str], DataFrame]], dict, dict]:
    """Per source group (one scan): exact-n sample on raw rows, then render.
    Returns ([(source names, rendered sample, rendered raw rows or None)],
    raw_counts, skipped)."""
    from corpusmill.sources.scan import load_sources

    loaded, skipped = load_sources(spark, specs, mix, frames)
    groups, raw_counts, lazy_counts = [], {}, []
    for members, raw in loaded:
        sampled, rep = sample_exact_n(raw, {m.name: m.sample_size for m in members}, seed=mix.seed)
        if rep is None:  # no cap: total = sampled, counted lazily (source column only)
            lazy_counts.append(([m.name for m in members],
                                raw.groupBy("source").agg(F.count(F.lit(1)).alias("total"))))
        else:
            raw_counts.update(rep)
        head = members[0]

        def rend(df: DataFrame, head=head) -> DataFrame:
            if head.format == "chatml" and template_factory is not None:
                return render_with_factory(df, template_factory, mix)
            return render_samples(df, head.format, mix, template, head.text_column)

        # (names, rendered exact-n sample, rendered raw rows): the last one
        # feeds the final text join, whose index is already inside the sample
        groups.append(([m.name for m in members], rend(sampled), rend(raw) if sampled is not raw else None))
    raw_counts["_lazy"] = lazy_counts
    return groups, raw_counts, skipped


def render_sources(spark: SparkSession, specs: list[SourceSpec], mix: MixSpec,
                   frames: dict[str, DataFrame] | None = None, template: ChatTemplate = CHATML,
                   template_factory=None) -> tuple[DataFrame | None, dict, dict]:
    """S1/S2 + A1 + P6: per source group scan, exact-n sample on raw rows,
    render with the group's format (chat formats through `template_factory`
    when one is given).  Returns (rendered, raw_counts, skipped)."""
    groups, raw_counts, skipped = render_groups(spark, specs, mix, frames, template, template_factory)
    lazy = raw_counts.pop("_lazy")
    raw_counts["_lazy"] = union_all([d for _, d in lazy]) if lazy else None
    return (union_all([g[1] for g in groups]) if groups else None), raw_counts, skipped


def isolated_tables(spark: SparkSession, store: StageStore, frames: list[DataFrame],
                    concurrent: int) -> list[DataFrame | Exception]:
    """Each frame written to a table of its own, or the error that it failed
    with, in the frames' order.  Up to `concurrent` jobs run at a time, each from a
    thread that has a scheduler pool of its own, so under FAIR scheduling
    (spark.scheduler.mode) small sources go on beside a large one; a slow or
    failing one holds up no other."""
    def write(i: int) -> DataFrame | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"corpusmill-source-{i % concurrent}")
        try:
            return store.put(f"samples_{i}", frames[i])
        except Exception as e:  # noqa: BLE001 - one source's failure is its own
            return e
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(concurrent, len(frames)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(write), i) for i in range(len(frames))]]


def prepare(spark: SparkSession, specs: list[SourceSpec], mix: MixSpec | None = None,
            frames: dict[str, DataFrame] | None = None, template: ChatTemplate = CHATML,
            store: StageStore | None = None, template_factory=None,
            isolate_sources: bool = False, concurrent_sources: int = 8) -> Prepared:
    """The whole job.  With `isolate_sources` (needs a store) every source
    group is materialised on its own, so a source whose files fail while
    being read (corrupt data, lost storage) is reported in `skipped` and the
    run goes on without it; otherwise such errors fail the job.  So many
    groups as `concurrent_sources` are written at a time."""
    mix = mix or MixSpec()
    specs = validate_sources(specs, mix)
    config = source_config_df(spark, specs)
    groups, raw_counts, skipped = render_groups(spark, specs, mix, frames, template, template_factory)
    lazy_counts = raw_counts.pop("_lazy")
    if not groups:
        raise NoSourceLoaded(f"no source could be loaded: {skipped}")

    def to_samples(rendered: DataFrame) -> DataFrame:
        # F2 + F1, then J1: the config lookup (broadcast: one row per source).
        # Only the narrow identity of a kept sample is kept: the text is
        # re-rendered from the (durable) sources for the selected rows at the
        # end, so the kept corpus is never written out as a whole.
        kept = length_band(rendered, mix.min_chars, mix.max_chars)
        return (kept.join(F.broadcast(config.select("source", "source_ord")), "source", "inner")
                .select("sample_id", "source", "source_ord", text_hash("text").alias("text_hash")))

    if isolate_sources and store is not None:
        parts, ok_groups = [], []
        tables = isolated_tables(spark, store, [to_samples(part) for _, part, _ in groups], concurrent_sources)
        for group, table in zip(groups, tables):
            names = group[0]
            if isinstance(table, DataFrame):
                parts.append(table)
                ok_groups.append(group)
            else:  # execution-time failure of this source group alone
                for n in names:
                    skipped[n] = str(table).splitlines()[0][:300] if str(table) else type(table).__name__
                    raw_counts.pop(n, None)
                lazy_counts = [(ns, d) for ns, d in lazy_counts if ns != names]
        if not parts:
            raise NoSourceLoaded(f"no source could be read: {skipped}")
        groups = ok_groups
        samples = union_all(parts)
    else:
        samples = to_samples(union_all([g[1] for g in groups]))
        if store is not None:
            samples = store.put("samples", samples)
    rendered = union_all([g[1] for g in groups])
    rendered_all = union_all([g[2] if g[2] is not None else g[1] for g in groups])

    lazy_totals = union_all([d for _, d in lazy_counts]) if lazy_counts else None

    # A2 on the narrow projection; N per source is one small collect.
    kept_counts = {r["source"]: r["count"] for r in samples.groupBy("source").count().collect()}
    weights = {s.name: float(s.weight) for s in specs}
    selection, limits = mix_selection(samples, weights, seed=mix.seed, sizes=kept_counts)
    mixed = selection.ranked(samples, "mix_rank")
    if mix.shuffle:
        mixed = with_ord_key(mixed, mix.seed)
    else:
        mixed = with_source_order_key(mixed, mix.seed)
    if store is not None:
        mixed = store.put("mixed", mixed)

    # O1 + G1 on the narrow index, then positions 0..M-1.
    survivors = dedup_exact(mixed) if mix.deduplicate else mixed
    if store is not None and mix.deduplicate:
        survivors = store.put("survivors", survivors)
    bound = sum(limits.values())
    if mix.shuffle:
        index = global_positions(survivors, max(bound, 1))
    else:
        index = global_positions(survivors, max(bound, 1), fixed_prefix=ORD_PREFIX, n_groups=max(1, len(specs)))
    if store is not None:
        index = store.put("index", index)

    # The text of the selected rows, rendered again from the sources (exact:
    # rendering is deterministic): rows past their source's threshold are
    # dropped where they are scanned, so only selected text meets the index.
    corpus = (selection.rows(rendered_all.select("sample_id", "source", "text"))
              .join(index.select("sample_id", "source_ord", "mix_rank", "ord_key", "pos"), "sample_id")
              .select("sample_id", "source", "source_ord", "text", "mix_rank", "ord_key", "pos"))

    # Per-source counts (one row per source each), assembled on the driver.
    after_counts = per_source(index)
    totals = {k: v[0] for k, v in raw_counts.items()}
    sampled = {k: v[1] for k, v in raw_counts.items()}
    if lazy_totals is not None:
        uncapped = {r["source"]: int(r["total"]) for r in lazy_totals.collect()}
        totals.update(uncapped)
        sampled.update(uncapped)
    rows = funnel_rows([s.name for s in specs], {"total": totals, "sampled": sampled, "kept": kept_counts,
                                                  "selected": limits, "after_dedup": after_counts})
    funnel = funnel_df(spark, rows)
    stats = stats_df(spark, kept_counts, sum(after_counts.values()))
    return Prepared(rendered=rendered, samples=samples, mixed=mixed, index=index, corpus=corpus,
                    funnel=funnel, stats=stats, raw_counts=raw_counts, kept_counts=kept_counts,
                    mix_counts=limits, skipped=skipped, funnel_rows=rows, after_counts=after_counts)

