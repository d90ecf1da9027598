"""Prepare + train-input job on a replicated documents table.

usage: python tools/scale_run.py <dir with documents.parquet> [cpus]
The table is expected to hold a hot source `src_hot` (a third of all rows);
it gets a binding sample cap so exact-n sampling runs at scale.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    data = sys.argv[1]
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    from corpusmill.config import MixSpec, SourceSpec, TrainSpec
    from corpusmill.plans import catalog
    from corpusmill.plans.jobs import run_prepare_job, run_train_input_job, train_rows_from_corpus
    from corpusmill.session import local_session

    extra = {}
    if os.environ.get("EVENT_LOG_DIR"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["EVENT_LOG_DIR"]}
    spark = local_session(cpus, shuffle_partitions=4 * cpus, app="corpusmill-scale", extra=extra)
    specs = catalog.docs_mix(data) + [
        SourceSpec(name="src_hot", sample_size=50_000, weight=0.3, format="text",
                   path=catalog.table(data, "documents"), source_column="source", id_column="doc_id",
                   source_ord=20)]
    out = tempfile.mkdtemp(prefix="corpusmill-scale-")
    t0 = time.time()
    res = run_prepare_job(spark, specs, os.path.join(out, "prep"), MixSpec())
    prep = time.time() - t0
    rows = spark.read.parquet(catalog.table(data, "documents")).count()
    corpus = spark.read.parquet(res.paths["corpus"])
    t1 = time.time()
    tt = run_train_input_job(spark, train_rows_from_corpus(corpus), os.path.join(out, "train"), TrainSpec())
    train = time.time() - t1
    funnel = {r["source"]: [r["total"], r["sampled"], r["kept"], r["selected"], r["after_dedup"]]
              for r in res.prepared.funnel.collect()}
    print(json.dumps({"rows": rows, "prepare_sec": round(prep, 2), "train_input_sec": round(train, 2),
                      "rows_per_sec": round(rows / prep, 1), "stages": {k: round(v, 2) for k, v in res.timings.items()},
                      "train_stages": tt, "corpus_rows": corpus.count(), "funnel_hot": funnel.get("src_hot"),
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
