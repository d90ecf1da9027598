"""The whole prepare job against a plain-Python statement of its semantics
(exact-n sample, strip, band, fraction mix, seeded order, keep-first dedup)
on random configurations over the sf0.001 documents."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpusmill.config import MixSpec
from corpusmill.plans import catalog
from corpusmill.plans.prepare import prepare
from tests.conftest import SF001
from tools.python_baseline import prepare_rows

_DOCS = None


def _docs(spark):
    global _DOCS
    if _DOCS is None:
        _DOCS = [(r["source"], f"{r['source']}/{r['doc_id']}", r["text"])
                 for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    return _DOCS


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 19), st.sampled_from([None, 0, 3, 7, 100]),
                          st.sampled_from([0.0, 0.1, 0.29, 0.5, 1.0, 1.5])), min_size=1, max_size=6,
                unique_by=lambda t: t[0]),
       st.integers(0, 1000), st.booleans(), st.booleans())
def test_prepare_equals_bruteforce(spark, cfg, seed, shuffle, dedup):
    specs = [catalog.doc_spec(SF001, i, w, cap) for i, cap, w in cfg]
    mix = MixSpec(seed=seed, shuffle=shuffle, deduplicate=dedup)
    p = prepare(spark, specs, mix)
    got = sorted((r["pos"], r["sample_id"], r["mix_rank"], r["h"]) for r in
                 p.corpus.selectExpr("pos", "sample_id", "mix_rank", "md5(text) AS h").collect())
    docs = [d for d in _docs(spark) if d[2] is not None]
    assert got == prepare_rows(docs, specs, seed, shuffle=shuffle, deduplicate=dedup)
