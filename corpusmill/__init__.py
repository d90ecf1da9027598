"""corpusmill: instruction-corpus preparation as Spark DataFrame jobs.

Sub-packages:
  functions  Column-returning helpers (whitespace strip, templates, order keys)
  sources    scans, record adapters and sinks
  operators  sampling, ranking, mixing, dedup, tokens, batches, reports
  plans      whole jobs (prepare, train input) and the registered queries
  streaming  incremental render/filter stage on a streaming DataFrame
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from corpusmill.config import MixSpec, SourceSpec, TrainSpec

# Python code shipped to executors (mapInPandas functions, tokenizer and
# template factories) is serialised by value, so workers need no installed
# copy of this package; worker functions import nothing from it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["MixSpec", "SourceSpec", "TrainSpec"]
