"""A quality classifier: naive Bayes support vectors.

Features of a text are indicators of its byte n-grams (n = 1, 2, 3, hashed)
and of n-grams over the sequence "word equals the word before".  Indicators
are scaled by the classes' log-count ratios and brought to length 1; a linear
hinge-loss model over them is fitted by dual coordinate descent.  A logistic
curve over the margins of rows left out of the descent turns margins into
scores between 0 and 1.

The fit sees at most `max_rows` labelled rows, those with the smallest hashed
ids; one task fits them.  Scoring covers every row and whole texts.

Null texts count as empty; texts without features get the margin of the bias.
Labels that are null, or whose document is missing, are left out; of several
labels for an id the larger counts.  Without any labelled row every score is
0.5, with one class only it is that class's smoothed rate.  Repeated rows are
scored alike; ids may be null; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusmill.llm.common import clear_worker, give_back, small_batches

#: Runs of equal neighbours that count as n-grams of the equality sequence.
EQUAL_RUNS = (1, 2, 3, 5, 8)


@dataclass(frozen=True)
class Training:
    max_rows: int = 12_000
    bits: int = 18
    cost: float = 1.0
    epochs: int = 10
    smoothing: float = 1.0
    seed: int = 42


def featurizer(bits: int) -> Callable[[str], np.ndarray]:
    """A function from a text to the distinct indices of its features."""
    size = 1 << bits
    first = np.zeros(size + len(EQUAL_RUNS), dtype=np.int64)
    shift = np.uint32(32 - bits)

    def features(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
        parts = [raw.astype(np.int64)]
        if len(raw) > 1:
            pair = raw[:-1] << np.uint32(8) | raw[1:]
            parts.append(((pair + np.uint32(1 << 24)) * np.uint32(0x9E3779B1) >> shift).astype(np.int64))
            if len(raw) > 2:
                triple = pair[:-1] << np.uint32(8) | raw[2:]
                parts.append((triple * np.uint32(0x85EBCA6B) >> shift).astype(np.int64))
        words = text.split()
        equal = bytes(map(str.__eq__, words[1:], words))
        parts.append(np.array([size + k for k, n in enumerate(EQUAL_RUNS) if b"\1" * n in equal], np.int64))
        found = np.concatenate(parts)
        order = np.arange(len(found))
        first[found] = order  # the last writer of each index is the one that stays
        return found[first[found] == order]

    return features


def fit(rows: list[tuple[str, int]], training: Training) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """(ratios, weights, bias, slope, offset) from (text, label) rows in a fixed order."""
    size = (1 << training.bits) + len(EQUAL_RUNS)
    features = featurizer(training.bits)
    docs = [features(text).astype(np.int32) for text, _ in rows]
    sign = np.array([1.0 if label else -1.0 for _, label in rows])
    counts = np.full((2, size), training.smoothing)
    for x, s in zip(docs, sign):
        counts[int(s > 0)][x] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weights, bias = np.zeros(size), 0.0
    positive = (sign > 0).mean() if len(sign) else 0.5
    if not 0 < positive < 1:
        rate = ((sign > 0).sum() + 1) / (len(sign) + 2)
        return ratios, weights, bias, 1.0, float(np.log(rate / (1 - rate)))

    # rows are scaled when they are met: scaled ones would take three times the room of all else
    norms = [np.linalg.norm(ratios[x]) or 1.0 for x in docs]
    rng = np.random.default_rng(training.seed)
    aside = rng.random(len(docs)) < 0.2
    dual = np.zeros(len(docs))
    for _ in range(training.epochs):
        for i in rng.permutation(np.flatnonzero(~aside)):
            x = docs[i]
            v = ratios[x] / norms[i]
            gradient = sign[i] * (weights[x] @ v + bias) - 1
            new = min(max(dual[i] - gradient / 2.0, 0.0), training.cost)  # |v|^2 + 1 for the bias
            if new != dual[i]:
                change = (new - dual[i]) * sign[i]
                weights[x] += change * v
                bias += change
                dual[i] = new
    margins = np.array([weights[x] @ (ratios[x] / n) + bias for x, n in zip(docs, norms)])
    return ratios, weights, bias, *_logistic(margins[aside], sign[aside] > 0)


def _logistic(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of least squares of logarithm
    (Newton steps); the prior of two smoothed targets keeps it finite."""
    slope, offset = 2.0, 0.0
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(30 if len(margins) else 0):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * (slope - 2), (p - target).sum()])
        w = p * (1 - p)
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-3]])
        slope, offset = np.array([slope, offset]) - np.linalg.solve(h, g)
    return float(max(slope, 0.1)), float(offset)


def train(df: DataFrame, labels: DataFrame, training: Training = Training(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", usable: Column | None = None) -> bytes:
    """The fitted model, serialised.  `usable` says which label rows may be seen."""
    small_batches(df.sparkSession)
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        chosen = chosen.where(usable)
    order = F.xxhash64(F.lit(training.seed), F.col("_label_id"))
    # labels without a document use up none of the rows
    present = df.select(F.col(id_col).alias("_id"))
    chosen = (chosen.groupBy(F.col(id_col).alias("_label_id")).agg(F.max(label_col).cast("int").alias("_label"))
              .join(present, F.col("_label_id") == F.col("_id"), "left_semi")
              .orderBy(order, "_label_id").limit(training.max_rows))
    # at most max_rows narrow rows are broadcast; repeated documents keep one text
    sample = (df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
              .join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
              .select("_label_id", F.xxhash64("text").alias("h"), "text", "_label")
              .dropDuplicates(["_label_id", "h"]))

    def run(batches):
        clear_worker()
        give_back()
        best: dict[int, tuple] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["_label_id"] not in best or r["h"] < best[r["_label_id"]][0]:
                    best[r["_label_id"]] = (r["h"], r["text"], r["_label"])
        ratios, weights, *rest = fit([best[k][1:] for k in sorted(best)], training)
        best.clear()
        yield pa.RecordBatch.from_arrays([pa.array([model(ratios, weights, rest)], pa.binary())], names=["model"])
        give_back()

    def model(ratios, weights, rest) -> bytes:
        return np.concatenate([ratios, weights, rest]).astype("<f8").tobytes()

    fitted = sample.repartition(1).mapInArrow(run, "model binary").first()
    if fitted is None:  # no labelled row
        ratios, weights, *rest = fit([], training)
        return model(ratios, weights, rest)
    return bytes(fitted.model)


def score(df: DataFrame, model: bytes, training: Training = Training(), text_col: str = "text",
          out_col: str = "score") -> DataFrame:
    """`df` with a score for every row; a column of that name is replaced."""
    small_batches(df.sparkSession)
    df = df.drop(out_col)
    shared = df.sparkSession.sparkContext.broadcast(model)  # two numbers for each feature
    schema = StructType([*df.schema.fields, StructField(out_col, DoubleType())])

    def run(batches):
        clear_worker()
        give_back()
        data = np.frombuffer(shared.value, "<f8")
        size = (1 << training.bits) + len(EQUAL_RUNS)
        ratios, weights, (bias, slope, offset) = data[:size], data[size:2 * size], data[2 * size:]
        product, square = ratios * weights, ratios * ratios
        features = featurizer(training.bits)
        for batch in batches:
            scores = []
            for text in batch.column(text_col):
                x = features(text.as_py() or "")
                n = np.sqrt(square[x].sum())
                margin = product[x].sum() / n + bias if n else bias
                scores.append(float(1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """Rows that labels are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))
