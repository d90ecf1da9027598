"""Language of texts by word-first backoff.

A model holds, for each language, the natural logs of the relative frequencies
of its most frequent words, and of character n-grams of each size inside words
(a space stands at both ends of a word).  A word that any language knows scores
by its frequencies; an unseen word by the mean over its known n-grams of the
largest size of which any is known, then of the next shorter size, down to
single characters; a word of which nothing is known says nothing.  Where a
language lacks a word or n-gram that another one knows, half a count in the
largest language stands in.  A text's score for a language is the sum over its
words plus the log of the language's share of all counted words; the
prediction is the language of the largest, its probability that of the softmax.

Words are runs of letters and marks in lower case, beginning with a letter; a
run of more than `word_chars` is cut into pieces of that length.

Training counts every word of every usable row: tasks count what they read,
Spark adds up, n-grams are counted on the distinct words.  The model that goes to all tasks
is bounded by `words` and `grams` (entries over all languages) and `languages`.

Null texts and texts without a letter are `und`, with a probability of 0, as is everything where
nothing was learned.  Rows with a null language or text teach nothing.  Ties go to
the language of more counted words, then to the name by code points.  Repeated rows count as
often as they stand there.  Extra columns pass through; empty tables give empty results.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from corpusmill.llm.common import Stages, per_worker, small_batches, text_batches

UNKNOWN = "und"
#: Scores of unseen words that a worker keeps, over all languages.
CELLS = 4_000_000


@dataclass(frozen=True)
class Limits:
    sizes: int = 5             # n-grams have 1 .. sizes characters
    words: int = 200_000       # words of the model, over all languages
    grams: int = 250_000       # n-grams of the model, over all languages and sizes
    languages: int = 256       # those of the most words
    word_chars: int = 64
    flush: int = 200_000       # counts that a task holds before it hands them on
    cached: int = 100_000      # unseen words that a worker keeps the scores of


@dataclass(frozen=True)
class Model:
    """languages, ln of their shares, for each size (0: words) the entries'
    numbers, and for entry i the languages that hold it, langs[edges[i]:edges[i + 1]],
    with what its log frequency there is above that of a language without it."""
    languages: list[str]
    priors: np.ndarray
    places: list[dict[str, int]]
    edges: np.ndarray
    langs: np.ndarray
    above: np.ndarray
    word_chars: int

    def row(self, entry: int) -> np.ndarray:
        out = np.zeros(len(self.languages))
        own = slice(self.edges[entry], self.edges[entry + 1])
        out[self.langs[own]] = self.above[own]
        return out


def word_finder(word_chars: int):
    """A function from a text to its words."""
    find = regex.compile(r"\p{L}[\p{L}\p{M}]{0,%d}" % (word_chars - 1)).findall
    return lambda text: find(text.lower())


def n_grams(word: str, size: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + size] for i in range(len(padded) - size + 1)]


def word_counts(df: DataFrame, how: Limits, lang_col: str, text_col: str) -> DataFrame:
    """(lang, word, n), added up inside each task."""
    def run(batches):
        words, counts, size = word_finder(how.word_chars), {}, 0
        for langs, texts in text_batches(batches, "lang", "text"):
            for lang, text in zip(langs, texts):
                own = counts.setdefault(lang, Counter())
                own.update(words(text))
            if sum(map(len, counts.values())) > how.flush:
                yield from rows(counts)
                counts = {}
        yield from rows(counts)

    def rows(counts):
        for lang, own in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())],
                names=["lang", "word", "n"])

    return (df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))


def gram_counts(words: DataFrame, how: Limits) -> DataFrame:
    """(lang, size, entry, n) of the n-grams of counted words."""
    def run(batches):
        counts = Counter()
        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                for size in range(1, how.sizes + 1):
                    for g in n_grams(word, size):
                        counts[lang, g] += n
                if len(counts) > how.flush:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    def rows(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([len(k[1]) for k in counts], pa.int32()),
             pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["lang", "size", "entry", "n"])

    return (words.mapInArrow(run, "lang string, size int, entry string, n long")
            .groupBy("lang", "size", "entry").agg(F.sum("n").alias("n")))


def most_frequent(entries: DataFrame, words: int, grams: int) -> DataFrame:
    """The most frequent entries of each language and size, at most `words` and
    `grams` of them; of equal counts all or none."""
    each = entries.groupBy("lang", "size", "n").agg(F.count(F.lit(1)).alias("c"))
    # rows of distinct counts, far fewer than entries
    down = Window.partitionBy("lang", "size").orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0)
    most = F.when(F.col("size") == 0, words).otherwise(grams)
    least = (each.withColumn("so_far", F.sum("c").over(down)).where(F.col("so_far") <= most)
             .groupBy("lang", "size").agg(F.min("n").alias("least")))
    # a row for each language and size
    return entries.join(F.broadcast(least.withColumnsRenamed({"lang": "l", "size": "s"})),
                        (F.col("lang") == F.col("l")) & (F.col("size") == F.col("s")) & (F.col("n") >= F.col("least")))


def train(df: DataFrame, usable: Column, stages: Stages, how: Limits = Limits(), lang_col: str = "lang",
          text_col: str = "text") -> Model:
    """The model of all usable rows."""
    small_batches(df.sparkSession)
    words = stages.put("words", word_counts(df.where(usable), how, lang_col, text_col))
    shares = (words.groupBy("lang").agg(F.sum("n").alias("n"))
              .orderBy(F.col("n").desc(), "lang").limit(how.languages).collect())  # a row for each language
    if not shares:
        return Model([], np.zeros(0), [{} for _ in range(how.sizes + 1)], np.zeros(1, int), np.zeros(0, int), np.zeros(0), how.word_chars)
    # of more counted words first, which settles ties
    languages = [r.lang for r in shares]
    words = words.where(F.col("lang").isin(languages))
    entries = stages.put("entries", words.select("lang", F.lit(0).alias("size"), F.col("word").alias("entry"), "n")
                         .unionByName(gram_counts(words, how)))
    kept = most_frequent(entries, how.words // len(languages), how.grams // (how.sizes * len(languages)))
    kept = kept.select("lang", "size", "entry", "n").collect()  # at most words + grams rows
    total = Counter()
    for r in kept:
        total[r.lang, r["size"]] += r.n
    missing = [math.log(0.5 / max([total[lang, s] for lang in languages] + [1])) for s in range(how.sizes + 1)]
    places: list[dict[str, int]] = [{} for _ in range(how.sizes + 1)]
    number = {lang: i for i, lang in enumerate(languages)}
    kept.sort(key=lambda r: (r["size"], r.entry, number[r.lang]))
    starts = []
    for k, r in enumerate(kept):
        if places[r["size"]].setdefault(r.entry, len(starts)) == len(starts):
            starts.append(k)
    above = [math.log(r.n / total[r.lang, r["size"]]) - missing[r["size"]] for r in kept]
    n = np.array([r.n for r in shares], float)
    return Model(languages, np.log(n / n.sum()), places, np.array([*starts, len(kept)]),
                 np.array([number[r.lang] for r in kept], np.int64), np.array(above), how.word_chars)


class Scorer:
    """Scores words; those not in the model are kept for later texts."""

    def __init__(self, model: Model, cached: int = Limits.cached):
        self.model, self.cached = model, cached
        self.find = word_finder(model.word_chars)
        self.forget()

    def forget(self) -> None:
        self.unseen: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages)))

    def back_off(self, word: str) -> np.ndarray:
        """The score of an unseen word."""
        for size in range(len(self.model.places) - 1, 0, -1):
            known = self.model.places[size]
            found = [known[g] for g in n_grams(word, size) if g in known]
            if found:
                return sum(map(self.model.row, found)) / len(found)
        return np.zeros(len(self.model.languages))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sums [texts, languages], up to a term that is equal for all languages; number of words of each text)."""
        m, width = self.model, len(self.model.languages)
        if len(self.unseen) > min(self.cached, CELLS // width):
            self.forget()
        words = list(map(self.find, texts))
        n = np.fromiter(map(len, words), np.int64, len(words))
        every = list(chain.from_iterable(words))
        place = list(map(m.places[0].get, every, every))  # an unseen word stands for itself
        new = {w for w in place if type(w) is str}.difference(self.unseen)
        if new:
            base = len(m.edges) - 1 + len(self.rows)
            self.unseen.update(zip(new, range(base, base + len(new))))
            self.rows = np.concatenate([self.rows, [self.back_off(w) for w in new]])
        at = np.fromiter((self.unseen[w] if type(w) is str else w for w in place), np.int64, len(place))
        owner = np.repeat(np.arange(len(texts)), n)
        unseen = at >= len(m.edges) - 1
        lo = m.edges[at[~unseen]]
        size = m.edges[at[~unseen] + 1] - lo
        entry = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        out = np.bincount(np.repeat(owner[~unseen], size) * width + m.langs[entry], m.above[entry], len(texts) * width)
        out = out.reshape(len(texts), width).astype(float)
        rows, own = at[unseen] - (len(m.edges) - 1), owner[unseen]
        for k in range(width):
            out[:, k] += np.bincount(own, self.rows[rows, k], len(texts))
        return out + m.priors, n


def predict(df: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    """`df` without the text, with the predicted language and its probability;
    columns of these names in `df` are replaced."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by its limits
    key = f"language_{zlib.crc32(model.above.tobytes() + repr((model.languages, model.places)).encode())}"
    others = [c for c in df.columns if c not in (text_col, lang_out, score_out)]
    kept = df.select(F.struct(*others).alias("row"), F.col(text_col).alias("text"))
    schema = StructType([kept.schema["row"], StructField(lang_out, StringType()), StructField(score_out, DoubleType())])

    def run(batches):
        names = shared.value.languages
        scorer = per_worker(key, lambda: Scorer(shared.value)) if names else None
        for batch in batches:
            texts = batch.column("text")
            size = pa.compute.binary_length(texts).fill_null(0).to_pylist()
            at, total = 0, 0
            for i, n in enumerate(size):
                total += n
                if total >= 1_000_000 or i == len(size) - 1:
                    part = batch.slice(at, i + 1 - at)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row"), *judged(scorer, names, [t or "" for t in part.column("text").to_pylist()])],
                        names=["row", lang_out, score_out])
                    at, total = i + 1, 0

    def judged(scorer, names, texts):
        if scorer is None:
            return pa.array([UNKNOWN] * len(texts), pa.string()), pa.array([0.0] * len(texts), pa.float64())
        sums, n = scorer.score(texts)
        best = sums.argmax(axis=1)
        share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        return (pa.array([names[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())], pa.string()),
                pa.array(np.where(n > 0, share, 0.0), pa.float64()))

    return kept.mapInArrow(run, schema).select("row.*", lang_out, score_out)
