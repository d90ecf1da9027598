"""Host-level quality rules in DataFrame functions only.

Every document gets counts and its own rule failures.  Failures are summed by
host and rule; each rate is shrunk towards the corpus by a beta prior fitted
to the hosts' own rates (method of moments), so that a host with few documents
is not judged by chance; a host whose shrunk rate for any rule passes that
rule's limit is rejected, and the verdict is joined back to its documents.

Null and empty texts have no words: all counts are 0 and the word rule fails.
A null host is a host like any other.  Repeated rows count as often as they
stand there; rows are returned one for one.  With no documents there is no
host and the result is empty.  Columns other than id, text and host are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import WS, Stages

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class HostRules:
    """Limits of the document rules, and for each rule the shrunk failure
    rate above which a host goes."""
    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols_per_100_words: int = 50
    max_dup_line_percent: int = 50
    host_limits: dict = field(default_factory=lambda: {
        "fail_words": 0.9, "fail_repeat": 0.5, "fail_symbols": 0.5, "fail_dup_lines": 0.5})


def count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`df` without the text, with n_words, word_chars, n_symbols, n_lines,
    n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_word = lambda x: x.rlike(f"[^{WS}]")
    split = df.withColumns({
        "_words": F.filter(F.split(text, f"[{WS}]+"), lambda x: x != ""),
        "_lines": F.filter(F.split(text, "\n"), has_word),
        "word_chars": F.char_length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": count_of(text, SYMBOLS).cast("long"),
    }).drop(text_col)
    n = F.size("_words")
    # a window of three words as one 64-bit hash with its place, sorted so that equal windows meet
    windows = split.withColumns({
        "n_words": n.cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_grams": F.when(n >= 4, F.sort_array(F.transform(
            F.slice(F.arrays_zip(F.col("_words").alias("a"),
                                 F.slice("_words", F.lit(2), n).alias("b"),
                                 F.slice("_words", F.lit(3), n).alias("c")), F.lit(1), F.greatest(n - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("p")))))
        .otherwise(F.expr("cast(array() as array<struct<h:bigint,p:int>>)")),
    }).drop("_words", "_lines")
    repeated = F.flatten(F.zip_with(
        "_grams", F.slice("_grams", F.lit(2), F.size("_grams")),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["p"], x["p"] + 1, x["p"] + 2, y["p"], y["p"] + 1, y["p"] + 2))
        .otherwise(F.array().cast("array<int>"))))
    return windows.withColumn("n_repeat_words", F.size(F.array_distinct(repeated)).cast("long")).drop("_grams")


def document_failures(counts: DataFrame, rules: HostRules) -> DataFrame:
    c = F.col
    return counts.withColumns({
        "fail_words": c("n_words") < rules.min_words,
        "fail_repeat": 100 * c("n_repeat_words") > rules.max_repeat_percent * c("n_words"),
        "fail_symbols": 100 * c("n_symbols") > rules.max_symbols_per_100_words * c("n_words"),
        "fail_dup_lines": 100 * c("n_dup_lines") > rules.max_dup_line_percent * c("n_lines"),
    })


def host_verdicts(failures: DataFrame, rules: HostRules, host_col: str = "host") -> DataFrame:
    """(host, n_docs, rate_<rule> shrunk, host_rejected), one row for each host."""
    names = list(rules.host_limits)
    hosts = failures.groupBy(host_col).agg(
        F.count(F.lit(1)).alias("n_docs"), *(F.sum(F.col(r).cast("long")).alias(r) for r in names))
    # the prior of each rule from the hosts' rates: mean, and variance beyond binomial noise
    moments = []
    for r in names:
        rate = F.col(r) / F.col("n_docs")
        moments += [(F.sum(r) / F.sum("n_docs")).alias(f"m_{r}"),
                    F.coalesce(F.var_samp(rate), F.lit(0.0)).alias(f"v_{r}"),
                    F.avg(1 / F.col("n_docs")).alias(f"i_{r}")]
    prior = hosts.agg(*moments).first().asDict()  # a single row of rates
    shrunk = hosts
    for r in names:
        mean, spread, per_host = (prior[f"{x}_{r}"] or 0.0 for x in "mvi")
        noise = mean * (1 - mean)
        between = max(spread - noise * per_host, noise * 0.001)
        strength = max(noise / between - 1, 1.0) if between > 0 else 1.0
        shrunk = shrunk.withColumn(f"rate_{r}", (F.col(r) + strength * mean) / (F.col("n_docs") + strength))
    rejected = F.lit(False)
    for r, limit in rules.host_limits.items():
        rejected = rejected | (F.col(f"rate_{r}") > limit)
    return shrunk.select(host_col, "n_docs", *(f"rate_{r}" for r in names), rejected.alias("host_rejected"))


def apply_rules(df: DataFrame, stages: Stages, rules: HostRules = HostRules(), id_col: str = "doc_id",
                text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts, rule failures, host verdict and `kept` for every row.  The
    texts are read once; the narrow counts are kept as a stage table."""
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(host_col).alias("host"))
    failures = stages.put("failures", document_failures(word_counts(narrow), rules))
    verdicts = host_verdicts(failures, rules).withColumnRenamed("host", "v_host")
    base = F.col("fail_words") | F.col("fail_repeat")
    return (failures.join(verdicts, F.col("host").eqNullSafe(F.col("v_host")), "left").drop("v_host")
            .withColumns({"base_failed": base, "kept": ~base & ~F.col("host_rejected")})
            .withColumnsRenamed({"id": id_col, "host": host_col}))
