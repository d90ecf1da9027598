"""The registered queries of the operators: thin digests of their outputs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    alignment, bpe, classifier, language, lexical, line_dedup, mixing, multi_index, near_dedup, quality_rules, records, secrets,
    suffix_dedup,
)
from corpusmill.llm.common import Stages, table

#: The id appended to every document of the binary output.
END_ID = 2
#: Ids of the binary output's vocabulary, special token included.
RECORD_VOCABULARY = 50_257


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(coded, ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents"), Stages(spark, "suffixes"))
    return left.select(F.col("id").alias("doc_id"), "n_bytes",
                       (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       (F.size("edges") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), Stages(spark, "rules")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_runs(table(spark, sf_dir, "documents"), Stages(spark, "lines")).select(
        "doc_id", "n_chunks", "n_removed_chunks", "n_removed_lines", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("kept_sha256"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, Stages(spark, "index"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), Stages(spark, "near"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    return found.select(
        "doc_id", *(secrets.kind_count(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"))


def quality_model(spark: SparkSession, sf_dir: str) -> bytes:
    return classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                            usable=~classifier.held_out(F.col("doc_id")))


#: Documents with at least this score count as good.
MIN_QUALITY = 0.3


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classifier.score(docs, quality_model(spark, sf_dir))
    return scored.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= MIN_QUALITY).cast("int").alias("predicted"))


def op9_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write_records(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
        END_ID, RECORD_VOCABULARY, Stages(spark, "records"))
    return records.read_records(manifest).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draws(table(spark, sf_dir, "documents"), Stages(spark, "mix"))
    return drawn.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.size("copies")).alias("taken"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Stages(spark, "lexical"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language.train(docs, ~held_out, Stages(spark, "language"))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    scored = alignment.link_scores(aligned.withColumn("groups_sha256", digest), Stages(spark, "alignment"))
    return scored.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    "op1_bpe_roundtrip": op1_bpe_roundtrip,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_near_dedup": op6_near_dedup,
    "op7_secrets": op7_secrets,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_binary_records": op9_binary_records,
    "op10_mix_sources": op10_mix_sources,
    "op11_lexical_search": op11_lexical_search,
    "op12_language_id": op12_language_id,
    "op13_token_alignment": op13_token_alignment,
}

_OP3 = """
with w as (
  select doc_id, source, coalesce(text, '') as t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
grams as (
  select doc_id, i, words[i:i + 2] as g
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)),
covered as (
  select doc_id, count(distinct p) as n_repeat_words from (
    select doc_id, unnest([i, i + 1, i + 2]) as p
    from (select doc_id, i, count(*) over (partition by doc_id, g) as n from grams) where n > 1)
  group by doc_id),
c as (
  select w.doc_id, source, len(words)::bigint as n_words, len(lines) as n_lines,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from w left join covered on w.doc_id = covered.doc_id),
f as (
  select *, n_words < 50 as f1, 100 * n_repeat_words > 50 * n_words as f2,
         100 * n_symbols > 50 * n_words as f3, 100 * n_dup_lines > 50 * n_lines as f4 from c),
h as (
  select source, rule, count(*) as n, sum(fail::int) as k
  from (select source, unnest(['f1', 'f2', 'f3', 'f4']) as rule, unnest([f1, f2, f3, f4]) as fail from f)
  group by source, rule),
m as (
  select rule, sum(k) / sum(n) as mean, coalesce(var_samp(k / n), 0) as spread, avg(1 / n) as per_host from h group by rule),
p as (
  select rule, mean, mean * (1 - mean) as noise,
         greatest(spread - mean * (1 - mean) * per_host, mean * (1 - mean) * 0.001) as between_hosts from m),
s as (
  select rule, mean, case when between_hosts > 0 then greatest(noise / between_hosts - 1, 1) else 1 end as strength from p),
v as (
  select source, bool_or((k + strength * mean) / (n + strength) > case rule when 'f1' then 0.9 else 0.5 end) as rejected
  from h join s using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 or f2) as base_failed,
       not (f1 or f2) and not rejected as kept
from f join v on f.source is not distinct from v.source
"""

_OP11 = """
with d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents where text is not null),
q as (
  select item_id, term, count(*) as times
  from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
        from benchmark where text is not null)
  group by item_id, term),
n as (select doc_id, terms, len(terms)::bigint as n from d where len(terms) > 0),
s as (select count(*)::bigint as docs, sum(n)::bigint as total from n),
tf as (
  select doc_id, n, term, count(*)::bigint as tf
  from (select doc_id, n, unnest(terms) as term from n) where term in (select term from q) group by doc_id, n, term),
w as (
  select term, floor(1000 * ln((2.0::double * docs + 2) / (2.0::double * df + 1)))::bigint as w
  from (select term, count(*) as df from tf group by term), s),
c as (
  select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))) as c
  from tf join w using (term), s),
r as (select item_id, doc_id, sum(times * c)::bigint as score from q join c using (term) group by item_id, doc_id)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from r where score > 0)
where rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op3_quality_rules": _OP3, "op11_lexical_search": _OP11}
