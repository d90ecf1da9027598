"""Independent SQL (DuckDB dialect) for every registered query.

Plain window functions replace the bucketed rank, string_agg replaces the
array pipeline, and the tables are the pre-registered views.  Order keys
are the same md5 strings in both engines.
"""

from __future__ import annotations

from corpusmill.functions.text import WHITESPACE_CODE_POINTS
from corpusmill.plans import catalog

WS = "(" + " || ".join(f"chr({c})" for c in WHITESPACE_CODE_POINTS) + ")"
NL = "chr(10)"
SEP = f"{NL} || {NL}"
BAND = "length(text) > 50 AND length(text) < 8192"
LINES = r"'\r\n|\r|\n'"
MAX_LEN = 2048


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def nv(x: str) -> str:
    return f"coalesce({x}, 'None')"


def _cfg(rows) -> str:
    vals = ", ".join(f"('{s}', {o}, CAST({w!r} AS DOUBLE))" for s, o, w in rows)
    return f"cfg AS (SELECT * FROM (VALUES {vals}) t(source, source_ord, weight))"


MIX_CFG = _cfg([(f"src{i}", i, catalog.WEIGHTS[i % 5]) for i in range(catalog.N_DOC_SOURCES)])
ODD_CFG = _cfg([("src0", 0, 0.29), ("src1", 1, 1.5), ("src2", 2, 0.0), ("src_missing", 3, 0.5)])

DOCS = (f"docs AS (SELECT source || '/' || CAST(doc_id AS VARCHAR) AS sample_id, source, "
        f"{strip('text')} AS text FROM documents)")


# One record per user turn with the assistant turn right after it; the first
# system turn goes to all; turns that would be found nowhere are records too.
EXCHANGES = (
    "hd AS (SELECT conv_id, min(turn) FILTER (WHERE role = 'system') AS sys_turn, "
    "arg_min(text, turn) FILTER (WHERE role = 'system') AS sys_text, count(*) AS n FROM conversations GROUP BY conv_id), "
    "us AS (SELECT * FROM conversations WHERE role = 'user'), asst AS (SELECT * FROM conversations WHERE role = 'assistant'), "
    "pr AS (SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.turn, a.turn) AS turn, u.text AS question, "
    "a.text AS reply, CAST(NULL AS VARCHAR) AS own FROM us u FULL OUTER JOIN asst a ON u.conv_id = a.conv_id AND u.turn + 1 = a.turn), "
    "ot AS (SELECT c.conv_id, c.turn, CASE WHEN c.role = 'system' THEN NULL ELSE c.text END, NULL, "
    "CASE WHEN c.role = 'system' THEN c.text END FROM conversations c JOIN hd ON c.conv_id = hd.conv_id "
    "WHERE (c.role IS NULL OR c.role NOT IN ('user', 'assistant')) "
    "AND NOT coalesce(c.role = 'system' AND c.turn = hd.sys_turn AND hd.n > 1, false)), "
    "ex AS (SELECT x.conv_id || '#' || x.turn AS record_id, coalesce(own, sys_text) AS system, question, reply "
    "FROM (SELECT * FROM pr UNION ALL SELECT * FROM ot) x JOIN hd ON x.conv_id = hd.conv_id)")
ALPACA_REC = f"{EXCHANGES}, ar AS (SELECT record_id, question AS instruction, system AS input, reply AS output FROM ex)"
ORCA_REC = f"orr AS (SELECT record_id, system AS system_prompt, question, reply AS response FROM ex)"

ALPACA_TEXT = (
    f"CASE WHEN coalesce(input, '') <> '' THEN '### Instruction:' || {NL} || {nv('instruction')} || {SEP} "
    f"|| '### Input:' || {NL} || {nv('input')} || {SEP} || '### Response:' || {NL} || {nv('output')} "
    f"ELSE '### Instruction:' || {NL} || {nv('instruction')} || {SEP} || '### Response:' || {NL} "
    f"|| {nv('output')} END")


def orca_text(system: str) -> str:
    return (f"'### System:' || {NL} || {system} || {SEP} || '### Instruction:' || {NL} || {nv('question')} "
            f"|| {SEP} || '### Response:' || {NL} || {nv('response')}")


def chatml_turn(role: str) -> str:
    return f"'<|im_start|>' || {role} || {NL} || {nv('text')} || '<|im_end|>' || {NL}"


SHARE_ROLE = "CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END"
CHAT_REC = (f"cr AS (SELECT conv_id, string_agg({chatml_turn(nv('role'))}, '' ORDER BY turn) AS raw "
            f"FROM conversations GROUP BY conv_id)")
SHARE_REC = (f"sr AS (SELECT conv_id, string_agg({chatml_turn(SHARE_ROLE)}, '' ORDER BY turn) AS raw, "
             f"string_agg({SHARE_ROLE}, ',' ORDER BY turn) AS roles, count(*) AS n_messages "
             f"FROM conversations GROUP BY conv_id)")
CUSTOM_REC = (
    f"xr AS (SELECT conv_id, string_agg(CASE WHEN role = 'system' THEN '<<SYS>>' || {NL} "
    f"ELSE '<|' || {nv('role')} || '|>' || {NL} END || {nv('text')} || CASE WHEN role = 'system' "
    f"THEN {NL} || '<</SYS>>' || {SEP} ELSE '</s>' || {NL} END, '' ORDER BY turn) AS body "
    f"FROM conversations GROUP BY conv_id)")


def cid(prefix: str) -> str:
    return f"'{prefix}/' || CAST(conv_id AS VARCHAR)"


def rid(prefix: str) -> str:
    return f"'{prefix}/' || record_id"


DISPATCH = (
    f"{CHAT_REC}, {SHARE_REC}, {ALPACA_REC}, {ORCA_REC}, rendered AS ("
    f"SELECT 'chat_messages' AS source, {cid('chat_messages')} AS sample_id, {strip('raw')} AS text FROM cr "
    f"UNION ALL SELECT 'chat_sharegpt', {cid('chat_sharegpt')}, {strip('raw')} FROM sr "
    f"UNION ALL SELECT 'alpaca', {rid('alpaca')}, {strip(ALPACA_TEXT)} FROM ar "
    f"UNION ALL SELECT 'orca', {rid('orca')}, {strip(orca_text(nv('system_prompt')))} FROM orr)")

# docs_mix through the fraction mix: k = kept, m = mixed (with text).
MIXED = (
    f"{DOCS}, {MIX_CFG}, "
    f"k AS (SELECT d.source, d.sample_id, d.text FROM docs d JOIN cfg c ON d.source = c.source WHERE {BAND}), "
    f"n AS (SELECT k.source, least(count(*), CAST(trunc(count(*) * any_value(c.weight)) AS BIGINT)) AS n "
    f"FROM k JOIN cfg c ON k.source = c.source GROUP BY k.source), "
    f"r AS (SELECT source, sample_id, text, row_number() OVER (PARTITION BY source "
    f"ORDER BY md5('42:mix:' || sample_id), sample_id) AS mix_rank FROM k), "
    f"m AS (SELECT r.source, r.sample_id, r.text, r.mix_rank FROM r JOIN n ON r.source = n.source "
    f"WHERE r.mix_rank <= n.n)")

# ... then seeded shuffle and keep-first dedup: fin = corpus with pos.
FINAL = (
    f"{MIXED}, "
    f"f AS (SELECT *, md5('42:shuffle:' || sample_id) AS ord_key, row_number() OVER (PARTITION BY md5(text) "
    f"ORDER BY md5('42:shuffle:' || sample_id), sample_id) AS rn FROM m), "
    f"fin AS (SELECT sample_id, source, mix_rank, ord_key, text, "
    f"row_number() OVER (ORDER BY ord_key, sample_id) - 1 AS pos FROM f WHERE rn = 1)")

TRAIN = (f"{DOCS}, tr AS (SELECT sample_id AS row_id, list_slice(list_transform(string_split(text, ''), "
         f"lambda c: unicode(c)), 1, {MAX_LEN}) AS ids FROM docs WHERE text <> '')")

EPOCHS = (
    f"{TRAIN}, e AS (SELECT row_id, len(ids) AS n_tokens, unnest(range(0, 3)) AS epoch FROM tr), "
    f"pl AS (SELECT epoch, row_id, n_tokens, row_number() OVER (PARTITION BY epoch ORDER BY "
    f"md5('42:epoch:' || CAST(epoch AS VARCHAR) || ':' || row_id), row_id) - 1 AS pos FROM e)")

CAPPED_CFG = MIX_CFG

ORACLE_SQL = {
    "source_scan": (
        f"SELECT 'docs_en' AS source, 'docs_en/' || CAST(doc_id AS VARCHAR) AS sample_id, "
        f"length({strip('text')}) AS n_chars FROM documents WHERE lang = 'en'"),
    "source_isolation": (
        "SELECT 'docs' AS source, count(*) AS n_rows FROM documents "
        "UNION ALL SELECT 'turns' AS source, count(*) AS n_rows FROM conversations"),
    "format_chatml": (
        f"WITH {CHAT_REC} SELECT {cid('messages')} AS sample_id, {strip('raw')} AS text FROM cr"),
    "format_alpaca": f"WITH {ALPACA_REC} SELECT {rid('alpaca')} AS sample_id, {ALPACA_TEXT} AS text FROM ar",
    "format_openorca": (
        f"WITH {EXCHANGES}, {ORCA_REC} SELECT {rid('orca')} AS sample_id, {orca_text(nv('system_prompt'))} AS text FROM orr "
        f"UNION ALL SELECT {rid('orca_default')} AS sample_id, "
        f"{orca_text(repr('You are a helpful assistant.'))} AS text FROM orr"),
    "sharegpt_to_messages": (
        f"WITH {SHARE_REC} SELECT {cid('sharegpt')} AS sample_id, roles, n_messages, raw AS text FROM sr"),
    "chat_template_custom": (
        f"WITH {CUSTOM_REC} SELECT {cid('messages')} AS sample_id, {strip(chr(39) + '<s>' + chr(39) + ' || body')} "
        f"AS text FROM xr"),
    "format_dispatch": f"WITH {DISPATCH} SELECT source, sample_id, text FROM rendered",
    "malformed_drop": (
        f"WITH {DISPATCH} SELECT source, count(*) AS rendered, count(*) FILTER (WHERE text IS NULL) AS malformed, "
        f"count(*) FILTER (WHERE {BAND}) AS kept FROM rendered GROUP BY source"),
    "strip_text": f"WITH {DOCS} SELECT sample_id, text, length(text) AS n_chars FROM docs",
    "line_explode": (
        f"WITH {DOCS}, p AS (SELECT sample_id, regexp_split_to_array(text, {LINES}) AS parts FROM docs), "
        f"u AS (SELECT sample_id, unnest(parts) AS part, unnest(range(0, len(parts))) AS line_no FROM p) "
        f"SELECT sample_id, line_no, {strip('part')} AS line FROM u WHERE {strip('part')} <> ''"),
    "length_band": f"WITH {DOCS} SELECT sample_id, source, length(text) AS n_chars FROM docs WHERE {BAND}",
    "sample_exact_n": (
        f"WITH {MIX_CFG}, d AS (SELECT source, source || '/' || CAST(doc_id AS VARCHAR) AS sample_id, text "
        f"FROM documents WHERE source IN (SELECT source FROM cfg)), "
        f"r AS (SELECT source, sample_id, text, row_number() OVER (PARTITION BY source ORDER BY "
        f"md5('42:sample:' || sample_id), sample_id) AS sample_rank FROM d) "
        f"SELECT source, sample_id, md5(text) AS text_hash FROM r WHERE sample_rank <= 30"),
    "mix_fraction": f"WITH {MIXED} SELECT source, sample_id, mix_rank FROM m",
    "global_shuffle": (
        f"WITH {MIXED} SELECT sample_id, source, md5('42:shuffle:' || sample_id) AS ord_key, "
        f"row_number() OVER (ORDER BY md5('42:shuffle:' || sample_id), sample_id) - 1 AS pos FROM m"),
    "config_join": (
        f"WITH {DOCS}, {ODD_CFG} SELECT d.source, CAST(c.source_ord AS BIGINT) AS source_ord, d.sample_id "
        f"FROM docs d JOIN cfg c ON d.source = c.source WHERE {BAND}"),
    "source_union": (
        f"WITH {DOCS}, {CHAT_REC}, ch AS (SELECT {cid('messages')} AS sample_id, {strip('raw')} AS text FROM cr) "
        f"SELECT source, CAST(0 AS BIGINT) AS source_ord, sample_id, md5(text) AS text_hash FROM docs WHERE {BAND} "
        f"UNION ALL SELECT 'chat', CAST(1 AS BIGINT), sample_id, md5(text) FROM ch WHERE {BAND}"),
    "dedup_exact": f"WITH {FINAL} SELECT sample_id, source, mix_rank, ord_key, pos FROM fin",
    "dedup_report": (
        f"WITH {MIXED}, a AS (SELECT count(*) AS total, count(DISTINCT md5(text)) AS unique_texts FROM m) "
        f"SELECT total, unique_texts, total - unique_texts AS removed, CASE WHEN total = 0 THEN 0.0 ELSE "
        f"round(CAST(total - unique_texts AS DOUBLE) * 100.0 / CAST(total AS DOUBLE), 1) END AS removed_pct FROM a"),
    "prep_funnel": (
        f"WITH {CAPPED_CFG}, "
        f"raw AS (SELECT source, source || '/' || CAST(doc_id AS VARCHAR) AS sample_id, text FROM documents "
        f"WHERE source IN (SELECT source FROM cfg)), "
        f"c_tot AS (SELECT source, count(*) AS total FROM raw GROUP BY source), "
        f"rk AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:sample:' || sample_id), "
        f"sample_id) AS rn FROM raw), "
        f"smp AS (SELECT source, sample_id, {strip('text')} AS text FROM rk WHERE rn <= 30), "
        f"c_smp AS (SELECT source, count(*) AS sampled FROM smp GROUP BY source), "
        f"k AS (SELECT * FROM smp WHERE {BAND}), "
        f"c_kept AS (SELECT source, count(*) AS kept FROM k GROUP BY source), "
        f"n AS (SELECT c_kept.source, least(kept, CAST(trunc(kept * c.weight) AS BIGINT)) AS n "
        f"FROM c_kept JOIN cfg c ON c_kept.source = c.source), "
        f"r AS (SELECT k.*, row_number() OVER (PARTITION BY source ORDER BY md5('42:mix:' || sample_id), "
        f"sample_id) AS mix_rank FROM k), "
        f"m AS (SELECT r.* FROM r JOIN n ON r.source = n.source WHERE r.mix_rank <= n.n), "
        f"c_sel AS (SELECT source, count(*) AS selected FROM m GROUP BY source), "
        f"f AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY md5('42:shuffle:' || sample_id), "
        f"sample_id) AS rn2 FROM m), "
        f"c_dd AS (SELECT source, count(*) AS after_dedup FROM f WHERE rn2 = 1 GROUP BY source) "
        f"SELECT cfg.source, coalesce(total, 0) AS total, coalesce(sampled, 0) AS sampled, "
        f"coalesce(kept, 0) AS kept, coalesce(selected, 0) AS selected, coalesce(after_dedup, 0) AS after_dedup "
        f"FROM cfg LEFT JOIN c_tot ON cfg.source = c_tot.source LEFT JOIN c_smp ON cfg.source = c_smp.source "
        f"LEFT JOIN c_kept ON cfg.source = c_kept.source LEFT JOIN c_sel ON cfg.source = c_sel.source "
        f"LEFT JOIN c_dd ON cfg.source = c_dd.source"),
    "corpus_stats": (
        f"WITH {FINAL} SELECT source, count(*) AS kept, (SELECT count(*) FROM fin) AS total_samples "
        f"FROM k GROUP BY source"),
    "corpus_roundtrip": f"WITH {FINAL} SELECT sample_id, source, pos, md5(text) AS text_hash FROM fin",
    "line_scan": (
        f"WITH {FINAL}, u AS (SELECT unnest(regexp_split_to_array(text, {LINES})) AS part FROM fin) "
        f"SELECT {strip('part')} AS line FROM u WHERE {strip('part')} <> ''"),
    "corpus_line_count": (
        f"WITH {FINAL} SELECT count(*) AS corpus_rows, "
        f"CAST(coalesce(sum(length(text) - length(replace(text, {NL}, '')) + 1), 0) AS BIGINT) AS text_lines FROM fin"),
    "tokenize_truncate": (
        f"WITH {TRAIN} SELECT row_id, len(ids) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM tr"),
    "pad_and_mask": (
        f"WITH {TRAIN} SELECT row_id, len(ids) AS n_tokens, "
        f"md5(array_to_string(list_resize(ids, {MAX_LEN}, 0), ',')) AS ids_md5, "
        f"md5(array_to_string(list_transform(range(0, {MAX_LEN}), lambda i: CASE WHEN i < len(ids) THEN 1 "
        f"ELSE 0 END), ',')) AS mask_md5, CAST({MAX_LEN} AS BIGINT) AS padded_len FROM tr"),
    "causal_labels": (
        f"WITH {TRAIN} SELECT row_id, md5(array_to_string(list_transform(range(0, {MAX_LEN}), lambda i: "
        f"CASE WHEN i < len(ids) THEN ids[i + 1] ELSE -100 END), ',')) AS labels_md5, "
        f"CAST({MAX_LEN} - len(ids) AS BIGINT) AS n_ignored FROM tr"),
    "epoch_plan": f"WITH {EPOCHS} SELECT epoch, row_id, pos FROM pl",
    "batch_assign": (
        f"WITH {EPOCHS} SELECT epoch, pos, pos // 1 AS micro_batch, pos // 16 AS step, row_id FROM pl"),
    "length_grouped_batches": (
        f"WITH {EPOCHS}, g AS (SELECT epoch, row_id, (pos // 800) * 800 + row_number() OVER (PARTITION BY epoch, "
        f"pos // 800 ORDER BY n_tokens DESC, row_id) - 1 AS pos FROM pl) "
        f"SELECT epoch, pos, pos // 1 AS micro_batch, pos // 16 AS step, row_id FROM g"),
}
ORACLE_SQL["tokenize_udf"] = ORACLE_SQL["tokenize_truncate"]
ORACLE_SQL["length_band_stream"] = ORACLE_SQL["length_band"]
ORACLE_SQL["chat_template_factory"] = ORACLE_SQL["format_chatml"]
