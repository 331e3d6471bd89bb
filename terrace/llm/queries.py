"""The registered query of each operator: production parameters, whole tables, digest columns of the contracts."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import alignment, chat, decontaminate, fingerprint, language_id, line_dedup, packing, prefix_trie, quality, secret_scan, simhash, substring_dedup, tokens
from terrace.llm.common import table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in secret_scan.KINDS[:3]],
        F.sha2(secret_scan.joined("spans", secret_scan.KINDS[:3]), 256).alias("base_sha256"),
        secret_scan.joined("spans", secret_scan.KINDS).alias("spans"), count("novel"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.fingerprints(table(spark, sf_dir, "documents"), keep=lambda edited: hashlib.sha256(edited.encode()).hexdigest(), parts=fingerprint.sentences)
    return found.withColumnRenamed("edited", "edited_sha256")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents")).drop("doc_key")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(chat.as_tool_use(table(spark, sf_dir, "conversations")), chat.SCHEMAS)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc_key")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = alignment.align(table(spark, sf_dir, "documents"), *paths, keep=lambda groups: F.sha2(groups, 256))
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans, op2_best_fit_packing, op3_document_fingerprints, op4_language_id, op5_substring_dedup, op6_token_counts,
        op7_chat_formatting, op8_benchmark_decontamination, op9_simhash_near_dedup, op10_quality_classifier,
        op11_line_dedup, op12_cross_tokenizer_alignment,
        op13_conversation_prefix_trie,
    )
}

_RUN, _LEAST = decontaminate.RUN, decontaminate.SIMILARITY

# The polynomial and the start of CRC-32.
_CRC32, _ONES = 0xEDB88320, 0xFFFFFFFF
_SQL_BLANKS = " || ".join(f"chr({ord(c)})" for c in line_dedup.BLANKS)


def _seed_sql(table: str, key: str) -> str:
    parts = [
        f"SELECT {key}, i AS at_, {n} AS mask, concat_ws(' ', {', '.join(f'w[i + {k + 1}]' for k in mask)}) AS seed "
        f"FROM (SELECT {key}, w, unnest(range(len(w) - {decontaminate.span(decontaminate.MASKS) - 1})) AS i FROM {table})"
        for n, mask in enumerate(decontaminate.MASKS)
    ]
    return " UNION ALL ".join(parts)


ORACLE = {
    "op7_chat_formatting": rf"""
        WITH RECURSIVE calls AS (
            SELECT conv_id, turn, coalesce(text, '') AS prompt, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r]+')) AS words,
                   0 AS start_depth FROM conversations WHERE role = 'user'),
        deep(conv_id, turn, depth) AS (
            SELECT conv_id, turn, 0 FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
            UNION ALL SELECT c.conv_id, c.turn, d.depth + 1 FROM deep d JOIN calls c ON c.conv_id = d.conv_id AND c.turn = d.turn + 2),
        told AS (
            SELECT m.conv_id, m.turn, m.role, m.text,
                   CASE m.role WHEN 'user' THEN 'call_' || m.conv_id || '_' || m.turn WHEN 'assistant' THEN 'call_' || m.conv_id || '_' || (m.turn - 1) END AS call_id,
                   CASE m.role WHEN 'user' THEN EXISTS (SELECT 1 FROM conversations r WHERE r.conv_id = m.conv_id AND r.turn = m.turn + 1 AND r.role = 'assistant')
                               WHEN 'assistant' THEN EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = m.conv_id AND c.turn = m.turn - 1) END AS linked,
                   d.depth, c.prompt, c.words
            FROM conversations m LEFT JOIN calls c ON m.role = 'user' AND c.conv_id = m.conv_id AND c.turn = m.turn
            LEFT JOIN deep d ON m.role = 'user' AND d.conv_id = m.conv_id AND d.turn = m.turn),
        judged AS (
            SELECT *, CASE WHEN role = 'user' THEN concat_ws(',', CASE WHEN prompt = '' THEN 'prompt: too short' END, CASE WHEN turn < 0 THEN 'turn: too small' END,
                                                             CASE WHEN words < 1 THEN 'words: too small' END,
                                                             CASE WHEN words > {chat.SCHEMAS[chat.REPLY]["properties"]["words"]["maximum"]} THEN 'words: too large' END)
                           WHEN role = 'assistant' AND NOT linked THEN 'call: none' ELSE '' END AS errors FROM told)
        SELECT conv_id, turn, role, call_id, linked, depth::BIGINT AS depth, turn AS order_turn, 0 AS order_step, errors = '' AS valid, errors,
               CASE role WHEN 'user' THEN '{{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":"user","tool_calls":[{{"arguments":{{"prompt":' || to_json(prompt)::VARCHAR
                                          || ',"turn":' || turn || ',"words":' || words || '}},"id":"' || call_id || '","name":"{chat.REPLY}"}}]}}'
                         WHEN 'assistant' THEN '{{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":"assistant","tool_call_id":"' || call_id || '"}}'
                         ELSE '{{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || to_json(role)::VARCHAR || '}}' END AS json
        FROM judged""",
    "op8_benchmark_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL),
        b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark WHERE text IS NOT NULL),
        ds AS ({_seed_sql("d", "doc_id")}),
        bs AS ({_seed_sql("b", "item_id")}),
        hits AS (SELECT DISTINCT ds.doc_id, bs.item_id, ds.at_ - bs.at_ AS diagonal FROM ds JOIN bs USING (mask, seed)),
        spots AS (
            SELECT hits.doc_id, hits.item_id, diagonal, least({_RUN}, len(b.w)) AS run, unnest(range(len(b.w))) AS j, d.w AS dw, b.w AS bw
            FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
        equal AS (SELECT doc_id, item_id, diagonal, run, j, len(bw) AS n,
                         (j + diagonal >= 0 AND j + diagonal < len(dw) AND bw[j + 1] = dw[j + diagonal + 1])::INT AS e FROM spots),
        runs AS (SELECT *, sum(e) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j ROWS BETWEEN CURRENT ROW AND {_RUN - 1} FOLLOWING) AS matched FROM equal),
        best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, j, j + diagonal) AS place_in,
                        row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, j + diagonal, j) AS place FROM runs
                 WHERE j <= n - run AND matched >= ceil({_LEAST} * run))
        SELECT doc_id, item_id, (j + diagonal)::INT AS doc_start, j::INT AS item_start, run::INT AS run, matched::INT AS matched FROM best WHERE place = 1""",
    "op11_line_dedup": rf"""
        WITH l AS (
            SELECT doc_id, at_, line, translate(trim(line, {_SQL_BLANKS}), '{line_dedup._UPPER}', '{line_dedup._UPPER.lower()}') AS key
            FROM (SELECT doc_id, unnest(w) AS line, unnest(range(len(w))) AS at_ FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents))),
        common AS (
            SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCUMENTS}),
        judged AS (SELECT l.*, common.keeper IS NOT NULL AND l.doc_id <> common.keeper AS gone FROM l LEFT JOIN common ON l.key = common.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY at_) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op13_conversation_prefix_trie": f"""
        WITH own AS (
            SELECT conv_id, list(struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS w
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        asked AS (
            SELECT conv_id, w, conv_id - (conv_id % {prefix_trie.FAMILY} + {prefix_trie.FAMILY}) % {prefix_trie.FAMILY} AS first_id,
                   xor(list_reduce(list_concat([{_ONES}::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                   lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * {_CRC32}))),
                       {_ONES}::BIGINT) % {prefix_trie.MOST_SHARED} AS h FROM own),
        told AS (SELECT a.conv_id, list_concat(coalesce(d.w[1:a.h], []), a.w[a.h + 1:]) AS w FROM asked a LEFT JOIN own d ON d.conv_id = a.first_id),
        heads AS (SELECT conv_id, length, depth, w[1:depth] AS node FROM (SELECT conv_id, len(w) AS length, unnest(range(len(w) + 1)) AS depth, w FROM told)),
        nodes AS (
            SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
            FROM heads GROUP BY node, depth),
        kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        costs AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(nodes.node[depth].said) ELSE 0 END AS cost
            FROM nodes LEFT JOIN kids USING (node)),
        sums AS (
            SELECT node[1:i] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(cost)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS i FROM costs) GROUP BY 1)
        SELECT c.conv_id, c.depth, up.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
        FROM costs c JOIN sums USING (node) LEFT JOIN nodes up ON c.depth > 0 AND up.node = c.node[1:c.depth - 1]""",
}
