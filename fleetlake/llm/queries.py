"""The registered queries of the training-data operators: thin, whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import (chat, decontamination, filter_audit, html_text, near_dedup, packing, quality_model, quality_rules, substring_dedup, token_counts, toxicity,
                           vector_codes, warc)
from fleetlake.llm.common import prepare, read_table
from fleetlake.session import shared_dir


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), k=4, percent=80)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_model.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    counts = token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), token_counts.lasting_cache(spark, sf_dir))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = warc.archived_pages(read_table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.conversation_digests(chat.format_conversations(conversations))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return vector_codes.vector_codes(read_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return filter_audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_text.main_text(read_table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_setsketch_near_dedup, op3_benchmark_decontamination, op4_substring_dedup, op5_quality_rules, op6_quality_classifier, op7_token_counts, op8_best_fit_packing, op9_warc, op10_chat_format,
                                  op11_vector_codes, op12_filter_audit, op13_html_extraction)}


_OP2_SQL = r"""
WITH RECURSIVE
    words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                 ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS shingles FROM words),
    one AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
    linked AS (SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
               GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT linked.y, reach.other FROM reach JOIN linked ON linked.x = reach.doc_id)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

_OP9_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size FROM pages),
     firsts AS (SELECT page_id, payload, size, min(page_id) OVER (PARTITION BY payload) AS response_id FROM payloads)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN size >= 100 AND page_id <> response_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 100 AND page_id <> response_id THEN response_id END AS refers_to
FROM firsts"""

_OP10_SQL = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
     rendered AS (SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS escaped FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       -- "### ", the role's name, ": ", the escaped text, " </turn>" and a line feed
       CAST(sum(4 + length(role) + 2 + length(escaped) + 9) AS BIGINT) AS formatted_chars,
       false AS rewrites_history
FROM rendered GROUP BY conv_id"""


def oracle_statements() -> dict[str, str]:
    """DuckDB SQL where SQL can say it; the other queries are held against brute force in ``tests/llm``."""
    return {"op2_setsketch_near_dedup": _OP2_SQL, "op9_warc": _OP9_SQL, "op10_chat_format": _OP10_SQL, "op12_filter_audit": filter_audit.SQL,
            "op11_vector_codes": vector_codes.SQL}
