"""The queries opN_<name> and the SQL that DuckDB can check them with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontamination, language_id, near_dedup, nearest, source_mixing, suffix_dedup, token_counts, tool_calls, toxicity, url_filter
from tickloom.llm.common import table

BYTE_VOCAB = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCAB = public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


#: The calls that op2 reads from conversations: a user's turn asks, the assistant's next turn answers.
ASK = {"ask": {"type": "object", "required": ["text", "turn"], "additionalProperties": False, "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}}


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a message: user turns are calls of `ask`, assistant turns the results of the turn before."""
    turns = table(spark, sf_dir, "conversations")
    call, result = F.col("role") == "user", F.col("role") == "assistant"
    name = F.concat(F.lit("ask-"), (F.col("turn") - F.when(result, 1).otherwise(0)).cast("string"))
    messages = turns.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").alias("pos"),
        F.when(call, "call").when(result, "result").otherwise("message").alias("kind"),
        "role",
        F.when(call, "ask").alias("name"),
        F.when(call | result, name).alias("call_id"),
        F.when(call, F.to_json(F.struct("text", "turn"))).alias("arguments"),
        F.when(~call, F.col("text")).alias("content"),
        F.array().cast("array<string>").alias("depends_on"),
    )
    rows = tool_calls.format_chats(messages, ASK)
    return rows.select(F.col("conv").alias("conv_id"), F.col("pos").alias("turn"), "kind", "call_id", "linked", "anchor", "level", "valid", F.sha2("message", 256).alias("message_sha256"))


OP2_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
         CASE role WHEN 'user' THEN 'ask-' || turn WHEN 'assistant' THEN 'ask-' || (turn - 1) END AS call_id
  FROM conversations),
calls AS (SELECT conv_id, call_id, min(turn) AS pos FROM m WHERE kind = 'call' GROUP BY ALL),
results AS (SELECT DISTINCT conv_id, call_id FROM m WHERE kind = 'result')
SELECT m.conv_id, m.turn, m.kind, m.call_id,
       CASE m.kind WHEN 'call' THEN r.call_id IS NOT NULL WHEN 'result' THEN c.call_id IS NOT NULL ELSE false END AS linked,
       greatest(m.turn, coalesce(c.pos, m.turn)) AS anchor,
       CASE WHEN m.kind = 'result' AND c.call_id IS NOT NULL THEN 1 ELSE 0 END AS level,
       CASE m.kind WHEN 'call' THEN coalesce(length(text), 0) > 0 AND turn >= 0 WHEN 'result' THEN c.call_id IS NOT NULL ELSE true END AS valid,
       sha256(CASE m.kind
         WHEN 'call' THEN '{"role":' || to_json(role)::VARCHAR || ',"tool_call":{"arguments":{"text":' || to_json(text)::VARCHAR || ',"turn":' || turn || '},"id":' || to_json(m.call_id)::VARCHAR || ',"name":"ask"}}'
         WHEN 'result' THEN '{"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(role)::VARCHAR || ',"tool_call_id":' || to_json(m.call_id)::VARCHAR || '}'
         ELSE '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || '}' END) AS message_sha256
FROM m LEFT JOIN calls c ON m.conv_id = c.conv_id AND m.call_id = c.call_id LEFT JOIN results r ON m.conv_id = r.conv_id AND m.call_id = r.call_id
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of documents whose quality label is 0 are the bad ones; a page's path ends in its document's number."""
    pages = table(spark, sf_dir, "pages")
    number = F.expr(r"try_cast(regexp_extract(url, '/([0-9]{1,18})(\.html)?/?([?#]|$)', 1) AS bigint)")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).cast("int").alias("bad"))
    labelled = pages.select("page_id", number.alias("doc_id")).join(labels, "doc_id").select("page_id", "bad")
    return url_filter.judge(pages, labelled)


OP3_SQL = url_filter.judge_sql("pages", r"""(
    SELECT page_id, 1 - quality AS bad
    FROM (SELECT page_id, try_cast(regexp_extract(url, '/([0-9]{1,18})(\.html)?/?([?#]|$)', 1) AS BIGINT) AS doc_id FROM pages) JOIN labels USING (doc_id))""")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_VOCAB)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), PIECE_VOCAB)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '') || chr(31)), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (nth - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS bound
  FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS nth FROM totals)),
levels AS (
  SELECT *, bound / w AS need,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(bound) OVER before, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0)) AS level
  FROM weighed WINDOW before AS (ORDER BY bound / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT level AS lvl FROM levels WHERE level <= need ORDER BY need, nth LIMIT 1),
plan AS (
  SELECT source, source_size, target, floor(r)::BIGINT AS whole, r - floor(r) AS part, target - floor(r)::BIGINT * source_size AS wanted
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS r
        FROM (SELECT source, source_size, least(bound, coalesce((SELECT lvl FROM chosen), 'inf'::DOUBLE) * w) AS target FROM levels))),
ranked AS (
  SELECT s.doc_id, s.source, s.size, p.source_size, p.target, p.whole, p.part, p.wanted,
         CASE WHEN p.part > 0 THEN (s.u / (1 - s.u)) / (p.part / (1 - p.part)) END AS ratio
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
placed AS (
  SELECT *, ratio / (1 + ratio) AS rank FROM ranked),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank) AS upto, sum(size) OVER (PARTITION BY source, rank) AS own FROM placed)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rank IS NOT NULL AND (upto - own) * 2 + own <= wanted * 2 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_tool_calls": op2_tool_calls,
    "op3_url_filter": op3_url_filter,
    "op4_decontamination": op4_decontamination,
    "op5_token_counts": op5_token_counts,
    "op6_language_id": op6_language_id,
    "op7_source_mixing": op7_source_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_nearest": op9_nearest,
    "op10_near_dedup": op10_near_dedup,
}

ORACLE_SQL: dict[str, str] = {"op2_tool_calls": OP2_SQL, "op3_url_filter": OP3_SQL, "op7_source_mixing": OP7_SQL}
