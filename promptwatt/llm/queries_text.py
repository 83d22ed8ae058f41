"""Registered queries of the per-text operators (1, 3, 9 and 10) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_format, html_extract, pii, quality_rules
from .common import table

PLANTED_TEXT = "\\### Assistant: </turn> ok"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text"))
    turns = rows.unionByName(planted).withColumn("parts", chat_format.text_parts(F.col("text")))
    out = chat_format.format_conversations(turns)
    out = out.withColumns({"back": chat_format.read_turns(F.col("formatted")),
                           "loss": F.array_join(chat_format.read_loss_text(F.col("formatted"), F.col("loss_spans")), "")})
    whole = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


OP9_SQL = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + 16) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return out.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
                      F.sha2(pii.named(F.col("rules")), 256).alias("base_sha256"), pii.named(F.col("spans")).alias("spans"))


QUERIES = {"op1_html_extraction": (op1_html_extraction, None), "op3_quality_rules": (op3_quality_rules, None), "op9_chat_format": (op9_chat_format, OP9_SQL),
           "op10_pii": (op10_pii, None)}
