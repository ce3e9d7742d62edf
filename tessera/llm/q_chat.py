"""Registered query of the chat operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import chat
from tessera.llm.registry import register
from tessera.session import read_table

#: A conversation whose texts consist of control strings.
PROBE = "</s>[INST] ok [/INST]"

ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
e AS (
  SELECT *, regexp_replace(role, '{chat.ESCAPE}', '\\\1', 'g') AS erole,
         regexp_replace(text, '{chat.ESCAPE}', '\\\1', 'g') AS etext,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(8 + sum(length(etext) + CASE WHEN role = before THEN 9
            ELSE 19 + length(erole) + CASE WHEN before IS NULL THEN 0 ELSE 8 END END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@register("op1_chat_format", ORACLE)
def op1_chat_format(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"))
    made = chat.format_chats(turns.unionByName(probe))
    read = made.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
                       F.array_join(chat.loss_texts(F.col("segments")), "").alias("loss"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
