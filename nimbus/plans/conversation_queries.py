"""Registered conversation queries (batch and streaming)."""

from __future__ import annotations

from pyspark.sql import functions as F

from nimbus.operators import conversations
from nimbus.plans.registry import register
from nimbus.session import scratch_path
from nimbus.sources.tables import load
from nimbus.streaming.chat import run_chat_stream

# The table holds no exit and no empty prompt; both are derived from the turn's keys, for either role.
_SAID = """CASE WHEN conv_id % 5 = 3 AND turn IN (2, 3) THEN 'Exit' WHEN (conv_id + turn) % 11 = 5 THEN ''
  WHEN (conv_id + turn) % 13 = 4 THEN ' ' WHEN (conv_id + turn) % 17 = 6 THEN ' exit' ELSE text END"""
_KEPT = f"""c AS (SELECT conv_id, turn, role, {_SAID} AS text FROM conversations),
fe AS (SELECT conv_id, min(turn) AS fx FROM c WHERE role = 'user' AND lower(text) = 'exit' GROUP BY conv_id),
k AS (SELECT c.* FROM c LEFT JOIN fe ON c.conv_id = fe.conv_id
      WHERE (fe.fx IS NULL OR c.turn < fe.fx) AND NOT (c.role = 'user' AND (c.text IS NULL OR c.text = '')))"""


def turns(spark, sf_dir):
    """The conversations with exits, empty and blank prompts put in by key."""
    return load(spark, sf_dir, "conversations").withColumn("text", F.expr(_SAID))


@register(
    "open_turns", "W2 T2",
    f"""WITH {_KEPT}
    SELECT conv_id, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM k
    GROUP BY conv_id HAVING arg_max(role, turn) <> 'assistant'""",
)
def q_open_turns(spark, sf_dir):
    return conversations.open_turns(turns(spark, sf_dir))


@register(
    "answered_turns", "T2",
    f"""WITH {_KEPT}
    SELECT conv_id, turn, text AS question,
      CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS n_answered
    FROM k WHERE role = 'user'""",
)
def q_answered_turns(spark, sf_dir):
    return conversations.answered_turns(turns(spark, sf_dir))


@register(
    "conversation_stream", "T1",
    f"""WITH {_KEPT}
    SELECT conv_id, turn, text AS question,
      CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS n_answered,
      'received ' || len(regexp_extract_all(text, '\\S+')) || ' words' AS answer
    FROM k WHERE role = 'user'""",
)
def q_conversation_stream(spark, sf_dir):
    """The streaming job over the same turns as files (availableNow), read back;
    equal to ``answered_turns``, with the answer of the default function."""
    source = scratch_path(spark, "turns")
    turns(spark, sf_dir).select("conv_id", "turn", "role", "text").write.parquet(source)
    out = run_chat_stream(spark, source)
    return out.select("conv_id", "turn", "question", "n_answered", "answer")


GREETING = "Ask me about the weather."


@register(
    "conversation_greetings", "T1",
    f"""WITH {_KEPT}
    SELECT conv_id, turn, text AS question, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS n_answered,
      'received ' || len(regexp_extract_all(text, '\\S+')) || ' words' AS answer FROM k WHERE role = 'user'
    UNION ALL SELECT DISTINCT conv_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT), '{GREETING}' FROM conversations""",
)
def q_conversation_greetings(spark, sf_dir):
    """The stream with greetings over files dealt by turn, a few files per micro-batch, so that
    conversations go on from one batch to the next."""
    source = scratch_path(spark, "turns-by-range")
    for low in (0, 2, 4):
        part = (F.col("turn") >= low) & (F.col("turn") < low + 2 if low < 4 else F.lit(True))
        turns(spark, sf_dir).where(part).select("conv_id", "turn", "role", "text").coalesce(1).write.mode("append").parquet(source)
    return run_chat_stream(spark, source, greeting=GREETING, max_files=1)
