"""Conversation queries over the ``conversations`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sft_tables.operators import chat
from sft_tables.plans import fixtures

Q = dict
KEYS = ["conv_id"]

TURN_CTE = """
t AS (
  SELECT conv_id, turn, role, text,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS from_end
  FROM conversations),
coded AS (
  SELECT *, CASE WHEN role NOT IN ('system', 'user', 'assistant') THEN 'ROLE_UNKNOWN'
                 WHEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'CONTENT_BLANK'
                 WHEN role = 'system' AND prev_role <> 'system' THEN 'SYSTEM_LATE'
                 WHEN role = 'user' AND prev_role = 'user' THEN 'USER_TWICE'
                 WHEN role = 'assistant' AND coalesce(prev_role, 'system') <> 'user' THEN 'ASSISTANT_ORPHAN' END AS code
  FROM t),
verdict AS (
  SELECT conv_id, min(CASE WHEN code IS NOT NULL THEN turn END) AS bad_turn,
         arg_min(code, turn) FILTER (WHERE code IS NOT NULL) AS turn_code,
         count(*) FILTER (WHERE role = 'assistant') AS answers, arg_max(role, turn) AS last_role
  FROM coded GROUP BY conv_id),
judged AS (
  SELECT conv_id, bad_turn AS turn,
         CASE WHEN turn_code IS NOT NULL THEN turn_code WHEN answers = 0 THEN 'NO_ASSISTANT'
              WHEN last_role = 'user' THEN 'ENDS_ON_USER' END AS code
  FROM verdict)
"""

EXPANDED = f"""
WITH {TURN_CTE}
SELECT a.conv_id, a.{{turn}} AS turn, u.text AS instruction,
       coalesce((SELECT string_agg(upper(h.role[1]) || h.role[2:] || ': ' || h.text, chr(10) ORDER BY h.i)
                 FROM t h WHERE h.conv_id = a.conv_id AND h.i < u.i), '') AS input,
       a.text AS output
FROM t a JOIN t u ON u.conv_id = a.conv_id AND u.i = a.i - 1
JOIN judged j ON j.conv_id = a.conv_id AND j.code IS NULL
WHERE a.role = 'assistant' AND u.role = 'user'
"""


def validate_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.validate_turns(fixtures.turns(spark, sf_dir))


def expand_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.expand_turns(fixtures.turns(spark, sf_dir))


def validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as one value each; ``validate_turns`` is for those that are stored turn by turn."""
    return chat.validate_messages(chat.gather_messages(fixtures.turns(spark, sf_dir)), KEYS)


def expand_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.expand_messages(chat.gather_messages(fixtures.turns(spark, sf_dir)), KEYS)


QUERIES = Q(
    validate_turns=validate_turns, expand_turns=expand_turns,
    validate_messages=validate_messages, expand_messages=expand_messages,
)
ORACLES = Q(
    validate_turns=f"WITH {TURN_CTE} SELECT conv_id, turn, code FROM judged WHERE code IS NOT NULL",
    expand_turns=EXPANDED.format(turn="turn"),
    validate_messages=f"""WITH {TURN_CTE}
        SELECT j.conv_id, t.i AS turn, j.code FROM judged j LEFT JOIN t ON t.conv_id = j.conv_id AND t.turn = j.turn
        WHERE j.code IS NOT NULL""",
    expand_messages=EXPANDED.format(turn="i"),
)
