"""Registered queries and, where SQL can say the same, their SQL form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# SQL pieces shared by several queries.
HASH = "('0x' || substr(md5({}), 1, 15))::BIGINT"
HASH_RANGE = "1152921504606846976.0"

PAIRS = """pairs AS (
  SELECT conv_id * 4294967296 + turn AS pair_id, conv_id, turn, text AS question, next_text AS answer
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

LABELLED = """labelled AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         list_filter([d.lang, d.source, CASE WHEN l.quality = 1 THEN 'quality' END,
                      CASE WHEN l.toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS terms
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"
