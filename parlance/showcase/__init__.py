"""Registered queries: each operator on the test tables, with the equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def load_all() -> None:
    from parlance.showcase import (  # noqa: F401
        composing, encoding, evaluating, preparing, profiling, sampling, similarity, streaming,
    )


# SQL fragments shared by the oracles
DIALOGUES = """d AS (
  SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m FROM conversations GROUP BY conv_id
), s AS (
  SELECT conv_id, CASE WHEN m[1].role = 'system' THEN m[2:] ELSE m END AS b,
         CASE WHEN m[1].role = 'system' THEN m[1].content ELSE '' END AS sys FROM d
), v AS (
  SELECT *, len(b) % 2 = 0 AND list_bool_and(list_transform(b, lambda x, i: x.role = CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END)) IS NOT FALSE AS good FROM s
)"""


def md5_of(*parts: str) -> str:
    return "md5(concat_ws(':', " + ", ".join(parts) + "))"


def draw_of(*parts: str) -> str:
    return f"('0x' || substr({md5_of(*parts)}, 1, 8))::BIGINT"


def words_of(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> '')"


def hash_of(token: str) -> str:
    return f"('0x' || substr(md5({token}), 1, 7))::INTEGER"
