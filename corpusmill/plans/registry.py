"""Registry of named queries: a Spark builder and, where SQL can say the same
thing, the equivalent DuckDB SQL used as an independent oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    section: str


_REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, section: str = ""):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, section)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # import for side effects: every module registers its queries
    from corpusmill.plans import (  # noqa: F401
        q_text, q_tokens, q_scores, q_runlog, q_io, q_stream, q_bpe)

    return dict(_REGISTRY)
