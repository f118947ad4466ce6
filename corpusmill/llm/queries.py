"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import (q_align, q_backoff, q_chat, q_decontaminate, q_mixing, q_quality, q_setjoin, q_simhash, q_spelling, q_surrogates,
                            q_units, q_urlrules, q_warc)

_MODULES = (q_decontaminate, q_units, q_mixing, q_quality, q_urlrules, q_warc, q_chat, q_backoff, q_surrogates, q_setjoin,
            q_align, q_simhash, q_spelling)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
