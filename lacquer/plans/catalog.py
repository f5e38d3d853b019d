"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lacquer.plans import entry_queries, line_queries, store_queries, text_queries

_MODULES = (text_queries, line_queries, entry_queries, store_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in _MODULES for k, v in m.SQL.items()}
