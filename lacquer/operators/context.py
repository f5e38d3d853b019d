"""Rows brought to other rows: scopes, resumption, context blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacquer.operators.merge import first_rows


def in_scope(rows: DataFrame, scope: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in the scope."""
    return rows.join(scope.select(*on).distinct(), on, "left_semi")


def pending(rows: DataFrame, done: DataFrame, on: list[str], finished: Column) -> DataFrame:
    """Rows without a finished result."""
    return rows.join(done.where(finished).select(*on).distinct(), on, "left_anti")


def context_block(rows: DataFrame, keys: list[str], order: list[Column], most: int, line: Column, name: str = "block") -> DataFrame:
    """One text per key of the lines of its first rows."""
    picked = first_rows(rows.withColumn("_line", line), keys, order, most)
    return picked.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "_line"))), lambda x: x["_line"]), "\n").alias(name), F.count("*").alias("rows_in_block"))
