"""Lines set side by side: leaks, positional pairs, patches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacquer.functions.text import blank, has_cjk, or_empty, split_nl


def leaking_lines(lines: DataFrame, keys: list[str], line: str, source: str, target: str) -> DataFrame:
    """Lines whose translation holds ideographs: (keys, line, source, target)."""
    return lines.where(has_cjk(target)).select(*keys, line, or_empty(source).alias(source), target)


def line_counts(lines: DataFrame, keys: list[str], line: str, source: str, target: str) -> DataFrame:
    """Per group the lines of both sides, whether their numbers differ, and how many leak."""
    return lines.groupBy(*keys).agg(
        F.countDistinct(F.when(F.col(source).isNotNull(), F.col(line))).alias("source_lines"),
        F.countDistinct(F.when(F.col(target).isNotNull(), F.col(line))).alias("target_lines"),
        F.countDistinct(F.when(has_cjk(target), F.col(line))).alias("leaking"),
    ).withColumn("mismatch", F.col("source_lines") != F.col("target_lines"))


def pair_by_position(texts: DataFrame, keys: list[str], source: str, target: str) -> DataFrame:
    """(keys, line, source, target): lines of two texts by position, a missing side empty."""
    zipped = F.arrays_zip(split_nl(or_empty(source)).alias("s"), split_nl(or_empty(target)).alias("t"))
    return texts.select(*keys, F.posexplode(zipped).alias("line", "_z")).select(*keys, "line", or_empty(F.col("_z.s")).alias(source), or_empty(F.col("_z.t")).alias(target))


def apply_patches(lines: DataFrame, patches: DataFrame, keys: list[str], line: str, target: str, order: str, fix: str, allowed: DataFrame | None = None) -> DataFrame:
    """Lines with the last patch of their place; patches for places that do not exist add lines.

    With ``allowed`` (keys, line) patches of all other places are left aside.
    """
    known = patches.where(F.col(fix).isNotNull() & F.col(line).isNotNull())
    if allowed is not None:
        known = known.join(allowed.select(*keys, line).distinct(), [*keys, line], "left_semi")
    last = known.groupBy(*keys, line).agg(F.max_by(fix, order).alias("_fix"))
    out = lines.join(last, [*keys, line], "full_outer")
    return out.withColumn("patched", F.col("_fix").isNotNull()).withColumn(target, F.coalesce("_fix", target)).drop("_fix")


def missing_translations(rows: DataFrame, source: str, target: str) -> DataFrame:
    """Rows whose source has text and whose target has none."""
    return rows.where(~blank(source) & blank(target))
