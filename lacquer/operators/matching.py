"""Dictionary names in texts: a containment join that is a hash join.

A name can only stand in a text that has its first two characters side by side.  Texts become
their distinct pairs of characters, joined with the first pair of the names (and the key both
sides share, such as the book); only those candidates are verified.  So the work follows the
texts and the hits, not texts times names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacquer.functions.text import estimate_tokens
from lacquer.session import spread


def beginnings(text: Column | str) -> Column:
    """What names in a text can begin with: its distinct characters and pairs of neighbouring ones."""
    # characters once, then neighbours by place: taking substrings would count from the start each time
    chars = F.split(F.col(text) if isinstance(text, str) else text, "")
    n = F.greatest(F.size(chars) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(chars, 1, n), F.slice(chars, 2, n), lambda a, b: F.concat(a, b))
    return F.array_distinct(F.concat(chars, pairs))


def occurrences(text: Column | str, name: Column | str) -> Column:
    """Non-overlapping occurrences of a name, counted from the left."""
    t = F.col(text) if isinstance(text, str) else text
    n = F.col(name) if isinstance(name, str) else name
    return ((F.length(t) - F.length(F.replace(t, n, F.lit("")))) / F.length(n)).cast("int")


def name_hits(texts: DataFrame, names: DataFrame, key: str, id_col: str, text_col: str, name_col: str = "name") -> DataFrame:
    """``(id, key, name, occ)`` for every text and every distinct name of its key that stands in it.

    Null and empty texts and names and null keys give nothing; each name counts once per text here.
    """
    texts = texts.where(F.col(key).isNotNull() & (F.col(text_col) != "")).select(F.col(id_col).alias("_id"), F.col(key).alias("_key"), F.col(text_col).alias("_text"))
    names = names.where(F.col(key).isNotNull() & (F.col(name_col) != "")).select(F.col(key).alias("_key"), F.col(name_col).alias("_name")).distinct()
    grams = spread(texts).select("_id", "_key", F.explode(beginnings("_text")).alias("_gram"))
    maybe = grams.join(names.withColumn("_gram", F.substring("_name", 1, 2)), ["_key", "_gram"]).select("_id", "_key", "_name")
    found = maybe.join(texts, ["_id", "_key"]).withColumn("occ", occurrences("_text", "_name")).where("occ > 0")
    return found.select(F.col("_id").alias(id_col), F.col("_key").alias(key), F.col("_name").alias(name_col), "occ")


def within_budget(rows: DataFrame, keys: list[str], order: list[Column], line: Column, most_tokens: int) -> DataFrame:
    """The leading rows whose lines, joined by line feeds, stay within a token estimate."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    size = F.sum(F.length(line) + 1).over(w) - 1
    return rows.withColumn("_size", size).where(((F.col("_size") + 2) / 3).cast("int") <= most_tokens).drop("_size")


def scored_entries(hits: DataFrame, entries: DataFrame, keys: list[str], id_col: str, entry: str, pinned: list[str]) -> DataFrame:
    """Entries found in each text with both scores: occurrences by length, and the longest name."""
    n = F.length("name")
    joined = hits.join(entries, [*keys, "name"])
    return joined.groupBy(id_col, *keys, entry).agg(
        F.sum(F.col("occ") * n).alias("score"), F.max(n).alias("longest"), F.max(F.col("name").isin(pinned) if pinned else F.lit(False)).alias("pinned")
    )


def pick_entries(scored: DataFrame, id_col: str, entry: str, most: int) -> DataFrame:
    """Pinned entries, then the best until ``most`` are reached; at least one unpinned one is taken."""
    w = Window.partitionBy(id_col)
    ranked = scored.withColumn("pins", F.sum(F.col("pinned").cast("int")).over(w)).withColumn("rank", F.row_number().over(Window.partitionBy(id_col, "pinned").orderBy(F.col("score").desc(), entry)))
    kept = ranked.where(F.col("pinned") | (F.col("rank") <= F.greatest(F.lit(most) - F.col("pins"), F.lit(1))))
    place = F.row_number().over(Window.partitionBy(id_col).orderBy(F.col("pinned").desc(), F.when(F.col("pinned"), F.lit(0)).otherwise(-F.col("score")), entry))
    return kept.withColumn("place", place)


__all__ = ["beginnings", "estimate_tokens", "name_hits", "occurrences", "pick_entries", "scored_entries", "within_budget"]
