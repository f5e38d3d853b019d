"""Entries of a glossary: quality, resolution by surface form, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacquer.functions.text import blank, clean_list, name_id, slug, trim_u
from lacquer.operators.merge import evidence_list, evidence_rows, first_filled, ordered_unions


def quality(evidences: Column | str) -> Column:
    """How many evidences have text."""
    e = F.col(evidences) if isinstance(evidences, str) else evidences
    return F.coalesce(F.size(F.filter(e, lambda x: ~blank(x["evidence"]))), F.lit(0))


def with_legacy_evidence(evidences: Column | str, text: Column | str, file: Column | str) -> Column:
    """The list of evidences with one kept in single fields at its end."""
    e = F.coalesce(F.col(evidences) if isinstance(evidences, str) else evidences, F.array().cast("array<struct<source_file:string,evidence:string>>"))
    t, f = (F.col(x) if isinstance(x, str) else x for x in (text, file))
    one = F.struct(trim_u(F.coalesce(f, F.lit(""))).alias("source_file"), trim_u(t).alias("evidence"))
    return F.when(~blank(t), F.concat(e, F.array(one))).otherwise(e)


def default_file(evidences: Column | str, file: Column | str) -> Column:
    """Evidences with a blank file replaced."""
    f = F.col(file) if isinstance(file, str) else file
    e = F.col(evidences) if isinstance(evidences, str) else evidences
    return F.transform(e, lambda x: F.struct(F.when(blank(x["source_file"]), f).otherwise(x["source_file"]).alias("source_file"), x["evidence"].alias("evidence")))


def entry_names(entries: DataFrame, scope: list[str], entry: str, names: str) -> DataFrame:
    """(scope, entry, name): distinct trimmed names."""
    return entries.select(*scope, entry, F.explode(clean_list(names)).alias("name")).distinct()


def entry_quality(entries: DataFrame, scope: list[str], entry: str, evidences: str) -> DataFrame:
    """One row per entry with its quality, over all its rows."""
    return entries.groupBy(*scope, entry).agg(F.sum(quality(evidences)).alias("quality"))


def best_by_name(entries: DataFrame, scope: list[str], entry: str, names: str, evidences: str) -> DataFrame:
    """For every name the entry of highest quality; of equals the smallest id."""
    scored = entry_names(entries, scope, entry, names).join(entry_quality(entries, scope, entry, evidences), [*scope, entry])
    return scored.groupBy(*scope, "name").agg(F.min(F.struct((-F.col("quality")).alias("q"), F.col(entry).alias("id"))).alias("_b")).select(*scope, "name", F.col("_b.id").alias("best"), (-F.col("_b.q")).alias("quality"))


def resolve(entries: DataFrame, scope: list[str], entry: str, names: str, evidences: str, iterations: int = 1) -> DataFrame:
    """``(scope, entry, target)``: each entry's best among the best entries of its names.

    One hop, as a single pass over the names goes; more ``iterations`` follow the targets on.
    An entry without names is its own target.
    """
    best = best_by_name(entries, scope, entry, names, evidences)
    own = entry_names(entries, scope, entry, names).join(best, [*scope, "name"])
    top = own.groupBy(*scope, entry).agg(F.min(F.struct((-F.col("quality")).alias("q"), F.col("best").alias("id"))).alias("_b")).select(*scope, entry, F.col("_b.id").alias("target"))
    out = entries.select(*scope, entry).distinct().join(top, [*scope, entry], "left").withColumn("target", F.coalesce("target", entry))
    for _ in range(iterations - 1):
        hop = out.select(*scope, F.col(entry).alias("target"), F.col("target").alias("_next"))
        out = out.join(hop, [*scope, "target"], "left").select(*scope, entry, F.coalesce("_next", "target").alias("target"))
    return out


def merge_entries(entries: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One entry per key: names and aliases united in order, evidences distinct, the first kind that is not blank."""
    rows = entries.withColumn("_order", order)
    out = rows.groupBy(*keys).agg(first_filled("kind", "_order").alias("kind"), F.count("*").alias("merged_rows"))
    lists = {"names_zh": F.col("names_zh"), "names_vi": F.col("names_vi"), "alias_zh": F.col("aliases.zh"), "alias_vi": F.col("aliases.vi")}
    out = out.join(ordered_unions(rows, keys, lists, F.col("_order")), keys, "left")
    for name in lists:
        out = out.withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    found = evidence_list(evidence_rows(rows, keys, "evidences", F.col("_order"), "evidence", [], need_file=False), keys, ["source_file", "evidence"])
    out = out.join(found, keys, "left")
    return out.withColumn("aliases", F.struct(F.col("alias_zh").alias("zh"), F.col("alias_vi").alias("vi"))).drop("alias_zh", "alias_vi")


def incoming_ids(incoming: DataFrame, known_best: DataFrame, scope: list[str], row: str, names: str, model_id: str) -> DataFrame:
    """The id an incoming object gets: the best known entry among its names, else its own id, else one made of its first name."""
    exploded = incoming.select(*scope, row, F.explode(clean_list(names)).alias("name")).join(known_best, [*scope, "name"])
    top = exploded.groupBy(*scope, row).agg(F.min(F.struct((-F.col("quality")).alias("q"), F.col("best").alias("id"))).alias("_b")).select(*scope, row, F.col("_b.id").alias("_known"))
    own = slug(model_id)
    made = name_id(F.try_element_at(clean_list(names), F.lit(1)))
    return incoming.join(top, [*scope, row], "left").withColumn("entry_id", F.coalesce("_known", F.when(own != "unknown", own).otherwise(made))).drop("_known")
