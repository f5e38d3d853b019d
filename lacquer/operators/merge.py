"""Keyed merge of repeated rows under a policy for each field, without relying on row order.

Every policy orders rows by an explicit sequence column (or a struct of them), so a result does
not depend on partitions.  Aggregates combine on the map side; only list-valued fields gather
elements, and those are made distinct per key and element before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacquer.functions.text import blank, trim_u


def first_filled(value: Column | str, order: Column | str) -> Column:
    """The first value that is not blank."""
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    return F.min_by(v, F.when(~blank(v.cast("string")), o))


def last_value(value: Column | str, order: Column | str) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    return F.max_by(v, o)


def longest_text(value: Column | str, order: Column | str, trimmed: bool = False) -> Column:
    """The longest text; of equally long ones the first.  Null counts as empty."""
    v = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))
    v = trim_u(v) if trimmed else v
    o = F.col(order) if isinstance(order, str) else order
    # min over (-length, order): the order may be of any type that sorts
    return F.min_by(v, F.struct((-F.length(v)).alias("l"), o.alias("o")))


def last_row_wins(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; rows with a null key go."""
    kept = rows.where(F.expr(" and ".join(f"{k} is not null" for k in keys)))
    w = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return kept.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_rows(rows: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key, with ``rank`` from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def _elements(lists: dict[str, Column], order: Column) -> Column:
    """All elements of several lists in one array: (list, element, (order, place))."""

    def of(name: str, column: Column) -> Column:
        return F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda e, i: F.struct(F.lit(name).alias("of"), trim_u(F.coalesce(e, F.lit(""))).alias("e"), F.struct(order.alias("o"), i.alias("p")).alias("at")))

    parts = [of(name, column) for name, column in lists.items()]
    return F.filter(F.concat(*parts) if len(parts) > 1 else parts[0], lambda x: x["e"] != "")


def _gathered(flat: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One array ``<name>__at`` per list of its distinct elements (at, e), in order of first appearance, from rows (keys, of, e, at)."""
    once = flat.groupBy(*keys, "of", "e").agg(F.min("at").alias("at"))
    return once.groupBy(*keys).agg(*[F.array_sort(F.collect_list(F.when(F.col("of") == n, F.struct("at", "e")))).alias(f"{n}__at") for n in names])


def ordered_unions(rows: DataFrame, keys: list[str], lists: dict[str, Column], order: Column) -> DataFrame:
    """For each list column one list per key of its distinct elements, in order of first appearance.

    Elements are trimmed and blank ones go.  All lists are stacked, so however many there are, the
    rows are read once; distinct per key and element comes first, so the lists hold no repeats
    while they are gathered.  Keys without any element have no row.
    """
    flat = rows.select(*keys, F.explode(_elements(lists, order)).alias("_x")).select(*keys, "_x.of", "_x.e", "_x.at")
    return _gathered(flat, keys, list(lists)).select(*keys, *[F.transform(f"{n}__at", lambda x: x["e"]).alias(n) for n in lists])


def ordered_union(rows: DataFrame, keys: list[str], element: Column, order: Column, name: str) -> DataFrame:
    """``ordered_unions`` of one list."""
    return ordered_unions(rows, keys, {name: element}, order)


def evidence_rows(rows: DataFrame, keys: list[str], evidences: str, order: Column, text: str, extra: list[str], need_file: bool, fallback: str | None = None) -> DataFrame:
    """Distinct evidences per key: (keys, at, source_file, text, extras); the first non-blank extra fills later gaps.

    ``need_file``: an evidence without a file goes; else only one without text.  ``fallback`` is the
    field that stands in where the text is null (an empty text is a text and goes).
    """
    flat = rows.select(*keys, order.alias("_o"), F.posexplode(evidences).alias("_p", "_e"))
    flat = flat.select(
        *keys, F.struct("_o", "_p").alias("_at"), trim_u(F.coalesce(F.col("_e.source_file"), F.lit(""))).alias("source_file"),
        trim_u(F.coalesce(F.col(f"_e.{text}"), F.col(f"_e.{fallback}") if fallback else F.lit(""), F.lit(""))).alias(text), *[F.col(f"_e.{x}").alias(x) for x in extra],
    )
    flat = flat.where((F.col(text) != "") & ((F.col("source_file") != "") if need_file else F.lit(True)))
    return flat.groupBy(*keys, "source_file", text).agg(F.min("_at").alias("_at"), *[first_filled(x, "_at").alias(x) for x in extra])


def evidence_list(distinct: DataFrame, keys: list[str], fields: list[str], name: str = "evidences") -> DataFrame:
    """The lists of ``evidence_rows``, in order of first appearance."""
    got = distinct.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_at", *fields))).alias("_l"))
    return got.select(*keys, F.transform("_l", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name))


def fill_missing_map(rows: DataFrame, keys: list[str], facts: str, order: Column) -> DataFrame:
    """One map per key: for each entry the first value that is not blank, else the last blank one."""
    flat = rows.select(*keys, order.alias("_o"), F.explode(facts).alias("_k", "_v"))
    filled = flat.groupBy(*keys, "_k").agg(F.coalesce(first_filled("_v", "_o"), last_value("_v", "_o")).alias("_v"))
    return filled.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("_k").alias("key"), F.col("_v").alias("value"))))).alias(facts))


def merge_states(rows: DataFrame, keys: list[str], order: Column, policies: dict[str, str]) -> DataFrame:
    """Rows as the states ``combine_states`` merges: beside each column ``<column>__at``, the order of its value (of a list: its elements with theirs)."""
    lists = [c for c, p in policies.items() if p == "union"]
    columns = [*keys, order.alias("first_seen")]
    for c, p in policies.items():
        if p not in ("first", "last", "longest", "union"):
            raise ValueError(f"no policy {p}")
        if c not in lists:
            columns += [F.col(c), order.alias(f"{c}__at")]
    return rows.select(*columns, *[F.transform(_elements({c: F.col(c)}, order), lambda x: F.struct(x["at"].alias("at"), x["e"].alias("e"))).alias(f"{c}__at") for c in lists])


def combine_states(states: DataFrame, keys: list[str], policies: dict[str, str]) -> DataFrame:
    """One state per key.  Each value keeps the order it came with, so states may be combined in any order and grouping."""
    lists = [c for c, p in policies.items() if p == "union"]
    aggregates = []
    for c, p in policies.items():
        at = f"{c}__at"
        if p == "first":
            rank = F.when(~blank(F.col(c).cast("string")), F.col(at))
            aggregates += [F.min_by(c, rank).alias(c), F.min(rank).alias(at)]
        elif p == "last":
            aggregates += [F.max_by(c, at).alias(c), F.max(at).alias(at)]
        elif p == "longest":
            text = F.coalesce(c, F.lit(""))
            rank = F.struct((-F.length(text)).alias("l"), F.col(at).alias("o"))
            aggregates += [F.min_by(text, rank).alias(c), F.min_by(at, rank).alias(at)]
    out = states.groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), *aggregates)
    if lists:
        marked = lambda c: F.transform(f"{c}__at", lambda x: F.struct(F.lit(c).alias("of"), x["e"].alias("e"), x["at"].alias("at")))
        stacked = F.concat(*map(marked, lists)) if len(lists) > 1 else marked(lists[0])
        flat = states.select(*keys, F.explode(stacked).alias("_x")).select(*keys, "_x.of", "_x.e", "_x.at")
        right = _gathered(flat, keys, lists).select(*[F.col(k).alias(f"{k}__k") for k in keys], *[f"{c}__at" for c in lists])
        same = [F.col(k).eqNullSafe(F.col(f"{k}__k")) for k in keys]
        out = out.join(right, same, "left").drop(*[f"{k}__k" for k in keys])
        kinds = {c: states.schema[f"{c}__at"].dataType for c in lists}
        for c in lists:
            out = out.withColumn(f"{c}__at", F.coalesce(f"{c}__at", F.array().cast(kinds[c]))).withColumn(c, F.transform(f"{c}__at", lambda x: x["e"]))
    return out


def merge_by_key(rows: DataFrame, keys: list[str], order: Column, policies: dict[str, str]) -> DataFrame:
    """One row per key.  Policies: ``first`` (not blank), ``last``, ``longest``, ``union`` (of a list).

    A null key is a key; rows with equal order count as one place.  Applying it to its own result changes nothing.
    """
    return combine_states(merge_states(rows, keys, order, policies), keys, policies).select(*keys, "first_seen", *policies)
