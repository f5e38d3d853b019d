"""Queries over the glossary: matching in texts, resolution, merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacquer.functions import text as t
from lacquer.operators import entities as en
from lacquer.operators.matching import name_hits, pick_entries, scored_entries, within_budget
from lacquer.operators.merge import evidence_rows
from lacquer.plans.duck import clean_list, trim
from lacquer.session import table

ENTRIES, TOKENS, PINNED = 12, 60, ["陆尘云", "秦坤清"]


def _named(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "glossary")
    return g.select("book_id", "canonical_id", F.explode(t.clean_list("names_zh")).alias("name")).distinct()


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return name_hits(table(spark, d, "chapters"), _named(spark, d), "book_id", "chunk_id", "source_chunk")


def glossary_block(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: for each chunk the entries of its book found in it, pinned ones first, within count and tokens."""
    named = _named(spark, d)
    picked = pick_entries(scored_entries(_hits(spark, d), named, ["book_id"], "chunk_id", "canonical_id", PINNED), "chunk_id", "canonical_id", ENTRIES)
    kept = within_budget(picked, ["chunk_id"], [F.col("place")], F.col("canonical_id"), TOKENS)
    return kept.groupBy("chunk_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "canonical_id"))), lambda x: x["canonical_id"]), "\n").alias("block"), F.sum("score").alias("score"))


def glossary_relevant(spark: SparkSession, d: str) -> DataFrame:
    """For each chunk the entries with the longest matching names."""
    scored = scored_entries(_hits(spark, d), _named(spark, d), ["book_id"], "chunk_id", "canonical_id", [])
    by_longest = scored.select("chunk_id", "canonical_id", F.col("longest").alias("score"), F.lit(False).alias("pinned"))
    picked = pick_entries(by_longest, "chunk_id", "canonical_id", ENTRIES)
    return picked.select("chunk_id", "canonical_id", F.col("score").cast("int").alias("score"), F.col("place").cast("int").alias("place"))


_MATCH = f"""
with names as (select distinct book_id, canonical_id, unnest({clean_list('names_zh')}) as name from glossary),
hits as (select c.chunk_id, n.canonical_id, n.name, (length(c.source_chunk) - length(replace(c.source_chunk, n.name, ''))) // length(n.name) as occ
  from chapters c join names n on c.book_id = n.book_id and contains(c.source_chunk, n.name)),
scored as (select chunk_id, canonical_id, sum(occ * length(name)) as score, max(length(name)) as longest, bool_or(name in ({", ".join(f"'{p}'" for p in PINNED)})) as pinned from hits group by 1, 2)
"""
_BLOCK = _MATCH + f""",
ranked as (select *, sum(pinned::int) over (partition by chunk_id) as pins, row_number() over (partition by chunk_id, pinned order by score desc, canonical_id) as rk from scored),
kept as (select *, row_number() over (partition by chunk_id order by pinned desc, case when pinned then 0 else -score end, canonical_id) as place from ranked where pinned or rk <= greatest({ENTRIES} - pins, 1)),
sized as (select *, sum(length(canonical_id) + 1) over (partition by chunk_id order by place rows unbounded preceding) - 1 as size from kept)
select chunk_id, string_agg(canonical_id, chr(10) order by place) as block, sum(score)::bigint as score from sized where (size + 2) // 3 <= {TOKENS} group by 1
"""
_RELEVANT = _MATCH + f""",
kept as (select chunk_id, canonical_id, longest as score, row_number() over (partition by chunk_id order by longest desc, canonical_id) as place from scored)
select chunk_id, canonical_id, score::int as score, place::int as place from kept where place <= {ENTRIES}
"""


def best_entity_by_name(spark: SparkSession, d: str) -> DataFrame:
    return en.best_by_name(table(spark, d, "glossary"), ["book_id"], "canonical_id", "names_zh", "evidences").select("book_id", "name", "best", F.col("quality").cast("int").alias("quality"))


_QUALITY = f"""
with q as (select book_id, canonical_id, sum(coalesce(len(list_filter(evidences, lambda e: {trim("coalesce(e.evidence, '')")} <> '')), 0)) as quality from glossary group by 1, 2),
n as (select distinct book_id, canonical_id, unnest({clean_list('names_zh')}) as name from glossary),
s as (select n.*, quality from n join q using (book_id, canonical_id)),
best as (select book_id, name, min({{'q': -quality, 'id': canonical_id}}) as b from s group by 1, 2)
"""
_BEST = _QUALITY + "select book_id, name, b.id as best, (-b.q)::int as quality from best"


def resolve_entities(spark: SparkSession, d: str) -> DataFrame:
    return en.resolve(table(spark, d, "glossary"), ["book_id"], "canonical_id", "names_zh", "evidences")


_TARGETS = _QUALITY + """,
top as (select n.book_id, n.canonical_id, min(b).id as target from n join best using (book_id, name) group by 1, 2),
targets as (select distinct g.book_id, g.canonical_id, coalesce(t.target, g.canonical_id) as target from glossary g left join top t using (book_id, canonical_id))
"""
_RESOLVE = _TARGETS + "select book_id, canonical_id, target from targets"


def merge_entities(spark: SparkSession, d: str) -> DataFrame:
    """The glossary with entries of one target merged."""
    g = table(spark, d, "glossary")
    targets = en.resolve(g, ["book_id"], "canonical_id", "names_zh", "evidences")
    merged = en.merge_entries(g.join(targets, ["book_id", "canonical_id"]), ["book_id", "target"], F.col("entry_no"))
    return merged.select(
        "book_id", "target", "kind", F.array_join("names_zh", "|").alias("names_zh"), F.array_join("names_vi", "|").alias("names_vi"), F.array_join("aliases.zh", "|").alias("alias_zh"),
        F.coalesce(F.array_join(F.transform("evidences", lambda e: F.concat_ws(":", e["source_file"], e["evidence"])), "|"), F.lit("")).alias("evidences"),
    )


def _union_sql(column: str, name: str) -> str:
    flat = f"(select book_id, target, entry_no, unnest(coalesce({column}, [])) as e, generate_subscripts(coalesce({column}, []), 1) as p from g)"
    once = f"(select book_id, target, {trim('e')} as e, min({{'o': entry_no, 'p': p}}) as at_pos from {flat} where {trim('coalesce(e, chr(32))')} <> '' group by 1, 2, 3)"
    return f"(select book_id, target, string_agg(e, '|' order by at_pos) as {name} from {once} group by 1, 2)"


_MERGE = _TARGETS + f""",
g as (select gl.*, t.target from glossary gl join targets t using (book_id, canonical_id)),
k as (select book_id, target, arg_min(kind, entry_no) filter (where {trim("coalesce(kind, '')")} <> '') as kind from g group by 1, 2),
ev as (select book_id, target, entry_no, unnest(evidences) as e, generate_subscripts(evidences, 1) as p from g),
ed as (select book_id, target, {trim("coalesce(e.source_file, '')")} as sf, {trim("coalesce(e.evidence, '')")} as tx, min({{'o': entry_no, 'p': p}}) as at_pos from ev where {trim("coalesce(e.evidence, '')")} <> '' group by 1, 2, 3, 4),
es as (select book_id, target, string_agg(sf || ':' || tx, '|' order by at_pos) as evidences from ed group by 1, 2)
select k.book_id, k.target, k.kind, coalesce(a.names_zh, '') as names_zh, coalesce(b.names_vi, '') as names_vi, coalesce(c.alias_zh, '') as alias_zh, coalesce(es.evidences, '') as evidences
from k left join {_union_sql('names_zh', 'names_zh')} a using (book_id, target) left join {_union_sql('names_vi', 'names_vi')} b using (book_id, target)
left join {_union_sql('aliases.zh', 'alias_zh')} c using (book_id, target) left join es using (book_id, target)
"""


def surface_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Ids for the objects answers bring, by the best known entry of their names."""
    c = table(spark, d, "chat_results").where("stage = 'terms' and content is not null")
    lines = c.select("result_id", "book_id", F.posexplode(t.split_nl("content")).alias("line_no", "line"))
    pairs = lines.select("result_id", "book_id", "line_no", t.trim_u(F.split("line", " = ")[0]).alias("zh")).where("zh <> ''")
    incoming = pairs.select(F.concat_ws("#", "result_id", "line_no").alias("row"), "book_id", F.array("zh").alias("names"), F.lit("").alias("model_id"))
    best = en.best_by_name(table(spark, d, "glossary"), ["book_id"], "canonical_id", "names_zh", "evidences")
    return en.incoming_ids(incoming, best, ["book_id"], "row", "names", "model_id").select("row", "entry_id")


_LOOKUP = _QUALITY + f""",
l as (select result_id, book_id, unnest(string_split(content, chr(10))) as line, generate_subscripts(string_split(content, chr(10)), 1) - 1 as line_no from chat_results where stage = 'terms' and content is not null),
p as (select result_id || '#' || line_no as row, book_id, {trim("string_split(line, ' = ')[1]")} as zh from l)
select p.row, coalesce(best.b.id, 'zh_' || substr(sha1(p.zh), 1, 10)) as entry_id from p left join best on best.book_id = p.book_id and best.name = p.zh where p.zh <> ''
"""


def evidence_dedupe(spark: SparkSession, d: str) -> DataFrame:
    rows = evidence_rows(table(spark, d, "glossary"), ["canonical_id"], "evidences", F.col("entry_no"), "evidence", [], need_file=False)
    return rows.select("canonical_id", "source_file", "evidence", F.col("_at._o").alias("first_entry"))


_DEDUPE = f"""
with e as (select canonical_id, entry_no, unnest(evidences) as e from glossary)
select canonical_id, {trim("coalesce(e.source_file, '')")} as source_file, {trim("coalesce(e.evidence, '')")} as evidence, min(entry_no) as first_entry from e where {trim("coalesce(e.evidence, '')")} <> '' group by 1, 2, 3
"""


def evidence_quality(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "glossary")
    filled = en.default_file(en.with_legacy_evidence("evidences", F.lit(" extra "), F.lit(None).cast("string")), F.lit("C000.txt"))
    return g.select("entry_no", en.quality("evidences").alias("quality"), F.size(filled).alias("with_extra"), F.size(F.filter(filled, lambda e: e["source_file"] == "C000.txt")).alias("defaulted"))


_EVIDENCE_QUALITY = f"""
select entry_no, coalesce(len(list_filter(evidences, lambda e: {trim("coalesce(e.evidence, '')")} <> '')), 0)::int as quality, (coalesce(len(evidences), 0) + 1)::int as with_extra,
  (coalesce(len(list_filter(evidences, lambda e: {trim("coalesce(e.source_file, '')")} in ('', 'C000.txt'))), 0) + 1)::int as defaulted from glossary
"""

QUERIES = {
    "glossary_block": glossary_block, "glossary_relevant": glossary_relevant, "best_entity_by_name": best_entity_by_name, "resolve_entities": resolve_entities, "merge_entities": merge_entities,
    "surface_lookup": surface_lookup, "evidence_dedupe": evidence_dedupe, "evidence_quality": evidence_quality,
}
SQL = {
    "glossary_block": _BLOCK, "glossary_relevant": _RELEVANT, "best_entity_by_name": _BEST, "resolve_entities": _RESOLVE, "merge_entities": _MERGE, "surface_lookup": _LOOKUP,
    "evidence_dedupe": _DEDUPE, "evidence_quality": _EVIDENCE_QUALITY,
}
