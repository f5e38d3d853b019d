"""Queries over the stores: edges, events, scenes, facts; scopes and context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacquer.functions import text as t
from lacquer.operators.chunking import Budget
from lacquer.operators.context import context_block, in_scope, pending
from lacquer.operators.merge import evidence_list, evidence_rows, fill_missing_map, first_rows, last_row_wins, merge_by_key
from lacquer.plans.duck import blank, clean_list, trim
from lacquer.plans.pipeline import NO_BLOCK, Passes, backfill, backfill_requests, chunk_chars, entry_lines, extract_events, glossary_blocks, known_entries, repair_lines, repair_log, translate
from lacquer.plans.provider import StubProvider
from lacquer.plans.text_queries import HEADER_OUTCOMES, packed_sql
from lacquer.session import table
from lacquer.sources.jsonl import object_lines
from lacquer.sources.texts import header_status, header_summary

_EDGE_KEY = ["book_id", "edge_id"]


def _seen() -> Column:
    """The order of edges; what is seen at one time is told apart by its content."""
    return F.struct("seen_at", "relation_type", "summary_zh")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "relation_edges").where("edge_id is not null")


def upsert_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges merged by book and id: evidences united with gaps filled, summaries longest."""
    e = _edges(spark, d)
    rows = e.withColumn("summary_zh", t.trim_u("summary_zh")).withColumn("summary_vi", t.trim_u("summary_vi"))
    merged = merge_by_key(rows, _EDGE_KEY, _seen(), {"relation_type": "first", "summary_zh": "longest", "summary_vi": "longest"})
    found = evidence_list(evidence_rows(e, _EDGE_KEY, "evidences", _seen(), "evidence_zh", ["evidence_vi"], need_file=True), _EDGE_KEY, ["source_file", "evidence_zh", "evidence_vi"])
    out = merged.join(found, _EDGE_KEY, "left")
    text = F.array_join(F.transform("evidences", lambda x: F.concat_ws(":", x["source_file"], x["evidence_zh"], t.or_empty(x["evidence_vi"]))), "|")
    return out.select(*_EDGE_KEY, "relation_type", "summary_zh", "summary_vi", F.coalesce(text, F.lit("")).alias("evidences"))


_EVIDENCE = f"""
er as (select *, {{'s': seen_at, 'r': relation_type, 'z': summary_zh}} as o from relation_edges where edge_id is not null),
ev as (select book_id, edge_id, o, unnest(evidences) as e, generate_subscripts(evidences, 1) as p from er),
ef as (select book_id, edge_id, {{'o': o, 'p': p}} as o, {trim("coalesce(e.source_file, '')")} as source_file, {trim("coalesce(e.evidence_zh, '')")} as evidence_zh, e.evidence_vi as evidence_vi from ev),
ed as (select book_id, edge_id, source_file, evidence_zh, min(o) as o, arg_min(evidence_vi, o) filter (where {trim("coalesce(evidence_vi, '')")} <> '') as evidence_vi from ef where source_file <> '' and evidence_zh <> '' group by 1, 2, 3, 4)
"""
_UPSERT_EDGES = f"""
with {_EVIDENCE},
es as (select book_id, edge_id, string_agg(source_file || ':' || evidence_zh || ':' || coalesce(evidence_vi, ''), '|' order by o) as evidences from ed group by 1, 2),
r as (select *, {trim("coalesce(summary_zh, '')")} as z, {trim("coalesce(summary_vi, '')")} as v from er),
p as (select book_id, edge_id, arg_min(relation_type, o) filter (where not {blank('relation_type')}) as relation_type, arg_min(z, {{'l': -length(z), 'o': o}}) as summary_zh, arg_min(v, {{'l': -length(v), 'o': o}}) as summary_vi from r group by 1, 2)
select p.*, coalesce(es.evidences, '') as evidences from p left join es using (book_id, edge_id)
"""


def evidence_fill_missing(spark: SparkSession, d: str) -> DataFrame:
    return evidence_rows(_edges(spark, d), _EDGE_KEY, "evidences", _seen(), "evidence_zh", ["evidence_vi"], need_file=True).select("edge_id", "source_file", "evidence_zh", "evidence_vi")


def last_edges(spark: SparkSession, d: str) -> DataFrame:
    rows = last_row_wins(table(spark, d, "relation_edges"), ["book_id", "edge_id"], [F.col("seen_at"), F.col("relation_type"), F.col("summary_zh")])
    return rows.select("edge_id", "relation_type", "summary_zh", "seen_at")


def fill_missing_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts of an entity: for each kind of relation the first target that is not blank."""
    e = table(spark, d, "relation_edges").where("source_entity is not null and relation_type is not null")
    rows = e.select("source_entity", "seen_at", "edge_id", F.create_map(F.lower("relation_type"), F.when(F.col("target_entity") != "unknown", F.col("target_entity")).otherwise("")).alias("facts"))
    merged = fill_missing_map(rows, ["source_entity"], "facts", F.struct("seen_at", "edge_id"))
    return merged.select("source_entity", F.explode("facts").alias("fact", "value"))


_FACTS = """
with r as (select source_entity, lower(relation_type) as fact, case when target_entity <> 'unknown' then target_entity else '' end as value, {'s': seen_at, 'e': edge_id} as o from relation_edges where source_entity is not null and relation_type is not null)
select source_entity, fact, coalesce(arg_min(value, o) filter (where value <> ''), arg_max(value, o)) as value from r group by 1, 2
"""


def _objects(spark: SparkSession, d: str) -> DataFrame:
    """Objects of event answers, with their place; only those with a title."""
    c = table(spark, d, "chat_results").where("stage = 'timeline'")
    lines = c.select("result_id", "book_id", F.posexplode(object_lines("content", sanitise=False)).alias("line_no", "line"))
    o = F.from_json("line", "chapter_number int, event_title_zh string, event_summary_zh string, event_summary_vi string, entities array<string>")
    rows = lines.select("result_id", "book_id", "line_no", o.alias("o")).select("result_id", "book_id", "line_no", "o.*").where(~t.blank("event_title_zh"))
    return rows.withColumn("chapter_number", F.coalesce("chapter_number", F.lit(0)))


_OBJECTS = f"""
c as (select result_id, book_id, {trim("content")} as x from chat_results where stage = 'timeline' and content is not null),
u as (select result_id, book_id, case when starts_with(x, '```') then {trim("regexp_replace(regexp_replace(x, '^```[a-zA-Z0-9]*\\s*', ''), '\\s*```$', '')")} else x end as x from c),
l as (select result_id, book_id, unnest(string_split(x, chr(10))) as line, generate_subscripts(string_split(x, chr(10)), 1) - 1 as line_no from u),
j as (select result_id, book_id, line_no, {trim("line")} as line from l),
o as (select book_id, {{'r': result_id, 'l': line_no}} as o, json_extract_string(line, '$.event_title_zh') as title, json_extract_string(line, '$.event_summary_zh') as zh, json_extract_string(line, '$.event_summary_vi') as vi,
  coalesce(try_cast(json_extract_string(line, '$.chapter_number') as int), 0) as n, coalesce(json_extract_string(line, '$.entities[*]'), []::varchar[]) as ents from j where starts_with(line, '{{') and json_valid(line)),
e as (select *, list_filter(list_transform(ents, lambda x: {trim("coalesce(x, chr(32))")}), lambda x: x <> '') as es from o where {trim("coalesce(title, '')")} <> ''),
k as (select *, sha1(concat_ws('|', n::varchar, {trim("title")}, array_to_string(list_sort(list_distinct(es)), '|'))) as event_id, sha1(concat_ws('|', n::varchar, {trim("title")})) as scene_id from e)
"""


def _united(key: str) -> str:
    """The entities of the rows of a key, once each, in order of first appearance."""
    return f"""f_{key} as (select book_id, {key}, o, unnest(es) as x, generate_subscripts(es, 1) as i from k),
d_{key} as (select book_id, {key}, x, min({{'o': o, 'i': i}}) as w from f_{key} group by 1, 2, 3),
s_{key} as (select book_id, {key}, string_agg(x, '|' order by w) as entities from d_{key} group by 1, 2)"""


def upsert_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of answers merged by book and id: the longest summaries, the earlier of equal ones, entities united."""
    rows = _objects(spark, d).withColumn("event_id", t.event_id("chapter_number", "event_title_zh", "entities"))
    policies = {"chapter_number": "first", "event_summary_zh": "longest", "event_summary_vi": "longest", "entities": "union"}
    merged = merge_by_key(rows, ["book_id", "event_id"], F.struct("result_id", "line_no"), policies)
    return merged.select("book_id", "event_id", "chapter_number", "event_summary_zh", "event_summary_vi", F.array_join("entities", "|").alias("entities"))


_EVENTS = f"""
with {_OBJECTS}, {_united("event_id")},
p as (select book_id, event_id, arg_min(n, o) as chapter_number, arg_min(coalesce(zh, ''), {{'l': -length(coalesce(zh, '')), 'o': o}}) as event_summary_zh, arg_min(coalesce(vi, ''), {{'l': -length(coalesce(vi, '')), 'o': o}}) as event_summary_vi from k group by 1, 2)
select p.*, coalesce(s.entities, '') as entities from p left join s_event_id s on s.event_id = p.event_id and s.book_id is not distinct from p.book_id
"""


def upsert_scenes(spark: SparkSession, d: str) -> DataFrame:
    """Scenes merged by book, chapter and title: entities united in order, summaries longest."""
    rows = _objects(spark, d).withColumn("scene_id", t.scene_id("chapter_number", "event_title_zh")).withColumn("summary", t.trim_u(t.or_empty("event_summary_zh")))
    merged = merge_by_key(rows, ["book_id", "scene_id"], F.struct("result_id", "line_no"), {"summary": "longest", "entities": "union"})
    return merged.select("book_id", "scene_id", "summary", F.array_join("entities", "|").alias("entities"))


_SCENES = f"""
with {_OBJECTS}, {_united("scene_id")},
p as (select book_id, scene_id, arg_min(z, {{'l': -length(z), 'o': o}}) as summary from (select *, {trim("coalesce(zh, '')")} as z from k) group by 1, 2)
select p.*, coalesce(s.entities, '') as entities from p left join s_scene_id s on s.scene_id = p.scene_id and s.book_id is not distinct from p.book_id
"""


def first_k_edges(spark: SparkSession, d: str) -> DataFrame:
    rows = first_rows(table(spark, d, "relation_edges").where("book_id is not null"), ["book_id", "chapter_number"], [F.col("seen_at"), F.col("edge_id")], 8)
    return rows.select("book_id", "chapter_number", "edge_id", "seen_at", F.col("rank").cast("int").alias("rank"))


def chapter_context(spark: SparkSession, d: str) -> DataFrame:
    """For each chunk a block of the first edges of its book and chapter."""
    e = table(spark, d, "relation_edges")
    line = F.concat_ws(" ", "source_entity", F.lower("relation_type"), "target_entity")
    blocks = context_block(e.where("book_id is not null and chapter_number is not null"), ["book_id", "chapter_number"], [F.col("seen_at"), F.col("edge_id")], 10, line)
    c = table(spark, d, "chapters").where("chapter_number is not null").select("chunk_id", "book_id", "chapter_number")
    return c.join(blocks, ["book_id", "chapter_number"], "left").select("chunk_id", F.coalesce("block", F.lit("")).alias("block"), F.coalesce("rows_in_block", F.lit(0)).cast("int").alias("rows_in_block"))


_CONTEXT = """
with r as (select *, row_number() over (partition by book_id, chapter_number order by seen_at nulls first, edge_id nulls first) as rk from relation_edges where book_id is not null and chapter_number is not null),
b as (select book_id, chapter_number, string_agg(concat_ws(' ', source_entity, lower(relation_type), target_entity), chr(10) order by rk) as block, count(*) as n from r where rk <= 10 group by 1, 2)
select c.chunk_id, coalesce(b.block, '') as block, coalesce(b.n, 0)::int as rows_in_block from chapters c left join b using (book_id, chapter_number) where c.chapter_number is not null
"""


def facts_in_scope(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose source is a character of the glossary."""
    scope = table(spark, d, "glossary").where("kind = 'character'").select(F.col("canonical_id").alias("source_entity"))
    return in_scope(table(spark, d, "relation_edges"), scope, ["source_entity"]).select("edge_id", "seen_at", "source_entity")


def facts_in_chapter(spark: SparkSession, d: str) -> DataFrame:
    """Edges about an entity that another edge of the same chapter of the same book leads to."""
    edges = table(spark, d, "relation_edges").withColumn("chapter_number", F.coalesce("chapter_number", F.lit(0)))
    scope = edges.select("book_id", "chapter_number", F.col("target_entity").alias("source_entity"))
    return in_scope(edges, scope, ["book_id", "chapter_number", "source_entity"]).select("book_id", "chapter_number", "edge_id", "seen_at", "source_entity")


_IN_CHAPTER = """
select e.book_id, coalesce(e.chapter_number, 0) as chapter_number, e.edge_id, e.seen_at, e.source_entity from relation_edges e
where exists (select 1 from relation_edges s where s.book_id = e.book_id and coalesce(s.chapter_number, 0) = coalesce(e.chapter_number, 0) and s.target_entity = e.source_entity)
"""


def fact_blocks(spark: SparkSession, d: str) -> DataFrame:
    """For each chapter of each book the first of these edges."""
    rows = facts_in_chapter(spark, d)
    return context_block(rows, ["book_id", "chapter_number"], [F.col("seen_at"), F.col("edge_id")], 30, F.concat_ws(" ", "source_entity", "edge_id")).select("book_id", "chapter_number", "block", F.col("rows_in_block").cast("int").alias("rows_in_block"))


_FACT_BLOCKS = f"""
with f as ({_IN_CHAPTER}), r as (select *, row_number() over (partition by book_id, chapter_number order by seen_at nulls first, edge_id nulls first) as rk from f)
select book_id, chapter_number, string_agg(concat_ws(' ', source_entity, edge_id), chr(10) order by rk) as block, count(*)::int as rows_in_block from r where rk <= 30 group by 1, 2
"""


def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    """Chunks without a translation that has text."""
    done = table(spark, d, "chat_results")
    key = ["book_id", "source_file", "chunk_index"]
    return pending(table(spark, d, "chapters"), done, key, (F.col("stage") == "translate") & ~t.blank("content")).select("chunk_id")


def quality_violations(spark: SparkSession, d: str) -> DataFrame:
    """Edges that break a rule of the schema: unknown ends, mixed case, long or unsourced evidence."""
    e = table(spark, d, "relation_edges")
    known = table(spark, d, "glossary").select(F.col("canonical_id").alias("k")).distinct()
    checks = e.join(known, e.source_entity == known.k, "left").withColumn("no_source", F.col("k").isNull()).drop("k").join(known, F.col("target_entity") == known.k, "left").withColumn("no_target", F.col("k").isNull())
    bad = F.filter("evidences", lambda x: (F.length(x["evidence_zh"]) > 220) | t.blank(x["source_file"]))
    return checks.select("edge_id", "seen_at", "no_source", "no_target", (F.lower("relation_type") != F.col("relation_type")).alias("mixed_case"), F.coalesce(F.size(bad), F.lit(0)).alias("bad_evidences")).where(
        "no_source or no_target or mixed_case or bad_evidences > 0"
    )


_QUALITY = f"""
with k as (select distinct canonical_id from glossary),
c as (select edge_id, seen_at, source_entity not in (select canonical_id from k where canonical_id is not null) as no_source, target_entity not in (select canonical_id from k where canonical_id is not null) as no_target,
  lower(relation_type) <> relation_type as mixed_case, coalesce(len(list_filter(evidences, lambda x: length(x.evidence_zh) > 220 or {trim("coalesce(x.source_file, '')")} = '')), 0)::int as bad_evidences from relation_edges)
select * from c where no_source or no_target or mixed_case or bad_evidences > 0
"""


def run_status_counts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chat_results")
    status = F.when(t.blank("content"), "empty").when(F.lower(t.or_empty("finish_reason")).isin("length", "max_tokens"), "cut").when(F.lower(t.or_empty("finish_reason")) == "error", "error").otherwise("done")
    return c.groupBy("stage", status.alias("status")).agg(F.count("*").alias("results"), F.countDistinct("request_hash").alias("requests"))


def answer_cache(spark: SparkSession, d: str) -> DataFrame:
    """The newest answer with text of each request."""
    rows = last_row_wins(table(spark, d, "chat_results").where(~t.blank("content")), ["request_hash"], [F.col("created_at"), F.col("result_id")])
    return rows.select("request_hash", "result_id")


def missing_requests(spark: SparkSession, d: str) -> DataFrame:
    """The distinct texts a back-fill of summaries has to ask for, and how many rows each serves."""
    wanted = backfill_requests(_edges(spark, d), ["edge_id", "seen_at"], [("summary_zh", "summary_vi")])
    return wanted.groupBy("field", "text").agg(F.count("*").alias("rows_served"))


def rejected_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers without any object, with their raw text cut for the reject file."""
    c = table(spark, d, "chat_results").where("stage in ('glossary', 'timeline') and content is not null")
    return c.where(F.size(object_lines("content", sanitise=False)) == 0).select("result_id", "source_file", "chunk_index", "finish_reason", F.substring("content", 1, 4000).alias("raw"))


_REJECTS = f"""
with c as (select *, {trim("content")} as x from chat_results where stage in ('glossary', 'timeline') and content is not null),
u as (select *, case when starts_with(x, '```') then {trim("regexp_replace(regexp_replace(x, '^```[a-zA-Z0-9]*\\s*', ''), '\\s*```$', '')")} else x end as y from c)
select result_id, source_file, chunk_index, finish_reason, substr(content, 1, 4000) as raw from u
where len(list_filter(list_transform(string_split(y, chr(10)), lambda l: {trim("l")}), lambda l: starts_with(l, '{{') and json_valid(l))) = 0
"""


def stub_events(spark: SparkSession, d: str) -> DataFrame:
    """The event pass from chunks to merged events, with the stand-in provider."""
    events = extract_events(table(spark, d, "chapters"), table(spark, d, "glossary"), Passes(provider=StubProvider("jsonl")))
    return events.select("book_id", "event_id", "chapter_number", "event_title_zh", "event_summary_zh", F.array_join("entities", "|").alias("entities"))


#: What the stand-in sees of a prompt: all behind the last rule.
_BODY = r"regexp_replace(chr(10) || '---' || chr(10) || chunk, '^.*\n---\n', '', 's')"
_STUB_EVENTS = f"""
with {packed_sql(dict(Budget().caps)["timeline"])},
m as (select c.book_id, coalesce(c.chapter_number, 0) as n, substr(sha1({_BODY}), 1, 8) as mark from numbered join chapters c using (chunk_id))
select distinct book_id, sha1(concat_ws('|', n::varchar, mark, substr(mark, 1, 4))) as event_id, n as chapter_number, mark as event_title_zh, mark || mark as event_summary_zh, substr(mark, 1, 4) as entities from m
"""


def stub_translation(spark: SparkSession, d: str) -> DataFrame:
    """The translation pass from chunks to texts, checked and repaired, with the stand-in provider."""
    return translate(table(spark, d, "chapters"), table(spark, d, "glossary"), Passes(provider=StubProvider("translate"), repairs=1), StubProvider("validate"))


_BREAKS = r"'\r\n|[\n\x{b}\f\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]'"


def _lines(x: str) -> str:
    """The lines of a text, without the empty piece behind the last break."""
    parts = f"regexp_split_to_array({x}, {_BREAKS})"
    return f"list_filter({parts}, lambda e, i: e <> '' or i < len({parts}))"


_FIRST_SOURCE_LINE = f"coalesce(({_lines('source_chunk')})[1], '')"
_SOURCE_SUFFIX = trim(rf"regexp_extract({trim(_FIRST_SOURCE_LINE)}, '(?i)(\|\s*SourceFile:.*)$', 1)")
_STUB_TRANSLATION = rf"""
with {packed_sql(chunk_chars(Passes(), "translate", True))},
v as (select chunk_id, chunk_no, {trim(f"substr('[' || substr(sha1({_BODY}), 1, 8) || '] ' || {_BODY}, 1, {3 * Passes().completion})")} as vi from numbered),
l as (select *, {_lines("vi")} as parts from v),
r as (select chunk_id, chunk_no, array_to_string(list_transform(parts, lambda e, i: case when regexp_matches(e, '[\x{{4e00}}-\x{{9fff}}]') then 'line ' || (i - 1) else e end), chr(10)) as text from l),
t as (select chunk_id, string_agg(text, chr(10) order by chunk_no) as body from r group by 1),
s as (select chunk_id, body, {_lines("body")} as lines, {_SOURCE_SUFFIX} as suffix from t join chapters using (chunk_id))
select chunk_id, case when suffix <> '' and len(lines) > 0 and not regexp_matches(lines[1], '(?i)\|\s*SourceFile:')
    then array_to_string(list_prepend(regexp_replace(lines[1], '[\s\x{{3000}}\x{{a0}}]+$', '') || ' ' || suffix, lines[2:]), chr(10)) else body end as text, 0::bigint as unresolved, 0::bigint as failed from s
"""


def stub_rehearsal(spark: SparkSession, d: str) -> DataFrame:
    """The translation pass without any request, the header kept apart: the beginnings of its chunks."""
    plan = translate(table(spark, d, "chapters"), table(spark, d, "glossary"), Passes(chunk_chars=2000, dry_run=True, translate_header=False))
    return plan.select("chunk_id", "text")


_REHEARSAL = rf"""
with h as (select chunk_id, source_chunk, regexp_split_to_array(source_chunk, '\r\n|[\n\x{{b}}\f\r\x{{1c}}-\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]')[1] as l from chapters where source_chunk is not null),
s as (select chunk_id, case when starts_with({trim("coalesce(l, '')")}, 'Chapter ') then l else '' end as header, source_chunk from h),
chapters as (select chunk_id, header, case when header <> '' then regexp_replace(array_to_string(string_split(source_chunk, chr(10))[2:], chr(10)), '^\n+', '') else source_chunk end as source_chunk from s),
{packed_sql(2000)},
t as (select chunk_id, string_agg('[DRY-RUN]' || substr(chunk, 1, 40) || '...', chr(10) || chr(10) order by chunk_no) as body from numbered group by 1)
select chunk_id, case when header <> '' then header || chr(10) || chr(10) || body else body end as text from t join chapters using (chunk_id)
"""


def line_repairs(spark: SparkSession, d: str) -> DataFrame:
    """Bilingual chunks whose lines hold ideographs, repaired by a stand-in that answers with objects."""
    c = table(spark, d, "chunk_lines").groupBy("pair_id", "line").agg(F.min("zh").alias("zh"), F.min("vi").alias("vi"))
    side = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", t.or_empty(name).alias("x")))), lambda v: v["x"]), "\n").alias(name)
    done = c.groupBy("pair_id").agg(side("zh"), side("vi")).select(F.col("pair_id").alias("chunk_id"), F.lit(0).alias("chunk_no"), F.col("zh").alias("chunk"), F.lit(NO_BLOCK).alias("block"), "vi")
    fixed = repair_lines(done, Passes(provider=StubProvider("fix"), repairs=2))
    return fixed.select(F.col("chunk_id").alias("pair_id"), "line", "vi")


_LINE_REPAIRS = r"""
with c as (select pair_id, line, coalesce(min(zh), '') as zh, coalesce(min(vi), '') as vi from chunk_lines group by 1, 2),
b as (select *, row_number() over (partition by pair_id order by line) - 1 as at_line from c),
n as (select pair_id, count(*) - (arg_max(zh, line) = '')::int as zh_lines, count(*) - (arg_max(vi, line) = '')::int as vi_lines from c group by 1)
select pair_id, at_line::int as line, case when at_line >= vi_lines then null when regexp_matches(vi, '[\x{4e00}-\x{9fff}]') then 'line ' || at_line else vi end as vi
from b join n using (pair_id) where at_line < greatest(zh_lines, vi_lines)
"""


def prompt_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The block of names as the passes put it into prompts: up to 40 entries as JSON lines, within 1,200 tokens."""
    how = Passes()
    return glossary_blocks(table(spark, d, "chapters"), table(spark, d, "glossary"), "book_id", "chunk_id", "source_chunk", how.glossary_entries, how.glossary_tokens)


_PROMPT_BLOCKS = f"""
with names as (select distinct book_id, canonical_id, unnest({clean_list('names_zh')}) as name from glossary),
lines as (select book_id, canonical_id, min('{{' || concat_ws(',', '"canonical_id":' || to_json(canonical_id), '"kind":' || to_json(kind), '"names_zh":' || to_json(names_zh), '"names_vi":' || to_json(names_vi)) || '}}') as line from glossary group by 1, 2),
hits as (select c.chunk_id, c.book_id, n.canonical_id, n.name, (length(c.source_chunk) - length(replace(c.source_chunk, n.name, ''))) // length(n.name) as occ
  from chapters c join names n on c.book_id = n.book_id and contains(c.source_chunk, n.name)),
scored as (select chunk_id, book_id, canonical_id, sum(occ * length(name)) as score from hits group by 1, 2, 3),
kept as (select *, row_number() over (partition by chunk_id order by score desc, canonical_id) as place from scored),
sized as (select k.chunk_id, place, line, sum(length(line) + 1) over (partition by k.chunk_id order by place rows unbounded preceding) - 1 as size from kept k join lines using (book_id, canonical_id) where place <= 40)
select chunk_id, string_agg(line, chr(10) order by place) as glossary_block from sized where (size + 2) // 3 <= 1200 group by 1
"""


def known_entry_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The block of the pass that looks for new entries: up to 25 entries with the longest names found, within 900 tokens."""
    return known_entries(table(spark, d, "chapters"), table(spark, d, "glossary"), Passes())


_KNOWN_BLOCKS = _PROMPT_BLOCKS.replace("sum(occ * length(name)) as score", "max(length(name)) as score").replace("place <= 40", "place <= 25").replace("<= 1200", "<= 900")


def glossary_lines(spark: SparkSession, d: str) -> DataFrame:
    return entry_lines(table(spark, d, "glossary"), "book_id")


_GLOSSARY_LINES = """
select book_id, canonical_id, min('{' || concat_ws(',', '"canonical_id":' || to_json(canonical_id), '"kind":' || to_json(kind), '"names_zh":' || to_json(names_zh), '"names_vi":' || to_json(names_vi)) || '}') as line from glossary group by 1, 2
"""


def repairs_left(spark: SparkSession, d: str) -> DataFrame:
    """The log of bilingual chunks before any repair: lines with ideographs, the first of them, and sides of unequal length."""
    c = table(spark, d, "chunk_lines").groupBy(F.col("pair_id").alias("chunk_id"), "line").agg(F.min("zh").alias("zh"), F.min("vi").alias("vi"))
    log = repair_log(c.withColumn("chunk_no", F.lit(0)))
    return log.select("chunk_id", "zh_lines", "vi_lines", "mismatch", F.concat_ws(",", F.transform("remaining", lambda x: x.cast("string"))).alias("remaining"), "remaining_count")


_REPAIRS_LEFT = r"""
with c as (select pair_id as chunk_id, line, min(zh) as zh, min(vi) as vi from chunk_lines group by 1, 2),
g as (select chunk_id, count(zh) as zh_lines, count(vi) as vi_lines, count(zh) <> count(vi) as mismatch, coalesce(list(line order by line) filter (where regexp_matches(vi, '[\x{4e00}-\x{9fff}]')), []) as bad from c group by 1)
select chunk_id, zh_lines, vi_lines, mismatch, array_to_string(bad[:24], ',') as remaining, len(bad)::int as remaining_count from g where mismatch or len(bad) > 0
"""


def header_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """How many headers a rewrite of all chapters would update, skip or fail to read."""
    return header_summary(header_status(table(spark, d, "chapters"), "source_file", "source_chunk"))


def stub_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Missing translations of summaries and evidences filled by the stand-in provider."""
    rows = backfill(_edges(spark, d), ["edge_id", "seen_at"], [("summary_zh", "summary_vi")], Passes(), evidences=["evidences"])
    return rows.select("edge_id", "seen_at", "summary_zh", "summary_vi", F.array_join(F.transform("evidences", lambda e: t.or_empty(e["evidence_vi"])), "|").alias("evidences_vi"))


def _echo(text: str) -> str:
    return f"'[' || substr(sha1({text}), 1, 8) || '] ' || {text}"


_STUB_BACKFILL = f"""
select edge_id, seen_at, summary_zh, case when {blank('summary_vi')} and not {blank('summary_zh')} then {_echo(trim('summary_zh'))} else summary_vi end as summary_vi,
  array_to_string(list_transform(evidences, lambda e: coalesce(case when {blank('e.evidence_vi')} and not {blank('e.evidence_zh')} then {_echo(trim('e.evidence_zh'))} else e.evidence_vi end, '')), '|') as evidences_vi
from relation_edges where edge_id is not null
"""

QUERIES = {
    "upsert_edges": upsert_edges, "evidence_fill_missing": evidence_fill_missing, "last_row_wins": last_edges, "fill_missing_facts": fill_missing_facts, "upsert_events": upsert_events,
    "upsert_scenes": upsert_scenes, "first_k_per_group": first_k_edges, "chapter_context": chapter_context, "facts_in_scope": facts_in_scope, "facts_in_chapter": facts_in_chapter, "fact_blocks": fact_blocks, "resume_pending": resume_pending,
    "quality_violations": quality_violations, "run_status_counts": run_status_counts, "answer_cache": answer_cache, "missing_requests": missing_requests, "rejected_answers": rejected_answers,
    "stub_events": stub_events, "stub_translation": stub_translation, "stub_backfill": stub_backfill,
    "stub_rehearsal": stub_rehearsal, "line_repairs": line_repairs, "repairs_left": repairs_left, "prompt_blocks": prompt_blocks, "known_entry_blocks": known_entry_blocks, "glossary_lines": glossary_lines, "header_outcomes": header_outcomes,
}
SQL = {
    "upsert_edges": _UPSERT_EDGES,
    "evidence_fill_missing": f"with {_EVIDENCE} select edge_id, source_file, evidence_zh, evidence_vi from ed",
    "last_row_wins": "with r as (select *, row_number() over (partition by book_id, edge_id order by seen_at desc nulls last, relation_type desc nulls last, summary_zh desc nulls last) as rk from relation_edges where book_id is not null and edge_id is not null) select edge_id, relation_type, summary_zh, seen_at from r where rk = 1",
    "fill_missing_facts": _FACTS, "upsert_events": _EVENTS, "upsert_scenes": _SCENES,
    "first_k_per_group": "with r as (select *, row_number() over (partition by book_id, chapter_number order by seen_at nulls first, edge_id nulls first) as rk from relation_edges where book_id is not null) select book_id, chapter_number, edge_id, seen_at, rk::int as rank from r where rk <= 8",
    "chapter_context": _CONTEXT,
    "facts_in_chapter": _IN_CHAPTER, "fact_blocks": _FACT_BLOCKS,
    "facts_in_scope": "select edge_id, seen_at, source_entity from relation_edges where source_entity in (select canonical_id from glossary where kind = 'character')",
    "resume_pending": f"select chunk_id from chapters c where not exists (select 1 from chat_results r where r.stage = 'translate' and not {blank('r.content')} and r.book_id = c.book_id and r.source_file = c.source_file and r.chunk_index = c.chunk_index)",
    "quality_violations": _QUALITY,
    "run_status_counts": f"select stage, case when {blank('content')} then 'empty' when lower(coalesce(finish_reason, '')) in ('length', 'max_tokens') then 'cut' when lower(coalesce(finish_reason, '')) = 'error' then 'error' else 'done' end as status, count(*) as results, count(distinct request_hash) as requests from chat_results group by 1, 2",
    "answer_cache": f"with r as (select *, row_number() over (partition by request_hash order by created_at desc, result_id desc) as rk from chat_results where request_hash is not null and not {blank('content')}) select request_hash, result_id from r where rk = 1",
    "missing_requests": f"select 'summary_vi' as field, {trim('summary_zh')} as text, count(*) as rows_served from relation_edges where edge_id is not null and not {blank('summary_zh')} and {blank('summary_vi')} group by 1, 2",
    "rejected_answers": _REJECTS, "stub_events": _STUB_EVENTS, "stub_translation": _STUB_TRANSLATION, "stub_backfill": _STUB_BACKFILL, "stub_rehearsal": _REHEARSAL, "line_repairs": _LINE_REPAIRS, "repairs_left": _REPAIRS_LEFT, "prompt_blocks": _PROMPT_BLOCKS, "known_entry_blocks": _KNOWN_BLOCKS, "glossary_lines": _GLOSSARY_LINES, "header_outcomes": HEADER_OUTCOMES,
}
