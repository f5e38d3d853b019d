"""Queries of text functions, chunking and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacquer.functions import text as t
from lacquer.operators.chunking import Budget, chunk_limits, line_chunks, stage_limit
from lacquer.plans.duck import blank, clean_list, trim
from lacquer.session import table
from lacquer.sources.jsonl import answer_objects, object_lines, recovered_objects
from lacquer.sources.texts import header_status

LIMIT = 2000


def line_chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    chunks = line_chunks(table(spark, d, "chapters"), "source_chunk", LIMIT, ["chunk_id"])
    return chunks.select("chunk_id", "chunk_no", F.length("chunk").alias("chars"), t.estimate_tokens("chunk").alias("tokens"), F.sha1(F.col("chunk").cast("binary")).alias("digest"))




def packed_sql(limit: int) -> str:
    """The chunks of chapters as common table expressions, the last ``numbered`` (chunk_id, chunk, chunk_no)."""
    return f"""packed as (
  select chunk_id, list_reduce(string_split(source_chunk, chr(10)),
    lambda acc, l: case when acc.open is not null and length(acc.open) + 1 + length(l) > {limit}
                  then {{'done': list_append(acc.done, acc.open), 'open': l}}
                  else {{'done': acc.done, 'open': case when acc.open is null then l else acc.open || chr(10) || l end}} end,
    {{'done': []::varchar[], 'open': null::varchar}}) as p
  from chapters where source_chunk is not null),
pieces as (select chunk_id, list_append(p.done, p.open) as c from packed),
numbered as (select chunk_id, unnest(c) as chunk, generate_subscripts(c, 1) - 1 as chunk_no from pieces)
"""


_LINE_CHUNKS = f"""
with {packed_sql(LIMIT)}
select chunk_id, chunk_no::int as chunk_no, length(chunk)::int as chars,
  (case when length(chunk) = 0 then 0 else greatest(1, (length(chunk) + 2) // 3) end)::int as tokens, sha1(chunk) as digest from numbered
"""


def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", t.estimate_tokens("text").alias("tokens"), t.estimate_tokens("target_text").alias("target_tokens"))


def header_fields(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters").where("source_chunk is not null").withColumn("head", t.trim_u(t.or_empty(t.first_text_line("source_chunk"))))
    return c.select(
        "chunk_id", t.header_number("head").alias("number"), t.header_title("head").alias("header_title"), F.length(t.after_header("source_chunk")).alias("rest_chars"), t.header_line("source_chunk").alias("header")
    )


_FIRST_TEXT = f"list_filter(string_split(source_chunk, chr(10)), lambda l: {trim('l')} <> '')[1]"
_HEAD = trim(f"coalesce({_FIRST_TEXT}, '')")
_HEADER_FIELDS = f"""
with h as (select chunk_id, source_chunk, {_HEAD} as head, string_split(source_chunk, chr(10)) as lines, regexp_split_to_array(source_chunk, '\\r\\n|[\\n\\x{{b}}\\f\\r\\x{{1c}}-\\x{{1e}}\\x{{85}}\\x{{2028}}\\x{{2029}}]')[1] as line1 from chapters where source_chunk is not null)
select chunk_id, try_cast(nullif(regexp_extract(head, '(?i)^Chapter\\s+(\\d+)\\s*-\\s*(.+)$', 1), '') as int) as number,
  case when regexp_extract(head, '(?i)^Chapter\\s+(\\d+)\\s*-\\s*(.+)$', 2) <> '' then {trim("regexp_replace(regexp_extract(head, '(?i)^Chapter\\s+(\\d+)\\s*-\\s*(.+)$', 2), '(?i)\\s*\\|\\s*SourceFile:.*$', '')")} end as header_title,
  length(regexp_replace(array_to_string(lines[2:], chr(10)), '^\\n+', ''))::int as rest_chars,
  case when starts_with({trim('line1')}, 'Chapter ') then line1 else '' end as header from h
"""


def header_rewrite(spark: SparkSession, d: str) -> DataFrame:
    rows = header_status(table(spark, d, "chapters"), "source_file", "source_chunk")
    return rows.select("chunk_id", "status", F.sha1(F.col("new_text").cast("binary")).alias("digest"))


_BODY = "regexp_replace(source_chunk, '^\\x{feff}', '')"
_HEADER_STATUS = f"""
h as (select chunk_id, source_chunk, source_file, try_cast(nullif(regexp_extract(source_file, '(?i)^C(\\d+)-(.+)\\.txt$', 1), '') as int) as n, regexp_extract(source_file, '(?i)^C(\\d+)-(.+)\\.txt$', 2) as title,
  {_BODY} as body from chapters),
e as (select *, 'Chapter ' || n || ' - ' || {trim('title')} || ' | SourceFile: ' || source_file as expected, {trim(f"coalesce(list_filter(string_split(body, chr(10)), lambda l: {trim('l')} <> '')[1], '')")} as first_line from h),
s as (select *, case when n is null then 'name' when source_chunk is null then 'error' when first_line = expected then 'present' when starts_with(first_line, 'Chapter ') then 'other header' else 'updated' end as status from e)
"""
HEADER_OUTCOMES = f"with {_HEADER_STATUS} select case status when 'updated' then 'updated' when 'error' then 'errors' else 'skipped' end as outcome, count(*) as files from s group by 1"
_HEADER_REWRITE = f"""
with {_HEADER_STATUS}
select chunk_id, status, sha1(case when status = 'updated' then expected || chr(10) || chr(10) || body else source_chunk end) as digest from s
"""


def canonical_slug(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "glossary")
    name = F.try_element_at(t.clean_list("names_zh"), F.lit(1))
    return g.select("entry_no", t.slug(F.try_element_at(t.clean_list("names_vi"), F.lit(1))).alias("slug"), t.name_id(name).alias("name_id"))


def _slug_sql(x: str) -> str:
    s = f"regexp_replace(regexp_replace(regexp_replace(lower({trim(f'coalesce({x}, chr(32))')}), '[^a-z0-9_-]+', '-', 'g'), '-{{2,}}', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"case when {s} = '' then 'unknown' else {s} end"


_CANONICAL_SLUG = f"""
with n as (select entry_no, {clean_list('names_zh')}[1] as zh, {clean_list('names_vi')}[1] as vi from glossary)
select entry_no, {_slug_sql('vi')} as slug, case when coalesce(zh, '') = '' then 'unknown' else 'zh_' || substr(sha1(zh), 1, 10) end as name_id from n
"""


def content_ids(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "relation_edges")
    return e.select(
        "edge_id", "seen_at", t.edge_id("chapter_number", "source_entity", "relation_type", "target_entity").alias("computed_id"), t.scene_id("chapter_number", "summary_zh").alias("scene_id"),
        t.event_id("chapter_number", "summary_zh", F.array("target_entity", "source_entity", "target_entity")).alias("event_id"),
    )


_CONTENT_IDS = f"""
select edge_id, seen_at, sha1(concat_ws('|', chapter_number::varchar, {trim("coalesce(source_entity, '')")}, {trim("coalesce(relation_type, '')")}, {trim("coalesce(target_entity, '')")})) as computed_id,
  sha1(concat_ws('|', chapter_number::varchar, {trim("coalesce(summary_zh, '')")})) as scene_id,
  sha1(concat_ws('|', chapter_number::varchar, {trim("coalesce(summary_zh, '')")}, array_to_string(list_sort({clean_list('[target_entity, source_entity]')}), '|'))) as event_id
from relation_edges
"""


def fact_ids(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "relation_edges")
    facts = F.create_map(F.lower("relation_type"), F.col("target_entity"), F.lit("note"), t.or_empty("summary_zh"), F.lit("note_vi"), t.or_empty("summary_vi"))
    return e.where("relation_type is not null and lower(relation_type) not in ('note', 'note_vi')").select("edge_id", "seen_at", t.fact_id("chapter_number", "source_entity", facts).alias("fact_id"))


_FACT_IDS = f"""
with f as (select *, lower(relation_type) as k from relation_edges where relation_type is not null and lower(relation_type) not in ('note', 'note_vi')),
r as (select *, list_sort([k, 'note']) as ks from f)
select edge_id, seen_at, sha1(concat_ws('|', chapter_number::varchar, {trim("coalesce(source_entity, '')")},
  sha1(array_to_string(list_transform(ks, lambda x: length(x)::varchar || '=' || x || '=' || case when x = 'note' then coalesce(summary_zh, '') else coalesce(target_entity, '') end), chr(10))))) as fact_id from r
"""


def answer_cleanup(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chat_results")
    wrapped = F.concat(F.lit("<think>plan: "), F.col("stage"), F.lit("\n</think>\n"), F.col("content"))
    return c.where("content is not null").select("result_id", F.sha1(t.strip_fence("content").cast("binary")).alias("unfenced"), F.sha1(t.strip_reasoning(wrapped).cast("binary")).alias("unreasoned"))


_ANSWER_CLEANUP = f"""
with c as (select result_id, {trim('content')} as x, {trim("regexp_replace('<think>plan: ' || stage || chr(10) || '</think>' || chr(10) || content, '(?is)<think>.*?</think>', '', 'g')")} as y from chat_results where content is not null)
select result_id, sha1(case when starts_with(x, '```') then {trim("regexp_replace(regexp_replace(x, '^```[a-zA-Z0-9]*\\s*', ''), '\\s*```$', '')")} else x end) as unfenced, sha1(y) as unreasoned from c
"""


def validate_marker(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chat_results").where("stage = 'validate'")
    v = t.validation(t.or_empty("content"), F.lit("original"))
    return c.select("result_id", v["ok"].alias("ok"), F.sha1(v["text"].cast("binary")).alias("digest"))


_VALIDATE = f"""
with c as (select result_id, {trim("coalesce(content, '')")} as x from chat_results where stage = 'validate'),
u as (select result_id, case when starts_with(x, '```') then {trim("regexp_replace(regexp_replace(x, '^```[a-zA-Z0-9]*\\s*', ''), '\\s*```$', '')")} else x end as x from c),
l as (select result_id, string_split(x, chr(10)) as lines from u),
b as (select *, list_transform(lines, lambda e: {trim("regexp_replace(" + trim("e") + ", '^[*`]+|[*`]+$', '', 'g')")}) as bare from l),
p as (select *, list_filter(range(1, len(bare) + 1), lambda i: bare[i] in ('PASS', 'FIXED_VI'))[1] as at_line from b)
select result_id, at_line is not null as ok,
  sha1(case when at_line is not null and bare[at_line] = 'FIXED_VI' then {trim("array_to_string(lines[at_line + 1:], chr(10))")} else 'original' end) as digest from p
"""


def file_names(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters")
    n = t.chapter_number("title")
    return c.select("chunk_id", n.alias("number"), F.concat(t.file_prefix(n), F.lit("-"), t.safe_file_name(t.or_empty("title")), F.lit(".txt")).alias("file"), F.col("source_file").rlike(r"(?i)^C(\d+)-(.+)\.txt$").alias("fits"))


_HAN = """list_reduce(list_filter(string_split(regexp_extract(coalesce(title, ''), '第(.+?)章', 1), ''), lambda ch: ch <> ''),
  lambda acc, ch: case when list_position(['零','一','二','三','四','五','六','七','八','九'], ch) > 0 then {'total': acc.total, 'digit': (list_position(['零','一','二','三','四','五','六','七','八','九'], ch) - 1)::int}
                               when list_position(['十','百','千'], ch) > 0 then {'total': (acc.total + case when acc.digit = 0 then 1 else acc.digit end * (10 ** list_position(['十','百','千'], ch)))::int, 'digit': 0}
                else acc end, {'total': 0::int, 'digit': 0::int})"""
_FILE_NAMES = f"""
with h as (select *, {_HAN} as v, regexp_extract(coalesce(title, ''), '第(.+?)章', 1) as inner_text from chapters),
n as (select *, (case when contains(coalesce(title, ''), '序章') then 0 when inner_text = '' then -1 when regexp_full_match(inner_text, '[0-9]+') then inner_text::int else v.total + v.digit end)::int as number from h)
select chunk_id, number, (case when number < 0 then 'CXXX' else 'C' || lpad(number::varchar, greatest(3, length(number::varchar))::int, '0') end) || '-' ||
  {trim("regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(title, ''), '[\\\\/:*?\"<>|：]', ' ', 'g'), '[\\x00-\\x1f]', '', 'g'), '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g')")} || '.txt' as file,
  regexp_matches(source_file, '(?i)^C(\\d+)-(.+)\\.txt$') as fits from n
"""

START, ENDS = "(?:字号|Cỡ chữ|Text size)[^\\n]*\\n", ["上一页", "版权所有", "备案编号"]


def page_body(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters").where("source_chunk is not null")
    html = F.concat(F.lit("<h1>"), t.or_empty("site"), F.lit("</h1><h2 class='t'> "), t.or_empty("title"), F.lit(' </h2><a href="/list">目录</a><a href="next'), F.col("chunk_id").cast("string"), F.lit('.html">下一页</a>'))
    base = F.concat(F.lit("https://"), t.or_empty("site"), F.lit(".example/b/1.html"))
    body = t.body_between("source_chunk", START, ENDS)
    return c.select("chunk_id", F.length(body).alias("body_chars"), F.sha1(body.cast("binary")).alias("digest"), t.page_title(html).alias("page_title"), t.next_link(html, "下一页", base, r"next\d+").alias("next_url"))


_CUT = "least(" + ", ".join(f"case when instr(tail, '{e}') > 0 then instr(tail, '{e}') else length(tail) + 1 end" for e in ENDS) + ")"
_PAGE_BODY = f"""
with c0 as (select chunk_id, site, title, {trim("regexp_replace(source_chunk, '\\r\\n?', chr(10), 'g')")} as x from chapters where source_chunk is not null),
c as (select *, regexp_replace(x, '^[\\s\\S]*?(?:{START})', '') as tail from c0),
b as (select *, {trim(f"substr(tail, 1, {_CUT} - 1)")} as cut from c),
f as (select *, regexp_replace(regexp_replace(cut, '\\n?_{{2,}}\\s*$', ''), '\\n{{3,}}', chr(10) || chr(10), 'g') as body from b)
select chunk_id, length(body)::int as body_chars, sha1(body) as digest,
  coalesce(nullif(case when contains(title, '第') then {trim("title")} end, ''), nullif({trim("coalesce(title, '')")}, ''), {trim("coalesce(site, '')")}) as page_title,
  'https://' || coalesce(site, '') || '.example/b/next' || chunk_id || '.html' as next_url from f
"""


def template_fill(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "eval_items")
    return e.select("item_id", t.fill_template("[{lang}] {text} ({suite})", lang="lang", text="text", suite="suite").alias("prompt"))


_TEMPLATE = "select item_id, '[' || coalesce(lang, '') || '] ' || coalesce(text, '') || ' (' || coalesce(suite, '') || ')' as prompt from eval_items"


def jsonl_objects(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chat_results").where("stage in ('glossary', 'timeline')")
    good = c.select("result_id", F.posexplode(object_lines("content", sanitise=False)).alias("object_no", "line"))
    return good.select("result_id", "object_no", F.get_json_object("line", "$.canonical_id").alias("canonical_id"), F.get_json_object("line", "$.event_title_zh").alias("event_title_zh"))


_OBJECT_LINES = f"""
c as (select result_id, stage, {trim("content")} as x from chat_results where stage in ('glossary', 'timeline') and content is not null),
u as (select result_id, stage, case when starts_with(x, '```') then {trim("regexp_replace(regexp_replace(x, '^```[a-zA-Z0-9]*\\s*', ''), '\\s*```$', '')")} else x end as x from c),
l as (select result_id, stage, unnest(string_split(x, chr(10))) as line, generate_subscripts(string_split(x, chr(10)), 1) as line_no from u),
g as (select result_id, stage, line_no, {trim("line")} as line from l),
objects as (select result_id, stage, line, (row_number() over (partition by result_id order by line_no) - 1)::int as object_no from g where starts_with(line, '{{') and json_valid(line))
"""
_JSONL = f"with {_OBJECT_LINES} select result_id, object_no, json_extract_string(line, '$.canonical_id') as canonical_id, json_extract_string(line, '$.event_title_zh') as event_title_zh from objects"
_ANSWER_OBJECTS = f"with {_OBJECT_LINES} select result_id, stage, object_no, line as object from objects"


def json_recovery(spark: SparkSession, d: str) -> DataFrame:
    """Objects found by matching braces in answers flattened to one line: whole ones, and whole parts of broken ones."""
    c = table(spark, d, "chat_results").where("stage in ('glossary', 'timeline') and content is not null")
    return c.select("result_id", F.posexplode(recovered_objects(F.regexp_replace("content", "\n", " "))).alias("object_no", "object"))


_RECOVERY = r"""
with l as (select result_id, unnest(string_split(content, chr(10))) as line, generate_subscripts(string_split(content, chr(10)), 1) as line_no from chat_results where stage in ('glossary', 'timeline') and content is not null),
f as (select result_id, line_no, case when json_valid(trim(line)) and starts_with(trim(line), '{') then [trim(line)] else list_filter(regexp_extract_all(line, '\{[^{}]*\}'), lambda x: json_valid(x)) end as found from l),
o as (select result_id, line_no, unnest(found) as object, generate_subscripts(found, 1) as i from f)
select result_id, (row_number() over (partition by result_id order by line_no, i) - 1)::int as object_no, object from o
"""


def answer_objects_query(spark: SparkSession, d: str) -> DataFrame:
    """Objects of answers, line by line or recovered (in the test tables no answer without object lines holds a whole object)."""
    c = table(spark, d, "chat_results").where("stage in ('glossary', 'timeline') and content is not null")
    return answer_objects(c, "content", ["result_id", "stage"])


def text_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(t.split_lines("text")).alias("lines"), F.length(t.trim_u("text")).alias("trimmed_chars"), t.has_cjk("text").alias("cjk"))


_TEXT_LINES = f"""
with l as (select doc_id, text, regexp_split_to_array(text, '\\r\\n|[\\n\\x{{b}}\\f\\r\\x{{1c}}-\\x{{1e}}\\x{{85}}\\x{{2028}}\\x{{2029}}]') as p from documents where text is not null)
select doc_id, (case when p[-1] = '' then len(p) - 1 else len(p) end)::int as lines, length({trim("text")})::int as trimmed_chars, regexp_matches(text, '[\\x{{4e00}}-\\x{{9fff}}]') as cjk from l
"""


def first_text_line(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chapters").where("source_chunk is not null").select("chunk_id", t.first_text_line("source_chunk").alias("first_line"))


_FIRST_LINE = f"select chunk_id, {_FIRST_TEXT} as first_line from chapters where source_chunk is not null"


def header_split(spark: SparkSession, d: str) -> DataFrame:
    """Chapters as header and body."""
    return table(spark, d, "chapters").where("source_chunk is not null").select("chunk_id", t.split_header("source_chunk").alias("s")).select("chunk_id", "s.header", F.sha1(F.col("s.body").cast("binary")).alias("digest"))


_HEADER_SPLIT = rf"""
with l as (select chunk_id, source_chunk, regexp_split_to_array(source_chunk, '\r\n|[\n\x{{b}}\f\r\x{{1c}}-\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]') as p from chapters where source_chunk is not null),
k as (select *, case when p[-1] = '' then p[1:len(p) - 1] else p end as q from l)
select chunk_id, case when starts_with({trim("coalesce(q[1], '')")}, 'Chapter ') then q[1] else '' end as header,
  sha1(case when starts_with({trim("coalesce(q[1], '')")}, 'Chapter ') then regexp_replace(array_to_string(q[2:], chr(10)), '^\n+', '') when len(q) = 0 then '' else source_chunk end) as digest from k
"""


def suffix_kept(spark: SparkSession, d: str) -> DataFrame:
    """Titles with the suffix of their file again, whole answers with all their lines."""
    c = table(spark, d, "chat_results").where("stage = 'title' and content is not null and source_file is not null")
    bare = F.regexp_replace("content", r"\s*\|\s*SourceFile:.*$", "")
    return c.select("result_id", t.keep_suffix(F.concat(F.lit("Chapter 1 - x | SourceFile: "), F.col("source_file")), bare).alias("text"))


_SUFFIX = f"""
with c as (select result_id, source_file, regexp_replace(content, '\\s*\\|\\s*SourceFile:.*$', '') as b from chat_results where stage = 'title' and content is not null and source_file is not null),
l as (select *, regexp_split_to_array(b, '\\r\\n|[\\n\\x{{b}}\\f\\r\\x{{1c}}-\\x{{1e}}\\x{{85}}\\x{{2028}}\\x{{2029}}]') as p from c),
k as (select *, case when p[-1] = '' then p[1:len(p) - 1] else p end as q from l)
select result_id, case when len(q) = 0 or regexp_matches(q[1], '(?i)\\|\\s*SourceFile:') then b
  else array_to_string(list_prepend(regexp_replace(q[1], '[\\s\\x{{3000}}\\x{{a0}}]+$', '') || ' ' || {trim("'| SourceFile: ' || source_file")}, q[2:]), chr(10)) end as text from k
"""


def budget_limits(spark: SparkSession, d: str) -> DataFrame:
    """Chunk sizes by stage beside prompts as long as the chunk limits."""
    caps = table(spark, d, "chunk_caps")
    b = Budget()
    extract, translate, validate = chunk_limits(b, 1034, 627, 900, True)
    used = (F.col("max_chars") / 3).cast("int")
    size = F.when(F.col("stage") == "extract", extract).when(F.col("stage") == "translate", translate).when(F.col("stage") == "validate", validate)
    for stage in ("timeline", "facts", "relations", "scenes"):
        size = size.when(F.col("stage") == stage, stage_limit(b, stage, used))
    return caps.select("stage", size.cast("int").alias("chars"))


_BUDGET = """
select stage, (case stage when 'extract' then greatest(256, 3 * (13000 - 400 - 1800 - 1034 - 900))
  when 'translate' then least(greatest(256, 3 * (13000 - 400 - 4500 - 627 - 1200)), greatest(256, 3 * greatest(128, (13000 - 400 - 3200 - 900) // 2)))
  when 'timeline' then least(greatest(256, 3 * (13000 - 400 - 2500 - max_chars // 3)), 9000) when 'facts' then least(greatest(256, 3 * (13000 - 400 - 2300 - max_chars // 3)), 6000)
  else least(greatest(256, 3 * (13000 - 400 - 2300 - max_chars // 3)), 7000) end)::int as chars from chunk_caps
"""


def required_fields(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "relation_edges")
    ok = ~t.blank("source_entity") & ~t.blank("relation_type") & ~t.blank("target_entity") & F.col("chapter_number").isNotNull() & (F.col("target_entity") != "unknown")
    return e.where(ok).select("edge_id", "seen_at", F.lower("relation_type").alias("relation"))


_REQUIRED = f"select edge_id, seen_at, lower(relation_type) as relation from relation_edges where not {blank('source_entity')} and not {blank('relation_type')} and not {blank('target_entity')} and chapter_number is not null and target_entity <> 'unknown'"

QUERIES = {
    "line_chunks": line_chunk_stats, "token_estimate": token_estimate, "header_fields": header_fields, "header_rewrite": header_rewrite, "canonical_slug": canonical_slug,
    "content_ids": content_ids, "fact_ids": fact_ids, "answer_cleanup": answer_cleanup, "validate_marker": validate_marker, "file_names": file_names, "page_body": page_body,
    "template_fill": template_fill, "jsonl_objects": jsonl_objects, "json_recovery": json_recovery, "answer_objects": answer_objects_query, "text_lines": text_lines,
    "first_text_line": first_text_line, "suffix_kept": suffix_kept, "header_split": header_split, "budget_limits": budget_limits, "required_fields": required_fields,
}
SQL = {
    "line_chunks": _LINE_CHUNKS, "header_fields": _HEADER_FIELDS, "header_rewrite": _HEADER_REWRITE, "canonical_slug": _CANONICAL_SLUG, "content_ids": _CONTENT_IDS, "fact_ids": _FACT_IDS,
    "answer_cleanup": _ANSWER_CLEANUP, "validate_marker": _VALIDATE, "file_names": _FILE_NAMES, "page_body": _PAGE_BODY, "template_fill": _TEMPLATE, "jsonl_objects": _JSONL, "answer_objects": _ANSWER_OBJECTS, "json_recovery": _RECOVERY, "text_lines": _TEXT_LINES,
    "first_text_line": _FIRST_LINE, "suffix_kept": _SUFFIX, "header_split": _HEADER_SPLIT, "budget_limits": _BUDGET, "required_fields": _REQUIRED,
    "token_estimate": "select doc_id, (case when coalesce(length(text), 0) = 0 then 0 else greatest(1, (length(text) + 2) // 3) end)::int as tokens, (case when coalesce(length(target_text), 0) = 0 then 0 else greatest(1, (length(target_text) + 2) // 3) end)::int as target_tokens from documents",
}
