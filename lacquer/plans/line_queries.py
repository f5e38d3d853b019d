"""Queries over lines set side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacquer.functions import text as t
from lacquer.operators.lines import apply_patches, leaking_lines, line_counts, missing_translations, pair_by_position
from lacquer.plans.duck import blank
from lacquer.session import table

_CJK = "[\\x{4e00}-\\x{9fff}]"


def line_leak_scan(spark: SparkSession, d: str) -> DataFrame:
    return line_counts(table(spark, d, "chunk_lines"), ["pair_id"], "line", "zh", "vi")


_LEAK = f"""
select pair_id, count(distinct case when zh is not null then line end) as source_lines, count(distinct case when vi is not null then line end) as target_lines,
  count(distinct case when regexp_matches(vi, '{_CJK}') then line end) as leaking,
  count(distinct case when zh is not null then line end) <> count(distinct case when vi is not null then line end) as mismatch
from chunk_lines group by pair_id
"""


def leaking(spark: SparkSession, d: str) -> DataFrame:
    return leaking_lines(table(spark, d, "chunk_lines"), ["pair_id"], "line", "zh", "vi").distinct()


_LEAKING = f"select distinct pair_id, line, coalesce(zh, '') as zh, vi from chunk_lines where regexp_matches(vi, '{_CJK}')"


def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    zipped = pair_by_position(docs, ["doc_id"], "text", "target_text")
    return zipped.select("doc_id", "line", F.length("text").alias("chars"), F.sha1(F.col("target_text").cast("binary")).alias("target_digest"))


_ZIP = """
with s as (select doc_id, string_split(coalesce(text, ''), chr(10)) as a, string_split(coalesce(target_text, ''), chr(10)) as b from documents),
n as (select *, unnest(range(greatest(len(a), len(b)))) as line from s)
select doc_id, line::int as line, length(coalesce(a[line + 1], ''))::int as chars, sha1(coalesce(b[line + 1], '')) as target_digest from n
"""


def line_patch(spark: SparkSession, d: str) -> DataFrame:
    """Leaking lines replaced by the last of two made-up fixes."""
    lines = table(spark, d, "chunk_lines").select("pair_id", "line", "zh", "vi").groupBy("pair_id", "line").agg(F.min("zh").alias("zh"), F.min("vi").alias("vi"))
    bad = lines.where(t.has_cjk("vi"))
    fixes = bad.select("pair_id", "line", F.lit(0).alias("seq"), F.concat(F.lit("? "), F.col("line").cast("string")).alias("fix")).unionByName(
        bad.where("line % 2 = 0").select("pair_id", "line", F.lit(1).alias("seq"), F.concat(F.lit("= "), F.col("line").cast("string")).alias("fix"))
    )
    return apply_patches(lines, fixes, ["pair_id"], "line", "vi", "seq", "fix").select("pair_id", "line", "vi", "patched")


_PATCH = f"""
with l as (select pair_id, line, min(vi) as vi from chunk_lines group by 1, 2)
select pair_id, line, case when coalesce(regexp_matches(vi, '{_CJK}'), false) then case when line % 2 = 0 then '= ' else '? ' end || line else vi end as vi,
  coalesce(regexp_matches(vi, '{_CJK}'), false) as patched from l
"""


def only_missing(spark: SparkSession, d: str) -> DataFrame:
    return missing_translations(table(spark, d, "relation_edges"), "summary_zh", "summary_vi").select("edge_id", "seen_at", t.trim_u("summary_zh").alias("text"))


def body_join(spark: SparkSession, d: str) -> DataFrame:
    """Translated lines joined in order again."""
    lines = table(spark, d, "chunk_lines").where("vi is not null").select("pair_id", "line", "vi").distinct()
    joined = lines.groupBy("pair_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "vi"))), lambda x: x["vi"]), "\n").alias("body"))
    return joined.select("pair_id", F.length("body").alias("chars"), F.sha1(F.col("body").cast("binary")).alias("digest"))


QUERIES = {"line_leak_scan": line_leak_scan, "leaking_lines": leaking, "positional_zip": positional_zip, "line_patch": line_patch, "only_missing": only_missing, "body_join": body_join}
SQL = {
    "line_leak_scan": _LEAK, "leaking_lines": _LEAKING, "positional_zip": _ZIP, "line_patch": _PATCH,
    "only_missing": f"select edge_id, seen_at, regexp_replace(summary_zh, '^[\\s\\x{{3000}}]+|[\\s\\x{{3000}}]+$', '', 'g') as text from relation_edges where not {blank('summary_zh')} and {blank('summary_vi')}",
    "body_join": "with l as (select distinct pair_id, line, vi from chunk_lines where vi is not null), j as (select pair_id, string_agg(vi, chr(10) order by line, vi) as body from l group by 1) select pair_id, length(body)::int as chars, sha1(body) as digest from j",
}
