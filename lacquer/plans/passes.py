"""The extraction passes after the events: entries, facts, edges and scenes, and all passes in order."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacquer.functions import text as t
from lacquer.operators.context import context_block, in_scope
from lacquer.operators.entities import best_by_name, default_file, incoming_ids, merge_entries, resolve
from lacquer.operators.matching import name_hits
from lacquer.operators.merge import evidence_list, evidence_rows, fill_missing_map, merge_by_key
from lacquer.plans.pipeline import NO_BLOCK, PROMPTS, Passes, chapter_blocks, extract_events, known_entries, run_stage, translate
from lacquer.plans.provider import ask
from lacquer.session import materialise
from lacquer.sources.jsonl import answer_objects, object_lines

_EVIDENCE = "array<struct<source_file:string,evidence_zh:string,evidence_vi:string,evidence:string>>"
PLACE = ["chapter_number", "chunk_id", "chunk_no", "object_no"]

PROMPTS |= {
    "entries": "List the names as JSON lines.\nKnown:\n{glossary_block}\n---\n{user_input}",
    "facts": "List facts of entities as JSON lines.\nNames:\n{glossary_block}\n---\n{user_input}",
    "relations": "List relations as JSON lines.\nNames:\n{glossary_block}\n---\n{user_input}",
    "scenes": "List scenes as JSON lines.\nNames:\n{glossary_block}\n---\n{user_input}",
}


@dataclass
class Stores:
    """The tables of a run."""

    glossary: DataFrame
    events: DataFrame | None = None
    facts: DataFrame | None = None
    edges: DataFrame | None = None
    scenes: DataFrame | None = None
    log: list[dict] = field(default_factory=list)


def stage_objects(chapters: DataFrame, blocks: DataFrame, passes: Passes, stage: str, schema: str, temperature: float = 0.2) -> DataFrame:
    """Objects of a stage with their place; a missing chapter number is that of the chapter, an unreadable one rejects the row."""
    own = chapters.withColumnRenamed("chapter_number", "own_number")
    answers = run_stage(own, blocks, passes, stage, temperature, ["chunk_id", "book_id", "own_number", "source_file"])
    objects = answer_objects(answers.where("error is null"), "content", ["chunk_id", "book_id", "chunk_no", "own_number", "source_file"])
    parsed = objects.withColumn("said_number", F.get_json_object("object", "$.chapter_number")).withColumn("o", F.from_json("object", schema))
    rows = parsed.select("*", "o.*").drop("o")
    number = F.when(F.col("said_number").isNull(), F.coalesce("own_number", F.lit(0))).otherwise(F.col("said_number").try_cast("int"))
    return rows.withColumn("chapter_number", number).where("chapter_number is not null")


#: Chapters are told apart by book and number; a chapter without a number counts as number 0 of its book.
CHAPTER = ["book_id", "chapter_number"]


def numbered(chapters: DataFrame) -> DataFrame:
    return chapters.select("chunk_id", "book_id", F.coalesce("chapter_number", F.lit(0)).alias("chapter_number"))


def with_context(blocks: DataFrame, chapters: DataFrame, *contexts: DataFrame) -> DataFrame:
    """Glossary blocks followed by context blocks of the same chapter of the same book."""
    own = numbered(chapters)
    names = []
    for i, context in enumerate(contexts):
        names.append(f"block_{i}")
        own = own.join(context.select(*CHAPTER, F.col("block").alias(names[-1])), CHAPTER, "left")
    own = own.join(blocks, "chunk_id", "left")
    return own.select("chunk_id", F.concat_ws("\n", F.coalesce("glossary_block", F.lit(NO_BLOCK)), *names).alias("glossary_block"))


def event_context(events: DataFrame, most: int) -> DataFrame:
    """The first events of each chapter of each book."""
    return context_block(events, CHAPTER, [F.col("first_seen"), F.col("event_id")], most, F.to_json(F.struct("event_title_zh", "event_summary_zh", "entities")))


def fact_context(facts: DataFrame, scope: DataFrame, most: int = 30) -> DataFrame:
    """Facts of each chapter of each book, about the entities ``scope`` (book, chapter, entity) finds in it."""
    known = in_scope(facts, scope, [*CHAPTER, "entity_id"])
    return context_block(known, CHAPTER, [F.col("first_seen"), F.col("fact_id")], most, F.to_json(F.struct("entity_id", "facts", "evidences")))


def extract_entries(chapters: DataFrame, glossary: DataFrame, passes: Passes) -> DataFrame:
    """The glossary with what the chapters add: ids by surface form, entries merged, resolved one hop."""
    blocks = known_entries(chapters, glossary, passes)
    schema = "canonical_id string, kind string, names_zh array<string>, names_vi array<string>, aliases struct<zh:array<string>,vi:array<string>>, evidences array<struct<source_file:string,evidence:string>>"
    new = stage_objects(chapters, blocks, passes, "entries", schema, 0.1).withColumn("row", F.concat_ws("#", "chunk_id", "chunk_no", "object_no"))
    new = new.where(F.size(t.clean_list("names_zh")) > 0)
    best = best_by_name(glossary, ["book_id"], "canonical_id", "names_zh", "evidences")
    named = incoming_ids(new, best, ["book_id"], "row", "names_zh", "canonical_id").withColumn("canonical_id", F.col("entry_id"))
    columns = ["book_id", "canonical_id", "kind", "names_zh", "names_vi", "aliases", "evidences"]
    added = named.withColumn("evidences", default_file("evidences", "source_file")).select(*columns, F.struct(F.lit(1).alias("new"), F.col("row").alias("at")).alias("_seq"))
    known = glossary.select(*columns, F.struct(F.lit(0).alias("new"), F.col("canonical_id").alias("at")).alias("_seq"))
    both = known.unionByName(added).where("canonical_id <> 'unknown'")
    once = materialise(merge_entries(both, ["book_id", "canonical_id"], F.col("_seq")).drop("merged_rows"), "entries")
    targets = resolve(once, ["book_id"], "canonical_id", "names_zh", "evidences")
    merged = merge_entries(once.join(targets, ["book_id", "canonical_id"]), ["book_id", "target"], F.col("canonical_id"))
    return merged.withColumnRenamed("target", "canonical_id").drop("merged_rows")


def extract_facts(chapters: DataFrame, stores: Stores, passes: Passes) -> DataFrame:
    """Facts of entities, merged by book and id: gaps filled, evidences united."""
    blocks = chapter_blocks(chapters, stores.glossary, passes)
    if stores.events is not None:
        blocks = with_context(blocks, chapters, event_context(stores.events, 10))
    rows = stage_objects(chapters, blocks, passes, "facts", f"entity_id string, facts map<string,string>, evidences {_EVIDENCE}").where(~t.blank("entity_id")).withColumn("facts", F.coalesce("facts", F.create_map().cast("map<string,string>")))
    rows = rows.withColumn("fact_key", t.fact_key("facts")).withColumn("fact_id", t.fact_id("chapter_number", "entity_id", "facts"))
    order, keys = F.struct(*PLACE), ["book_id", "fact_id"]
    merged = merge_by_key(rows, keys, order, {"chapter_number": "first", "entity_id": "first", "fact_key": "first"})
    facts = fill_missing_map(rows, keys, "facts", order)
    return merged.join(facts, keys, "left").join(_evidences(rows, keys, order), keys, "left")


def entities_found(chapters: DataFrame, glossary: DataFrame) -> DataFrame:
    """``(book_id, chapter_number, entity_id)``: the entries whose names stand in a chapter."""
    named = glossary.select("book_id", "canonical_id", F.explode(t.clean_list("names_zh")).alias("name")).distinct()
    found = name_hits(chapters, named, "book_id", "chunk_id", "source_chunk").join(named.withColumnRenamed("canonical_id", "entity_id"), ["book_id", "name"])
    return found.join(numbered(chapters).drop("book_id"), "chunk_id").select(*CHAPTER, "entity_id").distinct()


def extract_edges(chapters: DataFrame, stores: Stores, passes: Passes) -> DataFrame:
    """Relations between entities, merged by book and id: summaries longest, evidences united."""
    blocks = chapter_blocks(chapters, stores.glossary, passes)
    contexts = []
    if stores.events is not None:
        contexts.append(event_context(stores.events, 8))
    if stores.facts is not None:
        contexts.append(fact_context(stores.facts, entities_found(chapters, stores.glossary)))
    if contexts:
        blocks = with_context(blocks, chapters, *contexts)
    schema = f"source_entity string, relation_type string, target_entity string, summary_zh string, summary_vi string, evidences {_EVIDENCE}"
    rows = stage_objects(chapters, blocks, passes, "relations", schema).where(~t.blank("source_entity") & ~t.blank("relation_type") & ~t.blank("target_entity"))
    rows = rows.withColumn("edge_id", t.edge_id("chapter_number", "source_entity", "relation_type", "target_entity"))
    order, keys = F.struct(*PLACE), ["book_id", "edge_id"]
    policies = {"chapter_number": "first", "source_entity": "first", "relation_type": "first", "target_entity": "first", "summary_zh": "longest", "summary_vi": "longest"}
    return merge_by_key(rows, keys, order, policies).join(_evidences(rows, keys, order), keys, "left")


def extract_scenes(chapters: DataFrame, stores: Stores, passes: Passes) -> DataFrame:
    """Scenes, merged by book and id: entities united, summaries longest, evidences united."""
    blocks = chapter_blocks(chapters, stores.glossary, passes)
    if stores.events is not None:
        blocks = with_context(blocks, chapters, event_context(stores.events, 8))
    rows = stage_objects(chapters, blocks, passes, "scenes", f"scene_title_zh string, scene_title_vi string, scene_summary_zh string, scene_summary_vi string, entities array<string>, evidences {_EVIDENCE}")
    rows = rows.where(~t.blank("scene_title_zh")).withColumn("entities", t.clean_list("entities")).withColumn("scene_id", t.scene_id("chapter_number", "scene_title_zh"))
    order, keys = F.struct(*PLACE), ["book_id", "scene_id"]
    policies = {"chapter_number": "first", "scene_title_zh": "first", "scene_title_vi": "first", "scene_summary_zh": "longest", "scene_summary_vi": "longest", "entities": "union"}
    return merge_by_key(rows, keys, order, policies).join(_evidences(rows, keys, order), keys, "left")


def _evidences(rows: DataFrame, keys: list[str], order) -> DataFrame:
    known = rows.where("evidences is not null")
    return evidence_list(evidence_rows(known, keys, "evidences", order, "evidence_zh", ["evidence_vi"], need_file=True, fallback="evidence"), keys, ["source_file", "evidence_zh", "evidence_vi"])


def run_all(chapters: DataFrame, glossary: DataFrame, passes: Passes, stages: tuple[str, ...] = ("entries", "events", "facts", "relations", "scenes", "translate"), validator: object | None = None) -> tuple[Stores, DataFrame | None]:
    """All passes in their order, each written before the next reads it; returns the stores and the translated texts."""
    stores, text = Stores(glossary), None

    def done(stage: str, table: DataFrame) -> DataFrame:
        table = materialise(table, f"store-{stage}")
        stores.log.append({"ts": datetime.now(UTC).isoformat(), "stage": stage, "rows": table.count()})
        return table

    if "entries" in stages:
        stores.glossary = done("entries", extract_entries(chapters, glossary, passes))
    if "events" in stages:
        stores.events = done("events", extract_events(chapters, stores.glossary, passes))
    if "facts" in stages:
        stores.facts = done("facts", extract_facts(chapters, stores, passes))
    if "relations" in stages:
        stores.edges = done("relations", extract_edges(chapters, stores, passes))
    if "scenes" in stages:
        stores.scenes = done("scenes", extract_scenes(chapters, stores, passes))
    if "translate" in stages:
        text = done("translate", translate(chapters, stores.glossary, passes, validator))
    return stores, text


def append_log(spark: SparkSession, stores: Stores, path: str, run: str) -> None:
    """Append the run's log as JSON lines."""
    spark.createDataFrame([(run, e["ts"], e["stage"], e["rows"]) for e in stores.log], "run string, ts string, stage string, rows bigint").write.mode("append").json(path)


def prompt_report(chunk: DataFrame, providers: dict[str, object], only: tuple[str, ...] = (), max_tokens: int = 1000) -> DataFrame:
    """One call per stage on one chunk: its time, its raw answer, and what shows that the form was kept (objects, verdict, lines, header)."""
    parts = None
    first = chunk.select("chunk").limit(1)  # one row
    for stage, provider in providers.items():
        if only and stage not in only:
            continue
        values = {"glossary_block": F.lit(NO_BLOCK), "user_input": F.col("chunk"), "zh_chunk": F.col("chunk"), "vi_chunk": F.col("chunk")}
        values["bad_lines"] = F.to_json(F.struct(F.lit(0).alias("line"), F.col("chunk").alias("zh"), F.col("chunk").alias("vi")))
        places = {p: values[p] for p in re.findall(r"\{([a-z_]+)\}", PROMPTS[stage])}
        asked = first.withColumn("prompt", t.fill_template(PROMPTS[stage], **places))
        began = time.perf_counter()
        answer = materialise(ask(asked, provider, max_tokens), f"report-{stage}")
        elapsed = time.perf_counter() - began
        got = answer.crossJoin(F.broadcast(first))  # one row and one row
        body = t.or_empty("content")
        objects = F.size(object_lines("content"))
        row = got.select(
            F.lit(stage).alias("stage"), F.coalesce(objects, F.lit(0)).alias("objects"), (F.coalesce(objects, F.lit(0)) > 0).alias("parse_ok_nonempty"), t.validation(body, F.lit(""))["ok"].alias("verdict"),
            (F.size(t.split_nl(body)) == F.size(t.split_nl("chunk"))).alias("same_lines"), F.lower(t.or_empty(t.first_text_line(body))).startswith("chapter ").alias("header"), t.has_cjk(body).alias("leaks"),
            F.col("error").isNull().alias("answered"), "finish_reason", F.lit(round(elapsed, 3)).alias("elapsed_s"), F.lit(max_tokens).alias("max_tokens"), F.col("content").alias("raw"), F.substring(body, 1, 200).alias("preview"),
        )
        parts = row if parts is None else parts.unionByName(row)
    return parts
