"""The passes over chapters, as tables: chunks, requests, answers, keyed merges."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacquer.functions import text as t
from lacquer.operators.chunking import Budget, chunk_limits, line_chunks, pack_lines, stage_limit
from lacquer.operators.lines import apply_patches
from lacquer.operators.matching import name_hits, pick_entries, scored_entries, within_budget
from lacquer.operators.merge import evidence_list, evidence_rows, merge_by_key
from lacquer.plans.provider import StubProvider, ask, request_hash
from lacquer.session import materialise
from lacquer.sources.jsonl import answer_objects

#: Short neutral prompts; callers bring their own.
PROMPTS = {
    "events": "List the events as JSON lines.\nNames:\n{glossary_block}\n---\n{user_input}",
    "translate": "Translate.\nNames:\n{glossary_block}\n---\n{user_input}",
    "validate": "Answer PASS or FIXED_VI and the text.\nNames:\n{glossary_block}\nSource:\n{zh_chunk}\n---\n{vi_chunk}",
    "fix_lines": "Repair the lines; answer with one object of line and vi for each.\nNames:\n{glossary_block}\n---\n{bad_lines}",
}
HINT = "The previous translation did not pass. Keep closer to the source and the names.\n"
NO_BLOCK = "(none)"


@dataclass(frozen=True)
class Passes:
    """What a run needs: a provider, limits and prompts."""

    provider: object = StubProvider()
    budget: Budget = Budget()
    #: A fixed chunk size for all passes instead of what the budget gives.
    chunk_chars: int | None = None
    glossary_entries: int = 40
    glossary_tokens: int = 1200
    #: Entries shown to the pass that looks for new ones.
    known_entries: int = 25
    pinned: tuple[str, ...] = ()
    completion: int = 2500
    repairs: int = 3
    #: Translate once more what the validator does not pass.
    retry_whole: bool = True
    translate_header: bool = True
    dry_run: bool = False
    parallel: int | None = None


def glossary_blocks(texts: DataFrame, glossary: DataFrame, scope: str, id_col: str, text_col: str, most: int, tokens: int, pinned: list[str] | None = None, longest: bool = False) -> DataFrame:
    """``(id, glossary_block)``: the entries found in each text, best first, within count and tokens.

    The best have the most text in their occurrences, or with ``longest`` the longest name found.
    """
    named = glossary.select(scope, F.col("canonical_id"), F.explode(t.clean_list("names_zh")).alias("name")).distinct()  # an entry saved again counts once
    hits = name_hits(texts, named, scope, id_col, text_col)
    lines = entry_lines(glossary, scope)
    scored = scored_entries(hits, named, [scope], id_col, "canonical_id", pinned or [])
    picked = pick_entries(scored.withColumn("score", F.col("longest")) if longest else scored, id_col, "canonical_id", most)
    kept = within_budget(picked.join(lines, [scope, "canonical_id"]), [id_col], [F.col("place")], F.col("line"), tokens)
    return kept.groupBy(id_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n").alias("glossary_block"))


def entry_lines(glossary: DataFrame, scope: str) -> DataFrame:
    """``(scope, canonical_id, line)``: each entry as a JSON line, as prompts show it."""
    return glossary.groupBy(scope, "canonical_id").agg(F.min(F.to_json(F.struct("canonical_id", "kind", "names_zh", "names_vi"))).alias("line"))


def known_entries(chapters: DataFrame, glossary: DataFrame, passes: Passes) -> DataFrame:
    """The block of the pass that looks for new entries: those with the longest names found in the chapter."""
    return glossary_blocks(chapters, glossary, "book_id", "chunk_id", "source_chunk", passes.known_entries, passes.budget.glossary_extract, longest=True)


def shell_tokens(stage: str, system: str = "") -> int:
    """Tokens of a prompt without what is filled in."""
    bare = re.sub(r"\{[a-z_]+\}", "", PROMPTS[stage])
    return -(-len(bare) // 3) + -(-len(system) // 3)


def chunk_chars(passes: Passes, stage: str, validate: bool) -> int:
    """The chunk size of extraction or translation; a translation that is checked has to leave room for both texts."""
    system = getattr(passes.provider, "system", "")
    extract, translated, _ = chunk_limits(passes.budget, shell_tokens("events", system), shell_tokens("translate", system), shell_tokens("validate", system), validate)
    return extract if stage == "entries" else translated


def chunk_size(passes: Passes, stage: str, block: Column | str | None = None, validate: bool = False) -> Column:
    """The chunk size of a stage: what its prompt, with the block filled in, leaves of the budget, under the stage's cap."""
    if passes.chunk_chars is not None:
        return F.lit(passes.chunk_chars)
    system = getattr(passes.provider, "system", "")
    if stage in ("entries", "translate"):
        return F.lit(chunk_chars(passes, stage, validate))
    name = {"events": "timeline"}.get(stage, stage)
    used = F.lit(shell_tokens(stage, system)) + (t.estimate_tokens(block) if block is not None else F.lit(0))
    return stage_limit(passes.budget, name, used)


def answered(rows: DataFrame, prompt: Column, passes: Passes, label: str, temperature: float, provider: object | None = None, cache: DataFrame | None = None) -> DataFrame:
    """Rows with ``content``, ``finish_reason`` and ``error`` of the answers to their prompts.

    Prompts are made once and answers are written, so that no later action asks again.
    """
    asked = materialise(rows.withColumn("prompt", prompt).withColumn("request_hash", request_hash("prompt", F.lit(passes.completion), F.lit(temperature))), f"prompts-{label}")
    answers = materialise(ask(asked.select("prompt"), provider or passes.provider, passes.completion, temperature, cache, passes.parallel), f"answers-{label}")
    return asked.join(answers, "request_hash", "left").drop("prompt", "request_hash")


def run_stage(chapters: DataFrame, blocks: DataFrame, passes: Passes, stage: str, temperature: float, keep: list[str], cache: DataFrame | None = None) -> DataFrame:
    """Chunks of the chapters, as large as the stage's budget allows beside its block, with the answers to their prompts."""
    with_block = chapters.join(blocks, "chunk_id", "left").withColumn("glossary_block", F.coalesce("glossary_block", F.lit(NO_BLOCK)))
    chunks = line_chunks(with_block, "source_chunk", chunk_size(passes, stage, "glossary_block"), [*keep, "glossary_block"])
    return answered(chunks, t.fill_template(PROMPTS[stage], glossary_block="glossary_block", user_input="chunk"), passes, stage, temperature, cache=cache).drop("glossary_block")


def chapter_blocks(chapters: DataFrame, glossary: DataFrame, passes: Passes) -> DataFrame:
    return glossary_blocks(chapters, glossary, "book_id", "chunk_id", "source_chunk", passes.glossary_entries, passes.glossary_tokens, list(passes.pinned))


def extract_events(chapters: DataFrame, glossary: DataFrame, passes: Passes, cache: DataFrame | None = None) -> DataFrame:
    """Events of chapters, merged by book and id: longest summaries, entities united, evidences distinct."""
    answers = run_stage(chapters, chapter_blocks(chapters, glossary, passes), passes, "events", 0.2, ["chunk_id", "book_id", "chapter_number", "source_file"], cache)
    objects = answer_objects(answers.where("error is null"), "content", ["chunk_id", "chunk_no", "chapter_number", "source_file", "book_id"])
    parsed = objects.select("*", F.from_json("object", "event_title_zh string, event_summary_zh string, event_summary_vi string, entities array<string>, evidences array<struct<source_file:string,evidence_zh:string,evidence:string>>").alias("o")).select("*", "o.*")
    rows = parsed.where(~t.blank("event_title_zh")).withColumn("chapter_number", F.coalesce("chapter_number", F.lit(0))).withColumn("entities", t.clean_list("entities"))
    rows = rows.withColumn("event_id", t.event_id("chapter_number", "event_title_zh", "entities"))
    order, keys = F.struct("chapter_number", "chunk_id", "chunk_no", "object_no"), ["book_id", "event_id"]
    merged = merge_by_key(rows, keys, order, {"chapter_number": "first", "event_title_zh": "first", "event_summary_zh": "longest", "event_summary_vi": "longest", "entities": "union"})
    found = evidence_list(evidence_rows(rows.where("evidences is not null"), keys, "evidences", order, "evidence_zh", [], need_file=True, fallback="evidence"), keys, ["source_file", "evidence_zh"])
    return merged.join(found, keys, "left")


def translate(chapters: DataFrame, glossary: DataFrame, passes: Passes, validator: object | None = None) -> DataFrame:
    """``(chunk_id, text, unresolved, failed)``: texts translated in chunks, checked, repaired where ideographs remain, and joined again.

    What the validator does not pass is translated once more, with a hint, and checked again.  The
    first line keeps the source's file suffix; without ``translate_header`` the header stays as it
    is and only the body is translated.  A rehearsal (``dry_run``) asks nobody.  ``unresolved``
    counts lines that still hold ideographs, ``failed`` chunks without an answer.
    """
    header = t.header_line("source_chunk")
    kept_header = F.lit(False) if passes.translate_header else header != ""
    source = F.when(kept_header, t.after_header("source_chunk")).otherwise(F.col("source_chunk"))
    texts = chapters.where("source_chunk is not null").select("chunk_id", "book_id", "source_chunk", source.alias("source"))
    if passes.dry_run:
        chunks = F.transform(_packed("source", passes, validator), lambda c: F.concat(F.lit("[DRY-RUN]"), F.substring(c, 1, 40), F.lit("...")))
        body = F.array_join(chunks, "\n\n")
        return texts.select("chunk_id", F.when(kept_header, F.concat(header, F.lit("\n\n"), body)).otherwise(body).alias("text"), F.lit(0).cast("bigint").alias("unresolved"), F.lit(0).cast("bigint").alias("failed"))
    blocks = chapter_blocks(chapters, glossary, passes)
    chunks = texts.join(blocks, "chunk_id", "left").select("chunk_id", F.coalesce("glossary_block", F.lit(NO_BLOCK)).alias("block"), F.posexplode(_packed("source", passes, validator)).alias("chunk_no", "chunk"))
    prompt = t.fill_template(PROMPTS["translate"], glossary_block="block", user_input="chunk")
    vi = t.trim_u(t.or_empty("content"))
    done = answered(chunks, prompt, passes, "translate", 0.25).select("chunk_id", "chunk_no", "chunk", "block", vi.alias("vi"), F.col("content").isNull().alias("failed"))
    if validator is not None:
        check = t.fill_template(PROMPTS["validate"], glossary_block="block", zh_chunk="chunk", vi_chunk="vi")
        verdict = lambda rows, label: answered(rows, check, passes, label, 0.0, validator).withColumn("v", t.validation(t.or_empty("content"), F.col("vi"))).drop("content", "finish_reason", "error")
        checked = materialise(verdict(done, "validate").select("chunk_id", "chunk_no", "chunk", "block", F.col("v.text").alias("vi"), "failed", F.col("v.ok").alias("ok")), "validated")
        done = checked.where("ok").drop("ok")
        again = checked.where("not ok").drop("ok")
        if passes.retry_whole:
            redone = answered(again.drop("vi"), F.concat(F.lit(HINT), prompt), passes, "translate-again", 0.15).select("chunk_id", "chunk_no", "chunk", "block", vi.alias("vi"), F.col("content").isNull().alias("failed"))
            again = verdict(redone, "validate-again").select("chunk_id", "chunk_no", "chunk", "block", F.col("v.text").alias("vi"), "failed")
        done = done.unionByName(again)
    done = materialise(done, "translated")
    lines = repair_lines(done, passes)
    of_chunk = lines.groupBy("chunk_id", "chunk_no").agg(F.array_sort(F.collect_list(F.when(F.col("vi").isNotNull(), F.struct("line", "vi")))).alias("l"), F.sum(t.has_cjk(t.or_empty("vi")).cast("int")).alias("unresolved"))
    of_chunk = of_chunk.join(done.select("chunk_id", "chunk_no", "failed"), ["chunk_id", "chunk_no"])
    joined = of_chunk.groupBy("chunk_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", F.array_join(F.transform("l", lambda x: x["vi"]), "\n").alias("body")))), lambda x: x["body"]), "\n").alias("body"),
        F.sum("unresolved").alias("unresolved"), F.sum(F.col("failed").cast("bigint")).alias("failed"),
    )
    text = F.when(kept_header, F.concat(header, F.lit("\n\n"), F.col("body"))).otherwise(t.keep_suffix("source_chunk", "body") if passes.translate_header else F.col("body"))
    return joined.join(texts.select("chunk_id", "source_chunk"), "chunk_id").select("chunk_id", text.alias("text"), "unresolved", "failed")


def _packed(text: str, passes: Passes, validator: object | None) -> Column:
    return pack_lines(text, chunk_size(passes, "translate", validate=validator is not None))


def repair_lines(done: DataFrame, passes: Passes) -> DataFrame:
    """``(chunk_id, chunk_no, line, zh, vi)``: lines by position, those with ideographs repaired in up to ``repairs`` rounds.

    A round sends all bad pairs of a chunk in one request, as objects ``{line, zh, vi}``, and takes
    objects ``{line, vi}`` from the answer: only for lines that were sent, the last for each.  A chunk
    without lines keeps one row of nulls.
    """
    place = ["chunk_id", "chunk_no", "line"]
    zipped = F.arrays_zip(t.split_lines("chunk").alias("z"), t.split_lines("vi").alias("v"))
    lines = materialise(done.select("chunk_id", "chunk_no", "block", F.posexplode_outer(zipped).alias("line", "p")).select(*place, "block", F.col("p.z").alias("zh"), F.col("p.v").alias("vi")), "lines")
    for k in range(passes.repairs):
        bad = lines.where(t.has_cjk(t.or_empty("vi")))
        if bad.isEmpty():
            break
        pair = F.to_json(F.struct("line", t.or_empty("zh").alias("zh"), "vi"))
        requests = bad.groupBy("chunk_id", "chunk_no", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", pair.alias("pair")))), lambda x: x["pair"]), "\n").alias("bad_lines"))
        prompt = F.concat(t.fill_template(PROMPTS["fix_lines"], glossary_block="block", bad_lines="bad_lines"), F.lit("\n" * k))  # an unlike prompt, so that a cache asks again
        answers = answered(requests, prompt, passes, f"fix-{k}", 0.05)
        objects = answer_objects(answers.where("error is null"), "content", ["chunk_id", "chunk_no"])
        fixes = objects.select("chunk_id", "chunk_no", F.get_json_object("object", "$.line").try_cast("double").cast("int").alias("line"), F.from_json("object", "vi string")["vi"].alias("fix"), "object_no")
        fixes = fixes.withColumn("fix", t.trim_u("fix"))
        patched = apply_patches(lines, fixes, ["chunk_id", "chunk_no"], "line", "vi", "object_no", "fix", allowed=bad)
        lines = materialise(patched.drop("patched"), "lines")
    return lines.drop("block")


def repair_log(lines: DataFrame, most: int = 24) -> DataFrame:
    """Chunks with lines that still hold ideographs: how many, and the first ``most`` of them; and chunks whose sides differ in lines."""
    bad = F.collect_list(F.when(t.has_cjk(t.or_empty("vi")), F.col("line")))
    counts = lines.groupBy("chunk_id", "chunk_no").agg(F.array_sort(bad).alias("bad"), F.count("zh").alias("zh_lines"), F.count("vi").alias("vi_lines"))
    said = counts.select("chunk_id", "chunk_no", "zh_lines", "vi_lines", (F.col("zh_lines") != F.col("vi_lines")).alias("mismatch"), F.slice("bad", 1, most).alias("remaining"), F.size("bad").alias("remaining_count"))
    return said.where("mismatch or remaining_count > 0")


def backfill_requests(rows: DataFrame, keys: list[str], fields: list[tuple[str, str]], maps: list[str] | None = None, evidences: list[str] | None = None) -> DataFrame:
    """(keys, field, text) of every source text whose translation is blank.

    ``fields`` are pairs of columns; in a map the translation of entry ``k`` is entry ``k_vi``; in a
    list of evidences that of ``evidence_zh`` is ``evidence_vi``.
    """
    wanted = [F.when(~t.blank(s) & t.blank(v), F.struct(F.lit(v).alias("field"), t.trim_u(s).alias("text"))) for s, v in fields]
    lists = [F.array(*wanted)] if wanted else []
    lists += [_untranslated(m) for m in maps or []]
    for e in evidences or []:
        bare = F.filter(F.coalesce(F.col(e), F.array().cast(rows.schema[e].dataType)), lambda x: ~t.blank(x["evidence_zh"]) & t.blank(x["evidence_vi"]))
        lists.append(_texts(bare, f"{e}.evidence_vi"))
    flat = rows.select(*keys, F.explode(F.concat(*lists) if len(lists) > 1 else lists[0]).alias("_w")).where("_w is not null")
    return flat.select(*keys, "_w.field", "_w.text")


def _texts(evidences: Column, field: str) -> Column:
    return F.transform(evidences, lambda x: F.struct(F.lit(field).alias("field"), t.trim_u(x["evidence_zh"]).alias("text")))


def _untranslated(column: str) -> Column:
    """Entries of a map whose translated twin is blank, as (field, text)."""
    known = F.coalesce(F.col(column), F.create_map().cast("map<string,string>"))
    return F.transform(_fillable(known), lambda e: F.struct(F.concat(F.lit(f"{column}."), e["key"], F.lit("_vi")).alias("field"), t.trim_u(e["value"]).alias("text")))


def backfill(rows: DataFrame, keys: list[str], fields: list[tuple[str, str]], passes: Passes, maps: list[str] | None = None, evidences: list[str] | None = None, cache: DataFrame | None = None) -> DataFrame:
    """Rows with missing translations filled (see ``backfill_requests``); each distinct text is asked once, and only once.

    What a request fails for stays blank.  Rows with a null key stay as they are.
    """
    wanted = backfill_requests(rows, keys, fields, maps, evidences)
    texts = wanted.select("text").distinct()
    got = answered(texts, t.fill_template(PROMPTS["translate"], glossary_block=F.lit(NO_BLOCK), user_input="text"), passes, "backfill", 0.2, cache=cache)
    got = got.where("error is null").select("text", t.trim_u(t.or_empty("content")).alias("vi"))
    known = wanted.select(*keys, "text").distinct().join(got, "text").groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("text", "vi"))).alias("_vi"))
    out = rows.join(known, keys, "left")
    said = lambda x: F.try_element_at(F.coalesce("_vi", F.create_map().cast("map<string,string>")), t.trim_u(x))
    for s, v in fields:
        out = out.withColumn(v, F.when(t.blank(v) & ~t.blank(s), F.coalesce(said(F.col(s)), v)).otherwise(F.col(v)))
    for m in maps or []:
        whole = F.coalesce(F.col(m), F.create_map().cast("map<string,string>"))
        filled = F.filter(F.transform(_fillable(whole), lambda e: F.struct(F.concat(e["key"], F.lit("_vi")).alias("key"), said(e["value"]).alias("value"))), lambda e: e["value"].isNotNull())
        names = F.transform(filled, lambda e: e["key"])
        rest = F.map_filter(whole, lambda k, _: ~F.array_contains(names, k))
        out = out.withColumn(m, F.when(F.size(filled) > 0, F.map_concat(rest, F.map_from_entries(filled))).otherwise(F.col(m)))
    for e in evidences or []:
        fill = lambda x: x.withField("evidence_vi", F.when(t.blank(x["evidence_vi"]) & ~t.blank(x["evidence_zh"]), F.coalesce(said(x["evidence_zh"]), x["evidence_vi"])).otherwise(x["evidence_vi"]))
        out = out.withColumn(e, F.transform(e, fill))
    return out.drop("_vi")


def _fillable(known: Column) -> Column:
    """Entries of a map whose translated twin is blank."""
    return F.filter(F.map_entries(known), lambda e: ~e["key"].endswith("_vi") & ~t.blank(e["value"]) & t.blank(F.try_element_at(known, F.concat(e["key"], F.lit("_vi")))))
