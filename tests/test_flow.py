"""Sources, sinks, provider, passes and streaming end to end."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle

from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from lacquer.operators.merge import merge_by_key
from lacquer.plans.passes import append_log, event_context, fact_context, prompt_report, run_all, with_context
from lacquer.plans.pipeline import HINT, Passes, backfill, extract_events, repair_log, translate
from lacquer.plans.provider import Answer, HttpProvider, Retry, StubProvider, ask, switch
from lacquer.session import clear_work, materialise, shared_dir, small_rows
from lacquer.sources.jsonl import append_rejects, read_answer_files, read_jsonl, write_if_changed, write_jsonl
from lacquer.sources.texts import export_chapters, load_events, load_glossary, read_chapters
from lacquer.streaming.incremental import latest_version, merge_batch, store_version, upsert_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHAPTERS = "chunk_id bigint, book_id bigint, source_file string, chapter_number int, source_chunk string"
GLOSSARY = "canonical_id string, book_id bigint, kind string, names_zh array<string>, names_vi array<string>"


class Leaky:
    """Leaves ideographs; repairs with objects for what was sent, twice, and for what was not."""

    def chat(self, prompt, max_tokens, temperature):
        if "Translate." in prompt:
            return Answer("x\n好")
        sent = [json.loads(line)["line"] for line in prompt.rsplit("\n---\n", 1)[-1].split("\n") if line.startswith("{")]
        return Answer("well:\n" + "\n".join(f'{{"line": "{n}", "vi": "{w}"}}' for n in [*sent, 0, 77] for w in ("tệ", " tốt ")))


class Broken:
    def chat(self, prompt, max_tokens, temperature):
        if "bad" in prompt:
            raise OSError("down")
        return Answer("fine")


def sample(spark):
    chapters = spark.createDataFrame([(1, 1, "C001-a.txt", 1, "陆尘云来了。\n他走了。"), (2, 1, "C002-b.txt", 2, None), (3, 2, "C003-c.txt", None, "")], CHAPTERS)
    return chapters, spark.createDataFrame([("a", 1, "character", ["陆尘云"], ["Lục Trần Vân"])], GLOSSARY)


def test_jsonl_round_trip(spark, tmp_path):
    path = str(tmp_path / "o")
    rows = spark.createDataFrame([("b", None), ("a", "陆")], "k string, v string")
    write_jsonl(rows, path, ["k"])
    assert sorted((r.k, r.v) for r in read_jsonl(spark, path, "k string, v string").collect()) == [("a", "陆"), ("b", None)]
    (tmp_path / "x.jsonl").write_text('{"k": "1"}\n[{"k": "2"}]\nbroken {\n{"k": \n3\n')
    assert [r.k for r in read_jsonl(spark, str(tmp_path / "x.jsonl"), "k string").collect()] == ["1"]
    assert not write_if_changed(rows, 0, path) and not write_if_changed(rows, 1, path, dry_run=True) and write_if_changed(rows, 1, path)
    append_rejects(spark.createDataFrame([("x" * 5000,)], "raw string"), str(tmp_path / "r"))
    assert len(spark.read.json(str(tmp_path / "r")).first().raw) == 4000


def test_chapter_files(spark, tmp_path):
    (tmp_path / "C001-a.txt").write_text("one\ntwo")
    (tmp_path / "notes.txt").write_text("no")
    assert [(r.source_file, r.text) for r in read_chapters(spark, str(tmp_path)).collect()] == [("C001-a.txt", "one\ntwo")]
    for k in (3, 2, 10):
        (tmp_path / f"C{k:03d}-a.txt").write_text("x")
    assert [r.source_file for r in read_chapters(spark, str(tmp_path), ordered=True).collect()] == [f"C{k:03d}-a.txt" for k in (1, 2, 3, 10)]


def test_small_rows_refuse_growth(spark):
    with pytest.raises(ValueError):
        small_rows(spark.range(10), 5, "numbers")


def test_provider_errors_and_cache(spark):
    asked = spark.createDataFrame([("ok",), ("ok",), ("bad",), (None,)], "prompt string")
    got = ask(asked, Broken(), 10, retry=Retry(attempts=2, longest=0.01)).collect()
    assert sorted((r.content, r.error is None) for r in got if r.content) == [("fine", True)] and len(got) == 2
    again = ask(asked, StubProvider(), 10, cache=spark.createDataFrame(got, "request_hash string, content string, finish_reason string, error string"))
    assert sorted(r.content == "fine" for r in again.collect()) == [False, True]


def test_event_pass_repeats_itself(spark):
    chapters, glossary = sample(spark)
    run = lambda: sorted(r.event_id for r in extract_events(chapters, glossary, Passes(provider=StubProvider("jsonl"))).collect())
    assert run() == run() and len(run()) == 2


class Speaker:
    """Answers every stage with objects of its form."""

    def chat(self, prompt, max_tokens, temperature):
        stage = prompt.split("\n", 1)[0]
        if "names" in stage:
            return Answer('{"canonical_id": "New One", "kind": "character", "names_zh": ["陆尘云", "尘云"], "evidences": [{"source_file": "", "evidence": "陆尘云来了。"}]}\n{"canonical_id": "x", "names_zh": []}')
        if "facts" in stage:
            return Answer('{"entity_id": "a", "facts": {"state": "here", "state_vi": "x"}, "evidences": [{"source_file": "f", "evidence_zh": "e"}]}\n{"entity_id": " ", "facts": {}}\n{"chapter_number": "3.7", "entity_id": "b"}')
        if "relations" in stage:
            return Answer('{"chapter_number": 5, "source_entity": "a", "relation_type": "serves", "target_entity": "b", "summary_zh": "s"}')
        if "scenes" in stage:
            return Answer('noise {"scene_title_zh": "t", "scene_summary_zh": null, "entities": ["b", "a", "b", " "]}')
        if "events" in stage:
            return Answer('{"event_title_zh": "t", "event_summary_zh": "s", "entities": []}')
        return Answer("Chapter 1 - x\ndone")


def test_all_passes(spark, tmp_path):
    chapters, glossary = sample(spark)
    glossary = glossary.withColumn("aliases", F.lit(None).cast("struct<zh:array<string>,vi:array<string>>")).withColumn("evidences", F.lit(None).cast("array<struct<source_file:string,evidence:string>>"))
    stores, text = run_all(chapters, glossary, Passes(provider=Speaker(), repairs=0))
    entries = {(r.book_id, r.canonical_id): r for r in stores.glossary.collect()}
    assert entries[1, "a"].names_zh == ["陆尘云", "尘云"] and entries[1, "a"].evidences[0].source_file == "C001-a.txt" and (2, "new-one") in entries
    facts = stores.facts.collect()
    assert sorted((r.chapter_number, r.entity_id) for r in facts) == [(0, "a"), (1, "a")] and facts[0].facts == {"state": "here", "state_vi": "x"} and facts[0].evidences[0].evidence_zh == "e"
    assert sorted((r.book_id, r.chapter_number, r.summary_zh) for r in stores.edges.collect()) == [(1, 5, "s"), (2, 5, "s")]
    assert all(r.entities == ["b", "a"] and r.scene_summary_zh == "" for r in stores.scenes.collect())
    assert stores.events.count() == 2 and {r.chunk_id for r in text.collect()} == {1, 3} and [e["stage"] for e in stores.log] == ["entries", "events", "facts", "relations", "scenes", "translate"]
    append_log(spark, stores, str(tmp_path / "log"), "r1")
    assert spark.read.json(str(tmp_path / "log")).count() == 6


def test_prompt_report(spark):
    chunk = spark.createDataFrame([("Chapter 1 - a\nb",)], "chunk string")
    got = {r.stage: r for r in prompt_report(chunk, {"events": Speaker(), "translate": Speaker(), "validate": StubProvider("validate"), "facts": Broken()}, only=("events", "translate", "validate")).collect()}
    assert got["events"].objects == 1 and got["translate"].header and got["translate"].same_lines and got["validate"].verdict and "facts" not in got


def test_http_provider():
    import http.server
    import json
    import threading

    replies = [{"choices": [{"message": {"content": " ", "reasoning_content": "r"}, "finish_reason": "stop"}]}, {"choices": []}]
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps(replies[len(seen) - 1]).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    provider = HttpProvider.from_settings({"LLM_BASE_URL": f"http://127.0.0.1:{server.server_port}/", "LLM_API_KEY": "k", "LLM_SEND_LIMIT": "0"})
    assert provider.chat("p", 5, 0.1) == Answer("r", "stop")
    with pytest.raises(RuntimeError):
        provider.chat("p", 5, 0.1)
    server.shutdown()
    assert seen[0][0] == "/v1/chat/completions" and seen[0][1] == "Bearer k" and "max_tokens" not in seen[0][2]


def test_settings_of_provider_and_retries(tmp_path):
    (tmp_path / ".env").write_text("LLM_MODEL=m\nLLM_SEND_LIMIT=off\n")
    provider = HttpProvider.from_environment(str(tmp_path / ".env"), {"LLM_MODEL": "n", "LLM_TIMEOUT_S": "7", "OTHER": "x"})
    assert (provider.model, provider.timeout, provider.send_limit) == ("n", 7.0, False)
    assert Retry.from_settings({"LLM_MAX_RETRIES": "5"}).attempts == 5 and Retry.from_settings({}).attempts == 3
    assert [switch({"A": x}, "A", True) for x in ("0", "No", "", "x")] == [False, False, True, True] and not switch({"A": " "}, "A", True, empty=False) and switch({}, "A", True)


def test_repair_log(spark):
    lines = spark.createDataFrame([(1, 0, i, "z", "好" if i % 2 else "x") for i in range(60)] + [(2, 0, 0, "z", "x"), (3, 0, 0, "z", None)], "chunk_id int, chunk_no int, line int, zh string, vi string")
    got = {r.chunk_id: r for r in repair_log(lines).collect()}
    assert set(got) == {1, 3} and got[1].remaining == list(range(1, 48, 2)) and got[1].remaining_count == 30 and got[3].mismatch and got[3].remaining == []


def test_translation_repairs_leaks(spark):
    chapters, glossary = sample(spark)
    rows = {r.chunk_id: r for r in translate(chapters, glossary, Passes(provider=Leaky())).collect()}
    assert {k: r.text for k, r in rows.items()} == {1: "x\ntốt", 3: "x\ntốt"} and all((r.unresolved, r.failed) == (0, 0) for r in rows.values())
    unrepaired = translate(chapters, glossary, Passes(provider=Leaky(), repairs=0)).where("chunk_id = 1").first()
    assert (unrepaired.text, unrepaired.unresolved) == ("x\n好", 1)


class Twice:
    """Translates better when told that the first try did not pass."""

    def chat(self, prompt, max_tokens, temperature):
        return Answer("second" if prompt.startswith(HINT) and temperature == 0.15 else "first")


class Strict:
    def chat(self, prompt, max_tokens, temperature):
        return Answer("FIXED_VI\nthird" if prompt.endswith("second") else "no idea")


class NeverContent:
    def chat(self, prompt, max_tokens, temperature):
        return Answer("what?")


def test_what_does_not_pass_is_translated_again(spark):
    chapters, glossary = sample(spark)
    text = lambda validator, **how: {r.chunk_id: r.text for r in translate(chapters, glossary, Passes(provider=Twice(), **how), validator).collect()}
    assert text(Strict()) == {1: "third", 3: "third"}
    assert text(NeverContent()) == {1: "second", 3: "second"} and text(Strict(), retry_whole=False) == {1: "first", 3: "first"}
    assert text(StubProvider("validate")) == {1: "first", 3: "first"} and text(Broken()) == {1: "second", 3: "second"}


def test_headers_of_translations(spark):
    _, glossary = sample(spark)
    source = "Chapter 3 - 门 | SourceFile: C003-门.txt\n\n他来了。"
    chapters = spark.createDataFrame([(1, 1, "C003-门.txt", 3, source)], CHAPTERS)
    text = lambda **how: translate(chapters, glossary, Passes(provider=Twice(), repairs=0, **how)).first().text
    assert text() == "first | SourceFile: C003-门.txt"
    assert text(translate_header=False) == source.split("\n")[0] + "\n\nfirst"
    assert text(translate_header=False, dry_run=True) == source.split("\n")[0] + "\n\n[DRY-RUN]他来了。..." and text(dry_run=True).startswith("[DRY-RUN]Chapter 3")


def test_failed_chunks_are_counted(spark):
    chapters, glossary = sample(spark)
    rows = translate(chapters.where("chunk_id = 1").withColumn("source_chunk", F.lit("bad")), glossary, Passes(provider=Broken(), repairs=0)).collect()
    assert [(r.text, r.failed) for r in rows] == [("", 1)]


def test_chapters_of_two_books_share_no_context(spark):
    """Equal titles and chapter numbers in two books are two events, and each book sees its own."""
    events = spark.createDataFrame([(1, "e", 1, "t", "uno", ["a"], 1), (2, "e", 1, "t", "two", ["a"], 1), (1, "f", 1, "u", "more", [], 2)], "book_id bigint, event_id string, chapter_number int, event_title_zh string, event_summary_zh string, entities array<string>, first_seen int")
    chapters = spark.createDataFrame([(1, 1, 1), (2, 2, 1), (3, 2, None)], "chunk_id bigint, book_id bigint, chapter_number int")
    blocks = spark.createDataFrame([(1, "names")], "chunk_id bigint, glossary_block string")
    got = {r.chunk_id: r.glossary_block for r in with_context(blocks, chapters, event_context(events, 10)).collect()}
    assert got[1].split("\n")[0] == "names" and "uno" in got[1] and "more" in got[1] and "two" not in got[1]
    assert "two" in got[2] and "uno" not in got[2] and got[2].startswith("(none)") and got[3] == "(none)"
    facts = spark.createDataFrame([(b, f"k{b}{e}", 1, e, {"x": f"{b}"}, None, 1) for b in (1, 2) for e in ("a", "b")], "book_id bigint, fact_id string, chapter_number int, entity_id string, facts map<string,string>, evidences array<string>, first_seen int")
    scope = spark.createDataFrame([(1, 1, "a"), (2, 7, "b")], "book_id bigint, chapter_number int, entity_id string")
    assert [(r.book_id, r.rows_in_block) for r in fact_context(facts, scope).collect()] == [(1, 1)]


def test_backfill_of_maps_and_evidences(spark):
    schema = "i int, facts map<string,string>, evidences array<struct<source_file:string,evidence_zh:string,evidence_vi:string>>"
    rows = spark.createDataFrame([(1, {"a": "甲", "b": " ", "c": "乙", "c_vi": "có", "d": "丁", "d_vi": " "}, [("f", "甲", None), ("f", "丙", "có"), ("f", " ", None)]), (2, None, None)], schema)
    got = {r.i: r for r in backfill(rows, ["i"], [], Passes(), maps=["facts"], evidences=["evidences"]).collect()}
    facts = got[1].facts
    assert set(facts) == {"a", "a_vi", "b", "c", "c_vi", "d", "d_vi"} and facts["a_vi"].endswith("] 甲") and facts["c_vi"] == "có" and facts["d_vi"].endswith("] 丁")
    assert [e.evidence_vi for e in got[1].evidences] == [facts["a_vi"], "có", None] and got[2].facts is None and got[2].evidences is None
    bad = spark.createDataFrame([(1, "bad", None)], "i int, zh string, vi string")
    assert backfill(bad, ["i"], [("zh", "vi")], Passes(provider=Broken())).first().vi is None


def test_backfill_asks_once(spark, tmp_path):
    class Counting:
        def chat(self, prompt, max_tokens, temperature):
            with open(f"{tmp_path}/calls", "a") as f:
                f.write("x")
            return Answer("v")

    rows = spark.createDataFrame([(i, "甲" if i % 2 else "乙", None) for i in range(9)], "i int, zh string, vi string")
    out = backfill(rows, ["i"], [("zh", "vi")], Passes(provider=Counting()))
    assert out.count() == 9 and {r.vi for r in out.collect()} == {"v"}
    assert (tmp_path / "calls").read_text() == "xx"


def test_backfill(spark):
    rows = spark.createDataFrame([(1, "甲", None), (2, "甲", "có"), (3, None, None)], "i int, zh string, vi string")
    got = {r.i: r.vi for r in backfill(rows, ["i"], [("zh", "vi")], Passes()).collect()}
    assert got[1] and got[2] == "có" and got[3] is None


def test_incremental_upsert(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    rule = {"s": "longest", "l": "union", "f": "first", "z": "last"}
    schema = "k string, o int, s string, l array<string>, f string, z string"
    seen = []

    def run(*rows, checkpoint="cp"):
        if rows:
            seen.extend(rows)
            spark.createDataFrame(list(rows), schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        upsert_stream(stream, store, ["k"], ["o"], rule, str(tmp_path / checkpoint), buckets=4).awaitTermination()
        got = {r.k: (r.o, r.s, r.l, r.f, r.z) for r in latest_version(spark, store)[1].collect()}
        whole = merge_by_key(spark.createDataFrame(seen, schema), ["k"], F.col("o"), rule)
        assert got == {r.k: (r.first_seen, r.s, r.l, r.f, r.z) for r in whole.collect()}
        return got

    assert run(("a", 1, "x", ["p"], " ", "1"), ("a", 5, "y", [], "five", "5"))["a"] == (1, "x", ["p"], "five", "5")
    # what comes late finds its place: neither the last value nor the first one of the store is replaced by what lies between
    assert run(("a", 3, "z", ["q", "p"], "three", "3"), ("b", 1, "y", [], None, None))["a"] == (1, "x", ["p", "q"], "three", "5")
    assert run() == run()
    assert run(("a", 7, "longer", ["r"], "seven", "7"), checkpoint="fresh")["a"] == (1, "longer", ["p", "q", "r"], "three", "7")
    assert len(list((tmp_path / "store" / "manifests").glob("[0-9]*"))) <= 2


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([(f"k{i}", 1, "x") for i in range(40)], "k string, o int, s string")
    assert merge_batch(rows, store, ["k"], ["o"], {"s": "longest"}, "q", 0, buckets=8)
    assert merge_batch(rows.where("k = 'k3'").withColumn("s", F.lit("longer")), store, ["k"], ["o"], {"s": "longest"}, "q", 1)
    assert not merge_batch(rows, store, ["k"], ["o"], {"s": "longest"}, "q", 1)
    number, manifest = store_version(spark, store)
    assert number == 1 and sorted(manifest["buckets"].values()) == ["0"] * 7 + ["1"]
    assert {r.k: r.s for r in latest_version(spark, store)[1].collect()} == {f"k{i}": "longer" if i == 3 else "x" for i in range(40)}


def test_shared_folder_is_local_only_on_one_machine(spark):
    class Conf:
        def __init__(self, **known):
            self.known = {k.replace("_", "."): v for k, v in known.items()}

        def get(self, key, default=None):
            return self.known.get(key, default)

    class Session:
        def __init__(self, **known):
            self.conf = Conf(**known)

    with pytest.raises(ValueError):
        shared_dir(Session(spark_master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_dir(Session(spark_master="local-cluster[2,1,512]"))
    assert shared_dir(Session(spark_master="yarn", spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y" and shared_dir(Session(spark_master="local[4]")).startswith("file:")


def test_work_is_cleared(spark):
    kept = materialise(spark.range(3), "cleared")
    path = kept.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and clear_work(spark) > 0 and not os.path.exists(path)


def test_answer_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('```json\n{"k": "1"}\nbroken\n```')
    (tmp_path / "b.jsonl").write_text('<think>{"k": "0"}</think> so {"k": "2"} and {"k":\n"3"}')
    assert sorted((r.object_no, r.k) for r in read_answer_files(spark, str(tmp_path), "k string").collect()) == [(0, "1"), (0, "2"), (1, "3")]
    lines = tmp_path / "c.jsonl"
    lines.write_text('{"k": "1", "_corrupt": "own"}\nnoise {\n{"k": ')
    for schema in ("k string, _corrupt string", StructType.fromDDL("k string, _corrupt string")):
        assert [(r.k, r._corrupt) for r in read_jsonl(spark, str(lines), schema).collect()] == [("1", "own")]


def test_chapters_are_exported(spark, tmp_path):
    rows = spark.createDataFrame([("a.txt", "một"), ("b.txt", None), ("../c.txt", "x"), ("..", "x")], "source_file string, text string")
    assert [tuple(r) for r in export_chapters(rows, str(tmp_path / "out")).collect()] == [("a.txt", 5)]
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["a.txt"] and (tmp_path / "out" / "a.txt").read_text() == "một"


def test_stores_are_read_again(spark, tmp_path):
    events = spark.createDataFrame(
        [(1, 1, "t", "a", None, ["x"], [("f", None, "old"), ("f", "", "no")], 1), (1, 1, " t ", "longer", "v", [" x "], [("f", "new", None)], 2), (2, 1, "t", "b", None, ["x"], None, 1), (1, None, " ", "", "", [], None, 1)],
        "book_id bigint, chapter_number int, event_title_zh string, event_summary_zh string, event_summary_vi string, entities array<string>, evidences array<struct<source_file:string,evidence_zh:string,evidence:string>>, at int",
    )
    got = {r.book_id: r for r in load_events(events, F.col("at")).collect()}
    assert set(got) == {1, 2} and got[1].event_summary_zh == "longer" and got[1].entities == ["x"] and [e.evidence_zh for e in got[1].evidences] == ["old", "new"]
    path = str(tmp_path / "g.jsonl")
    assert load_glossary(spark, path).count() == 0
    (tmp_path / "g.jsonl").write_text('{"book_id": 1, "canonical_id": "A B", "names_zh": ["甲"], "evidence": " old ", "source_file": "f"}\n{"book_id": 1, "canonical_id": "a-b", "kind": "item", "names_zh": ["乙"]}\n{"book_id": 1, "canonical_id": "c", "names_zh": ["乙"]}\n{"book_id": 1, "canonical_id": " "}\n')
    entries = load_glossary(spark, path).collect()
    assert [(r.canonical_id, r.kind, sorted(r.names_zh), r.evidences[0].evidence) for r in entries] == [("a-b", "item", ["乙", "甲"], "old")]
