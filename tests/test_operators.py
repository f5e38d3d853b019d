"""Operators against brute force, with the edge cases of each."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lacquer.operators import entities as en
from lacquer.operators.chunking import Budget, chunk_limits, line_chunks
from lacquer.operators.context import context_block, in_scope, pending
from lacquer.operators.lines import apply_patches, line_counts, pair_by_position
from lacquer.operators.matching import name_hits, pick_entries, within_budget
from lacquer.operators.merge import evidence_list, evidence_rows, fill_missing_map, last_row_wins, longest_text, merge_by_key
from lacquer.sources.jsonl import answer_objects, balanced_objects
from lacquer.sources.texts import header_status, header_summary, read_settings, template_path

GLOSSARY = "entry_no bigint, canonical_id string, book_id bigint, kind string, names_zh array<string>, names_vi array<string>, aliases struct<zh:array<string>,vi:array<string>>, evidences array<struct<source_file:string,evidence:string>>"


def packed(text, limit):
    limit, chunks, held = max(limit, 64), [], None
    for line in text.split("\n"):
        if held is not None and len(held) + 1 + len(line) > limit:
            chunks.append(held)
            held = line
        else:
            held = line if held is None else held + "\n" + line
    return [*chunks, held]


def test_line_chunks(spark):
    rng = random.Random(5)
    texts = ["", "\n", "x" * 300, "a\n\nb\n", *["\n".join("z" * rng.randint(0, 50) for _ in range(rng.randint(1, 30))) for _ in range(40)]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)] + [(99, None)], "i int, t string")
    for limit in (1, 64, 100):
        got = {}
        for r in line_chunks(rows, "t", limit, ["i"]).collect():
            got.setdefault(r.i, {})[r.chunk_no] = r.chunk
        assert {i: [c[k] for k in sorted(c)] for i, c in got.items()} == {i: packed(x, limit) for i, x in enumerate(texts)}


def test_chunk_limits():
    extract, translate, validate = chunk_limits(Budget(), 1034, 627, 900, True)
    assert extract == 26598 and translate == min(18819, validate)
    assert chunk_limits(Budget(), 1034, 627, 900, False)[1] == 18819
    assert chunk_limits(Budget(context=10), 0, 0, 0, True) == (256, 256, 384)


def test_name_hits_are_brute_force(spark):
    rng = random.Random(3)
    texts = [(i, rng.choice([1, 2, None]), "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))) for i in range(60)] + [(100, 1, None), (101, 1, "")]
    names = [(rng.choice([1, 2]), "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))) for _ in range(30)] + [(1, ""), (1, None), (None, "a")]
    got = {(r.id, r.name, r.occ) for r in name_hits(spark.createDataFrame(texts, "id int, b int, t string"), spark.createDataFrame(names, "b int, name string"), "b", "id", "t").collect()}
    want = {(i, n, t.count(n)) for i, b, t in texts for k, n in names if b is not None and b == k and n and t and n in t}
    assert got == want


@pytest.mark.parametrize(("pins", "most", "kept"), [(0, 2, 2), (1, 2, 2), (2, 2, 3), (3, 2, 4)])
def test_pinned_entries(spark, pins, most, kept):
    rows = [(1, f"e{i}", 10 - i, i < pins) for i in range(6)]
    got = pick_entries(spark.createDataFrame(rows, "id int, e string, score int, pinned boolean"), "id", "e", most).collect()
    assert len(got) == kept and sum(r.pinned for r in got) == pins
    assert [r.e for r in sorted(got, key=lambda r: r.place)] == [f"e{i}" for i in range(kept)]


def test_token_budget_is_a_prefix(spark):
    rows = [(1, i, "x" * n) for i, n in enumerate([5, 3, 90, 1])]
    got = within_budget(spark.createDataFrame(rows, "k int, i int, l string"), ["k"], [F.col("i")], F.col("l"), 3).collect()
    assert sorted(r.i for r in got) == [0, 1]


def glossary(spark, rows):
    return spark.createDataFrame([(i, c, 1, k, zh, vi, None, ev) for i, (c, k, zh, vi, ev) in enumerate(rows)], GLOSSARY)


def test_resolution_is_one_hop(spark):
    e = lambda n: [("f", f"t{k}") for k in range(n)]
    g = glossary(spark, [("A", None, ["a", "b"], None, e(1)), ("B", None, ["b", "c"], None, e(2)), ("C", None, ["c"], None, e(3)), ("D", None, None, None, e(1)), ("E", None, [" ", "a"], None, None)])
    once = {r.canonical_id: r.target for r in en.resolve(g, ["book_id"], "canonical_id", "names_zh", "evidences").collect()}
    assert once == {"A": "B", "B": "C", "C": "C", "D": "D", "E": "A"}
    twice = {r.canonical_id: r.target for r in en.resolve(g, ["book_id"], "canonical_id", "names_zh", "evidences", iterations=2).collect()}
    assert twice["A"] == "C"


def test_merge_entries(spark):
    g = glossary(spark, [("A", " ", ["x", " y "], ["v"], [("f", "e"), ("f", " e ")]), ("A", "item", ["y", "z", None], None, [("", "e2"), ("g", " ")]), ("B", None, None, None, None)])
    got = {r.canonical_id: r for r in en.merge_entries(g, ["canonical_id"], F.col("entry_no")).collect()}
    assert got["A"].kind == "item" and got["A"].names_zh == ["x", "y", "z"] and got["A"].names_vi == ["v"]
    assert [(x.source_file, x.evidence) for x in got["A"].evidences] == [("f", "e"), ("", "e2")]
    assert got["B"].names_zh == [] and got["B"].evidences is None


def test_incoming_ids(spark):
    g = glossary(spark, [("A", None, ["a"], None, [("f", "t")])])
    best = en.best_by_name(g, ["book_id"], "canonical_id", "names_zh", "evidences")
    rows = spark.createDataFrame([(1, 1, ["q", "a"], "own"), (2, 1, ["q"], "Own Id"), (3, 1, ["q"], " "), (4, 1, None, None)], "row int, book_id bigint, names array<string>, model string")
    got = {r.row: r.entry_id for r in en.incoming_ids(rows, best, ["book_id"], "row", "names", "model").collect()}
    assert got[1] == "A" and got[2] == "own-id" and got[3].startswith("zh_") and got[4] == "unknown"


def test_evidence_policies(spark):
    rows = spark.createDataFrame(
        [("k", 1, [("f", "e", None), (" ", "x", None)]), ("k", 2, [("f", " e ", "vi"), ("f", "e", "later"), ("g", None, "z")]), ("n", 3, None)],
        "key string, o int, ev array<struct<source_file:string,evidence_zh:string,evidence_vi:string>>",
    )
    distinct = evidence_rows(rows, ["key"], "ev", F.col("o"), "evidence_zh", ["evidence_vi"], need_file=True)
    got = evidence_list(distinct, ["key"], ["source_file", "evidence_zh", "evidence_vi"]).collect()
    assert [(r.key, [tuple(x) for x in r.evidences]) for r in got] == [("k", [("f", "e", "vi")])]


def test_longest_first_of_equals(spark):
    rows = spark.createDataFrame([(1, 1, "aa"), (1, 2, "bb"), (1, 3, "c"), (2, 1, None), (2, 2, ""), (3, 1, "x"), (3, 2, "yyy")], "k int, o int, s string")
    got = {r.k: r.s for r in rows.groupBy("k").agg(longest_text("s", "o").alias("s")).collect()}
    assert got == {1: "aa", 2: "", 3: "yyy"}


def test_fill_missing_map(spark):
    rows = spark.createDataFrame([("k", 1, {"a": " ", "b": "1"}), ("k", 2, {"a": "x", "b": "2", "c": None}), ("k", 3, {"a": "y", "c": ""})], "k string, o int, m map<string,string>")
    assert fill_missing_map(rows, ["k"], "m", F.col("o")).first().m == {"a": "x", "b": "1", "c": ""}


def test_merge_by_key_is_idempotent(spark):
    rows = spark.createDataFrame([("k", 2, "bb", ["y", "x"]), ("k", 1, "a", ["x", " "]), ("l", 1, None, None)], "k string, o int, s string, l array<string>")
    rule = {"s": "longest", "l": "union"}
    once = merge_by_key(rows, ["k"], F.col("o"), rule)
    again = merge_by_key(once.withColumn("o", F.col("first_seen")), ["k"], F.col("o"), rule)
    assert sorted(map(str, once.select("k", "s", "l").collect())) == sorted(map(str, again.select("k", "s", "l").collect()))
    assert {r.k: r.l for r in once.collect()} == {"k": ["x", "y"], "l": []}


def test_last_row_wins(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), (None, 9)], "k string, o int")
    assert [(r.k, r.o) for r in last_row_wins(rows, ["k"], [F.col("o")]).collect()] == [("a", 3)]


def test_lines(spark):
    rows = spark.createDataFrame([(1, 0, "甲", "a"), (1, 1, "乙", "乙b"), (1, 2, None, "c"), (1, 1, "乙", "乙b")], "p int, line int, zh string, vi string")
    r = line_counts(rows, ["p"], "line", "zh", "vi").first()
    assert (r.source_lines, r.target_lines, r.leaking, r.mismatch) == (2, 3, 1, True)
    patches = spark.createDataFrame([(1, 1, 0, "old"), (1, 1, 1, "new"), (1, 7, 0, "end"), (1, 2, 0, None)], "p int, line int, seq int, fix string")
    got = {x.line: (x.vi, x.patched) for x in apply_patches(rows.dropDuplicates(), patches, ["p"], "line", "vi", "seq", "fix").collect()}
    assert got == {0: ("a", False), 1: ("new", True), 2: ("c", False), 7: ("end", True)}
    allowed = spark.createDataFrame([(1, 1), (1, 8)], "p int, line int")
    got = {x.line: (x.vi, x.patched) for x in apply_patches(rows.dropDuplicates(), patches, ["p"], "line", "vi", "seq", "fix", allowed).collect()}
    assert got == {0: ("a", False), 1: ("new", True), 2: ("c", False)}
    texts = spark.createDataFrame([(1, "a\nb", "x"), (2, None, "")], "i int, s string, t string")
    assert {(x.i, x.line, x.s, x.t) for x in pair_by_position(texts, ["i"], "s", "t").collect()} == {(1, 0, "a", "x"), (1, 1, "b", ""), (2, 0, "", "")}


def test_context(spark):
    rows = spark.createDataFrame([(1, i, f"l{i}") for i in range(5)], "k int, o int, s string")
    assert context_block(rows, ["k"], [F.col("o")], 3, F.col("s")).first().block == "l0\nl1\nl2"
    assert pending(rows, rows.where("o > 2"), ["o"], F.col("s") != "l4").count() == 4
    assert in_scope(rows, rows.where("o = 1"), ["o"]).count() == 1


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet='{}"\'a:1,\\ ', max_size=40))
def test_balanced_objects_parse(text):
    import json

    assert balanced_objects(text) == searched(text)


def searched(text):
    """Objects by a search from every brace anew."""
    import json

    found, at = [], text.find("{")
    while at >= 0:
        depth, quote, end, i = 0, "", -1, at
        while i < len(text) and end < 0:
            c = text[i]
            if quote:
                i += c == "\\"
                quote = "" if c == quote else quote
            elif c in "\"'":
                quote = c
            elif c in "{}":
                depth += 1 if c == "{" else -1
                end = i + 1 if not depth else -1
            i += 1
        try:
            good = end > 0 and isinstance(json.loads(text[at:end]), dict)
        except ValueError:
            good = False
        if good:
            found.append(text[at:end])
        at = text.find("{", end if good else at + 1)
    return found


def test_braces_that_never_close_take_one_walk():
    import time

    began = time.perf_counter()
    assert balanced_objects("{" * 200_000) == [] and balanced_objects('{"a' * 60_000) == [] and balanced_objects("{'" * 60_000 + '"}') == []
    assert balanced_objects("{" * 50_000 + '{"a": 1}' + "}" * 50_000) == ['{"a": 1}'] and time.perf_counter() - began < 5


def test_answer_objects(spark):
    texts = ['```json\n{"a": 1}\nnoise\n[1]\n{"b": \n```', 'so: {"a": {"b": "}"}} and {"c": 2}', "<think>{\"x\":1}</think>none", "{'a: it\"s}", None, "", '{"a": 1, "a": 2}']
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    got = {}
    for r in answer_objects(rows, "t", ["i"]).collect():
        got.setdefault(r.i, []).append(r.object)
    assert got[0] == ['{"a": 1}'] and got[1] == ['{"a": {"b": "}"}}', '{"c": 2}'] and 2 not in got and 4 not in got and 5 not in got


def test_header_status(spark):
    names = ["C001-a.txt", "x.txt", "C002-b.txt", "C003-c.txt", "C004-d.txt"]
    texts = ["body", "body", "\n Chapter 2 - b | SourceFile: C002-b.txt\nz", "Chapter 9 - q\nz", None]
    rows = spark.createDataFrame(list(zip(names, texts, strict=True)), "f string, t string")
    got = {r.f: r.status for r in header_status(rows, "f", "t").collect()}
    assert list(got.values()) == ["updated", "name", "present", "other header", "error"]
    assert {r.outcome: r.files for r in header_summary(header_status(rows, "f", "t")).collect()} == {"updated": 1, "skipped": 3, "errors": 1}
    forced = {r.f: r.new_text for r in header_status(rows, "f", "t", force=True).collect()}
    assert forced["C003-c.txt"] == "Chapter 3 - c | SourceFile: C003-c.txt\n\nz"


def test_settings(tmp_path):
    (tmp_path / "e").write_text("# c\nA=1\nB='2'\nbroken\n")
    assert read_settings(str(tmp_path / "e"), {"A": "9", "Z": "0"}) == {"A": "9", "B": "2"}
    assert read_settings(str(tmp_path / "no"), {"A": "9", "Z": "0"}, ["Z", "Y"]) == {"Z": "0"}
    assert template_path("/r", "/p", "x.txt") == "/p/x.txt" and template_path("/r", "/p", "d/x.txt") == "/r/d/x.txt" and template_path("/r", "/p", "/x") == "/x"
