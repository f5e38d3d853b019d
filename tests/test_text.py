"""Text functions against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lacquer.functions import text as t

SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def one(spark, value, expr, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first().y


def test_trim_as_python_strips(spark):
    values = [f"{s}x{s}" for s in SPACES] + ["﻿x", "​x​", "", "   ", None, "a b"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", t.trim_u("x").alias("y")).collect()
    got = {r.i: r.y for r in rows}
    assert all(got[i] == (v.strip() if v is not None else None) for i, v in enumerate(values))


@pytest.mark.parametrize("value", ["", "\n", "a", "a\n", "a\r\nb", "a\rb\x0bc\x0cd\x1ce\x1df\x1eg\x85h i j", "\n\nx\n"])
def test_split_lines_as_python(spark, value):
    assert one(spark, value, t.split_lines("x")) == value.splitlines()


def test_tokens(spark):
    assert [one(spark, v, t.estimate_tokens("x")) for v in ("", "a", "abc", "abcd", None)] == [0, 1, 1, 2, 0]


@pytest.mark.parametrize(("value", "want"), [("Hello  World!", "hello-world"), ("--A__b--", "a__b"), ("陆尘云", "unknown"), (None, "unknown"), ("  x ", "x"), ("a---b", "a-b")])
def test_slug(spark, value, want):
    assert one(spark, value, t.slug("x")) == want


def test_ids_hash_utf8(spark):
    assert one(spark, "陆", t.name_id("x")) == "zh_" + hashlib.sha1("陆".encode()).hexdigest()[:10]
    assert one(spark, "  ", t.name_id("x")) == "unknown"
    assert one(spark, "t", t.scene_id(F.lit(3), "x")) == hashlib.sha1(b"3|t").hexdigest()
    assert one(spark, "t", t.event_id(F.lit(3), "x", F.array(F.lit("b"), F.lit(" a "), F.lit("b"), F.lit(" ")))) == hashlib.sha1(b"3|t|a|b").hexdigest()


def test_fact_key_ignores_translations_and_order(spark):
    a = spark.sql("select map('b','2','a','1','a_vi','z') m").select(t.fact_key("m").alias("k")).first().k
    b = spark.sql("select map('a','1','b','2') m").select(t.fact_key("m").alias("k")).first().k
    c = spark.sql("select map('a','12','b','') m").select(t.fact_key("m").alias("k")).first().k
    assert a == b != c


def test_headers(spark):
    head = "chapter 12 -  A tale | SourceFile: C012-x.txt"
    assert one(spark, head, t.header_number("x")) == 12
    assert one(spark, head, t.header_title("x")) == "A tale"
    assert one(spark, head, t.header_line("x")) == ""  # the prefix is case-sensitive
    assert one(spark, "Chapter 1 - a\nb", t.header_line("x")) == "Chapter 1 - a"
    assert one(spark, "﻿Chapter 1 - a\n\n\nbody", t.strip_header("x")) == "﻿body"
    assert one(spark, "Chapter 1 - a\r\n \t\n　body\n x", t.strip_header("x")) == "　body\n x" and one(spark, "Chapter 1 - a", t.strip_header("x")) == ""
    assert one(spark, "Chapter 1- a\nbody", t.strip_header("x")) == "Chapter 1- a\nbody"
    assert one(spark, "h\n\n\nb\nc", t.after_header("x")) == "b\nc"
    assert one(spark, "T | SourceFile: f.txt\nz", t.keep_suffix("x", F.lit("V \nrest"))) == "V | SourceFile: f.txt\nrest"
    assert one(spark, "T\nz", t.keep_suffix("x", F.lit("V"))) == "V"


@pytest.mark.parametrize(
    ("answer", "want"),
    [("PASS", ("o", True)), ("a\n\n**PASS**\nx", ("o", True)), ("FIXED_VI\nnew\ntext ", ("new\ntext", True)), ("nothing", ("o", False)), ("", ("o", False)), ("```\nPASS\n```", ("o", True)), ("<think>PASS</think>no", ("o", False)), ("`FIXED_VI`", ("", True))],
)
def test_validation(spark, answer, want):
    got = one(spark, answer, t.validation("x", F.lit("o")))
    assert (got.text, got.ok) == want


def test_fences_and_reasoning(spark):
    assert one(spark, "```json\n{}\n```", t.strip_fence("x")) == "{}"
    assert one(spark, "a ``` b", t.strip_fence("x")) == "a ``` b"
    assert one(spark, "x< Think >\nno\n</ THINK> y```thinking\nz```", t.strip_reasoning("x")) == "x y"


@pytest.mark.parametrize(("value", "want"), [("十", 10), ("二十一", 21), ("二百零一", 201), ("一千零五", 1005), ("", 0), ("x三y", 3), ("两百", 100), ("十x二", 12)])
def test_han_numbers(spark, value, want):
    assert one(spark, value, t.han_number("x")) == want


@pytest.mark.parametrize(("value", "want"), [("正文 序章：魔", 0), ("第十二章 x", 12), ("第12章 x", 12), ("none", -1), (None, -1)])
def test_chapter_numbers(spark, value, want):
    assert one(spark, value, t.chapter_number("x")) == want


def test_file_names(spark):
    assert one(spark, 'a/b:c\x01\n ： "d"', t.safe_file_name("x")) == "a b c d"
    assert one(spark, 7, t.file_prefix("x"), "x int") == "C007"
    assert one(spark, 1234, t.file_prefix("x"), "x int") == "C1234"
    assert one(spark, -1, t.file_prefix("x"), "x int") == "CXXX"


def test_template_is_filled_once(spark):
    assert one(spark, "{b} x", t.fill_template("<{a}|{b}>", a="x", b=F.lit("B"))) == "<{b} x|B>"
    with pytest.raises(KeyError):
        t.fill_template("{c}", a="x")


def test_page_parts(spark):
    page = "menu\nSTART\n\n\n\nstory\nmore__\nEND2 x END1"
    assert one(spark, page, t.body_between("x", "START\n", ["END1", "END2"])) == "story\nmore"
    assert one(spark, " nothing\r\nmore\n____ ", t.body_between("x", "START", ["END"])) == "nothing\nmore"
    assert one(spark, "<h1>Site</h1><h2> 第一章 a</h2>", t.page_title("x")) == "第一章 a"
    assert one(spark, "<h1> A </h1>", t.page_title("x")) == "A"
    html = '<a href="/z.html">next</a><a href="p/7.html">next</a>'
    assert one(spark, html, t.next_link("x", "next", F.lit("https://h.x/b/1.html"), r"p/\d+")) == "https://h.x/b/p/7.html"
    assert one(spark, html, t.next_link("x", "next", F.lit("https://h.x/b/1.html"), "none")) == "https://h.x/z.html"
