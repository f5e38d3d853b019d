"""Text functions as column expressions: all run inside the JVM, in whole-stage code where Spark can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a full Unicode trim removes: white space and the four information separators.
_SPACE = r"[\s\x1c-\x1f]"
TRIM_PATTERN = rf"(?U)^{_SPACE}+|{_SPACE}+$"
#: The ten line-breaking characters of universal newlines; CRLF is one break.
LINE_BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Blocks of model reasoning, removed in this order.
REASONING = (
    r"<\s*think\s*>[\s\S]*?</\s*think\s*>",
    r"<\s*redacted_reasoning\s*>[\s\S]*?</\s*redacted_reasoning\s*>",
    r"<thinking>[\s\S]*?</thinking>",
    r"<reasoning>[\s\S]*?</reasoning>",
    r"```(?:think|thinking|reasoning)[\s\S]*?```",
)
SUFFIX_PATTERN = r"\s*\|\s*SourceFile:.*$"
HEADER_PATTERN = r"(?i)^Chapter\s+(\d+)\s*-\s*(.+)$"
CJK_PATTERN = r"[\x{4e00}-\x{9fff}]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_u(x: Column | str) -> Column:
    """Without Unicode white space at both ends; null stays null."""
    return F.regexp_replace(_c(x), TRIM_PATTERN, "")


def blank(x: Column | str) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(trim_u(x), F.lit("")) == ""


def or_empty(x: Column | str) -> Column:
    return F.coalesce(_c(x), F.lit(""))


def split_nl(x: Column | str) -> Column:
    """Lines divided at the line feed alone, empty ones kept."""
    return F.split(_c(x), "\n", -1)


def split_lines(x: Column | str) -> Column:
    """Lines divided at every line-breaking character, without the empty piece behind the last break."""
    parts = F.split(_c(x), LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def estimate_tokens(x: Column | str) -> Column:
    """A third of the code points, rounded up; 0 for an empty or null text."""
    n = F.coalesce(F.length(_c(x)), F.lit(0))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), ((n + 2) / 3).cast("int"))).cast("int")


def header_line(x: Column | str) -> Column:
    """The first line if it is a chapter header, else an empty string."""
    first = F.try_element_at(split_lines(x), F.lit(1))
    return F.when(trim_u(first).startswith("Chapter "), first).otherwise("")


def header_number(x: Column | str) -> Column:
    got = F.regexp_extract(trim_u(x), HEADER_PATTERN, 1)
    return F.when(got != "", got.try_cast("int"))


def strip_suffix(x: Column | str) -> Column:
    return trim_u(F.regexp_replace(_c(x), r"(?i)" + SUFFIX_PATTERN, ""))


def header_title(x: Column | str) -> Column:
    got = F.regexp_extract(trim_u(x), HEADER_PATTERN, 2)
    return F.when(got != "", strip_suffix(got))


def keep_suffix(source: Column | str, target: Column | str) -> Column:
    """The target with the source's file suffix on its first line, if it lacks one."""
    suffix = trim_u(F.regexp_extract(trim_u(F.try_element_at(split_lines(source), F.lit(1))), r"(?i)(\|\s*SourceFile:.*)$", 1))
    target = _c(target)
    lines = split_lines(target)
    first = F.try_element_at(lines, F.lit(1))
    fixed = F.concat(F.regexp_replace(first, r"(?U)\s+$", ""), F.lit(" "), suffix)
    joined = F.array_join(F.concat(F.array(fixed), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")
    return F.when((suffix != "") & first.isNotNull() & ~first.rlike(r"(?i)\|\s*SourceFile:"), joined).otherwise(target)


def build_header(number: Column | str, title: Column | str, file: Column | str) -> Column:
    return F.format_string("Chapter %d - %s | SourceFile: %s", _c(number), trim_u(title), _c(file))


def strip_header(x: Column | str) -> Column:
    """Without a leading chapter header and the blank lines behind it; a byte-order mark stays."""
    return F.regexp_replace(_c(x), r"(?U)^(\x{feff}?)Chapter\s+\d+\s+-\s+[^\r\n]+(?:\r?\n|$)(?:[\s&&[^\r\n]]*\r?\n)*(?:[\s&&[^\r\n]]+$(?!\n))?", "$1")


def after_header(x: Column | str) -> Column:
    """Everything behind the first line, without leading line feeds."""
    lines = split_nl(x)
    return F.regexp_replace(F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), "\n"), r"^\n+", "")


def split_header(x: Column | str) -> Column:
    """``struct(header, body)``: the header line and the lines behind it, or no header and the text as it is."""
    lines = split_lines(x)
    first = F.try_element_at(lines, F.lit(1))
    body = F.regexp_replace(F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), "\n"), r"^\n+", "")
    there = trim_u(first).startswith("Chapter ")
    return F.when(there, F.struct(first.alias("header"), body.alias("body"))).otherwise(F.struct(F.lit("").alias("header"), F.when(F.size(lines) == 0, "").otherwise(_c(x)).alias("body")))


def strip_fence(x: Column | str) -> Column:
    """Without a Markdown fence around the trimmed text."""
    t = trim_u(x)
    return F.when(t.startswith("```"), trim_u(F.regexp_replace(F.regexp_replace(t, r"^```[a-zA-Z0-9]*\s*", ""), r"\s*```$", ""))).otherwise(t)


def strip_reasoning(x: Column | str) -> Column:
    """Without blocks of model reasoning, trimmed."""
    out = _c(x)
    for block in REASONING:
        out = F.regexp_replace(out, "(?i)" + block, "")
    return trim_u(out)


def slug(x: Column | str) -> Column:
    """Lower-case id of ASCII letters, digits, underscores and single hyphens; ``unknown`` if nothing remains."""
    s = F.regexp_replace(F.lower(trim_u(or_empty(x))), "[^a-z0-9_-]+", "-")
    s = F.regexp_replace(F.regexp_replace(s, "-{2,}", "-"), "^-+|-+$", "")
    return F.when(s == "", "unknown").otherwise(s)


def name_id(x: Column | str) -> Column:
    """An id from the hash of a name; ``unknown`` for a blank one."""
    t = trim_u(or_empty(x))
    return F.when(t == "", "unknown").otherwise(F.concat(F.lit("zh_"), F.substring(F.sha1(t.cast("binary")), 1, 10)))


def clean_list(xs: Column | str) -> Column:
    """Trimmed, non-blank, distinct strings in order of first appearance; null counts as empty."""
    xs = F.coalesce(_c(xs), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(xs, lambda x: trim_u(F.coalesce(x, F.lit("")))), lambda x: x != ""))


def event_id(chapter: Column | str, title: Column | str, entities: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", _c(chapter).cast("string"), trim_u(or_empty(title)), F.array_join(F.array_sort(clean_list(entities)), "|")).cast("binary"))


def edge_id(chapter: Column | str, source: Column | str, relation: Column | str, target: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", _c(chapter).cast("string"), trim_u(or_empty(source)), trim_u(or_empty(relation)), trim_u(or_empty(target))).cast("binary"))


def scene_id(chapter: Column | str, title: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", _c(chapter).cast("string"), trim_u(or_empty(title))).cast("binary"))


def fact_key(facts: Column | str) -> Column:
    """A key of a map of facts without its translated twins: sorted entries, each with its length."""
    kept = F.map_filter(_c(facts), lambda k, v: ~k.endswith("_vi"))
    rows = F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat_ws("=", F.length(e["key"]).cast("string"), e["key"], or_empty(e["value"])))
    return F.sha1(F.array_join(rows, "\n").cast("binary"))


def fact_id(chapter: Column | str, entity: Column | str, facts: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", _c(chapter).cast("string"), trim_u(or_empty(entity)), fact_key(facts)).cast("binary"))


def fill_template(template: str, **values: Column | str) -> Column:
    """One pass over the template's places; a place without a value is an error, text in values is left alone."""
    import re

    pieces = re.split(r"\{([a-z_]+)\}", template)
    missing = [p for p in pieces[1::2] if p not in values]
    if missing:
        raise KeyError(f"no value for {missing}")
    return F.concat(*[or_empty(values[p]) if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def validation(output: Column | str, original: Column | str) -> Column:
    """``struct(text, ok)`` of a validator's answer: PASS keeps the original, FIXED_VI brings a new text."""
    cleaned = strip_reasoning(strip_fence(output))
    lines = split_lines(cleaned)
    bare = F.transform(lines, lambda x: trim_u(F.regexp_replace(trim_u(x), r"^[*`]+|[*`]+$", "")))
    verdict = F.transform(bare, lambda x: x.isin("PASS", "FIXED_VI"))
    at = F.array_position(verdict, F.lit(True)).cast("int")
    word = F.try_element_at(bare, F.when(at > 0, at).otherwise(1))
    fixed = trim_u(F.array_join(F.slice(lines, at + 1, F.size(lines)), "\n"))
    original = _c(original)
    return F.when((at > 0) & (word == "PASS"), F.struct(original.alias("text"), F.lit(True).alias("ok"))).when(at > 0, F.struct(fixed.alias("text"), F.lit(True).alias("ok"))).otherwise(
        F.struct(original.alias("text"), F.lit(False).alias("ok"))
    )


def normal_space(x: Column | str) -> Column:
    """Line feeds as line ends, runs of blanks and tabs as one blank, trimmed."""
    return trim_u(F.regexp_replace(F.regexp_replace(_c(x), r"\r\n?", "\n"), "[ \t]+", " "))


def safe_file_name(x: Column | str) -> Column:
    """Characters no file system takes become blanks, control characters go."""
    return normal_space(F.regexp_replace(F.regexp_replace(_c(x), '[\\\\/:*?"<>|：]', " "), r"[\x00-\x1f]", ""))


def han_number(x: Column | str) -> Column:
    """The value of a Han numeral, digit and unit folded from the left; other characters are passed over."""
    digits = F.create_map(*[F.lit(v) for pair in ((c, i) for i, c in enumerate("零一二三四五六七八九")) for v in pair])
    powers = F.create_map(*[F.lit(v) for pair in (("十", 10), ("百", 100), ("千", 1000)) for v in pair])
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("digit"))

    def step(acc: Column, c: Column) -> Column:
        d, u = F.try_element_at(digits, c), F.try_element_at(powers, c)
        return (
            F.when(d.isNotNull(), F.struct(acc["total"].alias("total"), d.alias("digit")))
            .when(u.isNotNull(), F.struct((acc["total"] + F.when(acc["digit"] == 0, 1).otherwise(acc["digit"]) * u).alias("total"), F.lit(0).alias("digit")))
            .otherwise(acc)
        )

    return F.aggregate(F.split(or_empty(x), ""), start, step, lambda acc: acc["total"] + acc["digit"])


def chapter_number(title: Column | str) -> Column:
    """0 for a prologue, the number between 第 and 章, else -1."""
    t = or_empty(title)
    strict = F.regexp_extract(t, "第([零一二三四五六七八九十百千]+)章", 1)
    inner = trim_u(F.when(strict != "", strict).otherwise(F.regexp_extract(t, "第(.+?)章", 1)))
    value = F.when(inner.rlike("^[0-9]+$"), inner.try_cast("int")).otherwise(han_number(inner))
    return F.when(t.contains("序章"), 0).when(inner != "", value).otherwise(-1)


def file_prefix(number: Column | str) -> Column:
    """``C000`` and on, ``CXXX`` for an unknown number."""
    n = _c(number)
    return F.when(n.isNull() | (n < 0), "CXXX").otherwise(F.format_string("C%03d", n))


def body_between(x: Column | str, start: str, ends: list[str]) -> Column:
    """What stands between a start pattern (or the beginning) and the earliest end mark behind it.

    Line ends become line feeds, a rule at the end goes, and there is at most one empty line in a row.
    """
    text = trim_u(F.regexp_replace(_c(x), r"\r\n?", "\n"))
    tail = F.regexp_replace(text, rf"^[\s\S]*?(?:{start})", "")
    cut = F.least(*[F.when(F.locate(e, tail) > 0, F.locate(e, tail)).otherwise(F.length(tail) + 1) for e in ends], F.length(tail) + 1)
    body = trim_u(F.substring(tail, F.lit(1), cut - 1))
    return F.regexp_replace(F.regexp_replace(body, r"\n?_{2,}\s*$", ""), r"\n{3,}", "\n\n")


def page_title(html: Column | str, mark: str = "第") -> Column:
    """The first that is not blank: h2 with a mark, h1 with one, h2, h1."""
    h = _c(html)

    def tag(name: str, inner: str) -> Column:
        got = normal_space(F.regexp_replace(F.regexp_extract(h, rf"(?is)<{name}[^>]*>({inner})</{name}>", 1), "<[^>]+>", ""))
        return F.nullif(got, F.lit(""))

    return F.coalesce(tag("h2", rf"[^<]*{mark}[^<]*"), tag("h1", rf"[^<]*{mark}[^<]*"), tag("h2", r".*?"), tag("h1", r".*?"), F.lit(""))


def next_link(html: Column | str, label: str, base: Column | str, prefer: str) -> Column:
    """The address of the link with a label, one that fits a pattern first, relative ones made absolute."""
    links = F.regexp_extract_all(_c(html), F.lit(rf'(?is)<a[^>]*href="([^"]+)"[^>]*>[^<]*{label}[^<]*</a>'), F.lit(1))
    fitting = F.filter(links, lambda u: u.rlike(prefer))
    url = F.coalesce(F.try_element_at(fitting, F.lit(1)), F.try_element_at(links, F.lit(1)))
    root = F.regexp_extract(_c(base), r"^(https?://[^/]+)", 1)
    folder = F.regexp_extract(_c(base), r"^(https?://.*/)", 1)
    return F.when(url.rlike("^https?://"), url).when(url.startswith("/"), F.concat(root, url)).otherwise(F.concat(folder, url))


def has_cjk(x: Column | str) -> Column:
    """Whether a text has an ideograph; null has none."""
    return F.coalesce(_c(x).rlike(CJK_PATTERN), F.lit(False))


def first_text_line(x: Column | str) -> Column:
    """The first line that is not blank, or null."""
    return F.try_element_at(F.filter(split_nl(x), lambda v: trim_u(v) != ""), F.lit(1))
