"""Answers cut off at a field limit or in transfer.

Two kinds of evidence meet.  *Lengths*: for every source the discrete hazard of each length
(results that end there, of those that reach it) is computed by window functions and tested
against the hazards of the neighbouring lengths; lengths that stand out at a controlled false
discovery rate are limits of that source.  *Endings*: each answer is read by what its stage
promises - sentences, a title line, ``zh = vi`` lines, JSON objects with the fields of the
stage - without closing notes, fences and marks put behind.

Most endings decide by themselves, wherever they lie, because transfers also break at lengths
that are no limit.  The others - the last name of a list may be whole or a beginning - are cut
off if the same name is known to go on, or if nothing is known and the length is a limit.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, BROKEN, OPEN = 0, 1, 2

_REPLACED = "�"
#: What can stand behind a text without belonging to it: cut marks and closing notes.
_CUT_MARK = re.compile(r"(?:\s|�|\[\s*(?:\.{3}|…)\s*\]|\(\s*(?:\.{3}|…)\s*\)|\[(?:truncated|cut|còn tiếp|未完)\]|```)+$", re.I)
_RULE = re.compile(r"[-–—~=*_#•\s]")
_NOTE = re.compile(r"[-–—~=*]++\s*+[^\n.!?。！？]{1,24}\s*[-–—~=*]+|[^\W\d_][^\n:：.!?。！？]{1,20}[:：]\s*\d+")
_TICKS = re.compile(r"[\s✔✅☑✓■□◆◇●○★☆※]+$")
_FENCE = re.compile(r"^\s*```[\w-]*[ \t]*\n?|\n?```\s*$")
_SENTENCE_END = re.compile(r"[.!?…。！？]+[\"”’」』）)\]]*$|[\"”’」』][.!?…。！？]*$")
_TERM = re.compile(r"^\s*(\S.*?)\s*=\s*(.*\S)?\s*$")
_HAN = re.compile("[㐀-鿿豈-﫿]")
#: The longest single mark behind a text; longer endings are text.
LONGEST_MARK = 120
_PASS = re.compile(r"^\W*PASS\W*$")

#: The fields of the whole objects of a stage, and the last list or text in them.
FIELDS = {
    "glossary": ("canonical_id", "kind", "names_zh", "names_vi", "evidences"),
    "timeline": ("chapter_number", "event_title_zh", "event_summary_zh", "event_summary_vi", "entities"),
}

READ_SCHEMA = "result_id bigint, source string, length int, body bigint, state int, kind string, key string, value string, final boolean"


def strip_note(text: str) -> str:
    """The text without the rules, or the note on its last lines, behind it; both may be of any length."""
    starts, end = [], len(text.rstrip())
    while len(starts) < 3 and (line_feed := text.rfind("\n", 0, end)) >= 0:  # a note may have a rule on a line before it and one behind
        starts.append(line_feed)
        end = len(text[:line_feed].rstrip())
    for line_feed in reversed(starts):
        if _NOTE.fullmatch(text[line_feed:].strip()):
            return text[:line_feed]
    end = len(text)
    while end and _RULE.match(text[end - 1]):
        end -= 1
    line_feed = text.find("\n", end)
    return text[:line_feed] if 0 <= line_feed < len(text) - 3 else text


def strip_marks(text: str) -> str:
    """The text without blanks, fences, cut marks and closing notes behind it."""
    text = _FENCE.sub("", text.strip())
    while True:
        text = text.rstrip()
        # a single mark is short, so that only the end is searched
        shorter = text[:-LONGEST_MARK] + _CUT_MARK.sub("", text[-LONGEST_MARK:])
        shorter = strip_note(shorter)
        shorter = shorter[:-LONGEST_MARK] + _TICKS.sub("", shorter[-LONGEST_MARK:])
        if shorter == text:
            return text
        text = shorter


def ends_sentence(text: str) -> bool:
    return bool(_SENTENCE_END.search(text[-LONGEST_MARK:]))


def open_quotation(text: str) -> bool:
    """Whether the last paragraph ends inside a quotation."""
    last = text.rsplit("\n", 1)[-1]
    if last.count('"') % 2:
        return True
    return any(last.rfind(a) > last.rfind(b) for a, b in ("“”", "「」", "『』"))


def read_text(content: str) -> int:
    if _PASS.match(content):
        return WHOLE
    body = strip_marks(content)
    if not body:
        return WHOLE if not content.rstrip().endswith(_REPLACED) else BROKEN
    if content.rstrip().rstrip("`\n ").endswith(_REPLACED):
        return BROKEN
    return WHOLE if ends_sentence(body) and not open_quotation(body) else BROKEN


def read_title(content: str, source_file: str | None) -> int:
    body = strip_marks(content)
    if not body:
        return BROKEN
    if source_file and "SourceFile" in body:
        return WHOLE if body.endswith(source_file) else BROKEN
    if re.search(r"\|\s*SourceFile:\s*\S.*\.\w{2,4}$", body):
        return WHOLE
    return BROKEN


def read_json(content: str, stage: str) -> tuple[int, list[str], str | None]:
    """State, the names in the objects, and the last name if it may be a beginning."""
    fields = FIELDS[stage]
    lines = [x for x in _FENCE.sub("", content.replace(_REPLACED, "\0")).split("\n") if x.strip()]
    names: list[str] = []
    last: dict | None = None
    for i, line in enumerate(lines):
        try:
            row = json.loads(line, strict=False)
        except ValueError:
            row = None
        if not isinstance(row, dict):
            if i == len(lines) - 1 or all(not x.strip(" `\0[].…") for x in lines[i + 1 :]):
                return BROKEN, names, None
            continue
        last = row
        if stage == "timeline" and isinstance(row.get("entities"), list):
            names += [x for x in row["entities"] if isinstance(x, str) and x]
    if last is None:
        return (BROKEN if lines else WHOLE), names, None
    if any(f not in last for f in fields):
        return BROKEN, names, None
    if stage == "glossary":
        evidences = last["evidences"] if isinstance(last["evidences"], list) else []
        said = evidences[-1].get("evidence") if evidences and isinstance(evidences[-1], dict) else None
        if evidences and (not isinstance(said, str) or not ends_sentence(said.strip()) or open_quotation(said)):
            return BROKEN, names, None
        return WHOLE, names, None
    entities = last.get("entities")
    if isinstance(entities, list) and entities and isinstance(entities[-1], str):
        return OPEN, names, entities[-1]
    return WHOLE, names, None


def read_terms(content: str) -> tuple[int, list[tuple[str, str]], tuple[str, str] | None]:
    """State, the pairs of the lines, and the last pair if it may be a beginning."""
    body = strip_marks(content)
    lines = [x for x in body.split("\n") if x.strip()]
    pairs = []
    for line in lines:
        m = _TERM.match(line)
        if m and m.group(2):
            pairs.append((m.group(1).strip(), m.group(2).strip()))
    if not lines:
        return WHOLE, pairs, None
    m = _TERM.match(lines[-1])
    if not m or not m.group(2) or content.rstrip().endswith(_REPLACED):
        return BROKEN, pairs, None
    zh, vi = pairs[-1]
    han, words = len(_HAN.findall(zh)), len(vi.split())
    parts = len([p for p in re.split("[·・•]", zh) if p])
    if han and words < (parts if parts > 1 else han):
        return BROKEN, pairs, None
    return OPEN, pairs, (zh, vi)


def read_answers(answers: DataFrame) -> DataFrame:
    """One row per answer that is not blank (``state``), and one per known name (``state`` null)."""

    from lacquer.session import spread

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            known: set[tuple[str, str, str]] = set()
            ids, sources, stages, files, contents, bodies = (batch.column(i).to_pylist() for i in range(6))
            for key, source, stage, file, content, body in zip(ids, sources, stages, files, contents, bodies, strict=True):
                stage = (stage or "").strip().lower()
                kind = name = value = None
                if stage == "title":
                    state = read_title(content, file)
                elif stage in FIELDS:
                    state, names, name = read_json(content, stage)
                    kind = "name" if name else None
                    value = name
                    known.update(("name", n, n) for n in (names[:-1] if name else names))
                elif stage == "terms":
                    state, pairs, last = read_terms(content)
                    if last:
                        kind, (name, value) = "term", last
                        pairs = pairs[:-1]
                    known.update(("term", zh, vi) for zh, vi in pairs)
                    for zh, vi in pairs:
                        han, words = _HAN.findall(zh), vi.split()
                        if len(han) == len(zh) == len(words):
                            known.update(("reading", h, w.lower()) for h, w in zip(han, words, strict=True))
                else:
                    state = read_text(content)
                out.append((key, source, len(content), body, state, kind, name, value, True))
            out += [(None, None, None, None, None, kind, a, b, False) for kind, a, b in known]
            columns = list(zip(*out, strict=True)) if out else [()] * 9
            types = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in READ_SCHEMA.split(", ")])

    rows = answers.where(F.col("content").rlike(r"(?U)\S")).select(
        F.col("result_id").cast("bigint"), "source", "stage", "source_file", "content", F.xxhash64("content").alias("body")
    )
    return spread(rows).mapInArrow(read, READ_SCHEMA)


def length_limits(read: DataFrame, neighbours: int = 25, rate: float = 0.01, least: int = 3) -> DataFrame:
    """``(source, length, ending, reached, p)``: lengths whose hazard stands out among their neighbours.

    Equal answers of a source count once.  The hazard of a length is tested, one-sided, against
    the pooled hazard of the lengths within ``neighbours`` of it, those without endings included.
    Hazards rise by themselves where all lengths end, so that the endings have to stand out among
    those of the same lengths too, as far as any answer reaches; ``p`` is the larger chance.  Within each source the false
    discovery rate is held at ``rate`` (step-up rule).  A source without a name is one source.
    """
    counts = read.where("state is not null").groupBy("source", "length").agg(F.countDistinct("body").alias("ending"))
    order = Window.partitionBy("source").orderBy("length")
    near = order.rangeBetween(-neighbours, neighbours)
    hazards = (
        counts.withColumn("reached", F.sum("ending").over(Window.partitionBy("source").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("at_most", F.max("length").over(Window.partitionBy("source")))
        .withColumn("other", F.sum("ending").over(near) - F.col("ending"))
    )

    def exposure(offset: int) -> Column:
        """Answers that reach a length, summed over all lengths up to this one and ``offset``."""
        shorter = F.sum(F.col("length").cast("bigint") * F.col("ending")).over(order.rangeBetween(Window.unboundedPreceding, offset))
        longer = F.sum("ending").over(order.rangeBetween(offset + 1, Window.unboundedFollowing))
        return F.coalesce(shorter, F.lit(0)) + F.greatest(F.col("length") + offset, F.lit(0)) * F.coalesce(longer, F.lit(0))

    hazards = hazards.withColumn("exposed", exposure(neighbours) - exposure(-neighbours - 1) - F.col("reached")).withColumn(
        "slots", F.least(F.col("length") + neighbours, F.col("at_most")) - F.greatest(F.col("length") - neighbours, F.lit(1))
    )

    @F.pandas_udf("double")
    def tail(ending: pd.Series, expected: pd.Series) -> pd.Series:
        """Chance of so many or more where so many are expected."""

        def one(k: int, mean: float) -> float:
            if k <= 0:
                return 1.0
            below = math.fsum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(k)) if mean > 0 else 1.0
            return max(0.0, 1.0 - below)

        return pd.Series([one(int(k), float(m)) for k, m in zip(ending, expected, strict=True)])

    # half an event stands for what was not seen; where nothing is near, nothing stands out
    by_hazard = F.when(F.col("exposed") > 0, F.col("reached") * (F.col("other") + 0.5) / F.col("exposed")).otherwise(F.col("reached"))
    by_count = F.when(F.col("slots") > 0, (F.col("other") + 0.5) / F.col("slots")).otherwise(F.col("reached"))
    # the chance falls with what is expected
    tested = hazards.withColumn("p", tail("ending", F.greatest(by_hazard.cast("double"), by_count.cast("double"))))
    ranked = tested.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy("p", "length"))).withColumn(
        "tests", F.count("*").over(Window.partitionBy("source"))
    )
    steps = ranked.withColumn("last", F.max(F.when(F.col("p") <= rate * F.col("rank") / F.col("tests"), F.col("rank"))).over(Window.partitionBy("source")))
    return steps.where((F.col("rank") <= F.col("last")) & (F.col("ending") >= least)).select("source", "length", "ending", "reached", "p")


def find_truncated(answers: DataFrame, neighbours: int = 25, rate: float = 0.01) -> DataFrame:
    """``(result_id, source, length, at_limit, cut)`` for every answer that is not blank.

    Null and blank contents have no row; a null source is one source; unknown stages are read as
    running text; repeated rows have repeated results; further columns are ignored.
    """
    from lacquer.session import materialise

    read = materialise(read_answers(answers), "answers-read")
    limits = materialise(length_limits(read, neighbours, rate), "length-limits").select(F.col("source").alias("of"), F.col("length").alias("limit_at"))
    rows = read.where("state is not null")
    rows = rows.join(limits, rows.source.eqNullSafe(limits["of"]) & (F.col("length") == F.col("limit_at")), "left").withColumn("at_limit", F.col("limit_at").isNotNull()).drop("of", "limit_at")

    known = read.where("state is null").select("kind", "key", "value").distinct()
    ask = rows.where(f"state = {OPEN}").select("kind", "key", "value").distinct()
    # terms: the same zh with a longer vi that begins alike, against the same vi
    terms = known.where("kind = 'term'").select(F.col("key").alias("k"), F.col("value").alias("v"))
    asked = ask.where("kind = 'term'")
    by_term = asked.join(terms, asked.key == terms.k).groupBy("kind", "key", "value").agg(
        F.max(F.col("v") == F.col("value")).alias("same"), F.max(F.col("v").startswith(F.col("value")) & (F.length("v") > F.length("value"))).alias("longer")
    )
    # else the reading of its last character against its last word
    readings = known.where("kind = 'reading'").select(F.col("key").alias("k"), F.col("value").alias("v"))
    last = asked.withColumn("char", F.substring("key", -1, 1)).withColumn("word", F.lower(F.element_at(F.split("value", r"\s+"), -1)))
    by_char = last.join(readings, last.char == readings.k).groupBy("kind", "key", "value").agg(
        F.max(F.col("v") == F.col("word")).alias("same_r"), F.max(F.col("v").startswith(F.col("word")) & (F.length("v") > F.length("word"))).alias("longer_r")
    )
    # names: seen as such elsewhere, or the beginning of one seen elsewhere; every beginning of a known name is looked up
    length = F.length("value")
    begun = known.where("kind = 'name'").select(F.explode(F.transform(F.sequence(F.lit(1), length), lambda n: F.substring(F.col("value"), F.lit(1), n))).alias("begin"), "value")
    begun = begun.groupBy("begin").agg(F.max(F.col("begin") == F.col("value")).alias("same"), F.max(F.length("begin") < length).alias("longer"))
    by_name = ask.where("kind = 'name'").join(begun, F.col("value") == F.col("begin")).select("kind", "key", "value", "same", "longer")
    verdict = (
        ask.join(by_term.unionByName(by_name), ["kind", "key", "value"], "left")
        .join(by_char, ["kind", "key", "value"], "left")
        .withColumn("seen", F.coalesce("same", F.lit(False)) | (F.col("same").isNull() & F.coalesce("same_r", F.lit(False))))
        .withColumn("goes_on", F.coalesce("longer", F.lit(False)) | (F.col("longer").isNull() & F.coalesce("longer_r", F.lit(False))))
        .select("kind", "key", "value", "seen", "goes_on")
    )
    # only the open endings meet the verdicts, one for each kind and name; the others have nothing to look up
    opened = rows.where(f"state = {OPEN}").join(verdict, ["kind", "key", "value"], "left")
    opened = opened.select("result_id", "source", "length", "at_limit", (~F.col("seen") & (F.col("goes_on") | F.col("at_limit"))).alias("cut"))
    return rows.where(f"state <> {OPEN}").select("result_id", "source", "length", "at_limit", (F.col("state") == BROKEN).alias("cut")).unionByName(opened)


def truncation_by_source(answers: DataFrame) -> DataFrame:
    """``(source, results, cut_results, cut_share)``: how often each source breaks off."""
    return find_truncated(answers).groupBy("source").agg(
        F.count("*").alias("results"), F.sum(F.col("cut").cast("bigint")).alias("cut_results"), F.avg(F.col("cut").cast("double")).alias("cut_share")
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return find_truncated(table(spark, sf_dir, "chat_results")).where("cut").select("result_id")


def p1_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return truncation_by_source(table(spark, sf_dir, "chat_results"))


__all__ = ["find_truncated", "length_limits", "p1_found", "p1_sources", "read_answers", "strip_marks", "truncation_by_source"]
