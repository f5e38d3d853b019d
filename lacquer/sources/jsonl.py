"""JSON lines, in files and in columns of answers: tolerant, with recovery."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacquer.functions.text import split_lines, strip_fence, strip_reasoning, trim_u


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Objects of a JSON-lines file; broken lines, arrays and scalars go."""
    fields = list((schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields)
    mark = "_corrupt"
    while any(f.name == mark for f in fields):
        mark += "_"
    lines = spark.read.text(path).where(F.ltrim("value").startswith("{"))
    parsed = lines.select(F.from_json("value", T.StructType([*fields, T.StructField(mark, T.StringType())]), {"columnNameOfCorruptRecord": mark}).alias("o")).select("o.*")
    return parsed.where(F.col(mark).isNull()).drop(mark)


def read_answer_files(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """``(source_path, object_no, ...)``: objects of files as models write them.

    Each file is one answer, read whole: fences and blocks of reasoning go, and where no line is an
    object, objects are found by their braces.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), "value")
    objects = answer_objects(files, "value", ["source_path"])
    return objects.select("source_path", "object_no", F.from_json("object", schema).alias("o")).select("source_path", "object_no", "o.*")


def write_jsonl(rows: DataFrame, path: str, order: list[str] | None = None, mode: str = "overwrite") -> None:
    """One object per line; ordered by range if an order is given."""
    (rows.orderBy(*order) if order else rows).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_if_changed(rows: DataFrame, changed: int, path: str, dry_run: bool = False) -> bool:
    """Overwrite only if something changed and it is no rehearsal."""
    if dry_run or not changed:
        return False
    write_jsonl(rows, path)
    return True


def append_rejects(rows: DataFrame, path: str, raw: str = "raw", most: int = 4000) -> None:
    """Append rejected answers with their raw text cut."""
    rows.withColumn(raw, F.substring(raw, 1, most)).write.mode("append").json(path)


def object_lines(text: Column | str, sanitise: bool = True) -> Column:
    """The lines of an answer that are JSON objects, as an array of strings.

    Fences go, and with ``sanitise`` blocks of reasoning; lines that do not parse and lines that
    are arrays or scalars are dropped.
    """
    body = strip_fence(text)
    body = strip_reasoning(body) if sanitise else body
    lines = F.transform(split_lines(body), trim_u)
    return F.filter(lines, lambda x: x.startswith("{") & F.try_parse_json(x).isNotNull())


_TOKEN = re.compile(r"[\\\"'{}]")


def balanced_objects(text: str | None) -> list[str]:
    """Texts of the JSON objects in a string, found by matching braces outside of quotations.

    Both kinds of quotation mark open a string.  Where a candidate does not parse or does not
    close, the search goes on at the next brace.  One walk settles every brace it meets outside of
    quotations, so that braces which never close cost one walk and not one each.
    """
    found: list[str] = []
    if not text or "{" not in text:
        return found
    tokens = [(m.start(), m.group()) for m in _TOKEN.finditer(text)]
    ends: dict[int, int] = {}  # token of an opening brace -> end of its object, or -1

    def walk(first: int) -> None:
        opened, quote, skip = [], "", -1
        for n in range(first, len(tokens)):
            at, c = tokens[n]
            if at == skip:
                continue
            if quote:
                if c == "\\":
                    skip = at + 1
                elif c == quote:
                    quote = ""
            elif c in "\"'":
                quote = c
            elif c == "{":
                opened.append(n)
            elif c == "}":
                ends[opened.pop()] = at + 1
                if not opened:
                    return
        ends.update(dict.fromkeys(opened, -1))

    decode = json.JSONDecoder().raw_decode
    behind = 0
    for n, (at, c) in enumerate(tokens):
        if c != "{" or at < behind:
            continue
        if n not in ends:
            walk(n)
        if ends[n] < 0:
            continue
        try:
            value, end = decode(text, at)
        except (ValueError, RecursionError):
            continue
        if isinstance(value, dict) and end == ends[n]:
            found.append(text[at:end])
            behind = end
    return found


@F.pandas_udf(T.ArrayType(T.StringType()))
def recovered_objects(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``balanced_objects`` over a column."""
    for batch in texts:
        yield batch.map(lambda t: balanced_objects(t))


def answer_objects(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep, object_no, object): the objects of answers, one per line, recovered by braces where no line is one."""
    lined = rows.withColumn("_lines", object_lines(text))
    good = lined.where(F.size("_lines") > 0).select(*keep, F.posexplode("_lines").alias("object_no", "object"))
    body = strip_reasoning(strip_fence(text))
    rest = lined.where((F.size("_lines") == 0) & F.col(text).contains("{")).select(*keep, F.posexplode(recovered_objects(body)).alias("object_no", "object"))
    return good.unionByName(rest)
