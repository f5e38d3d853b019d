"""Chapter files, configuration files and stores."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacquer.functions import text as t
from lacquer.operators.entities import merge_entries, resolve, with_legacy_evidence
from lacquer.operators.merge import evidence_list, evidence_rows, last_row_wins, merge_by_key
from lacquer.sources.jsonl import read_jsonl


def read_chapters(spark: SparkSession, folder: str, pattern: str = "C*.txt", ordered: bool = False) -> DataFrame:
    """``(source_file, text)`` of whole files whose name fits the pattern, by path if ``ordered``."""
    rows = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    rows = rows.select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"))
    return (rows.orderBy("path") if ordered else rows).drop("path")


def write_chapters(rows: DataFrame, path: str) -> None:
    """``(source_file, text)`` as Parquet, overwritten as a whole."""
    rows.select("source_file", "text").write.mode("overwrite").parquet(path)


def export_chapters(rows: DataFrame, folder: str) -> DataFrame:
    """Each text as a file of its own name in a folder all executors share; ``(source_file, bytes)`` of what was written.

    A file is written under another name first, so a repeated task leaves whole files.  Null texts
    and names with a path in them are left out.  The result has to be collected or counted for files to appear.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for name, text in zip(names, batch.column(1).to_pylist(), strict=True):
                body = text.encode()
                part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
                with open(part, "wb") as f:
                    f.write(body)
                os.replace(part, os.path.join(folder, name))
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["source_file", "bytes"])

    good = rows.where(F.col("text").isNotNull() & F.col("source_file").rlike(r"^[^/\x00]+$") & ~F.col("source_file").isin(".", ".."))
    return good.select("source_file", "text").mapInArrow(write, "source_file string, bytes bigint")


def header_summary(statuses: DataFrame) -> DataFrame:
    """``(outcome, files)``: how many headers were updated, skipped or failed."""
    outcome = F.when(F.col("status") == "updated", "updated").when(F.col("status") == "error", "errors").otherwise("skipped")
    return statuses.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("files"))


def header_status(rows: DataFrame, file: str, text: str, force: bool = False) -> DataFrame:
    """``status`` and ``new_text``: the header a file's name asks for, put before its text.

    A name of another form is skipped; so is a text that has the header already, or any header
    unless ``force``.  The input is never changed.
    """
    number = F.regexp_extract(file, r"(?i)^C(\d+)-(.+)\.txt$", 1).try_cast("int")
    title = F.regexp_extract(file, r"(?i)^C(\d+)-(.+)\.txt$", 2)
    expected = t.build_header(number, title, F.col(file))
    body = F.regexp_replace(t.strip_header(text) if force else F.col(text), r"^\x{feff}", "")
    first = t.trim_u(t.or_empty(t.first_text_line(body)))
    status = (
        F.when(number.isNull(), "name")
        .when(F.col(text).isNull(), "error")
        .when(first == expected, "present")
        .when(first.startswith("Chapter ") & F.lit(not force), "other header")
        .otherwise("updated")
    )
    return rows.withColumn("status", status).withColumn("new_text", F.when(F.col("status") == "updated", F.concat(expected, F.lit("\n\n"), body)).otherwise(F.col(text)))


def read_settings(path: str, environment: dict[str, str] | None = None, wanted: Iterable[str] = ()) -> dict[str, str]:
    """``key=value`` lines without comments; what the environment already has wins.

    Of the environment come the keys of the file and the ``wanted`` ones.
    """
    out: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                line = line.strip()
                if line and not line.startswith("#") and "=" in line:
                    key, value = line.split("=", 1)
                    out[key.strip()] = value.strip().strip("\"'")
    known = environment if environment is not None else dict(os.environ)
    return out | {k: known[k] for k in (*out, *wanted) if k in known}


def template_path(root: str, prompts: str, name: str) -> str:
    """Absolute names as they are, names with a slash below the root, bare ones in the prompt folder."""
    if os.path.isabs(name):
        return name
    return os.path.join(root, name) if "/" in name else os.path.join(prompts, name)


def load_store(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """A store read again: the last row of each id; rows without id go."""
    return last_row_wins(rows, keys, order)


def load_events(rows: DataFrame, order: Column, scope: tuple[str, ...] = ("book_id",)) -> DataFrame:
    """An event store read again: ids are made anew, rows that get the same id are merged, rows without title go."""
    titled = rows.where(~t.blank("event_title_zh")).withColumn("chapter_number", F.coalesce("chapter_number", F.lit(0)))
    keyed = titled.withColumn("event_id", t.event_id("chapter_number", "event_title_zh", "entities"))
    keys = [*scope, "event_id"]
    merged = merge_by_key(keyed, keys, order, {"chapter_number": "first", "event_title_zh": "first", "event_summary_zh": "longest", "event_summary_vi": "longest", "entities": "union"})
    if "evidences" not in rows.columns:
        return merged
    fields = {f.name for f in rows.schema["evidences"].dataType.elementType.fields}
    found = evidence_rows(keyed.where("evidences is not null"), keys, "evidences", order, "evidence_zh", [], need_file=True, fallback="evidence" if "evidence" in fields else None)
    return merged.join(evidence_list(found, keys, ["source_file", "evidence_zh"]), keys, "left")


def load_glossary(spark: SparkSession, path: str, scope: tuple[str, ...] = ("book_id",)) -> DataFrame:
    """A glossary read again: ids as slugs, ``unknown`` ones dropped, entries of one id merged, then entries resolved by their names; a missing file is an empty glossary."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    fields = "canonical_id string, kind string, names_zh array<string>, names_vi array<string>, aliases struct<zh:array<string>,vi:array<string>>, evidences array<struct<source_file:string,evidence:string>>, evidence string, source_file string"
    schema = ", ".join([*[f"{s} bigint" for s in scope], fields])
    rows = read_jsonl(spark, path, schema) if there else spark.createDataFrame([], schema)
    return merged_glossary(rows, scope)


def merged_glossary(rows: DataFrame, scope: tuple[str, ...] = ("book_id",)) -> DataFrame:
    """Entries merged by id and then by the best entry of their names; of the ids that meet the smallest row stands first."""
    whole = rows.withColumn("canonical_id", t.slug("canonical_id")).where("canonical_id <> 'unknown'")
    if {"evidence", "source_file"} <= set(rows.columns):
        whole = whole.withColumn("evidences", with_legacy_evidence("evidences", "evidence", "source_file"))
    order = F.struct("canonical_id", F.to_json(F.struct("kind", "names_zh", "names_vi", "aliases", "evidences")).alias("row"))
    once = merge_entries(whole, [*scope, "canonical_id"], order).drop("merged_rows")
    targets = resolve(once, list(scope), "canonical_id", "names_zh", "evidences")
    merged = merge_entries(once.join(targets, [*scope, "canonical_id"]), [*scope, "target"], F.col("canonical_id"))
    return merged.withColumnRenamed("target", "canonical_id").drop("merged_rows")
