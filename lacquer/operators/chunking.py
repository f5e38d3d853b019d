"""Packing lines into chunks, and the sizes chunks may have."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacquer.functions.text import split_nl

#: No chunk limit is taken below this.
LEAST_LIMIT = 64


def pack_lines(text: Column | str, limit: Column | int) -> Column:
    """Chunks of whole lines of at most ``limit`` code points; a longer line is a chunk of its own.

    Joined by line feeds the chunks give the text again.
    """
    limit = F.greatest(F.lit(limit) if isinstance(limit, int) else limit, F.lit(LEAST_LIMIT))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc: Column, line: Column) -> Column:
        full = acc["open"].isNotNull() & (F.length(acc["open"]) + 1 + F.length(line) > limit)
        done = F.when(full, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"])
        opened = F.when(full | acc["open"].isNull(), line).otherwise(F.concat_ws("\n", acc["open"], line))
        return F.struct(done.alias("done"), opened.alias("open"))

    return F.aggregate(split_nl(text), start, step, lambda acc: F.array_append(acc["done"], acc["open"]))


def line_chunks(texts: DataFrame, text_col: str, limit: Column | int, keep: list[str]) -> DataFrame:
    """One row per chunk: ``keep``, ``chunk_no`` (from 0) and ``chunk``; a null text has no chunk."""
    return texts.where(F.col(text_col).isNotNull()).select(*keep, F.posexplode(pack_lines(text_col, limit)).alias("chunk_no", "chunk"))


@dataclass(frozen=True)
class Budget:
    """Token budget of a model's context; all numbers are tokens."""

    context: int = 13000
    safety: int = 400
    completion_extract: int = 1800
    completion_translate: int = 4500
    completion_validate: int = 3200
    glossary: int = 1200
    glossary_extract: int = 900
    completion: tuple[tuple[str, int], ...] = (("timeline", 2500), ("facts", 2300), ("relations", 2300), ("scenes", 2300))
    caps: tuple[tuple[str, int], ...] = (("timeline", 9000), ("facts", 6000), ("relations", 7000), ("scenes", 7000))


def room(budget: Budget, completion: int, shell: int, pad: int) -> int:
    """Code points that fit beside completion, prompt shell and padding: three to a token, 256 at least."""
    return max(256, 3 * (budget.context - budget.safety - completion - shell - pad))


def chunk_limits(budget: Budget, shell_extract: int, shell_translate: int, shell_validate: int, validate: bool) -> tuple[int, int, int]:
    """Chunk sizes of extraction, translation and validation; with validation, translation has to leave room for both texts."""
    extract = room(budget, budget.completion_extract, shell_extract, budget.glossary_extract)
    translate = room(budget, budget.completion_translate, shell_translate, budget.glossary)
    pair = max(256, 3 * max(128, (budget.context - budget.safety - budget.completion_validate - shell_validate) // 2))
    return extract, min(translate, pair) if validate else translate, pair


def stage_limit(budget: Budget, stage: str, used: Column | int) -> Column:
    """Chunk size of a stage beside a prompt of ``used`` tokens, under the stage's cap."""
    completion, cap = dict(budget.completion)[stage], dict(budget.caps)[stage]
    free = F.lit(budget.context - budget.safety - completion) - (F.lit(used) if isinstance(used, int) else used)
    return F.least(F.greatest(F.lit(256), 3 * free), F.lit(cap))
