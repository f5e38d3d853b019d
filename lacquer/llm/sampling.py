"""Bounded, repeatable samples to train on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

_CELLS = 1 << 24


def bounded_rows(rows: DataFrame, id_col: str, columns: list[Column], most: int, salt: str, fit: Column | None = None) -> list[Row]:
    """At most ``most`` rows of these columns that ``fit``, those whose id has the smallest hashes.

    Only rows under a hash threshold that leaves about half as many again are gathered, so what
    comes to the driver does not grow with the table or its partitions.  The threshold follows from the
    number of all rows, which files know without being read; where many do not fit, the sample is smaller.
    """
    total = rows.count()
    if not total:
        return []
    cell = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(salt)), F.lit(_CELLS))
    names = [f"c{i}" for i in range(len(columns))]
    picked = (rows if fit is None else rows.where(fit)).select(cell.alias("cell"), *[c.alias(n) for c, n in zip(columns, names, strict=True)])
    if total > 2 * most:
        picked = picked.where(F.col("cell") < int(_CELLS * min(1.0, (1.5 * most + 100) / total)))
    return picked.orderBy("cell", *names).limit(most).select(*names).collect()


def bounded_texts(rows: DataFrame, id_col: str, text_col: str, most: int, salt: str, fit: Column | None = None) -> list[str]:
    """``bounded_rows`` of one column."""
    return [r[0] for r in bounded_rows(rows, id_col, [F.col(text_col)], most, salt, fit)]
