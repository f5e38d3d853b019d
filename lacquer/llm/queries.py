"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lacquer.llm import alignment, boilerplate, leakage, names, spam, splitting, tokenize, truncation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": truncation.p1_found,
    "p1_sources": truncation.p1_sources,
    "p2_found": splitting.p2_found,
    "p2_pieces": splitting.p2_pieces,
    "p2_coverage": splitting.p2_coverage,
    "p3_found": names.p3_found,
    "p3_entities": names.p3_entities,
    "p4_found": alignment.p4_found,
    "p5_found": boilerplate.p5_found,
    "p6_ids": tokenize.p6_ids,
    "p6_round_trip": tokenize.p6_round_trip,
    "p7_found": leakage.p7_found,
    "p7_verbatim": leakage.p7_verbatim,
    "p8_found": spam.p8_found,
}

SQL: dict[str, str] = {
    "p2_found": splitting.P2_FOUND_SQL,
    "p2_coverage": splitting.P2_COVERAGE_SQL,
    "p6_round_trip": tokenize.P6_ROUND_TRIP_SQL,
    "p7_verbatim": leakage.P7_VERBATIM_SQL,
}
