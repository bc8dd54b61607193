"""The query catalog of the core: name -> callable(spark, sf_dir), and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.operators import dedupe, intervals, orphans
from cadenza.plans import queries as core
from cadenza.plans import survey_queries  # noqa: F401  (adds to the queries of core)
from cadenza.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _tables(fn, *names: str) -> Query:
    return lambda spark, sf_dir: fn(*[table(spark, sf_dir, n) for n in names])


def queries() -> dict[str, Query]:
    return {
        "p2_found": _tables(dedupe.found, "job_messages"),
        "p3_found": _tables(orphans.found, "activity_v", "segment_manifest", "story_phrase"),
        "p3_report": lambda s, d: orphans.report(orphans.found(table(s, d, "activity_v"), table(s, d, "segment_manifest"), table(s, d, "story_phrase"))),
        "p4_found": _tables(intervals.found, "word_items", "page_data"),
        # the ways of hot keys, which small tables hardly have: the same results with low thresholds
        "salted_duplicates": lambda s, d: dedupe.found(table(s, d, "job_messages"), part_rows=2, hot_rows=2),
        "sliced_intervals": lambda s, d: intervals.found(table(s, d, "word_items"), table(s, d, "page_data"), hot_rows=4),
        "spread_orphans": lambda s, d: orphans.found(table(s, d, "activity_v"), table(s, d, "segment_manifest"), table(s, d, "story_phrase"), hot_rows=20),
    } | core.QUERIES


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": dedupe.FOUND_SQL,
        "p3_found": orphans.FOUND_SQL,
        "p3_report": orphans.REPORT_SQL,
        "p4_found": intervals.FOUND_SQL,
        "salted_duplicates": dedupe.FOUND_SQL,
        "sliced_intervals": intervals.FOUND_SQL,
        "spread_orphans": orphans.FOUND_SQL,
    } | core.SQL
