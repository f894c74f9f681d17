"""All queries outside the optional subpackage, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fjordmill.plans import basic_queries, core, report_queries, source_queries, stream_queries, url_queries

MODULES = [core, url_queries, basic_queries, report_queries, source_queries, stream_queries]
FLAGSHIP = report_queries.a1_metrics


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
