"""The queries that are registered for the driver, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom.plans import corpus_queries, crawl_queries, html_queries, page_queries, process_queries, source_queries, url_queries

FAMILIES = (corpus_queries, url_queries, crawl_queries, page_queries, html_queries, process_queries, source_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Return every query by name."""
    return {name: query for family in FAMILIES for name, (query, _) in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Return the SQL of the queries that SQL can express."""
    return {name: sql for family in FAMILIES for name, (_, sql) in family.QUERIES.items() if sql}
