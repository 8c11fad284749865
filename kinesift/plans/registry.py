"""All queries of the core, by name, and the SQL that states the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import census_queries, curation, decision_queries, geometry_queries, series_queries

MODULES = (curation, series_queries, decision_queries, census_queries, geometry_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
