"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medloom.queries import curation, pages, pipelines, records, text_ops

_MODULES = (curation, text_ops, records, pages, pipelines)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in getattr(module, "SQL", {}).items()}
