"""All queries of the training-data problems, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medloom.llm import queries as _queries
from medloom.llm import sql as _sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_sql.SQL)
