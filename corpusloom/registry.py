"""Registered queries over the driver's tables, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import check_queries, corpus_queries, extract_queries, vote_queries  # noqa: F401  they register their queries
from .plans.queries import ORACLE, QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of line atoms by language."""
    return QUERIES["q_coverage_by_lang"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
