"""All queries of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import operator_queries, scale_queries
from .plans import queries as lens_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = lens_queries.QUERIES | operator_queries.QUERIES | scale_queries.QUERIES
ORACLES: dict[str, str] = lens_queries.ORACLES | operator_queries.ORACLES | scale_queries.ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test tables as a graph, converted to a whole definition."""
    return QUERIES["q_definition_parts"](spark, sf_dir)
