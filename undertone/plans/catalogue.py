"""Queries and SQL of the core operators, by name."""

from __future__ import annotations

import importlib
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from undertone.plans import base
from undertone.sources.ship import ship

FAMILIES = ("sampling_queries", "text_queries", "eval_queries", "row_queries", "array_queries", "source_queries", "drift_queries", "more_queries", "extension_queries")


def shipped(query):
    """``query`` with the package sent to the executors first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def _load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"undertone.plans.{family}")


def queries() -> dict:
    _load()
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(base.SQL)
