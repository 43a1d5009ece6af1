"""Registered queries: (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shelfline.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query, name: str | None = None) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[name or fn.__name__] = run
    return run


def query_named(name: str) -> Callable[[Query], Query]:
    """For a query called like the operator it runs."""
    return lambda fn: query(fn, name)
