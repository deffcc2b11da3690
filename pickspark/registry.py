"""Queries of the library by name, and the equivalent SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans.fixtures import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of the views."""

    def put(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return f

    return put


from . import queries  # noqa: E402,F401  fills the tables
