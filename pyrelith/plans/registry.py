"""Named queries with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyrelith.sources.surrogate import load, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(*views: str, sql: str | None = None):
    """Register a function of the named views' DataFrames; ``sql`` is its twin over the same views."""

    def wrap(f: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*load(spark, sf_dir, *views))

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = oracle(sql, *[v for v in views if v.startswith("v_")])
        return f

    return wrap
