"""Registry of named queries over the test-data bindings.

Each query is ``fn(spark, sf_dir) -> DataFrame``; most carry an equivalent SQL
text (``ORACLE``) that another engine can run on the same parquet tables.
Double columns are rounded to 6 decimals at this edge only (the operators keep
full precision).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assay.functions.scalar import round_doubles

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, rounded: bool = True):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounded else df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from assay.plans import (queries_core, queries_eval, queries_io,  # noqa: F401
                             queries_ml, queries_star, queries_stream)
