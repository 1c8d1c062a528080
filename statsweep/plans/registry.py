"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` per name.

Builders live in ``statsweep.plans.catalog``; their DuckDB oracle SQL in
``statsweep.plans.oracle`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}


def query(name: str) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        return fn

    return deco
