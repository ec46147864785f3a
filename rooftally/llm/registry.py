"""Registration of this subpackage's queries, apart from those of the rest of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register
