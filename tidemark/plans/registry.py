"""Name to query and SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the DuckDB SQL for the same rows and columns."""

    def register(run: Query) -> Query:
        @wraps(run)
        def with_utc(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf)

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = with_utc
        if oracle is not None:
            ORACLES[name] = oracle
        return with_utc

    return register
