"""The queries of the document operators, each beside the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_MODULES = ("pages", "planning", "rendering", "cleaning", "matching", "reports", "progress", "parsing", "streams")

#: Bytes of a batch that goes to Python: whole documents by the 10,000, Spark's own limit, are too much for a worker.
BATCH_BYTES = 4 << 20


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its SQL."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        @wraps(function)
        def bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
            return function(spark, sf_dir)

        QUERIES[name] = bounded
        if sql:
            # count_if gives another integer type there than count
            SQL[name] = re.sub(r"count_if\(([^()]*)\)", r"count(CASE WHEN \1 THEN 1 END)", sql)
        return function

    return add


def load() -> None:
    for module in _MODULES:
        import_module(f"leafmill.catalog.{module}")
