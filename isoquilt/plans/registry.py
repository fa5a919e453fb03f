"""Registry of named queries and the SQL each is checked against."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isoquilt.plans import testbed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, needs: str = "", sql: str | None = None):
    """Register a query; ``needs`` lists the domain tables its SQL is built on."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = testbed.with_tables(needs.split(), sql)
        return fn

    return add
