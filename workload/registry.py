"""Named queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hearthstream.session import configure
from workload import twins

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    operators: str
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(operators: str, sql: str | None, *ctes: str, name: str | None = None):
    """Register a function as a query.

    ``operators`` are the inventory ids it covers; ``sql`` is the body of the
    twin and ``ctes`` the shared definitions it builds on.
    """

    def register(build: Build) -> Build:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        text = None if sql is None else twins.with_ctes(sql, *ctes)
        QUERIES[key] = Query(key, operators, configured, text)
        return build

    return register
