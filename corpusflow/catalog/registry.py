"""Registered queries: each runs an operator over whole tables; most carry the DuckDB text of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusflow.fixtures import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Views:
    """Access to the tables and views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None):
    """Register ``function(views)`` under a name, with the DuckDB text if there is one."""

    def register(function: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: function(Views(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return function

    return register
