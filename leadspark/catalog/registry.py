"""Named queries: a Spark callable and, where SQL can say it, its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Input tables by attribute: ``t.customer`` reads ``<dir>/customer.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A new folder for a query that writes and reads back."""
        return f"{shared_dir(self.spark)}/catalog/{name}-{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under a name."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
