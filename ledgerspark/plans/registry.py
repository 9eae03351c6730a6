"""Registration of queries and of the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .lakeview import oracle_with, view

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Lake:
    """The lake-shaped views of one directory, by attribute; ``given`` ones are tables that are there already."""

    given: dict[str, DataFrame] | None = None

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return view(self.spark, self.sf_dir, name, self.given)


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), recursive: bool = False):
    """Register ``f(lake)`` as a query; ``sql`` is its oracle over ``views``, which it may use like tables."""

    def register(f: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Lake(spark, sf_dir))
        if sql is not None:
            body = sql.strip()
            if views:
                head = oracle_with(*views)
                body = f"{head},\n{body[4:].lstrip()}" if body[:5].upper() == "WITH " else f"{head}\n{body}"
            ORACLES[name] = body.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else body
        return f

    return register
