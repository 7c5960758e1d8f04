"""Collects the registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from .views import Tables, with_views

AS_OF = date(2001, 6, 1)
NOW = datetime(2001, 6, 1, 12, 30, 0)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Registers a function of the tables under a key, with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return build

    return register
