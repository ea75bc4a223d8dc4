"""Registry of queries: a Spark function per key and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``key``; ``sql`` is the same result for an SQL engine."""
    def register(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql.strip()
        return function
    return register


def day_text(ts: Column | str) -> Column:
    """Calendar day as text, the same in every session time zone."""
    return F.date_format(ts, "yyyy-MM-dd")


def time_text(ts: Column | str) -> Column:
    """Second-exact time as text."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def big(value: Column | str) -> Column:
    """Integer widened to 64 bits."""
    return (F.col(value) if isinstance(value, str) else value).cast("bigint")
