"""Database tables over JDBC: parallel day-sliced reads and appends.

Connections are arguments; nothing is stored here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def day_slices(column: str, first: dt.date, last: dt.date) -> list[str]:
    """One half-open range predicate per day: each becomes a partition read by its own task."""
    days = (last - first).days + 1
    starts = [first + dt.timedelta(days=i) for i in range(days)]
    return [f"{column} >= TIMESTAMP '{d} 00:00:00' AND {column} < TIMESTAMP '{d + dt.timedelta(days=1)} 00:00:00'"
            for d in starts]


def read_days(spark: SparkSession, url: str, table: str, column: str, first: dt.date, last: dt.date,
              properties: dict[str, str]) -> DataFrame:
    """Scan the given days of a table; ranges and column lists run inside the database."""
    return spark.read.jdbc(url, table, predicates=day_slices(column, first, last), properties=properties)


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    """Scan a whole (small) table, such as a list of subscribers."""
    return spark.read.jdbc(url, table, properties=properties)


def append_rows(df: DataFrame, url: str, table: str, columns: list[str], properties: dict[str, str],
                writers: int = 8) -> None:
    """Append the listed columns with a bounded number of connections."""
    batch = {"batchsize": "10000", **properties}
    df.select(*columns).repartition(writers).write.mode("append").jdbc(url, table, properties=batch)
