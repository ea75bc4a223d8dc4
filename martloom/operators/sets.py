"""Set operations on frames and edge lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import mirrored


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION: rows of all frames, each once."""
    return union_all(*frames).distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def symmetric_edges(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Edges in both directions, each once.

    Each edge is first stored smaller end first and made distinct; the two directions
    are then written without a second shuffle.
    """
    ordered = edges.select(F.least(left, right).alias(left), F.greatest(left, right).alias(right)).distinct()
    loops = F.col(left) == F.col(right)
    return mirrored(ordered.filter(~loops), left, right).unionByName(ordered.filter(loops))


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Columns to rows."""
    return df.unpivot(keys, columns, name, value)
