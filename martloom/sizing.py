"""Size checks that decide between a broadcast side and a shuffled one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Rows small enough to copy to every task or to write into the plan, bytes
# below which an input is dealt out, and bytes of a piece where the work of a task must not grow with the input.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
LITERAL_ROWS = 2_000
SPREAD_BYTES = 64 * 1024 * 1024
PIECE_BYTES = 4 * 1024 * 1024


def rows_if_bounded(df: DataFrame, bound: int = LITERAL_ROWS) -> list[Row] | None:
    """Rows of ``df`` when there are at most ``bound`` of them, otherwise ``None``.

    At most ``bound + 1`` rows ever reach the driver.
    """
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


def is_bounded(df: DataFrame, bound: int = BROADCAST_ROWS, bound_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``bound`` rows and ``bound_bytes`` of content, both measured."""
    rows, size = df.limit(bound + 1).select(F.length(F.to_json(F.struct("*"))).alias("n")).agg(F.count("*"), F.sum("n")).first()
    return rows <= bound and (size or 0) <= bound_bytes


def broadcast_if_bounded(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after measuring that ``df`` stays within its bounds of rows and bytes.

    Beyond them the frame is returned as it is and the join is shuffled, with adaptive
    execution splitting skewed partitions.
    """
    return F.broadcast(df) if is_bounded(df, bound) else df


def spread_if_small(df: DataFrame, bound_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Deal a small input over all cores before work that is heavy per row.

    A small file is mostly a single row group, which one task reads alone.  The size is
    the planner's own estimate; a larger input already has many tasks and stays as it is.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if estimate <= bound_bytes else df


def spread_in_pieces(df: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Deal an input into pieces of bounded size, for an aggregation whose groups are nearly as many as the rows.

    Its first step holds the groups of a whole task; a task that reads a file split would hold more the larger the split.
    """
    return df.repartition(pieces_of(df, piece_bytes=piece_bytes))


def pieces_of(*inputs: DataFrame, piece_bytes: int = PIECE_BYTES) -> int:
    """Number of pieces of bounded size that the inputs make by the planner's estimate, at least one per core."""
    estimate = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    return max(inputs[0].sparkSession.sparkContext.defaultParallelism, -(-estimate // piece_bytes))
