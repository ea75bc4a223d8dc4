"""Per-key order operators that stay spread out when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.ordering import in_order


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    One shuffle of reduced rows: an aggregate with map-side combine instead of a ranked window,
    at the price of a local sort of each task's rows (the buffer holds whole rows).  ``order`` should end in a unique column.
    """
    return _extreme(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key; same plan as ``latest_per_key``."""
    return _extreme(df, keys, order, F.min_by)


def _extreme(df, keys, order, choose):
    rest = [c for c in df.columns if c not in keys]
    picked = choose(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def order_slices(df: DataFrame, keys: list[str], order: list[str], name: str = "_slice", parts: int | None = None) -> DataFrame:
    """Add the slice of each row, for the operators that work slice by slice.

    The rows are range-partitioned by key and order, and a slice is a key's share of one
    partition: it never falls when ``order`` rises.  As ``order`` ends in a unique column, a
    key with a third of all rows is cut into many slices, even where all its times are equal.
    """
    placed = in_order(df, *[F.col(c) for c in (*keys, *order)], parts=parts)
    return placed.withColumn(name, F.col("_part")).select(*df.columns, name)


def lag_in_slices(df: DataFrame, keys: list[str], order: list[str], value: str, slice_by: Column,
                  name: str = "previous") -> DataFrame:
    """``lag(value)`` per key, computed slice by slice.

    ``slice_by`` must not fall when ``order`` rises (a day of the timestamp, say).  The
    lag runs inside (key, slice); only the last value of each slice is carried over the
    slice border, so a hot key is spread over its slices.
    """
    sliced = df.withColumn("_slice", slice_by)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = sliced.withColumns({"_local": F.lag(F.struct(value)).over(inside)})
    edges = sliced.groupBy(*keys, "_slice").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    over_slices = Window.partitionBy(*keys).orderBy("_slice")
    carried = edges.select(*keys, "_slice", F.lag("_last").over(over_slices).alias("_carried"))
    return (local.join(carried, [*keys, "_slice"])
            .withColumn(name, F.coalesce("_local", "_carried")[value])
            .select(*df.columns, name))


def number_in_slices(df: DataFrame, keys: list[str], order: list[str], slice_by: Column,
                     name: str = "number") -> DataFrame:
    """``row_number`` per key, computed slice by slice with the counts of earlier slices."""
    sliced = df.withColumn("_slice", slice_by)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    counts = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return (sliced.withColumn("_inside", F.row_number().over(inside))
            .join(offsets, [*keys, "_slice"])
            .withColumn(name, (F.col("_offset") + F.col("_inside")).cast("bigint"))
            .select(*df.columns, name))


def rank_by_day(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """``rank`` of each day of a key, ties included: one more than the rows of earlier days.

    Rows are counted per (key, day) first; the window sees one row per day.
    """
    counts = df.groupBy(*keys, day).agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("rank", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) + 1).cast("bigint"))


def changes(df: DataFrame, keys: list[str], order: list[str], value: str, slice_by: Column) -> DataFrame:
    """Rows whose value differs from the one before it in the same key."""
    marked = lag_in_slices(df, keys, order, value, slice_by, "_before")
    return marked.filter(F.col("_before").isNull() | (F.col("_before") != F.col(value))).drop("_before")


def day_islands(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Runs of consecutive days per key, with first and last day.

    Days are made distinct before numbering, so repeated rows of a day cannot break a
    run, and a key never holds more rows than the calendar has days.
    """
    days = df.select(*keys, day).distinct()
    number = F.dense_rank().over(Window.partitionBy(*keys).orderBy(day))
    return (days.withColumn("_group", F.date_sub(F.col(day), number))
            .groupBy(*keys, "_group").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
            .drop("_group"))


def best_island(islands: DataFrame, owner: list[str], value: str, longest: int) -> DataFrame:
    """Per owner, the value of the run that is longest (capped), then latest, then smallest name."""
    length = F.least(F.datediff("last_day", "first_day"), F.lit(longest))
    scored = islands.select(*owner, value, length.alias("_length"), F.col("last_day"))
    top = scored.groupBy(*owner).agg(F.max(F.struct("_length", "last_day")).alias("_top"))
    tied = scored.join(top, owner).filter(
        (F.col("_length") == F.col("_top._length")) & (F.col("last_day") == F.col("_top.last_day")))
    return tied.groupBy(*owner).agg(F.min(value).alias(value))
