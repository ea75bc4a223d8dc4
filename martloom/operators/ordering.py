"""Whole-table order without a single-task window.

A window without keys runs in one task.  Here the rows are range-partitioned by the
order, sorted inside each partition and written to the shared folder together with
their position.  One small row per partition then carries the offset of everything
before it, so numbers, tiles, running totals and exact quantiles need no global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import cut_lineage

_SHIFT = 33  # fixed value: monotonically_increasing_id keeps the partition above bit 33


def in_order(df: DataFrame, *order: Column, parts: int | None = None) -> DataFrame:
    """``df`` with ``_part`` and ``_pos`` (from 1): its place in the whole order.

    The last order column should be a unique key: it makes the order total and lets
    range partitioning cut through a value that many rows share.  The number of partitions
    follows the session and the size of the data unless ``parts`` says otherwise.
    """
    placed = (df.repartitionByRange(*([parts] if parts else []), *order)
              .sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    kept = cut_lineage(placed)
    return (kept
            .withColumn("_part", F.shiftright("_place", _SHIFT))
            .withColumn("_pos", F.col("_place") - F.shiftleft(F.col("_part"), _SHIFT) + 1)
            .drop("_place"))


def _before(ordered: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per partition, the totals of all earlier partitions and of the table (one row per partition)."""
    per_part = ordered.groupBy("_part").agg(*[total.alias(name) for name, total in totals.items()])
    in_turn = Window.orderBy("_part")
    earlier = in_turn.rowsBetween(Window.unboundedPreceding, -1)
    every = in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_part.select(
        "_part", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name in totals],
        *[F.sum(name).over(every).alias(f"{name}_total") for name in totals])


def _with_before(ordered: DataFrame, totals: dict[str, Column]) -> DataFrame:
    # one row per shuffle partition, so the broadcast is bounded by the partition count
    return ordered.join(F.broadcast(_before(ordered, totals)), "_part")


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """Number the rows 1, 2, ... in a total order."""
    ordered = in_order(df, *order)
    return (_with_before(ordered, {"_rows": F.max("_pos")})
            .withColumn(name, (F.col("_rows_before") + F.col("_pos")).cast("bigint"))
            .drop("_part", "_pos", "_rows_before", "_rows_total"))


def global_ntile(df: DataFrame, tiles: int, order: list[Column], name: str = "tile") -> DataFrame:
    """``ntile(tiles)`` over the whole table: the first ``rows % tiles`` tiles get one row more."""
    ordered = in_order(df, *order)
    total = F.col("_rows_total")
    number = F.col("_rows_before") + F.col("_pos") - 1
    size = F.floor(total / tiles)
    extra = total % tiles
    in_large = extra * (size + 1)
    tile = F.when(number < in_large, F.floor(number / (size + 1))).otherwise(
        extra + F.floor((number - in_large) / F.greatest(size, F.lit(1))))
    return (_with_before(ordered, {"_rows": F.max("_pos")})
            .withColumn(name, (tile + 1).cast("bigint"))
            .drop("_part", "_pos", "_rows_before", "_rows_total"))


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Add, for each entry of ``totals``, its sum up to and including the row and ``<name>_total``.

    Inside a partition the sum is an ordinary window; the offset of earlier partitions
    is added to it.
    """
    ordered = in_order(df.withColumns({f"_in_{n}": c for n, c in totals.items()}), *order)
    joined = _with_before(ordered, {n: F.sum(f"_in_{n}") for n in totals})
    upto = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (joined
            .withColumns({n: F.sum(f"_in_{n}").over(upto) + F.col(f"{n}_before") for n in totals})
            .drop("_part", "_pos", *[f"_in_{n}" for n in totals], *[f"{n}_before" for n in totals]))


def exact_quantiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """Linear-interpolated quantiles: one row per share with ``share, quantile``.

    Equal values are counted together first, so a frequent value is one row.  A value
    is matched to the shares whose position falls into its span of positions.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    spans = running_totals(counted, [F.col(value)], {"upto": F.col("n")})
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    # every span tests the few shares; only the one or two spans of a share pass
    tested = spans.select(F.col(value).cast("double").alias("v"), (F.col("upto") - F.col("n")).alias("first"),
                          (F.col("upto") - 1).alias("last"), "upto_total", wanted)
    place = F.col("share") * (F.col("upto_total") - 1)
    low, high = F.floor(place), F.ceil(place)
    weight = place - low
    picked = tested.select(
        "share", weight.alias("w"),
        F.when((low >= F.col("first")) & (low <= F.col("last")), F.col("v")).alias("low"),
        F.when((high >= F.col("first")) & (high <= F.col("last")), F.col("v")).alias("high"),
    ).filter(F.col("low").isNotNull() | F.col("high").isNotNull())
    return (picked.groupBy("share", "w").agg(F.max("low").alias("low"), F.max("high").alias("high"))
            .select("share", (F.col("low") + (F.col("high") - F.col("low")) * F.col("w")).alias("quantile")))
