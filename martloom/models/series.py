"""Time series: resampling to hours, calendar and lag features, time-ordered folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.ordering import global_ntile


def hourly(df: DataFrame, ts: str, amount: Column | None = None) -> DataFrame:
    """``hour, n`` for every hour between the first and the last row, empty hours as 0."""
    counts = df.groupBy(F.date_trunc("hour", ts).alias("hour")).agg(
        (F.count("*") if amount is None else F.sum(amount)).alias("n"))
    ends = counts.agg(F.min("hour").alias("first"), F.max("hour").alias("last"))
    hours = ends.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return hours.join(counts, "hour", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def features(series: DataFrame, lags: list[int]) -> DataFrame:
    """Day of month, hour and earlier values of an hourly series.

    The window has no key, but the series has one row per hour: some ten thousand a year,
    however many events were counted.
    """
    order = Window.orderBy("hour")
    return series.select(
        "hour", "n", F.dayofmonth("hour").cast("bigint").alias("day"), F.hour("hour").cast("bigint").alias("hour_of_day"),
        *[F.lag("n", k).over(order).alias(f"lag_{k}") for k in lags])


def time_folds(df: DataFrame, folds: int, ts: str, key: str) -> DataFrame:
    """Add ``fold`` 0..folds: equal slices of time order.

    A model for fold ``i`` is trained on all earlier folds, hence strictly on the past;
    fold 0 is only ever trained on.
    """
    return global_ntile(df, folds + 1, [F.col(ts), F.col(key)], "fold").withColumn("fold", F.col("fold") - 1)


def train_and_test(folded: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Rows before a fold and the rows of the fold."""
    return folded.filter(F.col("fold") < fold), folded.filter(F.col("fold") == fold)
