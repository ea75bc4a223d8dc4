"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def in_day(ts: Column, day: dt.date | str) -> Column:
    """Rows of one day as a half-open range, which reaches the scan as a pushed filter."""
    start = dt.date.fromisoformat(str(day))
    return in_days(ts, start, start)


def in_days(ts: Column, first: dt.date | str, last: dt.date | str) -> Column:
    """Rows from ``first`` to ``last``, both included, as a half-open range."""
    start = dt.date.fromisoformat(str(first))
    stop = dt.date.fromisoformat(str(last)) + dt.timedelta(days=1)
    return (ts >= F.lit(f"{start}").cast("timestamp_ntz")) & (ts < F.lit(f"{stop}").cast("timestamp_ntz"))


def since_day(ts: Column, day: dt.date | str) -> Column:
    """Rows of ``day`` or later, as a range without an end on the raw column."""
    return ts >= F.lit(f"{dt.date.fromisoformat(str(day))}").cast("timestamp_ntz")


def since_year(ts: Column, year: int) -> Column:
    """Rows of ``year`` or later, again as a range on the raw column."""
    return ts >= F.lit(f"{year}-01-01").cast("timestamp_ntz")


def running_at(start: Column, end: Column, moment: Column | None = None) -> Column:
    """Whether ``moment`` lies inside ``[start, end]``; by default the time of the batch."""
    now = F.current_timestamp() if moment is None else moment
    return (start <= now) & (end >= now)


def span_days(end: Column, start: Column) -> Column:
    """Whole days between two timestamps, cut toward zero."""
    seconds = F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))
    return (seconds / F.lit(86400)).cast("bigint")


def age_day_part(end: Column, start: Column) -> Column:
    """Days left after whole months are taken out of the span ``end - start``.

    A negative span gives the negated day part of the reversed span.
    """
    forward = _day_part(end, start)
    backward = -_day_part(start, end)
    return F.when(end >= start, forward).when(end < start, backward)


def _clock(ts: Column) -> Column:
    """Microseconds since midnight."""
    stamp = ts.cast("timestamp")
    return F.unix_micros(stamp) - F.unix_micros(F.date_trunc("day", stamp))


def _day_part(later: Column, earlier: Column) -> Column:
    borrow_clock = F.when(_clock(later) < _clock(earlier), 1).otherwise(0)
    days = F.dayofmonth(later) - F.dayofmonth(earlier) - borrow_clock
    month_length = F.dayofmonth(F.last_day(earlier))
    return F.when(days < 0, days + month_length).otherwise(days).cast("bigint")


def local_time(utc: Column, zone: str = "Australia/Sydney") -> Column:
    """Wall-clock time of a UTC timestamp in ``zone``."""
    return F.from_utc_timestamp(utc.cast("timestamp"), zone)


def epoch_seconds(seconds: Column) -> Column:
    """Timestamp of a number of seconds since 1970."""
    return F.timestamp_seconds(seconds)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day with the columns of a date dimension."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_actual"))
    return days.select(
        F.date_format("date_actual", "yyyyMMdd").cast("bigint").alias("date_id"),
        "date_actual",
        F.year("date_actual").cast("bigint").alias("year_actual"),
        F.month("date_actual").cast("bigint").alias("month_actual"),
        F.dayofmonth("date_actual").cast("bigint").alias("day_of_month"),
        F.weekofyear("date_actual").cast("bigint").alias("week_of_year"),
        F.date_trunc("week", "date_actual").cast("date").alias("first_day_of_week"),
    )
