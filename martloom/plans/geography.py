"""Marts over geotagged events: zone activity, user travel, friend suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.time import local_time
from martloom.operators.aggregates import PAGE_ELEMENTS, ordered_lists
from martloom.operators.geo import nearest_place, within_distance
from martloom.operators.joins import lookup_join, mirrored
from martloom.operators.windows import best_island, changes, day_islands, first_per_key, latest_per_key, order_slices
from martloom.session import cut_lineage


def zone_activity(events: DataFrame, places: DataFrame) -> DataFrame:
    """Messages, reactions, subscriptions and registrations per zone, by week and by month.

    ``events`` has ``event_id, event_type, user_id, ts, lat, lon``.  A registration is the
    first message of a user.  Month figures are added up from the weekly table of the same
    month, so events are counted once.
    """
    def dated(df: DataFrame) -> DataFrame:
        return df.withColumns({"month": F.date_trunc("month", "ts"), "week": F.date_trunc("week", "ts")})

    zoned = dated(nearest_place(events.select("event_id", "event_type", "ts", "lat", "lon"), places, "event_id"))
    # the first message is chosen on the raw coordinates, so its place is looked up once per user
    located = events.filter((F.col("event_type") == "message") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    first = first_per_key(located.select("user_id", "ts", "event_id", "lat", "lon"), ["user_id"], ["ts", "event_id"])
    registrations = dated(nearest_place(first, places, "event_id")).groupBy("month", "week", "zone_id").agg(F.count("*").alias("week_user"))
    kinds = ("message", "reaction", "subscription")
    weekly = zoned.groupBy("month", "week", "zone_id").agg(
        *[F.count(F.when(F.col("event_type") == kind, 1)).alias(f"week_{kind}") for kind in kinds])
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("month", "week", "zone_id")]
    table = weekly.alias("w").join(registrations.alias("r"), same, "left").select(
        "w.*", F.coalesce("r.week_user", F.lit(0)).alias("week_user"))
    # at most six weeks per zone and month
    month = Window.partitionBy("month", "zone_id")
    return table.select("month", "week", "zone_id", *[f"week_{k}" for k in kinds], "week_user",
                        *[F.sum(f"week_{k}").over(month).alias(f"month_{k}") for k in kinds],
                        F.sum("week_user").over(month).alias("month_user"))


def city_events(messages: DataFrame, places: DataFrame) -> DataFrame:
    """Messages with the name of the nearest city in place of their coordinates."""
    zoned = nearest_place(messages, places, "event_id").drop("lat", "lon").withColumnRenamed("zone_id", "id")
    return lookup_join(zoned, places.select("id", "city"), ["id"], "left").drop("id")


def user_travel(messages: DataFrame, places: DataFrame, consecutive_days: int, zone: str = "Australia/Sydney",
                page_elements: int = PAGE_ELEMENTS) -> tuple[DataFrame, DataFrame]:
    """Current city, local time, number of visited cities and home city, and the cities themselves.

    ``messages`` has ``user_id, ts, event_id, lat, lon``.  The first frame has one row per user.
    The second one is its child table ``user_id, page, travel_array``: a journey of more than
    ``page_elements`` cities continues on further pages.
    """
    sliced = order_slices(messages.select("user_id", "ts", "event_id", "lat", "lon"), ["user_id"], ["ts", "event_id"])
    visits = cut_lineage(city_events(sliced, places))
    piece = F.col("_slice")
    current = latest_per_key(visits.drop("_slice"), ["user_id"], ["ts", "event_id"]).select(
        "user_id", F.col("city").alias("act_city"), local_time(F.col("ts"), zone).alias("local_time"))
    legs = cut_lineage(changes(visits, ["user_id"], ["ts", "event_id"], "city", piece))
    counts = legs.groupBy("user_id").agg(F.count("city").alias("travel_count"))
    lists = ordered_lists(legs, ["user_id"], ["ts", "event_id"], "city", piece, "travel_array", page_elements)
    islands = day_islands(visits.select("user_id", "city", F.to_date("ts").alias("day")), ["user_id", "city"], "day")
    home = best_island(islands, ["user_id"], "city", consecutive_days).withColumnRenamed("city", "home_city")
    users = current.join(counts, "user_id", "left").join(home, "user_id", "left").select(
        "user_id", "act_city", "local_time", "travel_count", "home_city")
    return users, lists


def friend_suggestions(messages: DataFrame, subscriptions: DataFrame, places: DataFrame, radius_km: float = 1.0) -> DataFrame:
    """Users to suggest to each other: same zone, close by, shared channel, never talked.

    ``messages`` has ``event_id, user_id, message_to, ts, lat, lon``; ``subscriptions`` has
    ``user_id, channel``.  Partners are looked for only in neighbouring grid cells of the
    same zone among subscribers of the same channel, and crowded cells are split.  Each pair is formed once per
    shared channel, with the smaller id on the left; one exchange by the pair then
    drops the repeats and the pairs that have talked, and the rest is mirrored.
    """
    last = latest_per_key(messages.select("user_id", "ts", "event_id", "lat", "lon"), ["user_id"], ["ts", "event_id"])
    last = nearest_place(last.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()), places, "event_id").select(
        "user_id", "zone_id", "lat", "lon")
    members = cut_lineage(last.join(subscriptions.select("user_id", "channel").distinct(), "user_id"))
    one, other = (members.select(F.col("user_id").alias(f"{side}_user"), "zone_id", "channel", F.col("lat").alias(f"{side}_lat"),
                                 F.col("lon").alias(f"{side}_lon")) for side in ("left", "right"))
    close = within_distance(one, other, radius_km, ("left_lat", "left_lon"), ("right_lat", "right_lon"),
                            on=["zone_id", "channel"], once=("left_user", "right_user"))
    met = (close.select(F.least("left_user", "right_user").alias("user_left"), F.greatest("left_user", "right_user").alias("user_right"), "zone_id")
           .groupBy("user_left", "user_right").agg(F.min("zone_id").alias("zone_id")))
    talked = messages.filter(F.col("message_to").isNotNull() & F.col("user_id").isNotNull()).select(
        F.least("user_id", "message_to").alias("user_left"), F.greatest("user_id", "message_to").alias("user_right")).distinct()
    fresh = met.join(talked, ["user_left", "user_right"], "left_anti")
    return mirrored(fresh, "user_left", "user_right")


def suggestions_report(suggestions: DataFrame, as_of: Column | None = None, zone: str = "Australia/Sydney") -> DataFrame:
    """Suggestions with the time of the run (``as_of``, by default now) in UTC and in local time."""
    now = F.current_timestamp() if as_of is None else as_of
    return suggestions.withColumn("processed_dttm", now).withColumn("local_time", local_time(now, zone))
