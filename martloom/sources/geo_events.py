"""Inputs of the geographic marts as they are delivered: nested events and the city file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.text import decimal_comma
from martloom.schemas import CITY_FILE


def city_file(spark: SparkSession, path: str) -> DataFrame:
    """``id, city, lat, lng`` of a file separated by ``;`` whose numbers have a decimal comma."""
    cities = spark.read.schema(CITY_FILE).option("sep", ";").option("header", True).csv(path)
    return cities.select(F.col("id").cast("bigint").alias("id"), "city", decimal_comma(F.col("lat")).alias("lat"), decimal_comma(F.col("lng")).alias("lng"))


def flat_events(raw: DataFrame) -> DataFrame:
    """Flat events out of ``event_type, event, lat, lon`` with the nested ``event``.

    The user is the sender of a message or reaction and the subscriber of a subscription.  The
    time is ``datetime`` or else ``message_ts``.  Delivered events have no number; where a
    column ``event_id`` is missing, a hash of the event stands in, so equal times have an order.
    """
    number = F.col("event_id") if "event_id" in raw.columns else F.xxhash64("event_type", F.to_json("event"), "lat", "lon")
    user = (F.when(F.col("event_type") == "message", F.col("event.message_from"))
            .when(F.col("event_type") == "reaction", F.col("event.reaction_from")).otherwise(F.col("event.user")))
    return raw.select(
        number.cast("bigint").alias("event_id"), "event_type", user.cast("bigint").alias("user_id"),
        F.col("event.message_to").cast("bigint").alias("message_to"), F.col("event.subscription_channel").cast("bigint").alias("channel"),
        F.coalesce(F.col("event.datetime").cast("timestamp"), F.col("event.message_ts").cast("timestamp")).alias("ts"),
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
