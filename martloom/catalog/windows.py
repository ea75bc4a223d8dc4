"""Window operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.catalog import standins as data
from martloom.catalog.registry import query, time_text
from martloom.operators import ordering, windows
from martloom.plans.customers import rfm_inputs
from martloom.tables import table


@query("w01_global_ntile", """
SELECT c_custkey, CAST(ntile(5) OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS tile FROM customer""")
def w01(spark, base):
    customers = table(spark, base, "customer").select("c_custkey", "c_acctbal")
    return ordering.global_ntile(customers, 5, [F.col("c_acctbal"), F.col("c_custkey")]).select("c_custkey", "tile")


@query("w02_latest_per_key", """
SELECT * FROM (SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""")
def w02(spark, base):
    events = table(spark, base, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return windows.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("w03_first_per_key", """
SELECT user_id, event_id, event_type FROM events WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def w03(spark, base):
    events = table(spark, base, "events").filter(F.col("event_type") == "signup").select("user_id", "event_id", "event_type", "ts")
    return windows.first_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("w04_change_detection", """
SELECT event_id, user_id, event_type, previous FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
WHERE previous IS NULL OR previous <> event_type""")
def w04(spark, base):
    events = table(spark, base, "events").select("event_id", "user_id", "event_type", "ts")
    sliced = windows.order_slices(events, ["user_id"], ["ts", "event_id"])
    marked = windows.lag_in_slices(sliced, ["user_id"], ["ts", "event_id"], "event_type", F.col("_slice"))
    return marked.filter(F.col("previous").isNull() | (F.col("previous") != F.col("event_type"))).drop("ts", "_slice")


@query("w05_rank_by_day", """
SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS day, CAST(rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS BIGINT) AS rank FROM events""")
def w05(spark, base):
    days = table(spark, base, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return windows.rank_by_day(days, ["user_id"], "day").select("user_id", "day", "rank")


CITY_ISLANDS_SQL = f"""(SELECT user_id, zone_id, min(day) AS first_day, max(day) AS last_day FROM (
  SELECT user_id, zone_id, day, day - CAST(dense_rank() OVER (PARTITION BY user_id, zone_id ORDER BY day) AS INT) AS grp FROM (
    SELECT DISTINCT user_id, zone_id, CAST(ts AS DATE) AS day FROM {data.ZONED_SQL} WHERE event_type = 'message')) GROUP BY user_id, zone_id, grp)"""


def _zone_islands(spark, base):
    from martloom.operators.geo import nearest_place
    messages = data.geo_events(spark, base).filter(F.col("event_type") == "message")
    zoned = nearest_place(messages, data.places(spark, base), "event_id").select("user_id", "zone_id", F.to_date("ts").alias("day"))
    return windows.day_islands(zoned, ["user_id", "zone_id"], "day")


@query("w06_day_islands", f"""
SELECT user_id, zone_id, strftime(first_day, '%Y-%m-%d') AS first_day, strftime(last_day, '%Y-%m-%d') AS last_day FROM {CITY_ISLANDS_SQL}""")
def w06(spark, base):
    return _zone_islands(spark, base).select("user_id", "zone_id", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first_day", "last_day")])


@query("w07_best_island", f"""
SELECT user_id, zone_id FROM {CITY_ISLANDS_SQL} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY least(last_day - first_day, 3) DESC, last_day DESC, zone_id) = 1""")
def w07(spark, base):
    return windows.best_island(_zone_islands(spark, base), ["user_id"], "zone_id", 3)


@query("w08_lag_features", """
SELECT event_type, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, n, lag(n, 1) OVER w AS lag_1, lag(n, 2) OVER w AS lag_2, lag(n, 24) OVER w AS lag_24
FROM (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL) WINDOW w AS (PARTITION BY event_type ORDER BY hour)""")
def w08(spark, base):
    hourly = table(spark, base, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"))
    # the hourly series has one row per hour of the calendar, however many events there are
    series = Window.partitionBy("event_type").orderBy("hour")
    return hourly.select("event_type", time_text("hour").alias("hour"), "n", *[F.lag("n", k).over(series).alias(f"lag_{k}") for k in (1, 2, 24)])


@query("w09_surrogate_number", """
SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) AS BIGINT) AS id FROM (SELECT DISTINCT p_brand, p_type FROM part)""")
def w09(spark, base):
    kinds = table(spark, base, "part").select("p_brand", "p_type").distinct()
    return ordering.global_row_number(kinds, [F.col("p_brand"), F.col("p_type")], "id")


@query("w10_running_totals", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS paid_so_far FROM orders""")
def w10(spark, base):
    orders = table(spark, base, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    total = ordering.running_totals(orders, [F.col("o_orderdate"), F.col("o_orderkey")], {"paid": F.col("o_totalprice").cast("decimal(18,2)")})
    return total.select("o_orderkey", F.col("paid").cast("double").alias("paid_so_far"))


@query("w02_rfm_measures", """
SELECT c_custkey AS user_id, coalesce(last_ts, TIMESTAMP '1999-01-01') AS last_order_ts, coalesce(n, 0) AS orders_count, CAST(coalesce(paid, 0) AS DOUBLE) AS orders_payment
FROM customer LEFT JOIN (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE TIMESTAMP '1999-01-01' END) AS last_ts, count(*) FILTER (o_orderstatus = 'F') AS n,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS paid FROM orders WHERE year(o_orderdate) >= 1999 GROUP BY o_custkey) ON c_custkey = o_custkey""")
def w02_measures(spark, base):
    users, orders = data.rfm_frames(spark, base)
    return rfm_inputs(users, orders, "F", 1999).withColumn("orders_payment", F.col("orders_payment").cast("double"))


