"""Customer marts: recency/frequency/value segments and weekly retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.numeric import money
from martloom.functions.time import since_year
from martloom.operators.ordering import global_ntile
from martloom.operators.windows import latest_per_key


def rfm_inputs(users: DataFrame, orders: DataFrame, closed: str, year: int, strict: bool = False) -> DataFrame:
    """Last closed order, number and payment of closed orders per user.

    ``users`` has ``user_id``; ``orders`` has ``user_id, order_ts, payment, status``.
    Orders are reduced per user before the join, so a busy user is one row.  A user
    without orders in the period keeps the start of the period, zero and zero; with
    ``strict=True`` such users are left out.
    """
    done = F.col("status") == closed
    start = F.lit(f"{year}-01-01").cast("timestamp_ntz")
    per_user = orders.filter(since_year(F.col("order_ts"), year)).groupBy("user_id").agg(
        F.max(F.when(done, F.col("order_ts")).otherwise(start)).alias("last_order_ts"),
        F.count(F.when(done, 1)).alias("orders_count"),
        F.sum(F.when(done, money(F.col("payment")))).alias("orders_payment"))
    joined = users.select("user_id").join(per_user, "user_id", "inner" if strict else "left")
    return joined.select(
        "user_id", F.coalesce("last_order_ts", start).alias("last_order_ts"),
        F.coalesce("orders_count", F.lit(0)).alias("orders_count"),
        F.coalesce("orders_payment", F.lit(0).cast("decimal(28,2)")).alias("orders_payment"))


def rfm_segments(users: DataFrame, orders: DataFrame, closed: str = "Closed", year: int = 2022,
                 strict: bool = False, tiles: int = 5) -> DataFrame:
    """Quintile 1-5 per user of recency, frequency and monetary value; ties go by user id."""
    segments = rfm_inputs(users, orders, closed, year, strict)
    for measure, name in (("last_order_ts", "recency"), ("orders_count", "frequency"),
                          ("orders_payment", "monetary_value")):
        segments = global_ntile(segments, tiles, [F.col(measure), F.col("user_id")], name)
    return segments.select("user_id", "recency", "frequency", "monetary_value")


def orders_with_status(orders: DataFrame, status_log: DataFrame) -> DataFrame:
    """Orders with their latest status; ``status_log`` has ``order_id, status_id, dttm``."""
    latest = latest_per_key(status_log.select("order_id", "status_id", "dttm"), ["order_id"], ["dttm", "status_id"])
    return orders.join(latest.select("order_id", F.col("status_id").alias("status")), "order_id", "inner")


def weekly_retention(sales: DataFrame) -> DataFrame:
    """Customers and revenue per week and item, split into new, returning and refunded.

    ``sales`` has ``week, item_id, customer_id, status, payment_amount``.  A customer is
    new in a week with exactly one sales row, returning with more, refunded with at least
    one refund.  Rows are first reduced to one per (week, customer, item, status), after
    which every distinct count is a plain count.
    """
    reduced = sales.groupBy("week", "customer_id", "item_id", "status").agg(
        F.count("*").alias("rows"), F.sum(money(F.col("payment_amount"))).alias("amount"))
    customers = reduced.groupBy("week", "customer_id").agg(F.sum("rows").alias("week_rows"))
    known = reduced.join(customers, ["week", "customer_id"])
    shipped = F.col("status") == "shipped"
    new = shipped & (F.col("week_rows") == 1)
    returning = shipped & (F.col("week_rows") > 1)
    refunded = F.col("status") == "refunded"
    return known.groupBy("week", "item_id").agg(
        F.count(F.when(new, 1)).alias("new_customers_count"),
        F.count(F.when(returning, 1)).alias("returning_customers_count"),
        F.count(F.when(refunded, 1)).alias("refunded_customer_count"),
        F.sum(F.when(new, F.col("amount"))).cast("double").alias("new_customers_revenue"),
        F.sum(F.when(returning, F.col("amount"))).cast("double").alias("returning_customers_revenue"),
        F.sum(F.when(refunded, F.col("amount"))).cast("double").alias("customers_refunded"),
    ).select(
        "new_customers_count", "returning_customers_count", "refunded_customer_count",
        F.lit("week").alias("period_name"), F.col("week").alias("period_start"),
        F.weekofyear("week").cast("bigint").alias("period_id"), "item_id",
        "new_customers_revenue", "returning_customers_revenue", "customers_refunded")


def daily_sales(staging: DataFrame, days: DataFrame) -> DataFrame:
    """Sales fact: staged rows with the id of their calendar day.

    ``staging`` has ``date_time`` and the fact columns, ``days`` the calendar columns.
    """
    dated = staging.withColumn("date_actual", F.to_date("date_time"))
    return dated.join(days.select("date_actual", "date_id"), "date_actual", "left").select(
        "date_id", "item_id", "customer_id", "city_id", "quantity", "payment_amount", "status")
