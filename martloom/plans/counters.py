"""Order counters per user and product or category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.streaming.jobs import closed_only


def user_counters(lines: DataFrame, key: str, name: str, output_key: str, output_name: str,
                  status: str = "CLOSED") -> DataFrame:
    """Closed order lines per user and ``key``; the name of the smallest order line is kept.

    ``lines`` has the columns of the order line message.
    """
    return closed_only(lines, status).groupBy(F.col("h_user_pk").alias("user_id"), F.col(key).alias(output_key)).agg(
        F.min_by(name, "h_order_pk").alias(output_name), F.count("*").alias("order_cnt"))


def product_counters(lines: DataFrame, status: str = "CLOSED") -> DataFrame:
    """Closed order lines per user and product."""
    return user_counters(lines, "h_product_pk", "productname", "product_id", "product_name", status)


def category_counters(lines: DataFrame, status: str = "CLOSED") -> DataFrame:
    """Closed order lines per user and category."""
    return user_counters(lines, "h_category_pk", "category_name", "category_id", "category_name", status)
