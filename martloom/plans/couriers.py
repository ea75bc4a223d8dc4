"""Courier marts: delivery fact and monthly ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.increments import past_watermark
from martloom.operators.joins import lookup_join

# Pay tiers as (average rating below, share of the order, least pay), the
# service fee and the part of tips that is paid out.
PAY_TIERS = [("4", "0.05", "100"), ("4.5", "0.07", "150"), ("4.9", "0.08", "175"), (None, "0.10", "200")]
PROCESSING_FEE = "0.25"
TIPS_PAID = "0.95"


def _dec(text: str, scale: int = 2):
    return F.lit(text).cast(f"decimal(6,{scale})")


def courier_ledger(deliveries: DataFrame) -> DataFrame:
    """Orders, rating, fee and pay per courier and month.

    ``deliveries`` has ``courier_id, courier_name, order_ts, rate, sum, tip_sum``.  Which
    tier applies is known only after the average rating of the month; the pay of every
    tier is therefore added up in the same aggregation and one of them chosen at the end,
    so deliveries are shuffled once and never joined to themselves.
    """
    amount, tips = F.col("sum").cast("decimal(18,2)"), F.col("tip_sum").cast("decimal(18,2)")
    pays = [F.sum(F.greatest(amount * _dec(rate), _dec(floor))).cast("decimal(28,4)").alias(f"_pay{i}")
            for i, (_, rate, floor) in enumerate(PAY_TIERS)]
    grouped = deliveries.groupBy(
        "courier_id", "courier_name", F.year("order_ts").cast("bigint").alias("settlement_year"),
        F.month("order_ts").cast("bigint").alias("settlement_month")).agg(
        F.count("*").alias("orders_count"), F.sum(amount).alias("_sum"), F.sum(tips).alias("_tips"),
        (F.sum(F.col("rate").cast("decimal(18,2)")).cast("double") / F.count("rate")).alias("rate_avg"), *pays)
    chosen = None
    for i, (bound, _, _) in enumerate(PAY_TIERS):
        pay = F.col(f"_pay{i}")
        if bound is None:
            chosen = chosen.otherwise(pay)
        else:
            below = F.col("rate_avg") < float(bound)
            chosen = F.when(below, pay) if chosen is None else chosen.when(below, pay)
    priced = grouped.withColumn("_pay", chosen)
    return priced.select(
        "courier_id", "courier_name", "settlement_year", "settlement_month", "orders_count",
        F.col("_sum").cast("double").alias("orders_total_sum"), "rate_avg",
        (F.col("_sum") * _dec(PROCESSING_FEE)).cast("double").alias("order_processing_fee"),
        F.col("_pay").cast("double").alias("courier_order_sum"), F.col("_tips").cast("double").alias("courier_tips_sum"),
        (F.col("_pay") + F.col("_tips") * _dec(TIPS_PAID)).cast("double").alias("courier_reward_sum"))


def dimension_increment(staged: DataFrame, key: str, columns: list[str], loaded: DataFrame, loaded_key: str) -> DataFrame:
    """Distinct dimension rows above the greatest loaded id; all of them on an empty target."""
    return past_watermark(staged.select(*dict.fromkeys([key, *columns])).distinct(), key, loaded, loaded_key)


def delivery_fact(staged: DataFrame, couriers: DataFrame, deliveries: DataFrame, orders: DataFrame,
                  fact: DataFrame) -> DataFrame:
    """Fact rows of orders above the greatest loaded one, with surrogate ids of all dimensions."""
    fresh = past_watermark(staged, "order_id", fact, "order_id")
    joined = lookup_join(fresh, deliveries.select("delivery_id", F.col("id").alias("delivery_sk"), "rate"), ["delivery_id"])
    joined = lookup_join(joined, couriers.select("courier_id", F.col("id").alias("courier_sk")), ["courier_id"])
    joined = lookup_join(joined, orders.select("order_id", F.col("id").alias("order_sk"), "order_ts", "orders_sum", "tip_sum"),
                         ["order_id"])
    return joined.select("delivery_sk", "rate", "courier_sk", "order_sk", "order_ts", "orders_sum",
                         F.col("tip_sum").alias("tips_sum")).distinct()
