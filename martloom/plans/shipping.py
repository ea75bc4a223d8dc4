"""Shipping marts over a wide log with one row per state of a shipment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import pieces
from martloom.functions.time import age_day_part, span_days
from martloom.operators.joins import lookup_join
from martloom.operators.ordering import global_row_number


def country_rates(log: DataFrame) -> DataFrame:
    """Countries and their base rates with a surrogate id."""
    pairs = log.select("shipping_country", F.col("shipping_country_base_rate").cast("decimal(14,3)")
                       .alias("shipping_country_base_rate")).distinct()
    return global_row_number(pairs, [F.col("shipping_country"), F.col("shipping_country_base_rate")], "id")


def agreements(log: DataFrame) -> DataFrame:
    """Vendor agreements taken apart from ``id:number:rate:commission``."""
    parts = pieces(F.col("vendor_agreement_description"))
    return log.select("vendor_agreement_description").distinct().select(
        parts[0].cast("bigint").alias("agreement_id"), parts[1].alias("agreement_number"),
        parts[2].cast("decimal(3,2)").alias("agreement_rate"),
        parts[3].cast("decimal(3,2)").alias("agreement_comission")).distinct()


def transfers(log: DataFrame) -> DataFrame:
    """Transfer types taken apart from ``type:model``, with rate and surrogate id."""
    parts = pieces(F.col("shipping_transfer_description"))
    kinds = log.select("shipping_transfer_description", "shipping_transfer_rate").distinct().select(
        parts[0].alias("transfer_type"), parts[1].alias("transfer_model"),
        F.col("shipping_transfer_rate").cast("decimal(14,3)").alias("shipping_transfer_rate")).distinct()
    order = [F.col(c) for c in ("transfer_type", "transfer_model", "shipping_transfer_rate")]
    return global_row_number(kinds, order, "shipping_transfer_id")


def shipping_info(log: DataFrame, rates: DataFrame, agreed: DataFrame, kinds: DataFrame) -> DataFrame:
    """One row per shipment with the ids of its country, agreement and transfer.

    Descriptions are joined on their typed parts, never on re-assembled text.
    """
    agreement, transfer = pieces(F.col("vendor_agreement_description")), pieces(F.col("shipping_transfer_description"))
    shipments = log.select(
        F.col("shippingid").alias("shipping_id"), F.col("vendorid").alias("vendor_id"), "payment_amount",
        "shipping_plan_datetime", "shipping_country",
        F.col("shipping_country_base_rate").cast("decimal(14,3)").alias("shipping_country_base_rate"),
        agreement[0].cast("bigint").alias("agreement_id"), transfer[0].alias("transfer_type"),
        transfer[1].alias("transfer_model"),
        F.col("shipping_transfer_rate").cast("decimal(14,3)").alias("shipping_transfer_rate")).distinct()
    with_rate = lookup_join(shipments, rates, ["shipping_country", "shipping_country_base_rate"])
    with_kind = lookup_join(with_rate, kinds, ["transfer_type", "transfer_model", "shipping_transfer_rate"])
    return lookup_join(with_kind, agreed.select("agreement_id"), ["agreement_id"]).select(
        "shipping_id", "vendor_id", "payment_amount", "shipping_plan_datetime", "shipping_transfer_id",
        "agreement_id", "id")


def _last_states() -> list:
    """Last status and state, latest booking and latest receipt of a shipment."""
    def latest(state):
        return F.max(F.when(F.col("state") == state, F.col("state_datetime")))
    return [F.max(F.struct("state_datetime", "status", "state")).alias("_last"),
            latest("booked").alias("shipping_start_fact_datetime"), latest("recieved").alias("shipping_end_fact_datetime")]


def shipping_status(log: DataFrame) -> DataFrame:
    """Last status and state, start and end of each shipment in one aggregation."""
    return log.groupBy(F.col("shippingid").alias("shipping_id")).agg(*_last_states()).select(
        "shipping_id", "_last.status", "_last.state", "shipping_start_fact_datetime", "shipping_end_fact_datetime")


def _mart_columns(plan_based: bool) -> list:
    """Columns of the datamart over typed rates, payment, status and times."""
    start, end = F.col("shipping_start_fact_datetime"), F.col("shipping_end_fact_datetime")
    due = F.col("shipping_plan_datetime") if plan_based else start
    rate_sum = F.col("shipping_country_base_rate") + F.col("agreement_rate") + F.col("shipping_transfer_rate")
    paid = F.col("payment_amount").cast("decimal(14,2)")
    return [
        "shipping_id", "vendor_id", "transfer_type",
        F.when(end.isNotNull(), span_days(end, start)).otherwise(0).alias("full_day_at_shipping"),
        F.when(end > due, 1).otherwise(0).cast("bigint").alias("is_delay"),
        F.when(F.col("status") == "finished", 1).otherwise(0).cast("bigint").alias("is_shipping_finish"),
        F.when(end > due, age_day_part(end, due)).otherwise(0).alias("delay_day_at_shipping"),
        paid.alias("payment_amount"),
        (rate_sum * paid).alias("vat"), (paid * F.col("agreement_comission")).alias("profit")]


def shipping_datamart(log: DataFrame, plan_based: bool = False) -> DataFrame:
    """Days, delay, finish flag, VAT and profit per shipment, straight from the log.

    A shipment counts as delayed when its end lies after its start; with
    ``plan_based=True`` when it lies after the planned time.  Rates are part of every log
    row, so one aggregation per shipment replaces the joins to the dimension tables.
    """
    agreement, transfer = pieces(F.col("vendor_agreement_description")), pieces(F.col("shipping_transfer_description"))
    terms = ["payment_amount", "shipping_plan_datetime", "shipping_country_base_rate", "vendor_agreement_description",
             "shipping_transfer_description", "shipping_transfer_rate"]
    grouped = log.groupBy(F.col("shippingid").alias("shipping_id"), F.col("vendorid").alias("vendor_id"), *terms).agg(*_last_states())
    return grouped.select(
        "*", "_last.status", agreement[2].cast("decimal(3,2)").alias("agreement_rate"),
        agreement[3].cast("decimal(3,2)").alias("agreement_comission"), transfer[0].alias("transfer_type"),
    ).withColumns({c: F.col(c).cast("decimal(14,3)") for c in ("shipping_country_base_rate", "shipping_transfer_rate")}
                  ).select(*_mart_columns(plan_based))


def datamart_from_tables(info: DataFrame, status: DataFrame, rates: DataFrame, agreed: DataFrame, kinds: DataFrame,
                         plan_based: bool = False) -> DataFrame:
    """The same mart over stored dimension, info and status tables."""
    joined = info.join(status, "shipping_id")
    joined = lookup_join(joined, rates.select("id", "shipping_country_base_rate"), ["id"])
    joined = lookup_join(joined, agreed.select("agreement_id", "agreement_rate", "agreement_comission"), ["agreement_id"])
    joined = lookup_join(joined, kinds.select("shipping_transfer_id", "transfer_type", "shipping_transfer_rate"),
                         ["shipping_transfer_id"])
    return joined.select(*_mart_columns(plan_based))
