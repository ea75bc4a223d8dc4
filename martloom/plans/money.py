"""Daily metrics of transactions per currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.numeric import safe_ratio
from martloom.functions.time import in_days
from martloom.operators.joins import with_base_rate

# The base currency and the transaction types that count.
BASE_CURRENCY = 420
COUNTED_TYPES = ["c2a_incoming", "c2b_partner_incoming", "sbp_incoming", "sbp_outgoing", "transfer_incoming",
                 "transfer_outgoing"]


def rates_towards(currencies: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """``day, currency_code, rate`` towards the base currency out of raw rates between all currencies."""
    return currencies.filter(F.col("currency_code_with") == base).select(
        F.to_date("date_update").alias("day"), F.col("currency_code").cast("bigint").alias("currency_code"),
        F.col("currency_with_div").cast("double").alias("rate"))


def currency_metrics(transactions: DataFrame, rates: DataFrame, first_day: str | None = None, last_day: str | None = None,
                     both_sides: bool = True, base: int = BASE_CURRENCY) -> DataFrame:
    """Amount in base currency, transactions and accounts per day and currency.

    ``transactions`` has ``account_number_from, account_number_to, currency_code, status,
    transaction_type, amount, transaction_dt``; ``rates`` has ``day, currency_code, rate``, or is
    the raw table with a counter-currency, of which the rows towards ``base`` are taken.
    A whole range of days, or all of them, is one grouped job.  Transactions are reduced per (day, currency,
    account) and then per (day, currency) before the rate is joined, so the join sees one
    row per day and currency.  Days or currencies without a rate are left out; the base
    currency always has rate 1.
    """
    own = F.col("account_number_from") >= 0
    other = F.col("account_number_to") >= 0
    if "currency_code_with" in rates.columns:
        rates = rates_towards(rates, base)
    wanted = in_days(F.col("transaction_dt"), first_day, last_day) if first_day and last_day else F.lit(True)
    counted = transactions.filter(
        wanted & (F.col("status") == "done")
        & F.col("transaction_type").isin(COUNTED_TYPES) & (own & other if both_sides else own))
    day = F.to_date("transaction_dt").alias("day")
    per_account = counted.groupBy(day, "currency_code", "account_number_from").agg(
        F.sum(F.abs(F.col("amount").cast("decimal(18,2)"))).alias("amount"), F.count("*").alias("rows"))
    per_currency = per_account.groupBy("day", "currency_code").agg(
        F.sum("amount").alias("amount"), F.sum("rows").alias("cnt_transactions"),
        F.count("*").alias("cnt_accounts_make_transactions"))
    priced = with_base_rate(rates, per_currency.select("day").distinct(), base)
    return per_currency.join(priced, ["day", "currency_code"]).select(
        F.col("day").alias("date_update"), F.col("currency_code").alias("currency_from"),
        (F.col("amount").cast("double") * F.col("rate")).alias("amount_total"), "cnt_transactions",
        safe_ratio(F.col("cnt_transactions"), F.col("cnt_accounts_make_transactions")).alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions")
