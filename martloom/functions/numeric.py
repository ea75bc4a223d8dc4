"""Money and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, precision: int = 18, scale: int = 2) -> Column:
    """Fixed-scale decimal view of an amount."""
    return value.cast(f"decimal({precision},{scale})")


def money_total(value: Column, scale: int = 2) -> Column:
    """Exact total: added as decimals (order of rows cannot change it), shown as double."""
    return F.sum(money(value, 18, scale)).cast("double")


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double; null where the divisor is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def tiered_pay(amount: Column, score: Column, tiers: list[tuple[float | None, float, float]]) -> Column:
    """Share of ``amount`` with a floor, both chosen by ``score``.

    ``tiers`` lists ``(upper bound of score, rate, floor)`` in rising order; the last
    bound is ``None``.
    """
    chosen = None
    for bound, rate, floor in tiers:
        pay = F.greatest(amount * F.lit(rate), F.lit(floor))
        if bound is None:
            return chosen.otherwise(pay) if chosen is not None else pay
        chosen = F.when(score < bound, pay) if chosen is None else chosen.when(score < bound, pay)
    return chosen


def plain_number(value: Column) -> Column:
    """A number as decimal text without exponent and idle zeros: 300.5, 10000000."""
    return F.when(value == 0, "0").otherwise(F.rtrim(F.rtrim(value.cast("decimal(38,10)").cast("string"), F.lit("0")), F.lit(".")))
