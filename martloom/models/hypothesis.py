"""Student's tests: the data are reduced to counts, means and variances in one pass."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIMPSON_STEPS = 4_000  # fixed value: an even number of steps of the rule


def two_samples(df: DataFrame, value: Column, first: Column, equal_variances: bool = True) -> DataFrame:
    """``n1, n2, t, dof`` for rows with ``first`` true against the others."""
    def stats(condition, i):
        chosen = F.when(condition, value)
        return [F.count(chosen).alias(f"n{i}"), F.avg(chosen).alias(f"m{i}"), F.var_samp(chosen).alias(f"v{i}")]
    row = df.agg(*stats(first, 1), *stats(~first, 2))
    n1, n2, v1, v2 = F.col("n1"), F.col("n2"), F.col("v1"), F.col("v2")
    if equal_variances:
        pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
        error, dof = F.sqrt(pooled * (1 / n1 + 1 / n2)), (n1 + n2 - 2).cast("double")
    else:
        e1, e2 = v1 / n1, v2 / n2
        error, dof = F.sqrt(e1 + e2), (e1 + e2) * (e1 + e2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1))
    return row.select("n1", "n2", ((F.col("m1") - F.col("m2")) / error).alias("t"), dof.alias("dof"))


def one_sample(df: DataFrame, value: Column, expected: float) -> DataFrame:
    """``n, t, dof`` of the mean against an expected value."""
    row = df.agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    return row.select("n", ((F.col("m") - expected) / F.sqrt(F.col("v") / F.col("n"))).alias("t"), (F.col("n") - 1).cast("double").alias("dof"))


def paired(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """``n, t, dof`` of the change within pairs; pairs with a gap are left out."""
    return one_sample(df, after - before, 0.0)


def with_p_value(tested: DataFrame, alternative: str = "two-sided") -> DataFrame:
    """Add the p-value of ``t`` under Student's distribution with ``dof`` degrees of freedom."""
    return tested.withColumn("p_value", p_value(F.col("t"), F.col("dof"), alternative))


def p_value(t: Column, dof: Column, alternative: str = "two-sided") -> Column:
    """Tail probability of Student's distribution.

    Both tails together are the share of the integral of ``sin(u) ** (dof - 1)`` over
    [0, pi/2] that lies below ``asin(sqrt(dof / (dof + t * t)))``.  Both integrals are taken by
    Simpson's rule from where the integrand is more than nothing.
    """
    full = F.lit(math.pi / 2)
    start = F.greatest(F.lit(0.0), full - F.lit(40.0) / F.sqrt(dof))
    top = F.greatest(start, F.asin(F.sqrt(dof / (dof + t * t))))
    both = _power_integral(start, top, dof - 1) / _power_integral(start, full, dof - 1)
    if alternative == "two-sided":
        return both
    upper = F.when(t > 0, both / 2).otherwise(1 - both / 2)
    return upper if alternative == "greater" else 1 - upper


def _power_integral(low: Column, high: Column, power: Column) -> Column:
    """Integral of ``sin(u) ** power`` by Simpson's rule."""
    width = (high - low) / SIMPSON_STEPS

    def term(total: Column, i: Column) -> Column:
        weight = F.when((i == 0) | (i == SIMPSON_STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return total + weight * F.pow(F.sin(low + i * width), power)
    return F.aggregate(F.sequence(F.lit(0), F.lit(SIMPSON_STEPS)), F.lit(0.0), term) * width / 3
