"""Constraint checks: rows that a declared constraint would have refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count the rows breaking each rule in one pass; a null result counts as kept."""
    counted = df.agg(*[F.count(F.when(~rule, 1)).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count the nulls of each column in one pass."""
    counted = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "nulls")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with the number of rows they hold.

    The child is counted per key before the join, so a hot key is one row.
    """
    counted = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("rows"))
    parents = parent.select(F.col(parent_key).alias(child_key))
    return counted.join(parents, child_key, "left_anti")
