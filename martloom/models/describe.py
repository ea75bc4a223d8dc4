"""Describing and cleaning tables: gaps, copies, spellings, outliers, associations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import place_name
from martloom.operators.joins import lookup_join
from martloom.operators.ordering import exact_quantiles
from martloom.session import cut_lineage


def missing_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls and their share per column, in one pass."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counted.unpivot(["_rows"], columns, "column_name", "missing").select(
        "column_name", "missing", (F.col("missing") / F.col("_rows")).alias("share"))


def impute(df: DataFrame, means: list[str] = (), modes: list[str] = (), constants: dict[str, object] | None = None) -> DataFrame:
    """Fill nulls with the mean, the most frequent value (ties: the smallest) or a constant."""
    filled = {}
    for column in means:
        filled[column] = F.coalesce(column, df.agg(F.avg(column).alias("m")).scalar())
    for column in modes:
        counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        top = counts.agg(F.min(F.struct(-F.col("n"), F.col(column).alias("v")))["v"].alias("v")).scalar()
        filled[column] = F.coalesce(column, top)
    for column, value in (constants or {}).items():
        filled[column] = F.coalesce(column, F.lit(value))
    return df.withColumns(filled)


def first_copies(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per distinct content of ``columns``: the smallest key and the number of copies.

    Content is compared by its SHA-256 digest, so long texts are not shuffled.
    """
    content = F.sha2(F.to_json(F.struct(*columns)), 256)
    return df.groupBy(content.alias("_content")).agg(F.min(key).alias(key), F.count("*").alias("copies")).drop("_content")


def without_copies(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that are the first of their content."""
    return df.join(first_copies(df, key, columns).select(key), key, "left_semi")


def unified_places(df: DataFrame, column: str, aliases: DataFrame | None = None) -> DataFrame:
    """Bring spellings of places together; ``aliases`` (``spelling, place``) maps the rest."""
    cleaned = df.withColumn(column, place_name(F.col(column)))
    if aliases is None:
        return cleaned
    known = aliases.select(place_name(F.col("spelling")).alias(column), F.col("place").alias("_place"))
    return lookup_join(cleaned, known, [column], "left").withColumn(column, F.coalesce("_place", column)).drop("_place")


def quartile_bounds(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """One row ``low, q1, median, q3, high`` with the whiskers of a box plot."""
    quantiles = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    at = {name: F.max(F.when(F.col("share") == share, F.col("quantile"))).alias(name)
          for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    spread = F.col("q3") - F.col("q1")
    return quantiles.agg(*at.values()).select(
        (F.col("q1") - reach * spread).alias("low"), "q1", "median", "q3", (F.col("q3") + reach * spread).alias("high"))


def within_quartiles(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Rows inside the whiskers."""
    bounds = cut_lineage(quartile_bounds(df, column, reach))  # one row
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    return df.filter((F.col(column) >= low) & (F.col(column) <= high))


def within_range(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose columns lie inside given limits."""
    for column, (low, high) in limits.items():
        df = df.filter(F.col(column).between(low, high))
    return df


def histogram(df: DataFrame, column: str, low: float, high: float, buckets: int) -> DataFrame:
    """Rows per equal-width bucket; 0 and ``buckets + 1`` hold what lies outside."""
    bucket = F.width_bucket(column, F.lit(float(low)), F.lit(float(high)), F.lit(buckets))
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns: ``left_column, right_column, r``; one pass."""
    pairs = list(combinations(columns, 2))
    names = [f"{a}|{b}" for a, b in pairs]
    row = df.agg(*[F.corr(a, b).alias(n) for (a, b), n in zip(pairs, names)])
    parts = F.split("pair", r"\|")
    return row.unpivot([], [F.col(f"`{n}`") for n in names], "pair", "r").select(
        parts[0].alias("left_column"), parts[1].alias("right_column"), "r")


def uncorrelated_columns(df: DataFrame, columns: list[str], limit: float = 0.9) -> list[str]:
    """Columns left after dropping the later one of each pair correlated above ``limit``."""
    strong = correlations(df, columns).filter(F.abs("r") > limit).collect()
    kept: list[str] = []
    for column in columns:
        if not any({r.left_column, r.right_column} == {column, other} for r in strong for other in kept):
            kept.append(column)
    return kept


def cramers_v(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """Association of two categorical columns: ``n, chi2, v``.

    Only the contingency table (one row per pair of categories) is joined to its margins.
    """
    cells = df.select(left.alias("a"), right.alias("b")).na.drop().groupBy("a", "b").agg(F.count("*").alias("n"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("row_n"))
    columns = cells.groupBy("b").agg(F.sum("n").alias("column_n"))
    share = F.col("n") * F.col("n") / (F.col("row_n").cast("double") * F.col("column_n"))
    totals = cells.join(rows, "a").join(columns, "b").agg(
        F.sum("n").alias("n"), F.sum(share).alias("s"), F.countDistinct("a").alias("ra"), F.countDistinct("b").alias("rb"))
    chi2 = F.col("n") * (F.col("s") - 1)
    return totals.select("n", chi2.alias("chi2"), F.sqrt(chi2 / F.col("n") / (F.least("ra", "rb") - 1)).alias("v"))
