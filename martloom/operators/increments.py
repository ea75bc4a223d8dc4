"""Loading only what the target does not hold yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.windows import first_per_key


def past_watermark(source: DataFrame, key: str, loaded: DataFrame, loaded_key: str) -> DataFrame:
    """Rows whose id lies above the greatest loaded one; everything when nothing is loaded."""
    top = loaded.agg(F.max(loaded_key).alias("m")).scalar()
    return source.filter(top.isNull() | (F.col(key) > top))


def unseen(source: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target lacks."""
    return source.join(loaded.select(*keys), keys, "left_anti")


def staged(source: DataFrame, unique: str, order: list[str], drop: list[str],
           defaults: dict[str, Column]) -> DataFrame:
    """Clean a landed file for staging: one row per unique id, missing columns filled in."""
    once = first_per_key(source, [unique], order)
    missing = {name: value for name, value in defaults.items() if name not in source.columns}
    return once.drop(*drop).withColumns(missing)


def dimension_rows(source: DataFrame, key: str, attributes: list[str | Column], loaded: DataFrame) -> DataFrame:
    """New members of a dimension: keys not loaded yet, one row per distinct attribute set."""
    return unseen(source.select(key, *attributes).distinct(), loaded, [key])
