"""Break-even figures and the bootstrap of profit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.ordering import global_row_number


def break_even(df: DataFrame, group: str, volume: str, limit: float) -> DataFrame:
    """Mean volume per group and the share of rows above the break-even volume."""
    return df.groupBy(group).agg(
        F.avg(volume).alias("mean_volume"), F.avg(F.when(F.col(volume) > limit, 1.0).otherwise(0.0)).alias("share_above"))


def draw_number(seed: int, replicate: Column, draw: Column, rows: Column) -> Column:
    """Row number 1..rows of a draw: a hash of seed, replicate and draw, the same on every run."""
    text = F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), draw.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % rows + 1


def bootstrap_profit(df: DataFrame, key: str, predicted: str, actual: str, replicates: int, draws: int, chosen: int,
                     unit_income: float, budget: float, seed: int = 42) -> DataFrame:
    """Profit of each replicate: draw rows with repetition, keep the best predicted, sell the actual volume.

    The table of draws has ``replicates * draws`` rows whatever the size of the data, so it
    is copied to every task while the data are scanned once where they lie.
    """
    numbered = global_row_number(df.select(key, predicted, actual), [F.col(key)], "_number")
    rows = numbered.agg(F.count("*").alias("n")).scalar()
    spark = df.sparkSession
    table = spark.range(replicates).select(F.col("id").alias("replicate"), F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw"))
    drawn = table.withColumn("_number", draw_number(seed, F.col("replicate"), F.col("draw"), rows))
    sample = numbered.join(F.broadcast(drawn), "_number")
    best = F.row_number().over(Window.partitionBy("replicate").orderBy(F.col(predicted).desc(), F.col(key), F.col("draw")))
    kept = sample.withColumn("_best", best).filter(F.col("_best") <= chosen)
    return kept.groupBy("replicate").agg((F.sum(F.col(actual).cast("decimal(28,6)")).cast("double") * unit_income - budget).alias("profit"))


def profit_summary(profits: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Mean profit, confidence interval and share of replicates with a loss."""
    tail = (1 - confidence) / 2
    # one value per replicate, a fixed small number, so the exact percentile is safe here
    return profits.agg(
        F.avg("profit").alias("mean_profit"), F.percentile("profit", F.lit(tail)).alias("low"),
        F.percentile("profit", F.lit(1 - tail)).alias("high"), F.avg(F.when(F.col("profit") < 0, 1.0).otherwise(0.0)).alias("loss_risk"))
