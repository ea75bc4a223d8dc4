"""Quality of predictions, from frames of label and prediction or score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.numeric import safe_ratio
from martloom.operators.ordering import running_totals


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``rmse, mae, mse, r2, smape`` in one pass; SMAPE in percent, a pair of zeros counts as 0."""
    error = F.col(prediction) - F.col(label)
    size = (F.abs(F.col(prediction)) + F.abs(F.col(label))) / 2
    part = F.when(size == 0, 0.0).otherwise(F.abs(error) / size)
    row = df.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(label).alias("spread"), (F.avg(part) * 100).alias("smape"))
    return row.select(F.sqrt("mse").alias("rmse"), "mae", "mse", (1 - F.col("mse") / F.nullif(F.col("spread"), F.lit(0.0))).alias("r2"), "smape")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``tp, fp, fn, tn, accuracy, precision, recall, f1`` for 0/1 labels and predictions."""
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    row = df.agg(*[F.count(F.when(cell, 1)).alias(name) for name, cell in (
        ("tp", yes & said), ("fp", ~yes & said), ("fn", yes & ~said), ("tn", ~yes & ~said))])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return row.select(
        "tp", "fp", "fn", "tn", safe_ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"), safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def _by_score(df: DataFrame, label: str, score: str, descending: bool = False) -> DataFrame:
    """One row per distinct score with its positives and negatives and their running totals."""
    counts = df.groupBy(score).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("positives"), F.count(F.when(F.col(label) != 1, 1)).alias("negatives"))
    order = F.col(score).desc() if descending else F.col(score).asc()
    return running_totals(counts, [order], {"positives_upto": F.col("positives"), "negatives_upto": F.col("negatives")})


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve by rank sums, equal scores counted half."""
    steps = _by_score(df, label, score)
    below = F.col("negatives_upto") - F.col("negatives") / 2
    row = steps.agg(F.sum(F.col("positives") * below).alias("won"), F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    return row.select(safe_ratio(F.col("won"), F.col("p").cast("double") * F.col("n")).alias("roc_auc"))


def thresholds(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall and false-positive share of all rows when accepting ``score`` and above."""
    steps = _by_score(df, label, score, descending=True)
    positives = F.col("positives_upto_total")
    totals = positives + F.col("negatives_upto_total")
    tp, fp = F.col("positives_upto"), F.col("negatives_upto")
    return steps.select(F.col(score).alias("threshold"), safe_ratio(tp, tp + fp).alias("precision"),
                        safe_ratio(tp, positives).alias("recall"), safe_ratio(fp, totals).alias("false_positive_share"))


def threshold_for(df: DataFrame, most_false: float, label: str = "label", score: str = "score") -> DataFrame:
    """The lowest threshold whose false positives stay within a share of all rows."""
    allowed = thresholds(df, label, score).filter(F.col("false_positive_share") <= most_false)
    best = F.min(F.struct("threshold", "precision", "recall", "false_positive_share")).alias("b")
    return allowed.agg(best).select("b.*")


def constant_mean(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Baseline: the training mean for every test row."""
    return test.withColumn("prediction", train.agg(F.avg(label).alias("m")).scalar())


def majority(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Baseline: the most frequent training class (ties: the smallest) for every test row."""
    counts = train.groupBy(label).agg(F.count("*").alias("n"))
    top = counts.agg(F.min(F.struct(-F.col("n"), F.col(label).alias("v")))["v"].alias("v")).scalar()
    return test.withColumn("prediction", top)
