"""Least squares from moments: one pass over the rows, whatever the number of folds and settings.

The normal equations need only sums of products.  They are summed per fold once; what a model is
trained on is then a sum of folds (all earlier ones, or all others), and so is what it is tested on: the squared error of
any coefficients follows from the moments of the test fold, without looking at its rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RESULT = "fold long, penalty double, n_train long, n_test long, coefficients array<double>, rmse double, r2 double, mean_rmse double"


def fold_moments(df: DataFrame, features: list[str], label: str, fold: str = "fold") -> DataFrame:
    """Per fold the sums ``m_i_j`` of the products of 1, the features and the label; one aggregation with map-side combine."""
    values = [F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(label).cast("double")]
    sums = [F.sum(values[i] * values[j]).alias(f"m_{i}_{j}") for i in range(len(values)) for j in range(i, len(values))]
    return df.groupBy(F.col(fold).cast("bigint").alias("fold")).agg(*sums)


def rolling_origin(moments: DataFrame) -> DataFrame:
    """For each fold but the first, its own moments and, as ``t_i_j``, those of all earlier folds.

    The window has no key, but there is one row per fold.
    """
    earlier = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    return _with_training(moments, lambda m: F.sum(m).over(earlier)).filter(F.col("t_0_0").isNotNull())


def left_out(moments: DataFrame) -> DataFrame:
    """For each fold its own moments and, as ``t_i_j``, those of all others: the total less its own."""
    every = Window.partitionBy(F.lit(0))
    return _with_training(moments, lambda m: F.sum(m).over(every) - F.col(m)).filter("t_0_0 > 0")


def _with_training(moments: DataFrame, total) -> DataFrame:
    return moments.withColumns({"t" + m[1:]: total(m) for m in moments.columns if m.startswith("m_")})


def validated(trained: DataFrame, features: int, penalties: list[float] = [0.0]) -> DataFrame:  # noqa: B006 - never changed
    """One model per fold and penalty: its coefficients (intercept first) and its errors on the fold.

    The squared penalty is not put on the intercept.  ``mean_rmse`` is the error of the training mean.
    Features that depend on each other get the smallest coefficients that fit.
    """
    size = features + 2

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                train, test = (np.array([[row[f"{side}_{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)]) for side in "tm")
                n, total, squares = test[0, 0], test[0, -1], test[-1, -1]
                mean = train[0, -1] / train[0, 0]
                spread = squares - total * total / n
                for penalty in penalties:
                    ridge = train[:-1, :-1] + penalty * np.diag([0.0] + [1.0] * features)
                    weights = np.linalg.lstsq(ridge, train[:-1, -1], rcond=None)[0]
                    error = max(0.0, squares - 2 * weights @ test[:-1, -1] + weights @ test[:-1, :-1] @ weights)
                    rows.append((row["fold"], penalty, int(train[0, 0]), int(n), weights.tolist(), np.sqrt(error / n),
                                 1 - error / spread if spread > 0 else None, np.sqrt(max(0.0, squares - 2 * mean * total + n * mean * mean) / n)))
            yield pd.DataFrame(rows, columns=["fold", "penalty", "n_train", "n_test", "coefficients", "rmse", "r2", "mean_rmse"])

    return trained.mapInPandas(solve, _RESULT)


def best_penalty(results: DataFrame) -> DataFrame:
    """The penalty with the least squared error over all folds, the smallest of equals: ``penalty, rmse``."""
    scored = results.groupBy("penalty").agg(F.sqrt(F.sum(F.col("rmse") * F.col("rmse") * F.col("n_test")) / F.sum("n_test")).alias("rmse"))
    return scored.orderBy("rmse", "penalty").limit(1)
