"""Preparing features, training, searching parameters, explaining and chaining models."""

from __future__ import annotations

import random

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.ordering import global_row_number
from martloom.session import cut_lineage

SEED = 42


def preparation(numeric: list[str], categorical: list[str], output: str = "features", strategy: str = "mean") -> list[Transformer | Estimator]:
    """Stages that fill gaps, encode categories, assemble and scale to unit variance."""
    filled = [f"{c}_filled" for c in numeric]
    stages: list = [Imputer(inputCols=numeric, outputCols=filled, strategy=strategy)]
    encoded = []
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        encoded = [f"{c}_encoded" for c in categorical]
        stages += [StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
                   OneHotEncoder(inputCols=indexed, outputCols=encoded)]
    return stages + [VectorAssembler(inputCols=filled, outputCol="_numbers"),
                     StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
                     VectorAssembler(inputCols=["_scaled", *encoded], outputCol=output)]


def model(kind: str, **params) -> Estimator:
    """Estimator by name: linear, ridge, tree, boosting; logistic, svm, tree_class, forest, ridge_class."""
    made = {
        "linear": lambda: LinearRegression(),
        "ridge": lambda: LinearRegression(elasticNetParam=0.0, regParam=1.0),
        # least squares on -1/+1 labels with a squared penalty; its sign is the class
        "ridge_class": lambda: LinearRegression(elasticNetParam=0.0, regParam=0.1, labelCol="signed_label"),
        "tree": lambda: DecisionTreeRegressor(maxDepth=5, seed=SEED),
        "boosting": lambda: GBTRegressor(maxDepth=2, maxIter=20, stepSize=0.21, seed=SEED),
        "logistic": lambda: LogisticRegression(elasticNetParam=1.0, regParam=0.001, maxIter=50),
        "svm": lambda: LinearSVC(regParam=0.01, maxIter=30),
        "tree_class": lambda: DecisionTreeClassifier(maxDepth=5, seed=SEED),
        "forest": lambda: RandomForestClassifier(numTrees=30, maxDepth=6, seed=SEED),
    }[kind]()
    return made.setParams(**params) if params else made


def fit(stages: list, train: DataFrame) -> PipelineModel:
    """Fit a chain of stages; every stage passes over the rows, so they are kept meanwhile."""
    kept = train.persist()
    try:
        return Pipeline(stages=stages).fit(kept)
    finally:
        kept.unpersist()


def counted(train: DataFrame) -> DataFrame:
    """Every distinct row once, with the number of its copies as ``_weight``."""
    return train.groupBy(*train.columns).agg(F.count("*").cast("double").alias("_weight"))


def fit_counted(stages: list, train: DataFrame) -> PipelineModel:
    """Fit a chain whose last stage passes over the rows many times and takes weights.

    Gaps, codes and scales are learned from all rows; the last stage gets equal rows once, with their
    number as weight, so it should be given no more columns than it uses.  ``train`` is read several times.
    """
    *preparation, last = stages
    prepared = Pipeline(stages=preparation).fit(train)
    kept = _features(prepared, counted(train), last).persist()
    try:
        return PipelineModel([*prepared.stages, _weighted(last).fit(kept)])
    finally:
        kept.unpersist()


def _weighted(last: Estimator) -> Estimator:
    return last.copy({last.getParam("weightCol"): "_weight"})


def _features(prepared: PipelineModel, rows: DataFrame, last: Estimator, *others: str) -> DataFrame:
    """What the last stage reads of the counted rows."""
    return prepared.transform(rows).select(last.getOrDefault("featuresCol"), last.getOrDefault("labelCol"), "_weight", *others)


def stored_split(df: DataFrame, key: str, columns: list[str], pieces: int | None = None, test_share: float = 0.25,
                 seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``split`` with the given columns only, written once; ``pieces`` adds ``_piece``, which deals the rows by a hash of the key."""
    dealt = [] if pieces is None else [F.pmod(F.xxhash64(key), F.lit(pieces)).cast("int").alias("_piece")]
    rows = cut_lineage(df.select(*columns, *dealt, _held_out(key, test_share, seed).alias("_held_out")))
    return rows.filter("NOT _held_out").drop("_held_out"), rows.filter("_held_out").drop("_held_out")


def split(df: DataFrame, key: str, test_share: float = 0.25, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same split on every run, cluster and SQL engine."""
    held_out = _held_out(key, test_share, seed)
    return df.filter(~held_out), df.filter(held_out)


def place_of(key: str, seed: int = SEED) -> Column:
    """A number from 0 on that follows from the key."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _held_out(key: str, test_share: float, seed: int) -> Column:
    return place_of(key, seed) % 10_000 < round(test_share * 10_000)


def signed(df: DataFrame, label: str = "label") -> DataFrame:
    """Labels 0/1 as -1/+1 for the ridge classifier."""
    return df.withColumn("signed_label", F.when(F.col(label) == 1, 1.0).otherwise(-1.0))


def search(stages: list, grid: list[dict], evaluator: Evaluator, train: DataFrame, fold: str = "fold", sample: int | None = None,
           seed: int = SEED) -> tuple[PipelineModel, list[tuple[dict, float]]]:
    """Cross-validated search over ``grid`` (settings of the last stage), all of it or a random sample.

    Column ``fold`` deals the rows to the folds.  As in ``fit_counted``, the preparation of a fold is learned
    from all rows of the others, and the last stage and the evaluator get equal rows once, with their number as weight.
    Returns the best model and every setting with its mean metric.
    """
    chosen = chosen_settings(grid, sample, seed)
    *preparation, last = stages
    tried = [_weighted(last).copy({last.getParam(name): value for name, value in setting.items()}) for setting in chosen]
    judge = evaluator.copy({evaluator.getParam("weightCol"): "_weight"})
    rows = cut_lineage(counted(train))
    folds = [r[0] for r in rows.select(fold).distinct().orderBy(fold).collect()]
    totals = [0.0] * len(chosen)
    for number in folds:
        others = F.col(fold) != number
        kept = _features(Pipeline(stages=preparation).fit(train.filter(others)), rows, last, fold).persist()
        for at, estimator in enumerate(tried):
            totals[at] += judge.evaluate(estimator.fit(kept.filter(others)).transform(kept.filter(~others)))
        kept.unpersist()
    means = [total / len(folds) for total in totals]
    best = means.index(max(means) if evaluator.isLargerBetter() else min(means))
    prepared = Pipeline(stages=preparation).fit(train)
    fitted = tried[best].fit(_features(prepared, rows, last))
    return PipelineModel([*prepared.stages, fitted]), list(zip(chosen, means))


def chosen_settings(grid: list[dict], sample: int | None = None, seed: int = SEED) -> list[dict]:
    """All settings, or a random sample that is the same on every run."""
    return grid if sample is None or sample >= len(grid) else random.Random(seed).sample(grid, sample)


def grid_of(**values: list) -> list[dict]:
    """All combinations of the given settings."""
    grid: list[dict] = [{}]
    for name, options in values.items():
        grid = [{**setting, name: option} for setting in grid for option in options]
    return grid


def importances(fitted: PipelineModel, names: list[str]) -> dict[str, float]:
    """Importance per feature: tree importances or absolute coefficients of the last stage."""
    last = fitted.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    return dict(zip(names, [float(v) for v in values]))


def permuted(df: DataFrame, key: str, column: str, seed: int = SEED) -> DataFrame:
    """``df`` with one column dealt out anew among the rows, see ``dealt_anew``."""
    return dealt_anew(df, key, [column], seed).drop(column).withColumnRenamed(f"{column}_anew", column)


def dealt_anew(df: DataFrame, key: str, columns: list[str], seed: int = SEED) -> DataFrame:
    """``df`` with ``<column>_anew``: the columns dealt out anew among the rows, all in the same order.

    Rows are numbered once by key and once by a hash of the key; the two numberings are
    joined, so the permutation is the same on every run and no task sees a whole column.
    """
    targets = global_row_number(df, [F.col(key)], "_number")
    given = df.select(key, *[F.col(c).alias(f"{c}_anew") for c in columns])
    donors = global_row_number(given, [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)], "_number").drop(key)
    return targets.join(donors, "_number").drop("_number")


def cascade(first: list, second: list, train: DataFrame, test: DataFrame, name: str) -> DataFrame:
    """Predict with one chain, hand its prediction to the next chain as column ``name``; both are fitted on counted rows."""
    opening = fit_counted(first, train)
    def scored(df):
        return opening.transform(df).select(*df.columns, F.col("prediction").alias(name))
    return fit_counted(second, cut_lineage(scored(train))).transform(scored(test))
