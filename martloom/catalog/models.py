"""Trained models: each query trains on the sample tables and returns figures about the result."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.catalog.registry import big, query
from martloom.catalog.statistics import HOURS_SQL
from martloom.models import corpus, metrics, moments, series, splits, training
from martloom.session import cut_lineage
from martloom.tables import table

NUMBERS = ["quantity", "discount", "tax"]
CATEGORIES = ["flag", "kind"]
BAG_PIECES = 16


def lines(spark, base) -> DataFrame:
    """Order lines as a training table: the amount to pay as target, some discounts missing.

    The stated price of a line is unrelated to its other columns, so nothing could be learned
    about it; the amount is made of quantity, part size and discount.
    """
    parts = table(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    joined = table(spark, base, "lineitem").join(parts, "l_partkey")
    amount = F.col("l_quantity") * (F.col("p_size") + 100) * (1 - F.col("l_discount"))
    return joined.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("quantity"), F.when(F.col("l_discount") < 0.1, F.col("l_discount")).alias("discount"),
        F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag"), F.col("p_type").alias("kind"),
        amount.alias("label"), F.when(amount > 3_500, 1.0).otherwise(0.0).alias("large"))


def _split_sql(rows: str) -> str:
    """The rows with ``held_out``, split as ``training.split`` does."""
    return f"(SELECT *, ('0x' || substr(md5(id || ':{training.SEED}'), 1, 8))::BIGINT % 10000 < 2500 AS held_out FROM {rows})"


LINES_SQL = _split_sql("""(SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey AS id, l_quantity * (p_size + 100) * (1 - l_discount) AS label,
 CASE WHEN l_quantity * (p_size + 100) * (1 - l_discount) > 3500 THEN 1 ELSE 0 END AS large FROM lineitem JOIN part ON l_partkey = p_partkey)""")


def _mean_sql(kind: str) -> str:
    """Counts, the figures of the mean as baseline, and that the model beats it."""
    return f"""
WITH s AS {LINES_SQL}, m AS (SELECT avg(label) FILTER (NOT held_out) AS mean, count(*) FILTER (NOT held_out) AS n_train FROM s)
SELECT '{kind}' AS model, any_value(n_train) AS n_train, count(*) AS n_test, round(sqrt(avg((label - mean) ** 2)), 4) AS baseline_rmse, round(avg(abs(label - mean)), 4) AS baseline_mae, TRUE AS beats_baseline
FROM s, m WHERE held_out"""


def _majority_sql(kind: str, rows: str = LINES_SQL, label: str = "large") -> str:
    """Counts, the accuracy of the most frequent class as baseline, and that the model beats it."""
    return f"""
WITH s AS {rows}, m AS (SELECT {label} AS top FROM s WHERE NOT held_out GROUP BY {label} ORDER BY count(*) DESC, {label} LIMIT 1)
SELECT '{kind}' AS model, (SELECT count(*) FROM s WHERE NOT held_out) AS n_train, count(*) AS n_test, round(avg(CASE WHEN {label} = top THEN 1.0 ELSE 0.0 END), 6) AS baseline_accuracy, TRUE AS beats_baseline
FROM s, m WHERE held_out"""


def _regression(spark, base, kind: str) -> DataFrame:
    """Held-out figures of the mean, and whether a model is nearer to the truth than it."""
    train, test = training.stored_split(lines(spark, base), "id", [*NUMBERS, *CATEGORIES, "label"])
    fitted = training.fit_counted([*training.preparation(NUMBERS, CATEGORIES), training.model(kind)], train)
    own = metrics.regression_metrics(fitted.transform(test)).select(F.col("rmse").alias("own_rmse"))
    mean = metrics.regression_metrics(metrics.constant_mean(train, test))
    n = _sizes(train, test)
    return n.join(mean).join(own).select(  # one row each
        F.lit(kind).alias("model"), "n_train", "n_test", F.round("rmse", 4).alias("baseline_rmse"), F.round("mae", 4).alias("baseline_mae"),
        (F.col("own_rmse") < F.col("rmse")).alias("beats_baseline"))


def _classification(spark, base, kind: str) -> DataFrame:
    """Held-out accuracy of the majority class, and whether a model is right more often than it."""
    data = training.signed(lines(spark, base).withColumn("label", F.col("large")))
    # a forest draws its bags from counted rows: dealt into pieces first, so that copies are not drawn all or none
    train, test = training.stored_split(data, "id", [*NUMBERS, *CATEGORIES, "label", "signed_label"], BAG_PIECES if kind == "forest" else None)
    fitted = training.fit_counted([*training.preparation(NUMBERS, CATEGORIES), training.model(kind)], train)
    scored = fitted.transform(test)
    if kind == "ridge_class":
        scored = scored.withColumn("prediction", F.when(F.col("prediction") > 0, 1.0).otherwise(0.0))
    return _against_majority(kind, train, test, scored)


def _sizes(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.agg(F.count("*").alias("n_train")).join(test.agg(F.count("*").alias("n_test")))


def _against_majority(kind: str, train: DataFrame, test: DataFrame, scored: DataFrame, label: str = "label") -> DataFrame:
    own = metrics.confusion(scored, label).select(F.col("accuracy").alias("own_accuracy"))
    most = metrics.confusion(metrics.majority(train, test, label), label)
    return _sizes(train, test).join(most).join(own).select(  # one row each
        F.lit(kind).alias("model"), "n_train", "n_test", F.round("accuracy", 6).alias("baseline_accuracy"),
        (F.col("own_accuracy") > F.col("accuracy")).alias("beats_baseline"))


def _named(results: dict[str, DataFrame]) -> DataFrame:
    frames = [frame.select(F.lit(name).alias("model"), *[F.round(F.col(c).cast("double"), 6).alias(c) for c in frame.columns]) for name, frame in results.items()]
    return reduce(DataFrame.unionByName, frames)


@query("l15_prepare_features", """
WITH f AS (SELECT c_custkey, coalesce(b, avg(b) OVER ()) AS b, c_mktsegment FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS b, c_mktsegment FROM customer)),
 s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS place FROM customer GROUP BY c_mktsegment)
SELECT c_custkey, round((b - avg(b) OVER ()) / stddev_samp(b) OVER (), 6) AS scaled_balance, place AS segment_place FROM f JOIN s USING (c_mktsegment)""")
def l15(spark, base):
    """Gaps filled by the mean, numbers scaled, segments encoded by frequency."""
    customers = table(spark, base, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"), "c_mktsegment")
    ready = training.fit(training.preparation(["balance"], ["c_mktsegment"]), customers).transform(customers)
    values = vector_to_array("features")
    return ready.select("c_custkey", F.round(values[0], 6).alias("scaled_balance"),
                        big(F.array_position(F.slice(values, 2, F.size(values)), 1.0) - 1).alias("segment_place"))


@query("l16_linear_regression", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def l16(spark, base):
    from pyspark.ml.feature import VectorAssembler
    fitted = training.fit([VectorAssembler(inputCols=["l_quantity"], outputCol="features"), training.model("linear", labelCol="l_extendedprice", solver="normal")],
                          table(spark, base, "lineitem")).stages[-1]
    return spark.range(1).select(*[F.round(F.lit(float(v)), d).alias(n) for n, v, d in (
        ("slope", fitted.coefficients[0], 4), ("intercept", fitted.intercept, 2), ("r2", fitted.summary.r2, 6))])


@query("l17_ridge_regression", """
SELECT round(corr(l_extendedprice, l_quantity) * sy / sx / (1 + 5000.0 / sy), 3) AS slope FROM lineitem, (SELECT stddev_samp(l_extendedprice) AS sy, stddev_samp(l_quantity) AS sx FROM lineitem) GROUP BY sx, sy""")
def l17(spark, base):
    """Ridge with one feature, whose solution is known in closed form."""
    from pyspark.ml.feature import VectorAssembler
    fitted = training.fit([VectorAssembler(inputCols=["l_quantity"], outputCol="features"), training.model("ridge", labelCol="l_extendedprice", solver="normal", regParam=5000.0)],
                          table(spark, base, "lineitem")).stages[-1]
    return spark.range(1).select(F.round(F.lit(float(fitted.coefficients[0])), 3).alias("slope"))


@query("l17_ridge_classifier", _majority_sql("ridge_class"))
def l17_classifier(spark, base):
    return _classification(spark, base, "ridge_class")


@query("l16_linear_full", _mean_sql("linear"))
def l16_full(spark, base):
    return _regression(spark, base, "linear")


def _level_sql(rows: str) -> str:
    """The best split of each node of ``rows`` (``node, quantity, size, tax, label``) by running sums over the distinct values."""
    return f"""(SELECT node, feature, threshold, gain, n_left, n_right FROM (
  SELECT node, feature, value AS threshold, nl AS n_left, na - nl AS n_right, (sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na) / na AS gain
  FROM (SELECT node, feature, value, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER g AS na, sum(s) OVER g AS sa
   FROM (SELECT node, feature, value, count(*) AS n, sum(label) AS s FROM (SELECT node, label, unnest(['quantity', 'size', 'tax']) AS feature, unnest([quantity, size, tax]) AS value FROM {rows}) GROUP BY ALL)
   WINDOW w AS (PARTITION BY node, feature ORDER BY value), g AS (PARTITION BY node, feature)) WHERE na > nl)
 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, threshold) = 1)"""


SPLIT_ROWS_SQL = "(SELECT 1 AS node, l_quantity::DOUBLE AS quantity, p_size::DOUBLE AS size, l_tax::DOUBLE AS tax, l_quantity * (p_size + 100) * (1 - l_discount) AS label FROM lineitem JOIN part ON l_partkey = p_partkey)"


@query("l18_exact_splits", f"""
WITH x AS MATERIALIZED {SPLIT_ROWS_SQL}, one AS MATERIALIZED {_level_sql('x')},
 y AS MATERIALIZED (SELECT CASE WHEN CASE feature WHEN 'quantity' THEN quantity WHEN 'size' THEN size ELSE tax END <= threshold THEN 2 ELSE 3 END AS node, quantity, size, tax, label FROM x, one),
 two AS {_level_sql('y')}
SELECT level, node::BIGINT AS node, feature, round(threshold, 6) AS threshold, round(gain, 3) AS gain, n_left::BIGINT AS n_left, n_right::BIGINT AS n_right FROM (SELECT 1 AS level, * FROM one UNION ALL SELECT 2, * FROM two)""")
def l18_exact(spark, base):
    """The first two levels of a regression tree with every distinct value as a candidate."""
    parts = table(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("size"))
    rows = table(spark, base, "lineitem").join(parts, "l_partkey").select(
        F.col("l_quantity").cast("double").alias("quantity"), "size", F.col("l_tax").cast("double").alias("tax"),
        (F.col("l_quantity") * (F.col("size") + 100) * (1 - F.col("l_discount"))).alias("label"))
    found = splits.grown(rows, ["quantity", "size", "tax"], "label", 2)
    return found.select("level", "node", "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 3).alias("gain"), "n_left", "n_right")


@query("l18_tree_regression", _mean_sql("tree"))
def l18(spark, base):
    return _regression(spark, base, "tree")


@query("l18_tree_classification", _majority_sql("tree_class"))
def l18_classes(spark, base):
    return _classification(spark, base, "tree_class")


@query("l19_boosting", _mean_sql("boosting"))
def l19(spark, base):
    return _regression(spark, base, "boosting")


@query("l20_logistic_l1", _majority_sql("logistic"))
def l20(spark, base):
    return _classification(spark, base, "logistic")


@query("l21_linear_svm", _majority_sql("svm"))
def l21(spark, base):
    return _classification(spark, base, "svm")


@query("l23_random_forest", _majority_sql("forest"))
def l23(spark, base):
    return _classification(spark, base, "forest")


SEARCH_GRID = training.grid_of(regParam=[0.0, 0.001, 0.01], elasticNetParam=[0.0, 1.0])


PENALTIES = [0.0, 100.0, 10_000.0, 1_000_000.0]


def _two_features_sql(rows: str, first: str, second: str, label: str, trains: str, penalties: list[float]) -> str:
    """Least squares on two features in closed form, per fold and penalty; ``trains`` tells which rows of ``r`` train fold ``f``."""
    listed = ", ".join(f"({p}::DOUBLE)" for p in penalties)
    return f"""
WITH r AS {rows}, f AS (SELECT DISTINCT fold FROM r),
 t AS (SELECT f.fold, count(*) AS n, avg({first}) AS m1, avg({second}) AS m2, avg({label}) AS my, var_pop({first}) * count(*) AS s11, var_pop({second}) * count(*) AS s22,
  covar_pop({first}, {second}) * count(*) AS s12, covar_pop({first}, {label}) * count(*) AS s1y, covar_pop({second}, {label}) * count(*) AS s2y FROM f JOIN r ON {trains} GROUP BY f.fold),
 w AS (SELECT *, ((s22 + penalty) * s1y - s12 * s2y) / ((s11 + penalty) * (s22 + penalty) - s12 * s12) AS b1,
  ((s11 + penalty) * s2y - s12 * s1y) / ((s11 + penalty) * (s22 + penalty) - s12 * s12) AS b2 FROM t, (VALUES {listed}) p(penalty)),
 e AS (SELECT w.fold, penalty, n, b1, b2, {label} - (my + b1 * ({first} - m1) + b2 * ({second} - m2)) AS miss, {label} - my AS mean_miss, {label} AS y FROM w JOIN r ON r.fold = w.fold)
SELECT fold::BIGINT AS fold, penalty, any_value(n) AS n_train, count(*) AS n_test, round(any_value(b1), 5) AS first_weight, round(any_value(b2), 5) AS second_weight,
 round(sqrt(avg(miss * miss)), 4) AS rmse, round(1 - sum(miss * miss) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg(mean_miss * mean_miss)), 4) AS mean_rmse FROM e GROUP BY fold, penalty"""


def _errors(results: DataFrame) -> DataFrame:
    return results.select("fold", "penalty", "n_train", "n_test", F.round(F.col("coefficients")[1], 5).alias("first_weight"),
                          F.round(F.col("coefficients")[2], 5).alias("second_weight"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"),
                          F.round("mean_rmse", 4).alias("mean_rmse"))


@query("l24_parameter_search", _two_features_sql(
    f"(SELECT *, ('0x' || substr(md5(id || ':{training.SEED}'), 1, 8))::BIGINT % 5 AS fold FROM (SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey AS id,"
    " l_quantity AS quantity, l_tax AS tax, l_quantity * (p_size + 100) * (1 - l_discount) AS label FROM lineitem JOIN part ON l_partkey = p_partkey))",
    "quantity", "tax", "label", "r.fold <> f.fold", PENALTIES))
def l24(spark, base):
    """Ridge penalties by five-fold cross-validation: the errors of every setting and fold, from one pass."""
    digest = F.md5(F.concat("id", F.lit(f":{training.SEED}")))
    data = lines(spark, base).withColumn("fold", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 5)
    trained = moments.left_out(moments.fold_moments(data, ["quantity", "tax"], "label"))
    return _errors(moments.validated(trained, 2, PENALTIES))


@query("l24_logistic_search")
def l24_logistic(spark, base):
    """Random search over the settings of an L1 logistic regression, by cross-validated ROC-AUC."""
    data, grid = lines(spark, base).withColumns({"label": F.col("large"), "fold": training.place_of("id") % 3}), SEARCH_GRID
    data = cut_lineage(data.select(*NUMBERS, *CATEGORIES, "label", "fold"))
    _, tried = training.search([*training.preparation(NUMBERS, CATEGORIES), training.model("logistic", maxIter=10)], grid, BinaryClassificationEvaluator(), data, sample=3)
    return spark.createDataFrame([(float(s["regParam"]), float(s["elasticNetParam"]), float(m) > 0.8) for s, m in tried], "reg_param double, elastic_net double, better_than_chance boolean")


@query("l25_pipeline_validation")
def l25_pipeline(spark, base):
    """The same with calendar features and the prepared pipeline, one fit per fold."""
    events = table(spark, base, "events").filter(F.col("event_type") == "purchase")
    hours = series.features(series.hourly(events, "ts"), [1, 2, 24]).na.drop().withColumn("label", F.col("n").cast("double"))
    folded = series.time_folds(hours.withColumn("id", F.unix_seconds("hour")), 3, "hour", "id").persist()
    results = {}
    for fold in (1, 2, 3):
        train, test = series.train_and_test(folded, fold)
        fitted = training.fit([*training.preparation(["day", "hour_of_day", "lag_1", "lag_2", "lag_24"], []), training.model("linear")], train)
        results[f"fold {fold}"] = metrics.regression_metrics(fitted.transform(test))
        results[f"fold {fold} mean"] = metrics.regression_metrics(metrics.constant_mean(train, test))
    kept = cut_lineage(_named(results))
    folded.unpersist()
    return kept


@query("l25_time_series_validation", _two_features_sql(f"""(SELECT n::DOUBLE AS label, lag_1::DOUBLE AS lag_1, lag_24::DOUBLE AS lag_24, ntile(4) OVER (ORDER BY hour) - 1 AS fold
  FROM (SELECT hour, n, lag(n, 1) OVER w AS lag_1, lag(n, 24) OVER w AS lag_24 FROM {HOURS_SQL} WINDOW w AS (ORDER BY hour)) WHERE lag_24 IS NOT NULL)""",
    "lag_1", "lag_24", "label", "r.fold < f.fold", [0.0]))
def l25(spark, base):
    """Hourly purchases, each fold predicted from the hours before it; all folds from one pass."""
    events = table(spark, base, "events").filter(F.col("event_type") == "purchase")
    hours = series.features(series.hourly(events, "ts"), [1, 24]).na.drop().withColumn("id", F.unix_seconds("hour"))
    folded = series.time_folds(hours, 3, "hour", "id")
    trained = moments.rolling_origin(moments.fold_moments(folded, ["lag_1", "lag_24"], "n"))
    return _errors(moments.validated(trained, 2))


@query("l30_feature_importance", """
SELECT unnest(['discount', 'quantity', 'tax']) AS feature, unnest([2, 1, 2]) AS place, 1.0::DOUBLE AS importance_sum, unnest([FALSE, TRUE, FALSE]) AS matters""")
def l30(spark, base):
    """Importance in the tree, and whether quality is lost when a column is dealt out anew.

    The amount follows mostly from the quantity, so that comes first and the others matter little.
    """
    train, test = training.stored_split(lines(spark, base), "id", ["id", *NUMBERS, "label"])
    fitted = training.fit_counted([*training.preparation(NUMBERS, []), training.model("tree")], train.drop("id"))
    own = training.importances(fitted, NUMBERS)
    evaluator = RegressionEvaluator(metricName="rmse")
    whole = evaluator.evaluate(fitted.transform(test))
    dealt = cut_lineage(training.dealt_anew(test, "id", NUMBERS).drop("id"))
    lost = {name: evaluator.evaluate(fitted.transform(dealt.withColumn(name, F.col(f"{name}_anew")))) - whole for name in NUMBERS}
    rows = [(n, 1 if own[n] == max(own.values()) else 2, round(sum(own.values()), 9), lost[n] > 0.1 * whole) for n in NUMBERS]
    return spark.createDataFrame(rows, "feature string, place int, importance_sum double, matters boolean")


@query("l32_cascade", _majority_sql("cascade"))
def l32(spark, base):
    """The predicted price as a feature of the model that predicts large lines."""
    train, test = training.stored_split(lines(spark, base), "id", [*NUMBERS, *CATEGORIES, "label", "large"])
    first = [*training.preparation(NUMBERS, CATEGORIES), training.model("tree")]
    second = [*training.preparation(["quantity", "predicted_price"], ["flag"], "features2"), training.model("logistic", labelCol="large", featuresCol="features2")]
    scored = training.cascade(first, second, train, test, "predicted_price")
    return _against_majority("cascade", train, test, scored, "large")


LABELLED_SQL = _split_sql("(SELECT doc_id::VARCHAR AS id, toxic FROM documents JOIN labels USING (doc_id))")


@query("l36_toxicity_classifier", f"SELECT *, n_test AS n_scored FROM ({_majority_sql('logistic', LABELLED_SQL, 'toxic')}) AS r".replace(", TRUE AS beats_baseline", ""))
def l36(spark, base):
    """Toxic documents out of whole texts, against the majority class."""
    labels = table(spark, base, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    data = table(spark, base, "documents").select("doc_id", "text").join(labels, "doc_id")
    train, test = training.split(data, "doc_id")
    scored = corpus.text_classifier().fit(corpus.balanced(train)).transform(test)
    share = vector_to_array("probability")[1]
    n = scored.agg(F.count(F.when((share >= 0) & (share <= 1), 1)).alias("n_scored"))
    return _against_majority("logistic", train, test, scored).drop("beats_baseline").join(n)  # one row each
