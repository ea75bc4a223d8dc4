"""Statistics: description, tests, series, metrics, neighbours, bootstrap, term weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog.registry import big, query, time_text
from martloom.functions.numeric import money, money_total
from martloom.models import bootstrap, corpus, describe, hypothesis, metrics, neighbours, series
from martloom.sizing import spread_if_small
from martloom.tables import table

GAPS_SQL = """(SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, CASE WHEN c_acctbal < 9000 THEN c_mktsegment END AS segment, CASE WHEN c_acctbal > 500 THEN c_name END AS name FROM customer)"""


def _gaps(spark, base):
    balance = F.col("c_acctbal")
    return table(spark, base, "customer").select(
        "c_custkey", F.when(balance >= 0, balance).alias("balance"), F.when(balance < 9000, F.col("c_mktsegment")).alias("segment"),
        F.when(balance > 500, F.col("c_name")).alias("name"))


@query("l01_missing_profile", f"""
SELECT column_name, missing, CAST(missing AS DOUBLE) / n AS share FROM (SELECT count(*) AS n, count(*) - count(balance) AS balance, count(*) - count(segment) AS segment, count(*) - count(name) AS name FROM {GAPS_SQL})
UNPIVOT (missing FOR column_name IN (balance, segment, name))""")
def l01_profile(spark, base):
    return describe.missing_profile(_gaps(spark, base), ["balance", "segment", "name"])


@query("l01_impute", f"""
SELECT c_custkey, round(coalesce(balance, (SELECT avg(balance) FROM {GAPS_SQL})), 4) AS balance,
 coalesce(segment, (SELECT segment FROM {GAPS_SQL} WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)) AS segment, coalesce(name, 'unk') AS name FROM {GAPS_SQL}""")
def l01_impute(spark, base):
    filled = describe.impute(_gaps(spark, base), ["balance"], ["segment"], {"name": "unk"})
    return filled.select("c_custkey", F.round("balance", 4).alias("balance"), "segment", "name")


@query("l02_first_copies", "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text, lang")
def l02(spark, base):
    return describe.first_copies(table(spark, base, "documents"), "doc_id", ["text", "lang"])


@query("l02_without_copies", "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)")
def l02_rows(spark, base):
    return describe.without_copies(table(spark, base, "documents"), "doc_id", ["text"]).select("doc_id", "n_chars")


@query("l03_place_names", """
SELECT CASE WHEN n_nationkey = 3 THEN 'third nation' ELSE replace(lower(n_name), '_', ' ') END AS place, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def l03(spark, base):
    """Nation names in three spellings, one of them an alias, brought together."""
    nations = table(spark, base, "nation").select("n_nationkey", "n_name")
    customers = table(spark, base, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    spelling = F.when(F.col("c_acctbal") < 2000, F.concat(F.lit("  "), F.lower("n_name"))).when(
        F.col("c_acctbal") < 6000, F.regexp_replace("n_name", "_", " - ")).otherwise(F.col("n_name"))
    aliases = nations.filter(F.col("n_nationkey") == 3).select(F.col("n_name").alias("spelling"), F.lit("third nation").alias("place"))
    return describe.unified_places(customers.select(spelling.alias("place")), "place", aliases).groupBy("place").agg(F.count("*").alias("customers"))


QUARTILES_SQL = """(SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events)"""


@query("l04_without_outliers", f"""
SELECT event_id, value FROM events, {QUARTILES_SQL} WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def l04(spark, base):
    return describe.within_quartiles(table(spark, base, "events").select("event_id", "value"), "value")


@query("l04_within_range", "SELECT c_custkey FROM customer WHERE c_acctbal BETWEEN 0 AND 5000 AND c_nationkey BETWEEN 5 AND 20")
def l04_range(spark, base):
    return describe.within_range(table(spark, base, "customer"), {"c_acctbal": (0, 5000), "c_nationkey": (5, 20)}).select("c_custkey")


@query("l05_box_plot", f"""
SELECT round(q1 - 1.5 * (q3 - q1), 6) AS low, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 + 1.5 * (q3 - q1), 6) AS high FROM {QUARTILES_SQL}""")
def l05(spark, base):
    bounds = describe.quartile_bounds(table(spark, base, "events"), "value")
    return bounds.select(*[F.round(c, 6).alias(c) for c in bounds.columns])


@query("l05_histogram", """
SELECT CAST(CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 90000 THEN 9 ELSE floor((l_extendedprice - 10000) / 10000) + 1 END AS BIGINT) AS bucket, count(*) AS rows FROM lineitem GROUP BY 1""")
def l05_histogram(spark, base):
    return describe.histogram(table(spark, base, "lineitem"), "l_extendedprice", 10_000, 90_000, 8).withColumn("bucket", big("bucket"))


@query("l05_quantiles", """
SELECT unnest([0.05, 0.5, 0.95])::DOUBLE AS share, round(unnest(quantile_cont(o_totalprice, [0.05, 0.5, 0.95])), 6) AS quantile FROM orders""")
def l05_quantiles(spark, base):
    from martloom.operators.ordering import exact_quantiles
    return exact_quantiles(table(spark, base, "orders"), "o_totalprice", [0.05, 0.5, 0.95]).withColumn("quantile", F.round("quantile", 6))


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "gross"]
NUMERIC_SQL = "(SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * 1.1::DOUBLE + l_quantity AS gross FROM lineitem)"


def _numeric(spark, base):
    return table(spark, base, "lineitem").withColumn("gross", F.col("l_extendedprice") * 1.1 + F.col("l_quantity")).select(*NUMERIC)


@query("l06_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) AS r FROM {NUMERIC_SQL}"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]))
def l06(spark, base):
    return describe.correlations(_numeric(spark, base), NUMERIC).withColumn("r", F.round("r", 6))


@query("l06_uncorrelated_columns", f"""
SELECT sum(l_quantity) AS l_quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice, CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS l_discount, CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS l_tax FROM {NUMERIC_SQL}""")
def l06_columns(spark, base):
    """Totals of the columns that are left: the gross amount repeats the price and is dropped."""
    frame = _numeric(spark, base)
    return frame.agg(*[money_total(F.col(c)).alias(c) for c in describe.uncorrelated_columns(frame, NUMERIC)])


@query("l07_cramers_v", """
WITH c AS (SELECT l_returnflag AS a, floor(l_quantity / 10) AS b, count(*) AS n FROM lineitem GROUP BY ALL),
 s AS (SELECT sum(n) AS n, sum(n * n / (ra * rb)) AS s FROM (SELECT n::DOUBLE AS n, sum(n::DOUBLE) OVER (PARTITION BY a) AS ra, sum(n::DOUBLE) OVER (PARTITION BY b) AS rb FROM c))
SELECT CAST(n AS BIGINT) AS n, round(n * (s - 1), 4) AS chi2, round(sqrt((s - 1) / 2), 6) AS v FROM s""")
def l07(spark, base):
    tested = describe.cramers_v(table(spark, base, "lineitem"), F.col("l_returnflag"), F.floor(F.col("l_quantity") / 10))
    return tested.select("n", F.round("chi2", 4).alias("chi2"), F.round("v", 6).alias("v"))


def _two_sql(error: str, dof: str) -> str:
    return f"""
SELECT n1, n2, round((m1 - m2) / {error}, 6) AS t, round({dof}, 4) AS dof FROM (SELECT count(*) FILTER (s = 'F') AS n1, count(*) FILTER (s <> 'F') AS n2, avg(p) FILTER (s = 'F') AS m1, avg(p) FILTER (s <> 'F') AS m2,
 var_samp(p) FILTER (s = 'F') AS v1, var_samp(p) FILTER (s <> 'F') AS v2 FROM (SELECT o_orderstatus AS s, o_totalprice AS p FROM orders))"""


@query("l08_two_sample_test", _two_sql("sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2))", "CAST(n1 + n2 - 2 AS DOUBLE)"))
def l08(spark, base):
    tested = hypothesis.two_samples(table(spark, base, "orders"), F.col("o_totalprice"), F.col("o_orderstatus") == "F")
    return tested.select("n1", "n2", F.round("t", 6).alias("t"), F.round("dof", 4).alias("dof"))


@query("l08_unequal_variances", _two_sql("sqrt(v1 / n1 + v2 / n2)", "(v1 / n1 + v2 / n2) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1))"))
def l08_unequal(spark, base):
    tested = hypothesis.two_samples(table(spark, base, "orders"), F.col("o_totalprice"), F.col("o_orderstatus") == "F", equal_variances=False)
    return tested.select("n1", "n2", F.round("t", 6).alias("t"), F.round("dof", 4).alias("dof"))


@query("l09_one_sample_test", """
SELECT count(*) AS n, round((avg(l_quantity) - 25.5) / sqrt(var_samp(l_quantity) / count(*)), 6) AS t, CAST(count(*) - 1 AS DOUBLE) AS dof FROM lineitem""")
def l09(spark, base):
    return hypothesis.one_sample(table(spark, base, "lineitem"), F.col("l_quantity"), 25.5).withColumn("t", F.round("t", 6))


@query("l09_paired_test", """
SELECT count(d) AS n, round(avg(d) / sqrt(var_samp(d) / count(d)), 6) AS t, CAST(count(d) - 1 AS DOUBLE) AS dof FROM
 (SELECT avg(value) FILTER (ts >= TIMESTAMP '2024-01-16') - avg(value) FILTER (ts < TIMESTAMP '2024-01-16') AS d FROM events GROUP BY user_id)""")
def l09_paired(spark, base):
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    pairs = table(spark, base, "events").groupBy("user_id").agg(
        F.avg(F.when(~late, F.col("value"))).alias("before"), F.avg(F.when(late, F.col("value"))).alias("after"))
    return hypothesis.paired(pairs, F.col("before"), F.col("after")).withColumn("t", F.round("t", 6))


def _simpson_sql(high: str) -> str:
    steps = hypothesis.SIMPSON_STEPS
    return (f"(({high} - a) / {steps} / 3 * list_sum(list_transform(range({steps + 1}), lambda i: "
            f"(CASE WHEN i = 0 OR i = {steps} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)::DOUBLE * pow(sin(a + i * ({high} - a) / {steps}), dof - 1))))")


@query("l09_p_values", f"""
WITH s AS (SELECT count(*) AS n, (avg(l_quantity) - 25.5) / sqrt(var_samp(l_quantity) / count(*)) AS t, CAST(count(*) - 1 AS DOUBLE) AS dof FROM lineitem),
 b AS (SELECT *, greatest(0.0::DOUBLE, pi() / 2 - 40 / sqrt(dof)) AS a FROM s),
 g AS (SELECT *, greatest(a, asin(sqrt(dof / (dof + t * t)))) AS top FROM b),
 p AS (SELECT n, t, {_simpson_sql('top')} / {_simpson_sql('pi() / 2')} AS tails FROM g)
SELECT n, round(t, 6) AS t, round(CASE WHEN t > 0 THEN 1 - tails / 2 ELSE tails / 2 END, 6) AS p_value FROM p""")
def l09_p(spark, base):
    """The same tests with their one-sided p-values."""
    tested = hypothesis.one_sample(table(spark, base, "lineitem"), F.col("l_quantity"), 25.5)
    return hypothesis.with_p_value(tested, "less").select("n", F.round("t", 6).alias("t"), F.round("p_value", 6).alias("p_value"))


@query("l10_user_month", """
SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
 CAST(sum(ceil(o_totalprice / 1000)) AS BIGINT) AS started_thousands FROM orders GROUP BY ALL""")
def l10(spark, base):
    return table(spark, base, "orders").groupBy("o_custkey", big(F.year("o_orderdate")).alias("y"), big(F.month("o_orderdate")).alias("m")).agg(
        F.count("*").alias("orders"), money_total(F.col("o_totalprice")).alias("revenue"), F.sum(F.ceil(F.col("o_totalprice") / 1000)).cast("bigint").alias("started_thousands"))


TOP_SQL = """(SELECT r_name, p_brand, revenue FROM (SELECT r_name, p_brand, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY r_name ORDER BY revenue DESC, p_brand) <= 5)"""


def _top_brands(spark, base):
    from pyspark.sql import Window
    lines = table(spark, base, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum(money(F.col("l_extendedprice"))).alias("amount"))
    regions = (table(spark, base, "supplier").join(table(spark, base, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
               .join(table(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("l_suppkey"), "r_name"))
    parts = table(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    sums = lines.join(parts, "l_partkey").join(regions, "l_suppkey").groupBy("r_name", "p_brand").agg(F.sum("amount").alias("revenue"))
    # one row per region and brand is left here
    place = F.row_number().over(Window.partitionBy("r_name").orderBy(F.col("revenue").desc(), "p_brand"))
    return sums.withColumn("place", place).filter(F.col("place") <= 5)


@query("l11_top_by_region", f"SELECT r_name, p_brand, CAST(revenue AS DOUBLE) AS revenue FROM {TOP_SQL}")
def l11(spark, base):
    return _top_brands(spark, base).select("r_name", "p_brand", F.col("revenue").cast("double").alias("revenue"))


@query("l11_top_overlap", f"SELECT p_brand, count(*) AS regions FROM {TOP_SQL} GROUP BY p_brand")
def l11_overlap(spark, base):
    return _top_brands(spark, base).groupBy("p_brand").agg(F.count("*").alias("regions"))


@query("l12_dearest_places", """
SELECT n_name, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS mean_price FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY mean_price DESC, n_name LIMIT 10""")
def l12(spark, base):
    per_customer = table(spark, base, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(money(F.col("o_totalprice"))).alias("amount"), F.count("*").alias("n"))
    named = per_customer.join(table(spark, base, "customer"), "c_custkey").join(table(spark, base, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    mean = F.round(F.sum("amount").cast("double") / F.sum("n"), 6).alias("mean_price")
    return named.groupBy("n_name").agg(mean).orderBy(F.col("mean_price").desc(), "n_name").limit(10)


HOURS_SQL = """(SELECT h AS hour, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS h FROM events WHERE event_type = 'purchase')
 LEFT JOIN (SELECT date_trunc('hour', ts) AS t, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) ON h = t)"""


@query("l13_hourly_resample", f"SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, n FROM {HOURS_SQL}")
def l13(spark, base):
    bought = table(spark, base, "events").filter(F.col("event_type") == "purchase")
    return series.hourly(bought, "ts").withColumn("hour", time_text("hour"))


@query("l14_series_features", f"""
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, n, day(hour)::BIGINT AS day, hour(hour)::BIGINT AS hour_of_day, lag(n, 1) OVER w AS lag_1, lag(n, 2) OVER w AS lag_2, lag(n, 24) OVER w AS lag_24 FROM {HOURS_SQL} WINDOW w AS (ORDER BY hour)""")
def l14(spark, base):
    bought = table(spark, base, "events").filter(F.col("event_type") == "purchase")
    return series.features(series.hourly(bought, "ts"), [1, 2, 24]).withColumn("hour", time_text("hour"))


@query("l22_neighbour_classes", """
SELECT query_id, label AS prediction FROM (SELECT query_id, label, row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, label) AS r FROM
 (SELECT q.vec_id AS query_id, t.label::BIGINT AS label FROM embeddings q JOIN embeddings t ON q.vec_id <> t.vec_id
  QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[]), t.vec_id) <= 5) GROUP BY query_id, label) WHERE r = 1""")
def l22(spark, base):
    """Each vector classified by its five nearest others."""
    vectors = table(spark, base, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return neighbours.classify(vectors.select("id", "vector"), vectors, 5).withColumn("prediction", big("prediction"))


@query("l25_time_folds", """
SELECT fold, count(*) AS rows, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts FROM (SELECT ts, CAST(ntile(6) OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS fold FROM events) GROUP BY fold""")
def l25(spark, base):
    folded = series.time_folds(table(spark, base, "events").select("event_id", "ts"), 5, "ts", "event_id")
    return folded.groupBy("fold").agg(F.count("*").alias("rows"), time_text(F.min("ts")).alias("first_ts"), time_text(F.max("ts")).alias("last_ts"))


@query("l26_baselines", """
WITH s AS (SELECT *, o_orderdate < TIMESTAMP '2000-01-01' AS train FROM orders), m AS (SELECT avg(o_totalprice) AS mean FROM s WHERE train), c AS (SELECT o_orderstatus AS top FROM s WHERE train GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT count(*) AS rows, round(avg(abs(o_totalprice - mean)), 4) AS mae, round(avg(CASE WHEN o_orderstatus = top THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM s, m, c WHERE NOT train""")
def l26(spark, base):
    orders = table(spark, base, "orders")
    early = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    train, test = orders.filter(early), orders.filter(~early)
    mean = metrics.constant_mean(train, test, "o_totalprice").withColumnRenamed("prediction", "mean")
    both = metrics.majority(train, mean, "o_orderstatus")
    return both.agg(F.count("*").alias("rows"), F.round(F.avg(F.abs(F.col("o_totalprice") - F.col("mean"))), 4).alias("mae"),
                    F.round(F.avg(F.when(F.col("o_orderstatus") == F.col("prediction"), 1.0).otherwise(0.0)), 6).alias("accuracy"))


@query("l27_regression_metrics", """
SELECT round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(avg(e * e), 2) AS mse, round(1 - avg(e * e) / var_pop(y), 6) AS r2, round(100 * avg(CASE WHEN abs(p) + abs(y) = 0 THEN 0 ELSE abs(e) / ((abs(p) + abs(y)) / 2) END), 6) AS smape
FROM (SELECT l_extendedprice AS y, l_quantity * 2000 AS p, l_quantity * 2000 - l_extendedprice AS e FROM lineitem)""")
def l27(spark, base):
    scored = table(spark, base, "lineitem").select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction"))
    m = metrics.regression_metrics(scored)
    return m.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2"), F.round("smape", 6).alias("smape"))


SCORED_SQL = "(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_quantity + l_discount AS score FROM lineitem)"


def _scored(spark, base):
    return table(spark, base, "lineitem").select(F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"), (F.col("l_quantity") + F.col("l_discount")).alias("score"))


@query("l28_confusion", f"""
SELECT tp, fp, fn, tn, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy, round(tp::DOUBLE / (tp + fp), 6) AS precision, round(tp::DOUBLE / (tp + fn), 6) AS recall, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1
FROM (SELECT count(*) FILTER (label = 1 AND p) AS tp, count(*) FILTER (label = 0 AND p) AS fp, count(*) FILTER (label = 1 AND NOT p) AS fn, count(*) FILTER (label = 0 AND NOT p) AS tn FROM (SELECT label, score > 25 AS p FROM {SCORED_SQL}))""")
def l28(spark, base):
    m = metrics.confusion(_scored(spark, base).withColumn("prediction", F.when(F.col("score") > 25, 1).otherwise(0)))
    return m.select("tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("l28_roc_auc", f"""
SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / (count(*) FILTER (label = 1)::DOUBLE * count(*) FILTER (label = 0)), 8) AS roc_auc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM {SCORED_SQL})""")
def l28_auc(spark, base):
    return metrics.roc_auc(_scored(spark, base)).withColumn("roc_auc", F.round("roc_auc", 8))


@query("l29_threshold", f"""
WITH g AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM {SCORED_SQL} GROUP BY score),
 c AS (SELECT score, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS p, sum(p + n) OVER () AS total FROM g WINDOW w AS (ORDER BY score DESC))
SELECT score AS threshold, round(tp::DOUBLE / (tp + fp), 6) AS precision, round(tp::DOUBLE / p, 6) AS recall, round(fp::DOUBLE / total, 6) AS false_positive_share FROM c WHERE fp::DOUBLE / total <= 0.02 ORDER BY score LIMIT 1""")
def l29(spark, base):
    best = metrics.threshold_for(_scored(spark, base), 0.02)
    return best.select("threshold", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "false_positive_share")])


@query("l31_segment_profile", """
SELECT c_mktsegment, count(*) AS customers, round(avg(share), 6) AS mean_share FROM (SELECT o_custkey, avg(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0::DOUBLE ELSE 0 END) AS share, count(*) AS n FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey
WHERE n >= 5 AND share >= 0.6 GROUP BY c_mktsegment""")
def l31(spark, base):
    """Customers under a rule and with a score of at least 0.6, described by segment."""
    urgent = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1.0).otherwise(0.0)
    scored = table(spark, base, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.avg(urgent).alias("share"), F.count("*").alias("n"))
    chosen = scored.filter((F.col("n") >= 5) & (F.col("share") >= 0.6)).join(table(spark, base, "customer"), "c_custkey")
    return chosen.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.round(F.avg("share"), 6).alias("mean_share"))


@query("l33_break_even", """
SELECT CAST(c_nationkey AS BIGINT) AS region, round(avg(o_totalprice), 4) AS mean_volume, round(avg(CASE WHEN o_totalprice > 300000 THEN 1.0 ELSE 0.0 END), 6) AS share_above FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def l33(spark, base):
    customers = table(spark, base, "customer").select(F.col("c_custkey").alias("o_custkey"), big("c_nationkey").alias("region"))
    figures = bootstrap.break_even(table(spark, base, "orders").join(customers, "o_custkey"), "region", "o_totalprice", 300_000)
    return figures.select("region", F.round("mean_volume", 4).alias("mean_volume"), F.round("share_above", 6).alias("share_above"))


BOOTSTRAP_SQL = """(WITH n AS (SELECT l_orderkey, o_totalprice AS actual, predicted, row_number() OVER (ORDER BY l_orderkey) AS number FROM orders JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS predicted FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey),
 d AS (SELECT r AS replicate, i AS draw, ('0x' || substr(md5('42:' || r || ':' || i), 1, 15))::BIGINT % (SELECT count(*) FROM n) + 1 AS number FROM range(1000) a(r), range(200) b(i)),
 s AS (SELECT replicate, actual FROM d JOIN n USING (number) QUALIFY row_number() OVER (PARTITION BY replicate ORDER BY predicted DESC, l_orderkey, draw) <= 50)
 SELECT replicate, CAST(sum(CAST(actual AS DECIMAL(28,6))) AS DOUBLE) * 0.01::DOUBLE - 130000.0::DOUBLE AS profit FROM s GROUP BY replicate)"""


def _profits(spark, base):
    predicted = table(spark, base, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(money(F.col("l_quantity"))).alias("predicted"))
    wells = table(spark, base, "orders").select("o_orderkey", F.col("o_totalprice").alias("actual")).join(predicted, "o_orderkey")
    return bootstrap.bootstrap_profit(wells, "o_orderkey", "predicted", "actual", 1000, 200, 50, 0.01, 130_000.0)


@query("l34_bootstrap_profit", f"SELECT replicate, round(profit, 4) AS profit FROM {BOOTSTRAP_SQL}")
def l34(spark, base):
    """1000 samples of 200 orders, the 50 with the largest predicted quantity sold."""
    return _profits(spark, base).withColumn("profit", F.round("profit", 4))


@query("l34_profit_summary", f"""
SELECT round(avg(profit), 4) AS mean_profit, round(quantile_cont(profit, 0.025), 4) AS low, round(quantile_cont(profit, 0.975), 4) AS high, round(avg(CASE WHEN profit < 0 THEN 1.0 ELSE 0.0 END), 6) AS loss_risk FROM {BOOTSTRAP_SQL}""")
def l34_summary(spark, base):
    s = bootstrap.profit_summary(_profits(spark, base))
    return s.select(*[F.round(c, 4).alias(c) for c in ("mean_profit", "low", "high")], F.round("loss_risk", 6).alias("loss_risk"))


STOP_SQL = "(" + ", ".join(f"'{w}'" for w in corpus.STOP_WORDS) + ")"


@query("l35_tf_idf", f"""
WITH t AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS term FROM documents) WHERE term NOT IN {STOP_SQL} GROUP BY ALL)
SELECT doc_id, term, n, round(n * ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1)), 6) AS weight FROM t JOIN (SELECT term, count(*) AS df FROM t GROUP BY term) USING (term)""")
def l35(spark, base):
    documents = spread_if_small(table(spark, base, "documents").select("doc_id", "text"))
    return corpus.tf_idf(documents, "doc_id", "text").withColumn("weight", F.round("weight", 6))


@query("l37_batch_log_features", f"""
SELECT user_id AS key, CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'click') AS DOUBLE) AS arc, CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'signup') AS DOUBLE) AS gas,
 arg_min(value, (ts, event_id)) FILTER (event_type = 'view') AS first_temp, arg_max(value, (ts, event_id)) FILTER (event_type = 'view') AS last_temp, count(*) FILTER (event_type = 'view') AS readings
FROM events WHERE NOT (event_type = 'click' AND value < 1) GROUP BY user_id HAVING count(*) FILTER (event_type = 'view') > 1""")
def l37(spark, base):
    """Sums per batch, first and last reading; bad power rows and single readings are left out."""
    kind, value, order = F.col("event_type"), F.col("value"), F.struct("ts", "event_id")
    good = table(spark, base, "events").filter(~((kind == "click") & (value < 1)))
    reading = F.when(kind == "view", order)
    return good.groupBy(F.col("user_id").alias("key")).agg(
        money_total(F.when(kind == "click", value)).alias("arc"), money_total(F.when(kind == "signup", value)).alias("gas"),
        F.min_by(value, reading).alias("first_temp"), F.max_by(value, reading).alias("last_temp"),
        F.count(reading).alias("readings")).filter(F.col("readings") > 1)


