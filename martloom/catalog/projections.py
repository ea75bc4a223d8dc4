"""Projections, filters and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog import standins as data
from martloom.catalog.registry import big, query
from martloom.functions.numeric import money, tiered_pay
from martloom.functions.time import in_day, running_at, since_year
from martloom.operators import checks
from martloom.schemas import EVENT_PROPS
from martloom.tables import table


@query("p01_project_rename", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS login FROM customer")
def p01(spark, base):
    return table(spark, base, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("login"))


@query("p02_flatten_struct", f"SELECT event_id, k FROM {data.EVENTS_K_SQL}")
def p02(spark, base):
    return table(spark, base, "events").select("event_id", F.from_json("props", EVENT_PROPS).alias("event")).select("event_id", "event.*")


@query("p03_compare_filter", """
SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase' AND user_id <> 3 AND value > 50""")
def p03(spark, base):
    return table(spark, base, "events").filter(
        (F.col("event_type") == "purchase") & (F.col("user_id") != 3) & (F.col("value") > 50)).select("event_id", "event_type", "value")


@query("p04_in_list", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'signup')")
def p04(spark, base):
    return table(spark, base, "events").filter(F.col("event_type").isin("click", "view", "signup")).select("event_id", "event_type")


@query("p05_not_null", f"""
SELECT event_id, message_to FROM (SELECT event_id, CASE WHEN event_type = 'message' THEN message_to END AS message_to FROM {data.GEO_SQL})
WHERE message_to IS NOT NULL""")
def p05(spark, base):
    return data.geo_events(spark, base).select(
        "event_id", F.when(F.col("event_type") == "message", F.col("message_to")).alias("message_to")).filter(F.col("message_to").isNotNull())


@query("p06_null_safe_equal", """
SELECT event_id, CASE WHEN CASE WHEN value > 100 THEN 1 END IS NOT DISTINCT FROM 1 THEN 1 ELSE 0 END AS large FROM events""")
def p06(spark, base):
    maybe = F.when(F.col("value") > 100, 1)
    return table(spark, base, "events").select("event_id", F.when(maybe.eqNullSafe(1), 1).otherwise(0).alias("large"))


@query("p07_one_day", """
SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-05-28'""")
def p07(spark, base):
    return table(spark, base, "orders").filter(in_day(F.col("o_orderdate"), "1997-05-28")).select("o_orderkey", "o_totalprice")


@query("p08_since_year", "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) >= 2000")
def p08(spark, base):
    return table(spark, base, "orders").filter(since_year(F.col("o_orderdate"), 2000)).select("o_orderkey", "o_custkey")


@query("p09_week_of_run_date", """
SELECT o_orderkey, CAST(week(o_orderdate) AS BIGINT) AS week_of_year FROM orders WHERE week(o_orderdate) = week(DATE '1999-06-16')""")
def p09(spark, base):
    return table(spark, base, "orders").filter(
        F.weekofyear("o_orderdate") == F.weekofyear(F.lit("1999-06-16").cast("date"))).select(
        "o_orderkey", big(F.weekofyear("o_orderdate")).alias("week_of_year"))


@query("p10_running_at", """
SELECT l_orderkey, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate <= TIMESTAMP '1998-06-01' AND l_shipdate >= TIMESTAMP '1998-06-01' GROUP BY l_orderkey""")
def p10(spark, base):
    joined = table(spark, base, "lineitem").join(table(spark, base, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    moment = F.lit("1998-06-01").cast("timestamp_ntz")
    return joined.filter(running_at(F.col("o_orderdate"), F.col("l_shipdate"), moment)).groupBy("l_orderkey").agg(F.count("*").alias("lines"))


@query("p11_valid_accounts", f"""
SELECT count(*) FILTER (account_number_from >= 0) AS one_side, count(*) FILTER (account_number_from >= 0 AND account_number_to >= 0) AS both_sides
FROM {data.TRANSACTIONS_SQL}""")
def p11(spark, base):
    own, other = F.col("account_number_from") >= 0, F.col("account_number_to") >= 0
    return data.transactions(spark, base).agg(
        F.count(F.when(own, 1)).alias("one_side"), F.count(F.when(own & other, 1)).alias("both_sides"))


@query("p12_searched_case", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size FROM lineitem""")
def p12(spark, base):
    q = F.col("l_quantity")
    return table(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(q < 10, "small").when(q < 30, "medium").otherwise("large").alias("size"))


@query("p13_tiered_pay", """
SELECT event_id, round(CASE WHEN user_id % 10 < 4 THEN greatest(value * 0.05::DOUBLE, 1.0::DOUBLE) WHEN user_id % 10 < 8 THEN greatest(value * 0.07::DOUBLE, 1.5::DOUBLE)
  ELSE greatest(value * 0.1::DOUBLE, 2.0::DOUBLE) END, 6) AS pay FROM events""")
def p13(spark, base):
    pay = tiered_pay(F.col("value"), F.col("user_id") % 10, [(4, 0.05, 1.0), (8, 0.07, 1.5), (None, 0.1, 2.0)])
    return table(spark, base, "events").select("event_id", F.round(pay, 6).alias("pay"))


@query("p14_money", """
SELECT l_returnflag, CAST(sum((CAST(l_discount AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2)) + 0.10) * CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS vat
FROM lineitem GROUP BY l_returnflag""")
def p14(spark, base):
    rate = money(F.col("l_discount"), 4) + money(F.col("l_tax"), 4) + F.lit("0.10").cast("decimal(4,2)")
    return table(spark, base, "lineitem").groupBy("l_returnflag").agg(
        F.sum(rate * money(F.col("l_extendedprice"), 14)).cast("double").alias("vat"))


@query("p15_typed_null", """
SELECT n_name, CAST(NULL AS VARCHAR) AS feedback, 's3' AS load_src FROM nation""")
def p15(spark, base):
    return table(spark, base, "nation").select(
        "n_name", F.lit(None).cast("string").alias("feedback"), F.lit("s3").alias("load_src"))


@query("q01_check_rules", """
SELECT 'discount_low' AS rule, count(*) FILTER (NOT l_discount < 0.05) AS violations FROM lineitem
UNION ALL SELECT 'flag_known', count(*) FILTER (NOT l_returnflag IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'quantity_positive', count(*) FILTER (NOT l_quantity > 0) FROM lineitem""")
def q01(spark, base):
    return checks.rule_violations(table(spark, base, "lineitem"), {
        "discount_low": F.col("l_discount") < 0.05, "flag_known": F.col("l_returnflag").isin("A", "N"),
        "quantity_positive": F.col("l_quantity") > 0})


@query("q02_not_null", f"""
SELECT 'user_id' AS column_name, count(*) FILTER (user_id IS NULL) AS nulls FROM {data.EVENTS_K_SQL}
UNION ALL SELECT 'large_value', count(*) FILTER (CASE WHEN value > 100 THEN value END IS NULL) FROM {data.EVENTS_K_SQL}
UNION ALL SELECT 'k', count(*) FILTER (k IS NULL) FROM {data.EVENTS_K_SQL}""")
def q02(spark, base):
    events = data.events_with_k(spark, base).withColumn("large_value", F.when(F.col("value") > 100, F.col("value")))
    return checks.null_violations(events, ["user_id", "large_value", "k"])


@query("q03_duplicate_keys", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q03(spark, base):
    return checks.duplicate_keys(table(spark, base, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumn("l_linenumber", big("l_linenumber"))


@query("q04_orphans", """
SELECT l_orderkey, count(*) AS rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""")
def q04(spark, base):
    parents = table(spark, base, "orders").filter(F.col("o_orderstatus") != "P")
    return checks.orphans(table(spark, base, "lineitem"), "l_orderkey", parents, "o_orderkey")
