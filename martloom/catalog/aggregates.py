"""Aggregations, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog import standins as data
from martloom.catalog.registry import big, query
from martloom.functions.numeric import money, money_total, safe_ratio
from martloom.functions.time import since_day
from martloom.operators import aggregates, sets
from martloom.operators.windows import day_islands, order_slices
from martloom.plans.groups import oldest_groups
from martloom.tables import table


@query("a01_group_aggregates", """
SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean, min(l_quantity) AS low, max(l_quantity) AS high
FROM lineitem GROUP BY l_suppkey""")
def a01(spark, base):
    price = F.col("l_extendedprice")
    return table(spark, base, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), money_total(price).alias("total"), (money_total(price) / F.count("*")).alias("mean"),
        F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


@query("a02_conditional", """
SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS closed,
  CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F'), 0) AS DOUBLE) AS paid,
  max(o_orderdate) FILTER (o_orderstatus = 'F') AS last_closed FROM orders GROUP BY o_custkey""")
def a02(spark, base):
    closed = F.col("o_orderstatus") == "F"
    return table(spark, base, "orders").groupBy("o_custkey").agg(
        F.count(F.when(closed, 1)).alias("closed"),
        F.coalesce(money_total(F.when(closed, F.col("o_totalprice"))), F.lit(0.0)).alias("paid"),
        F.max(F.when(closed, F.col("o_orderdate"))).alias("last_closed"))


@query("a03_count_distinct", """
SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY event_type""")
def a03(spark, base):
    return table(spark, base, "events").groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct(F.to_date("ts")).alias("days"))


@query("a04_ratio", """
SELECT user_id, CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) / nullif(count(*) FILTER (event_type = 'view' AND value > 60), 0) AS conversion FROM events GROUP BY user_id""")
def a04(spark, base):
    kind = F.col("event_type")
    bought, viewed = F.count(F.when(kind == "purchase", 1)), F.count(F.when((kind == "view") & (F.col("value") > 60), 1))
    return table(spark, base, "events").groupBy("user_id").agg(safe_ratio(bought, viewed).alias("conversion"))


@query("a05_having_count", """
SELECT 'once' AS kind, count(*) AS customers FROM (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01' GROUP BY 1 HAVING count(*) = 1)
UNION ALL SELECT 'more', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01' GROUP BY 1 HAVING count(*) > 1)""")
def a05(spark, base):
    counts = table(spark, base, "orders").filter(since_day(F.col("o_orderdate"), "2001-06-01")).groupBy("o_custkey").count()
    once = counts.filter("count = 1").agg(F.lit("once").alias("kind"), F.count("*").alias("customers"))
    return once.unionByName(counts.filter("count > 1").agg(F.lit("more").alias("kind"), F.count("*").alias("customers")))


@query("a06_having_key", """
SELECT l_partkey, l_returnflag FROM lineitem GROUP BY l_partkey, l_returnflag HAVING l_returnflag = 'R'""")
def a06(spark, base):
    return table(spark, base, "lineitem").filter(F.col("l_returnflag") == "R").select("l_partkey", "l_returnflag").distinct()


@query("a07_group_expression", """
SELECT CAST(year(l_shipdate) AS BIGINT) AS y, CAST(month(l_shipdate) AS BIGINT) AS m, count(*) AS n FROM lineitem GROUP BY ALL""")
def a07(spark, base):
    return table(spark, base, "lineitem").groupBy(big(F.year("l_shipdate")).alias("y"), big(F.month("l_shipdate")).alias("m")).agg(F.count("*").alias("n"))


@query("a08_ordered_list", """
SELECT user_id, CAST(0 AS BIGINT) AS page, string_agg(event_type, ',' ORDER BY ts, event_id) AS journey, count(*) AS steps FROM events GROUP BY user_id""")
def a08(spark, base):
    events = table(spark, base, "events").select("user_id", "ts", "event_id", "event_type")
    sliced = order_slices(events, ["user_id"], ["ts", "event_id"])
    lists = aggregates.ordered_lists(sliced, ["user_id"], ["ts", "event_id"], "event_type", F.col("_slice"), "list")
    return lists.select("user_id", "page", F.array_join("list", ",").alias("journey"), F.size("list").cast("bigint").alias("steps"))


@query("a08_ordered_list_pages", """
SELECT user_id, (rn - 1) // 7 AS page, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY rn) AS ids FROM
 (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY ALL""")
def a08_pages(spark, base):
    """Very long lists continue on further pages; a page size of seven shows it."""
    events = table(spark, base, "events").select("user_id", "ts", "event_id")
    sliced = order_slices(events, ["user_id"], ["ts", "event_id"], parts=50)
    lists = aggregates.ordered_lists(sliced, ["user_id"], ["ts", "event_id"], "event_id", F.col("_slice"), "list", page_elements=7)
    return lists.select("user_id", "page", F.array_join(F.col("list").cast("array<string>"), ",").alias("ids"))


@query("a09_collect_set", f"""
SELECT user_id, CAST(0 AS BIGINT) AS page, string_agg(CAST(channel AS VARCHAR), ',' ORDER BY channel) AS channels FROM (SELECT DISTINCT user_id, channel FROM {data.GEO_SQL} WHERE event_type = 'subscription') GROUP BY user_id""")
def a09(spark, base):
    subscribed = data.geo_events(spark, base).filter(F.col("event_type") == "subscription")
    pages = aggregates.nested_pages(subscribed, ["user_id"], F.col("channel"), "channels")
    return pages.select("user_id", "page", F.array_join(F.array_sort("channels").cast("array<string>"), ",").alias("channels"))


@query("a10_pivot", """
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'click') AS DOUBLE) AS click, CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'view') AS DOUBLE) AS view,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS DOUBLE) AS purchase FROM events GROUP BY user_id""")
def a10(spark, base):
    kinds = ["click", "view", "purchase"]
    events = table(spark, base, "events").withColumn("amount", money(F.col("value")))
    wide = aggregates.pivot_sum(events, ["user_id"], "event_type", kinds, "amount")
    return wide.select("user_id", *[F.col(k).cast("double").alias(k) for k in kinds])


@query("a11_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def a11(spark, base):
    return table(spark, base, "part").select("p_brand", "p_type").distinct()


@query("a12_global_max", "SELECT max(event_id) AS top_id, max(ts) AS last_ts FROM events")
def a12(spark, base):
    return table(spark, base, "events").agg(F.max("event_id").alias("top_id"), F.max("ts").alias("last_ts"))


@query("a13_first_value", """
SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, max(event_type) AS greatest_type FROM events GROUP BY user_id""")
def a13(spark, base):
    return table(spark, base, "events").groupBy("user_id").agg(
        F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"), F.max("event_type").alias("greatest_type"))


ISLANDS_SQL = """(SELECT user_id, min(day) AS first_day, max(day) AS last_day FROM (
  SELECT user_id, day, day - CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS grp FROM (
    SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase')) GROUP BY user_id, grp)"""


@query("a14_run_bounds", f"""
SELECT user_id, strftime(first_day, '%Y-%m-%d') AS first_day, strftime(last_day, '%Y-%m-%d') AS last_day FROM {ISLANDS_SQL}""")
def a14(spark, base):
    bought = table(spark, base, "events").filter(F.col("event_type") == "purchase").select("user_id", F.to_date("ts").alias("day"))
    runs = day_islands(bought, ["user_id"], "day")
    return runs.select("user_id", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first_day", "last_day")])


@query("a15_shares", """
SELECT c_mktsegment, count(*) AS rows, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) AS share FROM customer GROUP BY c_mktsegment""")
def a15(spark, base):
    return aggregates.shares(table(spark, base, "customer"), "c_mktsegment")


@query("t01_lowest_ten", """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n, user_id LIMIT 10""")
def t01(spark, base):
    return table(spark, base, "events").groupBy("user_id").agg(F.count("*").alias("n")).orderBy("n", "user_id").limit(10)


@query("t02_oldest_as_filter", f"""
SELECT k, count(*) AS n FROM {data.EVENTS_K_SQL} WHERE k IN (SELECT k FROM {data.EVENTS_K_SQL} GROUP BY k ORDER BY min(ts), k LIMIT 10) GROUP BY k""")
def t02(spark, base):
    events = data.events_with_k(spark, base)
    groups = events.groupBy(F.col("k").alias("group_id")).agg(F.min("ts").alias("registration_dt"))
    # ten rows by construction
    old = F.broadcast(oldest_groups(groups, 10).select(F.col("group_id").alias("k")))
    return events.join(old, "k").groupBy("k").agg(F.count("*").alias("n"))


@query("t03_ratio_order", """
SELECT s_nationkey, ratio FROM (SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, count(*) FILTER (s_acctbal > 5000)::DOUBLE / nullif(count(*) FILTER (s_acctbal <= 5000), 0) AS ratio FROM supplier GROUP BY 1)
ORDER BY ratio DESC NULLS LAST, s_nationkey""")
def t03(spark, base):
    rich, poor = F.count(F.when(F.col("s_acctbal") > 5000, 1)), F.count(F.when(F.col("s_acctbal") <= 5000, 1))
    return table(spark, base, "supplier").groupBy(big("s_nationkey").alias("s_nationkey")).agg(
        safe_ratio(rich, poor).alias("ratio")).orderBy(F.desc_nulls_last("ratio"), "s_nationkey")


@query("u01_union_distinct", """
SELECT CAST(c_nationkey AS BIGINT) AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def u01(spark, base):
    return sets.union_distinct(table(spark, base, "customer").select(big("c_nationkey").alias("nationkey")),
                               table(spark, base, "supplier").select(big("s_nationkey").alias("nationkey")))


@query("u02_union_all", """
SELECT 'customer' AS side, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier""")
def u02(spark, base):
    customers = table(spark, base, "customer").select(F.lit("customer").alias("side"), F.col("c_acctbal").alias("balance"))
    return sets.union_all(customers, table(spark, base, "supplier").select(F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("side")))


@query("u03_symmetric_edges", f"""
SELECT user_id AS user_left, message_to AS user_right FROM {data.GEO_SQL} WHERE event_type = 'message'
UNION SELECT message_to, user_id FROM {data.GEO_SQL} WHERE event_type = 'message'""")
def u03(spark, base):
    talks = data.geo_events(spark, base).filter(F.col("event_type") == "message").select(
        F.col("user_id").alias("user_left"), F.col("message_to").alias("user_right"))
    return sets.symmetric_edges(talks, "user_left", "user_right")


@query("u04_unpivot", """
SELECT s_suppkey, kind, amount FROM (SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS nation, s_acctbal AS balance FROM supplier) UNPIVOT (amount FOR kind IN (nation, balance))""")
def u04(spark, base):
    wide = table(spark, base, "supplier").select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"), F.col("s_acctbal").alias("balance"))
    return sets.unpivot(wide, ["s_suppkey"], ["nation", "balance"], "kind", "amount")


@query("f23_map_explode", """
SELECT s_suppkey, kind, amount FROM (SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS nation, s_acctbal AS balance FROM supplier) UNPIVOT (amount FOR kind IN (nation, balance))""")
def f23(spark, base):
    counted = F.create_map(F.lit("nation"), F.col("s_nationkey").cast("double"), F.lit("balance"), F.col("s_acctbal"))
    return table(spark, base, "supplier").select("s_suppkey", F.explode(counted).alias("kind", "amount"))


