"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog import standins as data
from martloom.catalog.registry import big, day_text, query
from martloom.functions.numeric import money_total
from martloom.functions.time import calendar, in_days, since_year
from martloom.operators import geo, joins
from martloom.operators.windows import latest_per_key
from martloom.session import scratch_path
from martloom.streaming import runs
from martloom.tables import stream, table


@query("j01_inner_chain", """
SELECT r_name, p_type, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY r_name, p_type""")
def j01(spark, base):
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    orders = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(table(spark, base, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, base, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .join(table(spark, base, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .join(table(spark, base, "supplier").select("s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("r_name", "p_type").agg(F.count("*").alias("lines"), money_total(F.col("l_extendedprice")).alias("revenue")))


@query("j02_composite_key", """
SELECT a.l_orderkey, a.l_partkey, a.discount, a.n AS lines, b.n AS returned FROM
 (SELECT l_orderkey, l_partkey, CAST(CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS discount, count(*) AS n FROM lineitem GROUP BY ALL) a
 JOIN (SELECT l_orderkey, l_partkey, CAST(CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS discount, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) b
 USING (l_orderkey, l_partkey, discount)""")
def j02(spark, base):
    lines = table(spark, base, "lineitem").withColumn("rate", F.col("l_discount").cast("decimal(4,2)"))
    keys = ["l_orderkey", "l_partkey", "rate"]
    every = lines.groupBy(*keys).agg(F.count("*").alias("lines"))
    back = lines.filter(F.col("l_returnflag") == "R").groupBy(*keys).agg(F.count("*").alias("returned"))
    return every.join(back, keys).select("l_orderkey", "l_partkey", F.col("rate").cast("double").alias("discount"), "lines", "returned")


@query("j03_left_outer", """
SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN
 (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey) ON c_custkey = o_custkey""")
def j03(spark, base):
    recent = since_year(F.col("o_orderdate"), 2001)
    counts = table(spark, base, "orders").filter(recent).groupBy("o_custkey").agg(F.count("*").alias("n"))
    return table(spark, base, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


@query("j04_full_outer", """
SELECT coalesce(a.k, b.k) AS nationkey, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM
 (SELECT CAST(c_nationkey AS BIGINT) AS k, count(*) AS customers FROM customer WHERE c_acctbal > 5000 GROUP BY 1) a FULL JOIN
 (SELECT CAST(s_nationkey AS BIGINT) AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) b ON a.k = b.k""")
def j04(spark, base):
    customers = table(spark, base, "customer").filter(F.col("c_acctbal") > 5000).groupBy(big("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers"))
    suppliers = table(spark, base, "supplier").filter(F.col("s_acctbal") > 5000).groupBy(big("s_nationkey").alias("nationkey")).agg(F.count("*").alias("suppliers"))
    return joins.merge_by_key([customers, suppliers], "nationkey").fillna(0, ["customers", "suppliers"])


@query("j05_left_anti", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01')""")
def j05(spark, base):
    month = table(spark, base, "orders").filter(in_days(F.col("o_orderdate"), "1998-03-01", "1998-03-31")).select(F.col("o_custkey").alias("c_custkey"))
    return joins.has_no_match(table(spark, base, "customer").select("c_custkey", "c_name"), month, ["c_custkey"])


@query("j06_not_in", """
SELECT 'plain' AS list, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
UNION ALL SELECT 'with null', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""")
def j06(spark, base):
    customers = table(spark, base, "customer").select("c_custkey")
    recent = table(spark, base, "orders").filter(since_year(F.col("o_orderdate"), 2001))
    holed = recent.select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey"))
    plain = joins.not_in(customers, "c_custkey", recent, "o_custkey").select(F.lit("plain").alias("list"), "c_custkey")
    return plain.unionByName(joins.not_in(customers, "c_custkey", holed, "o_custkey").select(F.lit("with null").alias("list"), "c_custkey"))


@query("j07_semi", """
SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""")
def j07(spark, base):
    back = table(spark, base, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).select(F.col("l_partkey").alias("p_partkey"))
    return joins.has_match(table(spark, base, "part").select("p_partkey", "p_name"), back, ["p_partkey"])


@query("j08_scalar_max", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0.9 * (SELECT max(o_totalprice) FROM orders)""")
def j08(spark, base):
    orders = table(spark, base, "orders")
    top = orders.agg(F.max("o_totalprice").alias("m")).scalar()
    return orders.filter(F.col("o_totalprice") > top * 0.9).select("o_orderkey", "o_totalprice")


@query("j09_nearest_place", f"SELECT event_id, zone_id FROM {data.ZONED_SQL}")
def j09(spark, base):
    return geo.nearest_place(data.geo_events(spark, base), data.places(spark, base), "event_id").select("event_id", "zone_id")


@query("j09_nearest_by_grid", f"SELECT event_id, zone_id FROM {data.ZONED_SQL}")
def j09_grid(spark, base):
    """The search for very many places, forced here to show that it gives the same result."""
    return geo.nearest_by_grid(data.geo_events(spark, base), data.places(spark, base), first_radius_km=60.0).select("event_id", "zone_id")


J10_SQL = f"""(SELECT DISTINCT user_id, user_id // 5 AS block, k FROM {data.EVENTS_K_SQL})"""


@query("j10_pairs_sharing", f"""
SELECT DISTINCT a.user_id AS "left", b.user_id AS "right" FROM {J10_SQL} a JOIN {J10_SQL} b ON a.k = b.k AND a.block = b.block WHERE a.user_id <> b.user_id""")
def j10(spark, base):
    """Users of one neighbourhood (five users at most) who used the same number."""
    used = data.events_with_k(spark, base).select("user_id", F.floor(F.col("user_id") / 5).alias("block"), "k").distinct()
    return joins.pairs_sharing(used, ["block", "k"], "user_id")


@query("j10_partner_counts", f"""
SELECT zone_id, user_id, count(*) OVER (PARTITION BY zone_id) - 1 AS partners FROM (SELECT DISTINCT zone_id, user_id FROM {data.ZONED_SQL})""")
def j10_counts(spark, base):
    zoned = geo.nearest_place(data.geo_events(spark, base), data.places(spark, base), "event_id")
    return joins.partner_counts(zoned, ["zone_id"], "user_id")


LAST_SQL = f"""(SELECT user_id, arg_max(lat, (ts, event_id)) AS lat, arg_max(lon, (ts, event_id)) AS lon FROM {data.GEO_SQL} GROUP BY user_id)"""


@query("j11_within_distance", f"""
SELECT a.user_id AS user_left, b.user_id AS user_right, round({data.distance_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 6) AS distance
FROM {LAST_SQL} a JOIN {LAST_SQL} b ON a.user_id <> b.user_id WHERE {data.distance_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 1.0""")
def j11(spark, base):
    last = latest_per_key(data.geo_events(spark, base).select("user_id", "ts", "event_id", "lat", "lon"), ["user_id"], ["ts", "event_id"])
    left = last.select(F.col("user_id").alias("user_left"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    right = last.select(F.col("user_id").alias("user_right"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    near = geo.within_distance(left, right, 1.0, ("lat1", "lon1"), ("lat2", "lon2"))
    return near.filter(F.col("user_left") != F.col("user_right")).select("user_left", "user_right", F.round("distance", 6).alias("distance"))


@query("j12_stream_static", f"""
SELECT event_id, n_name FROM {data.EVENTS_K_SQL} JOIN nation ON k % 25 = n_nationkey""")
def j12(spark, base):
    arriving = stream(spark, base, "events").select("event_id", (F.get_json_object("props", "$.k").cast("bigint") % 25).alias("n_nationkey"))
    joined = arriving.join(table(spark, base, "nation").select(big("n_nationkey").alias("n_nationkey"), "n_name"), "n_nationkey")
    path = scratch_path(spark, "joined")
    runs.start(joined, lambda batch, i: runs.write_batch(batch, path, i), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return spark.read.parquet(path).select("event_id", "n_name")


@query("j13_calendar_join", """
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_id, CAST(week(o_orderdate) AS BIGINT) AS week_of_year, count(*) AS n
FROM orders GROUP BY ALL""")
def j13(spark, base):
    daily = table(spark, base, "orders").groupBy(F.to_date("o_orderdate").alias("date_actual")).agg(F.count("*").alias("n"))
    first, last = daily.agg(F.min("date_actual"), F.max("date_actual")).first()
    return daily.join(calendar(spark, first, last), "date_actual").select("date_id", "week_of_year", "n")


@query("j14_latest_join_back", """
SELECT o_orderkey, o_custkey, last_flag FROM orders JOIN (SELECT l_orderkey, arg_max(l_returnflag, (l_shipdate, l_linenumber, l_returnflag)) AS last_flag FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")
def j14(spark, base):
    log = table(spark, base, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", F.col("l_returnflag").alias("last_flag"))
    last = latest_per_key(log, ["l_orderkey"], ["l_shipdate", "l_linenumber", "last_flag"])
    return table(spark, base, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "last_flag")


@query("j15_base_rate", f"""
SELECT strftime(day, '%Y-%m-%d') AS day, currency_code, rate FROM {data.RATES_SQL} WHERE currency_code <> 420
UNION ALL SELECT DISTINCT strftime(transaction_dt, '%Y-%m-%d'), CAST(420 AS BIGINT), 1.0::DOUBLE FROM {data.TRANSACTIONS_SQL}""")
def j15(spark, base):
    days = data.transactions(spark, base).select(F.to_date("transaction_dt").alias("day")).distinct()
    return joins.with_base_rate(data.rates(spark, base), days, 420).withColumn("day", day_text("day"))


@query("j16_key_lookup", """
SELECT s_suppkey AS courier_id, count(*) AS facts, min(rn) AS courier_sk FROM lineitem JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS rn FROM supplier) ON l_suppkey = s_suppkey GROUP BY s_suppkey""")
def j16(spark, base):
    from martloom.operators.ordering import global_row_number
    couriers = global_row_number(table(spark, base, "supplier").select(F.col("s_suppkey").alias("courier_id")), [F.col("courier_id")], "courier_sk")
    facts = table(spark, base, "lineitem").select(F.col("l_suppkey").alias("courier_id"))
    return joins.lookup_join(facts, couriers, ["courier_id"]).groupBy("courier_id").agg(
        F.count("*").alias("facts"), F.min("courier_sk").alias("courier_sk"))


@query("j16_salted_lookup", """
SELECT p_brand, count(*) AS facts FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def j16_salted(spark, base):
    """The lookup for a side too large to copy, forced here to show that it gives the same result."""
    facts = table(spark, base, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey")
    lookup = table(spark, base, "part").select("p_partkey", "p_brand")
    return joins.salted_join(facts, lookup, ["p_partkey"], piece_rows=40).groupBy("p_brand").agg(F.count("*").alias("facts"))


@query("j17_merge_by_key", """
SELECT coalesce(o.k, e.k) AS key, coalesce(orders, 0) AS orders, coalesce(lines, 0) AS lines, coalesce(events, 0) AS events
FROM (SELECT o_custkey AS k, count(DISTINCT o_orderkey) AS orders, count(l_orderkey) AS lines FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) o
FULL JOIN (SELECT user_id AS k, count(*) AS events FROM events GROUP BY 1) e ON o.k = e.k""")
def j17(spark, base):
    orders = table(spark, base, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    per_order = table(spark, base, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    per_customer = orders.join(per_order, "o_orderkey", "left").groupBy("key").agg(F.count("*").alias("orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("lines"))
    events = table(spark, base, "events").groupBy(F.col("user_id").alias("key")).agg(F.count("*").alias("events"))
    return joins.merge_by_key([per_customer, events], "key").fillna(0, ["orders", "lines", "events"])
