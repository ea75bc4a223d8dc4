"""Ready-made marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog import standins as data
from martloom.catalog.registry import big, day_text, query, time_text
from martloom.functions.time import calendar, in_day
from martloom.operators.increments import dimension_rows
from martloom.operators.ordering import global_row_number
from martloom.operators.vault import message_lines
from martloom.plans import couriers, counters, customers, geography, groups, money, shipping
from martloom.session import cut_lineage, scratch_path
from martloom.sources.files import write_delimited
from martloom.sources.geo_events import city_file, flat_events
from martloom.streaming import jobs
from martloom.tables import table

RFM_INPUT_SQL = """(SELECT c_custkey AS user_id, coalesce(last_ts, TIMESTAMP '{year}-01-01') AS last_ts, coalesce(n, 0) AS n, coalesce(paid, 0) AS paid FROM customer {join}
 (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE TIMESTAMP '{year}-01-01' END) AS last_ts, count(*) FILTER (o_orderstatus = 'F') AS n,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS paid FROM orders WHERE year(o_orderdate) >= {year} GROUP BY o_custkey) ON c_custkey = o_custkey)"""
RFM_SQL = """SELECT user_id, CAST(ntile(5) OVER (ORDER BY last_ts, user_id) AS BIGINT) AS recency, CAST(ntile(5) OVER (ORDER BY n, user_id) AS BIGINT) AS frequency,
 CAST(ntile(5) OVER (ORDER BY paid, user_id) AS BIGINT) AS monetary_value FROM """


@query("m01_rfm_segments", RFM_SQL + RFM_INPUT_SQL.format(year=1999, join="LEFT JOIN"))
def m01(spark, base):
    return customers.rfm_segments(*data.rfm_frames(spark, base), closed="F", year=1999)


@query("m01_rfm_segments_strict", RFM_SQL + RFM_INPUT_SQL.format(year=2001, join="JOIN"))
def m01_strict(spark, base):
    """Only users with an order in the period."""
    return customers.rfm_segments(*data.rfm_frames(spark, base), closed="F", year=2001, strict=True)


@query("m02_latest_status", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS cost, status FROM orders JOIN
 (SELECT l_orderkey, arg_max(l_linenumber, (l_shipdate, l_linenumber))::BIGINT AS status FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")
def m02(spark, base):
    orders = table(spark, base, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("cost"))
    log = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("order_id"), big("l_linenumber").alias("status_id"), F.col("l_shipdate").alias("dttm"))
    return customers.orders_with_status(orders, log)


@query("m03_country_rates", f"SELECT shipping_country, shipping_country_base_rate::DOUBLE AS rate, row_number() OVER (ORDER BY shipping_country) AS id FROM (SELECT DISTINCT shipping_country, shipping_country_base_rate FROM {data.SHIPPING_SQL})")
def m03_rates(spark, base):
    return shipping.country_rates(data.shipping_log(spark, base)).select("shipping_country", F.col("shipping_country_base_rate").cast("double").alias("rate"), "id")


@query("m03_agreements", f"""
SELECT a[1]::BIGINT AS agreement_id, a[2] AS agreement_number, a[3]::DOUBLE AS agreement_rate, a[4]::DOUBLE AS agreement_comission FROM
 (SELECT DISTINCT regexp_split_to_array(vendor_agreement_description, ':+') AS a FROM {data.SHIPPING_SQL})""")
def m03_agreements(spark, base):
    agreed = shipping.agreements(data.shipping_log(spark, base))
    return agreed.select("agreement_id", "agreement_number", *[F.col(c).cast("double").alias(c) for c in ("agreement_rate", "agreement_comission")])


@query("m03_transfers", f"""
SELECT a[1] AS transfer_type, a[2] AS transfer_model, rate::DOUBLE AS rate, row_number() OVER (ORDER BY a[1], a[2], rate) AS shipping_transfer_id FROM
 (SELECT DISTINCT regexp_split_to_array(shipping_transfer_description, ':+') AS a, shipping_transfer_rate AS rate FROM {data.SHIPPING_SQL})""")
def m03_transfers(spark, base):
    return shipping.transfers(data.shipping_log(spark, base)).select("transfer_type", "transfer_model", F.col("shipping_transfer_rate").cast("double").alias("rate"), "shipping_transfer_id")


SHIPMENT_SQL = f"""(SELECT DISTINCT shippingid, vendorid, payment_amount, shipping_plan_datetime, shipping_country, shipping_country_base_rate, vendorid AS agreement_id,
 CAST('0.0' || (vendorid % 9 + 1) AS DECIMAL(3,2)) AS agreement_rate, CAST('0.0' || (vendorid % 3 + 1) AS DECIMAL(3,2)) AS agreement_comission,
 split_part(shipping_transfer_description, ':', 1) AS transfer_type, split_part(shipping_transfer_description, ':', 2) AS transfer_model, shipping_transfer_rate FROM {data.SHIPPING_SQL})"""


@query("m04_shipping_info", f"""
SELECT shippingid AS shipping_id, vendorid AS vendor_id, payment_amount::DOUBLE AS payment_amount, shipping_plan_datetime, agreement_id,
 dense_rank() OVER (ORDER BY transfer_type, transfer_model, shipping_transfer_rate) AS shipping_transfer_id, dense_rank() OVER (ORDER BY shipping_country, shipping_country_base_rate) AS id FROM {SHIPMENT_SQL}""")
def m04(spark, base):
    log = cut_lineage(data.shipping_log(spark, base))
    info = shipping.shipping_info(log, shipping.country_rates(log), shipping.agreements(log), shipping.transfers(log))
    return info.withColumn("payment_amount", F.col("payment_amount").cast("double"))


STATUS_SQL = f"""(SELECT shippingid AS shipping_id, arg_max(status, (state_datetime, status, state)) AS status, arg_max(state, (state_datetime, status, state)) AS state,
 max(state_datetime) FILTER (state = 'booked') AS shipping_start_fact_datetime, max(state_datetime) FILTER (state = 'recieved') AS shipping_end_fact_datetime FROM {data.SHIPPING_SQL} GROUP BY shippingid)"""


@query("m05_shipping_status", f"SELECT * FROM {STATUS_SQL}")
def m05(spark, base):
    return shipping.shipping_status(data.shipping_log(spark, base))


def _datamart_sql(due: str) -> str:
    return f"""
SELECT i.shippingid AS shipping_id, vendorid AS vendor_id, transfer_type,
 CASE WHEN e IS NOT NULL THEN date_part('day', e - s)::BIGINT ELSE 0 END AS full_day_at_shipping, CASE WHEN e > {due} THEN 1 ELSE 0 END::BIGINT AS is_delay,
 CASE WHEN status = 'finished' THEN 1 ELSE 0 END::BIGINT AS is_shipping_finish, CASE WHEN e > {due} THEN day(age(e, {due}))::BIGINT ELSE 0 END AS delay_day_at_shipping,
 payment_amount::DOUBLE AS payment_amount, ((shipping_country_base_rate + agreement_rate + shipping_transfer_rate) * payment_amount)::DOUBLE AS vat,
 (payment_amount * agreement_comission)::DOUBLE AS profit
FROM {SHIPMENT_SQL} i JOIN (SELECT shipping_id, status, shipping_start_fact_datetime AS s, shipping_end_fact_datetime AS e FROM {STATUS_SQL}) x ON i.shippingid = x.shipping_id"""


def _plain(mart):
    return mart.select(*[F.col(c).cast("double").alias(c) if c in ("payment_amount", "vat", "profit") else c for c in mart.columns])


@query("m06_shipping_datamart", _datamart_sql("s"))
def m06(spark, base):
    return _plain(shipping.shipping_datamart(data.shipping_log(spark, base)))


@query("m06_shipping_datamart_planned", _datamart_sql("shipping_plan_datetime"))
def m06_planned(spark, base):
    """Delay measured against the planned time."""
    return _plain(shipping.shipping_datamart(data.shipping_log(spark, base), plan_based=True))


@query("m06_datamart_from_tables", _datamart_sql("s"))
def m06_tables(spark, base):
    """The mart joined from dimension, info and status tables."""
    log = cut_lineage(data.shipping_log(spark, base))
    rates, agreed, kinds = shipping.country_rates(log), shipping.agreements(log), shipping.transfers(log)
    info = shipping.shipping_info(log, rates, agreed, kinds)
    return _plain(shipping.datamart_from_tables(info, shipping.shipping_status(log), rates, agreed, kinds))


@query("m07_new_dimension_rows", """
SELECT 'customer' AS dimension, CAST(o_custkey AS VARCHAR) AS key, max(CAST(n_name AS VARCHAR)) AS attribute FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-03-01') GROUP BY o_custkey
UNION ALL SELECT DISTINCT 'item', CAST(p_partkey AS VARCHAR), p_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01')
UNION ALL SELECT DISTINCT 'city', CAST(n_nationkey AS VARCHAR), n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)""")
def m07(spark, base):
    """Dimension members that an earlier load has not written: customers, items and cities."""
    nations = table(spark, base, "nation").select("n_nationkey", "n_name")
    people = table(spark, base, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, base, "orders")
    seen = orders.filter(F.col("o_orderdate") < F.lit("1995-03-01").cast("timestamp_ntz")).select(F.col("o_custkey").alias("key")).distinct()
    buyers = orders.select(F.col("o_custkey").alias("c_custkey")).distinct().join(people, "c_custkey").groupBy(F.col("c_custkey").alias("key")).agg(F.max("n_name").alias("attribute"))
    new_customers = dimension_rows(buyers, "key", ["attribute"], seen)
    lines = table(spark, base, "lineitem")
    old_parts = lines.filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select(F.col("l_partkey").alias("key")).distinct()
    sold = lines.select(F.col("l_partkey").alias("p_partkey")).distinct().join(table(spark, base, "part"), "p_partkey").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("attribute"))
    new_items = dimension_rows(sold, "key", ["attribute"], old_parts)
    known = table(spark, base, "supplier").select(F.col("s_nationkey").alias("key")).distinct()
    new_cities = dimension_rows(people.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("attribute")), "key", ["attribute"], known)
    frames = {"customer": new_customers, "item": new_items, "city": new_cities}
    parts = [f.select(F.lit(n).alias("dimension"), F.col("key").cast("string").alias("key"), "attribute") for n, f in frames.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("m08_daily_sales", f"""
SELECT CAST(19980602 AS BIGINT) AS date_id, item_id, customer_id, quantity, payment_amount, status FROM {data.SALES_SQL} WHERE CAST(date_time AS DATE) = DATE '1998-06-02'""")
def m08(spark, base):
    staged = data.sales(spark, base).filter(in_day(F.col("date_time"), "1998-06-02")).withColumn("city_id", F.lit(None).cast("bigint"))
    return customers.daily_sales(staged, calendar(spark, "1998-01-01", "1998-12-31")).drop("city_id")


@query("m09_weekly_retention", f"""
WITH r AS (SELECT week, customer_id, item_id, status, count(*) AS n, sum(CAST(payment_amount AS DECIMAL(18,2))) AS amount FROM {data.SALES_SQL} GROUP BY ALL),
 c AS (SELECT *, sum(n) OVER (PARTITION BY week, customer_id) AS week_rows FROM r)
SELECT count(DISTINCT customer_id) FILTER (status = 'shipped' AND week_rows = 1) AS new_customers_count, count(DISTINCT customer_id) FILTER (status = 'shipped' AND week_rows > 1) AS returning_customers_count,
 count(DISTINCT customer_id) FILTER (status = 'refunded') AS refunded_customer_count, 'week' AS period_name, strftime(week, '%Y-%m-%d') AS period_start, week(week)::BIGINT AS period_id, item_id,
 CAST(sum(amount) FILTER (status = 'shipped' AND week_rows = 1) AS DOUBLE) AS new_customers_revenue, CAST(sum(amount) FILTER (status = 'shipped' AND week_rows > 1) AS DOUBLE) AS returning_customers_revenue,
 CAST(sum(amount) FILTER (status = 'refunded') AS DOUBLE) AS customers_refunded
FROM c GROUP BY week, item_id""")
def m09(spark, base):
    return customers.weekly_retention(data.sales(spark, base)).withColumn("period_start", day_text("period_start"))


@query("m10_courier_increment", """
SELECT s_suppkey AS courier_id, s_name AS courier_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)
 AND s_suppkey > (SELECT max(l_suppkey) FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-04')""")
def m10_couriers(spark, base):
    staged = data.deliveries(spark, base)
    loaded = staged.filter(F.col("order_ts") < F.lit("1995-01-04").cast("timestamp_ntz")).select("courier_id")
    return couriers.dimension_increment(staged, "courier_id", ["courier_name"], loaded, "courier_id")


@query("m10_delivery_fact", """
SELECT DISTINCT d.rn AS delivery_sk, 5.0::DOUBLE AS rate, c.rn AS courier_sk, o.rn AS order_sk, o.o_orderdate AS order_ts, o.o_totalprice AS orders_sum, o.o_totalprice * 0.125::DOUBLE AS tips_sum
FROM lineitem JOIN (SELECT o_orderkey, o_orderdate, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) o ON l_orderkey = o.o_orderkey
JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS rn FROM supplier) c ON l_suppkey = c.s_suppkey
JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS rn FROM part) d ON l_partkey = d.p_partkey
WHERE l_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-02')""")
def m10_fact(spark, base):
    """Order lines as deliveries with surrogate ids of courier, delivery and order."""
    orders = table(spark, base, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_ts"), F.col("o_totalprice").alias("orders_sum"), (F.col("o_totalprice") * 0.125).alias("tip_sum"))
    dm_orders = global_row_number(orders, [F.col("order_id")], "id")
    dm_couriers = global_row_number(table(spark, base, "supplier").select(F.col("s_suppkey").alias("courier_id")), [F.col("courier_id")], "id")
    dm_deliveries = global_row_number(table(spark, base, "part").select(F.col("p_partkey").alias("delivery_id"), F.lit(5.0).alias("rate")), [F.col("delivery_id")], "id")
    staged = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("courier_id"), F.col("l_partkey").alias("delivery_id"))
    loaded = orders.filter(F.col("order_ts") < F.lit("1995-01-02").cast("timestamp_ntz")).select("order_id")
    return couriers.delivery_fact(staged, dm_couriers, dm_deliveries, dm_orders, loaded)


@query("m11_courier_ledger", f"""
WITH g AS (SELECT courier_id, courier_name, year(order_ts)::BIGINT AS settlement_year, month(order_ts)::BIGINT AS settlement_month, count(*) AS orders_count, sum(sum) AS total, CAST(sum(rate) AS DOUBLE) / count(rate) AS rate_avg, sum(tip_sum) AS tips
  FROM {data.DELIVERIES_SQL} GROUP BY ALL),
 p AS (SELECT d.courier_id, year(order_ts)::BIGINT AS settlement_year, month(order_ts)::BIGINT AS settlement_month, sum(CASE WHEN rate_avg < 4 THEN greatest(d.sum * 0.05, 100) WHEN rate_avg < 4.5 THEN greatest(d.sum * 0.07, 150)
   WHEN rate_avg < 4.9 THEN greatest(d.sum * 0.08, 175) ELSE greatest(d.sum * 0.10, 200) END) AS pay
  FROM {data.DELIVERIES_SQL} d JOIN g ON g.courier_id = d.courier_id AND g.settlement_year = year(order_ts) AND g.settlement_month = month(order_ts) GROUP BY ALL)
SELECT courier_id, courier_name, settlement_year, settlement_month, orders_count, total::DOUBLE AS orders_total_sum, rate_avg, (total * 0.25)::DOUBLE AS order_processing_fee,
 pay::DOUBLE AS courier_order_sum, tips::DOUBLE AS courier_tips_sum, (pay + tips * 0.95)::DOUBLE AS courier_reward_sum FROM g JOIN p USING (courier_id, settlement_year, settlement_month)""")
def m11(spark, base):
    return couriers.courier_ledger(data.deliveries(spark, base))


MEMBERS_SQL = f"(SELECT DISTINCT k AS group_id, user_id FROM {data.EVENTS_K_SQL})"
WRITERS_SQL = f"(SELECT DISTINCT user_id FROM {data.EVENTS_K_SQL} WHERE event_type = 'click' AND value > 150)"
ACTIVE_SQL = f"(SELECT group_id, count(*) AS cnt_users_in_group_with_messages FROM {MEMBERS_SQL} WHERE user_id IN (SELECT user_id FROM {WRITERS_SQL}) GROUP BY group_id)"
OLD_SQL = f"(SELECT k FROM {data.EVENTS_K_SQL} GROUP BY k ORDER BY min(ts), k LIMIT 10)"
ADDED_SQL = f"(SELECT k AS group_id, count(DISTINCT user_id) AS cnt_added_users FROM {data.EVENTS_K_SQL} WHERE event_type = 'signup' AND k IN {OLD_SQL} GROUP BY k)"


def _group_frames(spark, base):
    log = data.events_with_k(spark, base).select(F.col("k").alias("group_id"), "user_id", F.when(F.col("event_type") == "signup", "add").otherwise(F.col("event_type")).alias("event"), "ts", "value")
    writers = log.filter((F.col("event") == "click") & (F.col("value") > 150)).select("user_id")
    registered = log.groupBy("group_id").agg(F.min("ts").alias("registration_dt"))
    return log, writers, registered


@query("m12_users_with_messages", f"SELECT * FROM {ACTIVE_SQL} ORDER BY cnt_users_in_group_with_messages, group_id LIMIT 10")
def m12(spark, base):
    log, writers, _ = _group_frames(spark, base)
    return groups.users_with_messages(log, writers).orderBy("cnt_users_in_group_with_messages", "group_id").limit(10)


@query("m13_users_added", f"SELECT * FROM {ADDED_SQL} ORDER BY cnt_added_users, group_id LIMIT 10")
def m13(spark, base):
    log, _, registered = _group_frames(spark, base)
    return groups.users_added(log, registered).orderBy("cnt_added_users", "group_id").limit(10)


@query("m14_group_conversion", f"""
SELECT group_id, cnt_added_users, cnt_users_in_group_with_messages, cnt_users_in_group_with_messages / cnt_added_users AS group_conversion FROM {ADDED_SQL} LEFT JOIN {ACTIVE_SQL} USING (group_id)""")
def m14(spark, base):
    log, writers, registered = _group_frames(spark, base)
    return groups.group_conversion(log, writers, log, registered)


@query("m15_zone_activity", f"""
WITH z AS MATERIALIZED (SELECT *, date_trunc('month', ts) AS month, date_trunc('week', ts) AS week FROM {data.ZONED_SQL}),
 f AS (SELECT month, week, zone_id, count(*) AS n FROM (SELECT * FROM z WHERE event_type = 'message' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1) GROUP BY ALL),
 w AS (SELECT month, week, zone_id, count(*) FILTER (event_type = 'message') AS week_message, count(*) FILTER (event_type = 'reaction') AS week_reaction, count(*) FILTER (event_type = 'subscription') AS week_subscription FROM z GROUP BY ALL),
 j AS (SELECT w.*, coalesce(n, 0) AS week_user FROM w LEFT JOIN f USING (month, week, zone_id))
SELECT strftime(month, '%Y-%m-%d') AS month, strftime(week, '%Y-%m-%d') AS week, zone_id, week_message, week_reaction, week_subscription, week_user,
 CAST(sum(week_message) OVER m AS BIGINT) AS month_message, CAST(sum(week_reaction) OVER m AS BIGINT) AS month_reaction, CAST(sum(week_subscription) OVER m AS BIGINT) AS month_subscription, CAST(sum(week_user) OVER m AS BIGINT) AS month_user
FROM j WINDOW m AS (PARTITION BY month, zone_id)""")
def m15(spark, base):
    activity = geography.zone_activity(data.geo_events(spark, base), data.places(spark, base))
    return activity.withColumns({"month": day_text("month"), "week": day_text("week")})


TRAVEL_SQL = f"""
WITH c AS MATERIALIZED (SELECT user_id, ts, event_id, city FROM {data.ZONED_SQL} z JOIN {data.PLACES_SQL} p ON z.zone_id = p.id WHERE event_type = 'message'),
 t AS (SELECT user_id, string_agg(city, ',' ORDER BY ts, event_id) AS travel_array, count(*) AS travel_count FROM (SELECT *, lag(city) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM c) WHERE prev IS NULL OR prev <> city GROUP BY user_id)"""


def _travel(spark, base):
    messages = data.geo_events(spark, base).filter(F.col("event_type") == "message")
    return geography.user_travel(messages, data.places(spark, base), 27)


USER_TRAVEL_SQL = f"""
{TRAVEL_SQL},
 i AS (SELECT user_id, city, min(day) AS a, max(day) AS b FROM (SELECT user_id, city, day, day - CAST(dense_rank() OVER (PARTITION BY user_id, city ORDER BY day) AS INT) AS grp FROM (SELECT DISTINCT user_id, city, CAST(ts AS DATE) AS day FROM c)) GROUP BY user_id, city, grp),
 h AS (SELECT user_id, city AS home_city FROM i QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY least(b - a, 27) DESC, b DESC, city) = 1),
 l AS (SELECT user_id, arg_max(city, (ts, event_id)) AS act_city, max(ts) AS ts FROM c GROUP BY user_id)
SELECT user_id, act_city, strftime(timezone('Australia/Sydney', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local_time, travel_count, home_city FROM l LEFT JOIN t USING (user_id) LEFT JOIN h USING (user_id)"""


@query("m16_user_travel", USER_TRAVEL_SQL)
def m16(spark, base):
    users, _ = _travel(spark, base)
    return users.withColumn("local_time", time_text("local_time"))


@query("m16_from_delivered_files", USER_TRAVEL_SQL)
def m16_delivered(spark, base):
    """The same mart out of nested events and the city file with decimal commas."""
    path = scratch_path(spark, "cities")
    cities = data.places(spark, base)
    write_delimited(cities.select("id", "city", *[F.regexp_replace(F.col(c).cast("string"), "[.]", ",").alias(c) for c in ("lat", "lng")]), path, ";")
    messages = flat_events(data.delivered_events(spark, base)).filter(F.col("event_type") == "message")
    users, _ = geography.user_travel(messages, city_file(spark, path), 27)
    return users.withColumn("local_time", time_text("local_time"))


@query("m16_travel_array", f"{TRAVEL_SQL} SELECT user_id, CAST(0 AS BIGINT) AS page, travel_array FROM t")
def m16_array(spark, base):
    """The visited cities of each user, the child table of ``m16_user_travel``."""
    _, lists = _travel(spark, base)
    return lists.withColumn("travel_array", F.array_join("travel_array", ","))


@query("m17_friend_suggestions", f"""
WITH g AS MATERIALIZED (SELECT * FROM {data.ZONED_SQL}),
 l AS (SELECT user_id, arg_max(zone_id, (ts, event_id)) AS zone_id, arg_max(lat, (ts, event_id)) AS lat, arg_max(lon, (ts, event_id)) AS lon FROM g WHERE event_type = 'message' GROUP BY user_id),
 s AS (SELECT DISTINCT user_id, channel FROM g WHERE event_type = 'subscription'),
 d AS (SELECT user_id AS a, message_to AS b FROM g WHERE event_type = 'message' UNION SELECT message_to, user_id FROM g WHERE event_type = 'message')
SELECT DISTINCT x.user_id AS user_left, y.user_id AS user_right, x.zone_id, '2024-02-01 12:00:00' AS processed_dttm, '2024-02-01 23:00:00' AS local_time FROM l x JOIN l y ON x.zone_id = y.zone_id AND x.user_id <> y.user_id JOIN s sx ON sx.user_id = x.user_id JOIN s sy ON sy.user_id = y.user_id AND sx.channel = sy.channel
WHERE {data.distance_sql('x.lat', 'x.lon', 'y.lat', 'y.lon')} <= 1.0 AND NOT EXISTS (SELECT 1 FROM d WHERE d.a = x.user_id AND d.b = y.user_id)""")
def m17(spark, base):
    events = data.geo_events(spark, base)
    messages = events.filter(F.col("event_type") == "message")
    subscriptions = events.filter(F.col("event_type") == "subscription").select("user_id", "channel")
    pairs = geography.friend_suggestions(messages, subscriptions, data.places(spark, base))
    report = geography.suggestions_report(pairs, F.lit("2024-02-01 12:00:00").cast("timestamp"))
    return report.withColumns({"processed_dttm": time_text("processed_dttm"), "local_time": time_text("local_time")})


@query("m18_campaign_notifications", f"""
SELECT restaurant_id, adv_campaign_id, adv_campaign_content, client_id, CAST(NULL AS VARCHAR) AS feedback FROM {data.CAMPAIGNS_SQL} JOIN {data.SUBSCRIBERS_SQL} USING (restaurant_id)
WHERE adv_start <= TIMESTAMP '2024-01-20 00:00:00' AND adv_end >= TIMESTAMP '2024-01-20 00:00:00'""")
def m18(spark, base):
    moment = F.lit("2024-01-20").cast("timestamp")
    running = jobs.active_campaigns(jobs.campaign_rows(data.campaigns(spark, base)), moment)
    return jobs.notifications(running, data.subscribers(spark, base), moment).select(
        "restaurant_id", "adv_campaign_id", "adv_campaign_content", "client_id", "feedback")


COUNTED_SQL = f"(SELECT * FROM {data.MESSAGE_LINES_SQL} WHERE status = 'CLOSED')"


@query("m19_product_counters", f"SELECT {data.uuid_sql('user_id')} AS user_id, {data.uuid_sql('product_id')} AS product_id, product_name, order_cnt FROM (SELECT user_id, product_id, min(productname) AS product_name, count(*) AS order_cnt FROM {COUNTED_SQL} GROUP BY user_id, product_id)")
def m19_products(spark, base):
    return counters.product_counters(message_lines(data.order_messages(spark, base)))


@query("m19_category_counters", f"SELECT {data.uuid_sql('user_id')} AS user_id, {data.uuid_sql('category_name')} AS category_id, category_name, order_cnt FROM (SELECT user_id, category_name, count(*) AS order_cnt FROM {COUNTED_SQL} GROUP BY user_id, category_name)")
def m19_categories(spark, base):
    return counters.category_counters(message_lines(data.order_messages(spark, base)))


def _metrics_sql(first: str | None, last: str | None, accounts: str) -> str:
    days = f"CAST(transaction_dt AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'" if first else "TRUE"
    return f"""
SELECT strftime(t.day, '%Y-%m-%d') AS date_update, t.currency_code AS currency_from, amount::DOUBLE * rate AS amount_total, cnt_transactions, cnt_transactions / cnt_accounts AS avg_transactions_per_account, cnt_accounts AS cnt_accounts_make_transactions
FROM (SELECT CAST(transaction_dt AS DATE) AS day, currency_code, sum(abs(CAST(amount AS DECIMAL(18,2)))) AS amount, count(*) AS cnt_transactions, count(DISTINCT account_number_from) AS cnt_accounts
 FROM {data.TRANSACTIONS_SQL} WHERE status = 'done' AND transaction_type <> 'authorisation' AND {accounts} AND {days} GROUP BY ALL) t
JOIN (SELECT day, currency_code, rate FROM {data.RATES_SQL} WHERE currency_code <> 420 UNION ALL SELECT DISTINCT CAST(transaction_dt AS DATE), 420, 1.0::DOUBLE FROM {data.TRANSACTIONS_SQL}) r ON t.day = r.day AND t.currency_code = r.currency_code"""


BOTH = "account_number_from >= 0 AND account_number_to >= 0"


@query("m20_daily_currency_metrics", _metrics_sql("1998-10-03", "1998-10-03", BOTH))
def m20(spark, base):
    mart = money.currency_metrics(data.transactions(spark, base), data.rates(spark, base), "1998-10-03", "1998-10-03")
    return mart.withColumn("date_update", day_text("date_update"))


@query("m20_daily_currency_metrics_one_side", _metrics_sql("1998-10-03", "1998-10-03", "account_number_from >= 0"))
def m20_one_side(spark, base):
    mart = money.currency_metrics(data.transactions(spark, base), data.rates(spark, base), "1998-10-03", "1998-10-03", both_sides=False)
    return mart.withColumn("date_update", day_text("date_update"))


@query("m21_metrics_backfill", _metrics_sql(None, None, BOTH))
def m21(spark, base):
    """All days in one grouped job."""
    mart = money.currency_metrics(data.transactions(spark, base), data.rates(spark, base))
    return mart.withColumn("date_update", day_text("date_update"))
