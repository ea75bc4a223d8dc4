"""Frames of the marts' input shapes, derived row by row from the sample tables.

Each frame has an SQL twin (``*_SQL``) for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.aggregates import nested_pages
from martloom.operators.joins import join_in_pieces, lookup_in_pieces
from martloom.schemas import EVENT_PROPS
from martloom.sizing import pieces_of, spread_if_small, spread_in_pieces
from martloom.tables import table


def events_with_k(spark: SparkSession, base: str) -> DataFrame:
    """Events with the number ``k`` out of their JSON properties."""
    return table(spark, base, "events").withColumn("k", F.from_json("props", EVENT_PROPS)["k"])


EVENTS_K_SQL = "(SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"

KINDS = {"view": "message", "click": "message", "purchase": "reaction", "signup": "subscription"}


def geo_events(spark: SparkSession, base: str) -> DataFrame:
    """Events as geotagged messages, reactions and subscriptions.

    Five users share a neighbourhood; neighbourhoods are spread over ten degrees, and
    every user moves between three regions.
    """
    events = spread_if_small(table(spark, base, "events")).withColumn("k", F.from_json("props", EVENT_PROPS)["k"])
    user, event, k = F.col("user_id"), F.col("event_id"), F.col("k")
    block = F.floor(user / 5).cast("bigint")
    south = (block * 7919) % 10007 + (user % 5) * 4 + event % 4 + (k % 3) * 1700
    east = (block * 6151) % 9973 + (user % 5) * 3 + event % 3 + (k % 3) * 2300
    kind = F.lit("other")
    for source, target in KINDS.items():
        kind = F.when(F.col("event_type") == source, target).otherwise(kind)
    return events.select(
        "event_id", "ts", "user_id", kind.alias("event_type"),
        (F.lit(-33.0) - south.cast("double") / 1000.0).alias("lat"),
        (F.lit(151.0) + east.cast("double") / 1000.0).alias("lon"),
        F.when(k < 3, block * 5 + k % 5).otherwise(user + 1000 + k).alias("message_to"),
        (k % 7).alias("channel"))


GEO_SQL = f"""(SELECT event_id, ts, user_id,
  CASE event_type WHEN 'view' THEN 'message' WHEN 'click' THEN 'message' WHEN 'purchase' THEN 'reaction'
    WHEN 'signup' THEN 'subscription' ELSE 'other' END AS event_type,
  CAST(-33.0 AS DOUBLE) - CAST(((user_id // 5) * 7919) % 10007 + (user_id % 5) * 4 + event_id % 4 + (k % 3) * 1700 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS lat,
  CAST(151.0 AS DOUBLE) + CAST(((user_id // 5) * 6151) % 9973 + (user_id % 5) * 3 + event_id % 3 + (k % 3) * 2300 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS lon,
  CASE WHEN k < 3 THEN (user_id // 5) * 5 + k % 5 ELSE user_id + 1000 + k END AS message_to,
  k % 7 AS channel
 FROM {EVENTS_K_SQL})"""


def delivered_events(spark: SparkSession, base: str) -> DataFrame:
    """The same events as they are delivered: nested, half of them with the time in the other field."""
    kind, even = F.col("event_type"), F.col("event_id") % 2 == 0
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return geo_events(spark, base).select("event_id", "event_type", "lat", "lon", F.struct(
        F.when(kind == "message", F.col("user_id")).alias("message_from"), F.when(kind == "message", F.col("message_to")).alias("message_to"),
        F.when(kind == "reaction", F.col("user_id")).cast("string").alias("reaction_from"),
        F.when(kind.isin("subscription", "other"), F.col("user_id")).cast("string").alias("user"),
        F.when(kind == "subscription", F.col("channel")).alias("subscription_channel"),
        F.when(even, text).alias("datetime"), F.when(~even, text).alias("message_ts")).alias("event"))


def places(spark: SparkSession, base: str) -> DataFrame:
    """Nations as city centres: ``id, city, lat, lng``."""
    key = F.col("n_nationkey")
    return table(spark, base, "nation").select(
        key.cast("bigint").alias("id"), F.col("n_name").alias("city"),
        (F.lit(-33.0) - ((key * 7) % 25 * 550).cast("double") / 1000.0).alias("lat"),
        (F.lit(151.0) + ((key * 11) % 25 * 500).cast("double") / 1000.0).alias("lng"))


PLACES_SQL = """(SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS city,
  CAST(-33.0 AS DOUBLE) - CAST((n_nationkey * 7) % 25 * 550 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS lat,
  CAST(151.0 AS DOUBLE) + CAST((n_nationkey * 11) % 25 * 500 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS lng
 FROM nation)"""


def distance_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """Haversine distance in SQL."""
    return (f"(12742.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
            f" + cos(radians({lat2})) * cos(radians({lat1})) * pow(sin(radians({lng2} - {lng1}) / 2), 2)))))")


ZONED_SQL = f"""(SELECT g.*, (SELECT arg_min(p.id, ({distance_sql('p.lat', 'p.lng', 'g.lat', 'g.lon')}, p.id)) FROM {PLACES_SQL} p) AS zone_id
 FROM {GEO_SQL} g)"""


def rfm_frames(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Users and orders in the shape of the segment mart; status ``F`` is closed."""
    users = table(spark, base, "customer").select(F.col("c_custkey").alias("user_id"))
    orders = table(spark, base, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_ts"),
        F.col("o_totalprice").alias("payment"), F.col("o_orderstatus").alias("status"))
    return users, orders


def shipping_log(spark: SparkSession, base: str) -> DataFrame:
    """Wide shipping log: one ``booked`` row per order and one state row per line.

    Country comes from the customer's nation, agreement and transfer from order columns.  The rows are dealt by
    shipment over pieces of bounded size, as the marts group them.
    """
    pieces = order_pieces(spark, base)
    orders = spread_if_small(table(spark, base, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"))
    customers = table(spark, base, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, base, "nation").select("n_nationkey", "n_name")
    wide = lookup_in_pieces(orders.withColumnRenamed("o_custkey", "c_custkey"), customers, "c_custkey", pieces).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"))
    vendor = F.col("c_custkey") % 20
    described = wide.select(
        F.col("o_orderkey").alias("shippingid"), vendor.alias("vendorid"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("payment_amount"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("shipping_plan_datetime"),
        F.col("n_name").alias("shipping_country"),
        ((F.col("n_nationkey") % 5 + 1) / F.lit(100.0)).cast("decimal(14,3)").alias("shipping_country_base_rate"),
        F.concat_ws(":", vendor.cast("string"), F.concat(F.lit("vsp-"), vendor.cast("string")),
                    F.concat(F.lit("0.0"), (vendor % 9 + 1).cast("string")),
                    F.concat(F.lit("0.0"), (vendor % 3 + 1).cast("string"))).alias("vendor_agreement_description"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit("p:"), F.lower(F.substring("o_orderpriority", 3, 4)))
        .alias("shipping_transfer_description"),
        (F.substring("o_orderpriority", 1, 1).cast("int") / F.lit(1000.0)).cast("decimal(14,3)").alias("shipping_transfer_rate"),
        "o_orderdate", "o_orderstatus").repartition(pieces, "shippingid")
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    steps = lines.select(
        F.col("l_orderkey").alias("shippingid"),
        F.when(F.col("l_returnflag") == "N", "recieved").when(F.col("l_returnflag") == "R", "returned").otherwise("pending").alias("state"),
        (F.col("l_shipdate") + F.expr("make_dt_interval(0, 5 * l_linenumber, 17 * l_linenumber)")).alias("state_datetime"))
    booked = described.select(*[c for c in described.columns if c not in ("o_orderdate", "o_orderstatus")],
                              F.lit("in_progress").alias("status"), F.lit("booked").alias("state"),
                              F.col("o_orderdate").alias("state_datetime"))
    moved = described.join(steps.repartition(pieces, "shippingid"), "shippingid").select(
        *[c for c in described.columns if c not in ("o_orderdate", "o_orderstatus")],
        F.when(F.col("state") == "recieved", "finished").otherwise("in_progress").alias("status"), "state", "state_datetime")
    return booked.unionByName(moved)


SHIPPING_SQL = """(WITH described AS (
  SELECT o_orderkey AS shippingid, o_custkey % 20 AS vendorid, CAST(o_totalprice AS DECIMAL(14,2)) AS payment_amount,
    o_orderdate + INTERVAL 30 DAY AS shipping_plan_datetime, n_name AS shipping_country,
    CAST((n_nationkey % 5 + 1) / 100.0 AS DECIMAL(14,3)) AS shipping_country_base_rate,
    concat_ws(':', CAST(o_custkey % 20 AS VARCHAR), 'vsp-' || (o_custkey % 20), '0.0' || (o_custkey % 20 % 9 + 1), '0.0' || (o_custkey % 20 % 3 + 1)) AS vendor_agreement_description,
    substr(o_orderpriority, 1, 1) || 'p:' || lower(substr(o_orderpriority, 3, 4)) AS shipping_transfer_description,
    CAST(CAST(substr(o_orderpriority, 1, 1) AS INT) / 1000.0 AS DECIMAL(14,3)) AS shipping_transfer_rate,
    o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
 SELECT * EXCLUDE (o_orderdate), 'in_progress' AS status, 'booked' AS state, o_orderdate AS state_datetime FROM described
 UNION ALL
 SELECT d.* EXCLUDE (o_orderdate), CASE WHEN l_returnflag = 'N' THEN 'finished' ELSE 'in_progress' END,
   CASE l_returnflag WHEN 'N' THEN 'recieved' WHEN 'R' THEN 'returned' ELSE 'pending' END,
   l_shipdate + to_minutes(CAST(317 * l_linenumber AS INT))
 FROM described d JOIN lineitem ON shippingid = l_orderkey)"""


def sales(spark: SparkSession, base: str) -> DataFrame:
    """Order lines as sales rows; ``R`` lines are refunds, the week starts on Monday."""
    lines = spread_if_small(table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"))
    orders = table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, base, "part").select("p_partkey", "p_brand")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.date_trunc("week", "o_orderdate").cast("date").alias("week"), F.col("p_brand").alias("item_id"),
        F.col("o_custkey").alias("customer_id"), F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "R", "refunded").otherwise("shipped").alias("status"),
        F.col("l_extendedprice").alias("payment_amount"), F.col("o_orderdate").alias("date_time"))


SALES_SQL = """(SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, p_brand AS item_id, o_custkey AS customer_id, l_quantity AS quantity,
  CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'shipped' END AS status, l_extendedprice AS payment_amount, o_orderdate AS date_time
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def deliveries(spark: SparkSession, base: str) -> DataFrame:
    """Order lines as deliveries: the supplier is the courier, the discount gives the rating."""
    lines = spread_in_pieces(table(spark, base, "lineitem").select("l_suppkey", "l_shipdate", "l_discount", "l_quantity", "l_extendedprice"))
    couriers = table(spark, base, "supplier").select("s_suppkey", "s_name")
    return lines.join(couriers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("courier_id"), F.col("s_name").alias("courier_name"), F.col("l_shipdate").alias("order_ts"),
        (F.lit(4.0).cast("decimal(4,2)") + F.col("l_discount").cast("decimal(4,2)") * 10 * F.when(F.col("l_suppkey") % 2 == 0, 1).otherwise(2)
         - F.when(F.col("l_suppkey") % 5 == 0, F.lit(1)).otherwise(F.lit(0))).cast("decimal(6,2)").alias("rate"),
        (F.col("l_quantity").cast("decimal(10,2)") * 80).cast("decimal(18,2)").alias("sum"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("tip_sum"))


DELIVERIES_SQL = """(SELECT l_suppkey AS courier_id, s_name AS courier_name, l_shipdate AS order_ts,
  CAST(CAST(4.0 AS DECIMAL(4,2)) + CAST(l_discount AS DECIMAL(4,2)) * 10 * CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 2 END
    - CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END AS DECIMAL(6,2)) AS rate,
  CAST(CAST(l_quantity AS DECIMAL(10,2)) * 80 AS DECIMAL(18,2)) AS sum, CAST(l_extendedprice AS DECIMAL(18,2)) AS tip_sum
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


def transactions(spark: SparkSession, base: str) -> DataFrame:
    """Orders as bank transactions; currency from the nation, type from the priority."""
    orders = table(spark, base, "orders")
    customers = table(spark, base, "customer").select("c_custkey", "c_nationkey")
    types = F.create_map(*[F.lit(x) for pair in TRANSACTION_TYPES.items() for x in pair])
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(F.col("o_orderkey") % 11 == 0, -1).otherwise(F.col("o_custkey")).alias("account_number_from"),
        F.when(F.col("o_orderkey") % 13 == 0, -1).otherwise(F.col("o_custkey") + 1).alias("account_number_to"),
        (F.col("c_nationkey") + 410).cast("bigint").alias("currency_code"),
        F.when(F.col("o_orderstatus") == "P", "queued").otherwise("done").alias("status"),
        types[F.substring("o_orderpriority", 1, 1)].alias("transaction_type"),
        F.when(F.col("o_orderkey") % 7 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"))


TRANSACTION_TYPES = {"1": "c2a_incoming", "2": "c2b_partner_incoming", "3": "sbp_outgoing", "4": "authorisation", "5": "transfer_incoming"}

TRANSACTIONS_SQL = """(SELECT CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE o_custkey END AS account_number_from,
  CASE WHEN o_orderkey % 13 = 0 THEN -1 ELSE o_custkey + 1 END AS account_number_to,
  CAST(c_nationkey + 410 AS BIGINT) AS currency_code, CASE WHEN o_orderstatus = 'P' THEN 'queued' ELSE 'done' END AS status,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'c2a_incoming' WHEN '2' THEN 'c2b_partner_incoming' WHEN '3' THEN 'sbp_outgoing'
    WHEN '4' THEN 'authorisation' WHEN '5' THEN 'transfer_incoming' END AS transaction_type,
  CASE WHEN o_orderkey % 7 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount, o_orderdate AS transaction_dt
 FROM orders JOIN customer ON o_custkey = c_custkey)"""


def rates(spark: SparkSession, base: str) -> DataFrame:
    """A rate per day and currency in use; one nation never has a rate."""
    used = transactions(spark, base).select(F.to_date("transaction_dt").alias("day"), "currency_code").distinct()
    return used.filter(F.col("currency_code") != 413).select(
        "day", "currency_code",
        ((F.col("currency_code") - 405 + F.dayofmonth("day")) / F.lit(8.0)).alias("rate"))


RATES_SQL = f"""(SELECT day, currency_code, CASE WHEN currency_code = 420 THEN 1.0::DOUBLE ELSE (currency_code - 405 + day(day)) / 8.0::DOUBLE END AS rate
 FROM (SELECT DISTINCT CAST(transaction_dt AS DATE) AS day, currency_code FROM {TRANSACTIONS_SQL}) WHERE currency_code <> 413)"""


def order_messages(spark: SparkSession, base: str) -> DataFrame:
    """Orders as nested messages with user, restaurant and products.

    An order with very many products is sent in several messages of bounded length.
    """
    orders = table(spark, base, "orders")
    customers = table(spark, base, "customer").select("c_custkey", "c_name", "c_mktsegment")
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, base, "part").select("p_partkey", "p_name", "p_type")
    product = F.struct(F.col("l_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"))
    nested = nested_pages(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")), ["l_orderkey"], product, "products", 1000)
    return (orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(nested, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(F.struct(
                F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").cast("timestamp").alias("date"),
                F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("OPEN").alias("status"),
                F.col("o_totalprice").alias("cost"), F.col("o_totalprice").alias("payment"),
                F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.lower("c_name").alias("login")).alias("user"),
                F.struct((F.col("o_custkey") % 50).cast("string").alias("id"), F.concat(F.lit("Place "), (F.col("o_custkey") % 50).cast("string")).alias("name")).alias("restaurant"),
                "products").alias("payload")))


def order_pieces(spark: SparkSession, base: str) -> int:
    """Pieces of orders and lines, not fewer than the session's shuffles have, so that all of them agree."""
    return max(pieces_of(table(spark, base, "orders"), table(spark, base, "lineitem")), int(spark.conf.get("spark.sql.shuffle.partitions")))


def _order_parts(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, int]:
    """Orders with their customer, lines with their product, and the pieces of both; products and orders meet last.

    Joined by the text of the order id, the rows lie as the tables of orders are grouped.
    """
    orders, lines = table(spark, base, "orders"), table(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    pieces = order_pieces(spark, base)
    customers = table(spark, base, "customer").select("c_custkey", "c_name")
    parts = table(spark, base, "part").select("p_partkey", "p_name", "p_type")
    bought = lookup_in_pieces(orders.withColumnRenamed("o_custkey", "c_custkey"), customers, "c_custkey", pieces).select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("order_dt"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("OPEN").alias("status"),
        F.col("o_totalprice").alias("ordercost"), F.col("o_totalprice").alias("payment"), F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("username"), F.lower("c_name").alias("userlogin"), (F.col("c_custkey") % 50).cast("string").alias("restaurant_id"),
        F.concat(F.lit("Place "), (F.col("c_custkey") % 50).cast("string")).alias("restaurantname"))
    sold = lookup_in_pieces(spread_if_small(lines).withColumnRenamed("l_partkey", "p_partkey"), parts, "p_partkey", pieces).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("productname"), F.col("p_type").alias("category_name"))
    return bought, sold, pieces


def order_rows(spark: SparkSession, base: str, by: list[str] | None = None) -> DataFrame:
    """The lines of the order messages as flat columns, for readers that need no messages; dealt by the order, or ``by``."""
    bought, sold, pieces = _order_parts(spark, base)
    rows = join_in_pieces(sold, bought, "order_id", pieces)
    return rows.repartition(pieces, *by) if by else rows


def order_heads(spark: SparkSession, base: str) -> DataFrame:
    """What the same rows say of the order, once per order that has a line."""
    bought, sold, pieces = _order_parts(spark, base)
    return join_in_pieces(bought, sold.select("order_id"), "order_id", pieces, "left_semi")


MESSAGE_LINES_SQL = """(SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_dt, CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS status,
  o_totalprice AS cost, CAST(c_custkey AS VARCHAR) AS user_id, c_name AS username, lower(c_name) AS userlogin,
  CAST(o_custkey % 50 AS VARCHAR) AS restaurant_id, 'Place ' || (o_custkey % 50) AS restaurantname,
  CAST(l_partkey AS VARCHAR) AS product_id, p_name AS productname, p_type AS category_name
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)"""


def uuid_sql(text: str) -> str:
    """Version-5 UUID of a text in SQL."""
    digest = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({text}))"
    return (f"(SELECT concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), "
            f"translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3), substr(h, 21, 12)) FROM (SELECT {digest} AS h))")


def campaigns(spark: SparkSession, base: str) -> DataFrame:
    """Events as campaign messages: the bought product group is the restaurant."""
    events = events_with_k(spark, base).filter(F.col("event_type") == "purchase")
    return events.select(F.to_json(campaign_struct()).alias("value"))


def campaign_struct():
    """Campaign columns out of an event with ``k``."""
    ts = F.col("ts").cast("timestamp")
    return F.struct(
        F.col("k").alias("restaurant_id"), F.col("event_id").alias("adv_campaign_id"),
        F.concat(F.lit("offer "), F.col("event_id").cast("string")).alias("adv_campaign_content"),
        F.concat(F.lit("owner "), F.col("user_id").cast("string")).alias("adv_campaign_owner"),
        F.lit("desk").alias("adv_campaign_owner_contact"),
        F.timestamp_seconds(F.unix_seconds(ts)).alias("adv_campaign_datetime_start"),
        F.timestamp_seconds(F.unix_seconds(ts) + (F.col("k") + 1) * 7200).alias("adv_campaign_datetime_end"),
        F.timestamp_seconds(F.unix_seconds(ts)).alias("datetime_created"))


CAMPAIGNS_SQL = f"""(SELECT k AS restaurant_id, event_id AS adv_campaign_id, 'offer ' || event_id AS adv_campaign_content, 'owner ' || user_id AS adv_campaign_owner,
  date_trunc('second', ts) AS adv_start, date_trunc('second', ts) + to_hours(CAST((k + 1) * 2 AS INT)) AS adv_end
 FROM {EVENTS_K_SQL} WHERE event_type = 'purchase')"""


def subscribers(spark: SparkSession, base: str) -> DataFrame:
    """Customers as subscribers of a restaurant."""
    return table(spark, base, "customer").select(
        (F.col("c_custkey") % 100).alias("restaurant_id"), F.col("c_name").alias("client_id"))


SUBSCRIBERS_SQL = "(SELECT c_custkey % 100 AS restaurant_id, c_name AS client_id FROM customer)"
