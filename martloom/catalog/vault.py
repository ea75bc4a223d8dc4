"""Data vault: hubs, satellites, links and the social vault."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog import standins as data
from martloom.catalog.registry import query, time_text
from martloom.functions.keys import link_hash
from martloom.operators.increments import unseen
from martloom.operators.vault import VAULT_TABLES, append_unseen, distinct_vault_rows, hub, line_vault, order_lines, vault_table
from martloom.session import lean_writes, scratch, scratch_path
from martloom.sources import files
from martloom.tables import table

LOADED = "2024-02-01 00:00:00"
LINES = data.MESSAGE_LINES_SQL


def vault(spark, base, by=None):
    """All vault tables of the orders, loaded at a fixed time; the one that is read is built from the columns it needs.

    Tables of orders come from one row per order; lines are dealt by order, or ``by`` the keys that a table is grouped by.
    """
    return line_vault(data.order_heads(spark, base), data.order_rows(spark, base, by), F.lit(LOADED).cast("timestamp"))


def _stamped(df, *columns):
    return df.select(*columns, time_text("load_dt").alias("load_dt"), "load_src")


STAMP_SQL = f"'{LOADED}' AS load_dt, 'kafka_stg_msg' AS load_src"


COST_TEXT = "regexp_replace(CAST(cost AS VARCHAR), '[.]0$', '')"


def joined(*parts: str) -> str:
    """Key of several columns in SQL."""
    return data.uuid_sql(" || '#$#' || ".join(parts))


@query("v01_hub_user", f"SELECT {data.uuid_sql('user_id')} AS h_user_pk, user_id, {STAMP_SQL} FROM (SELECT DISTINCT user_id FROM {LINES})")
def hub_user(spark, base):
    return _stamped(vault(spark, base)["h_user"], "h_user_pk", "user_id")


@query("v01_hub_product", f"SELECT {data.uuid_sql('product_id')} AS h_product_pk, product_id, {STAMP_SQL} FROM (SELECT DISTINCT product_id FROM {LINES})")
def hub_product(spark, base):
    return _stamped(vault(spark, base)["h_product"], "h_product_pk", "product_id")


@query("v01_hub_restaurant", f"SELECT {data.uuid_sql('restaurant_id')} AS h_restaurant_pk, restaurant_id, {STAMP_SQL} FROM (SELECT DISTINCT restaurant_id FROM {LINES})")
def hub_restaurant(spark, base):
    return _stamped(vault(spark, base)["h_restaurant"], "h_restaurant_pk", "restaurant_id")


@query("v01_hub_order", f"SELECT {data.uuid_sql('order_id')} AS h_order_pk, order_id, strftime(order_dt, '%Y-%m-%d %H:%M:%S') AS order_dt, {STAMP_SQL} FROM (SELECT DISTINCT order_id, order_dt FROM {LINES})")
def hub_order(spark, base):
    return _stamped(vault(spark, base)["h_order"], "h_order_pk", "order_id", time_text("order_dt").alias("order_dt"))


@query("v01_hub_category", f"SELECT {data.uuid_sql('category_name')} AS h_category_pk, category_name, {STAMP_SQL} FROM (SELECT DISTINCT category_name FROM {LINES})")
def hub_category(spark, base):
    return _stamped(vault(spark, base)["h_category"], "h_category_pk", "category_name")


@query("v01_hub_append", f"SELECT CAST(c_custkey AS VARCHAR) AS user_id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01') THEN 'first' ELSE 'second' END AS load_src FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def hub_append(spark, base):
    """Two loads of the same hub: the second appends only keys the first did not write."""
    orders = table(spark, base, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderdate")
    path, stamp = scratch_path(spark, "h_user"), F.lit(LOADED).cast("timestamp")
    early = orders.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    files.write_table(hub(early, "h_user_pk", "user_id", stamp, "first"), path, mode="append")
    loaded = spark.read.parquet(path)
    second = scratch_path(spark, "h_user_second")
    files.write_table(append_unseen(hub(orders, "h_user_pk", "user_id", stamp, "second"), loaded, "h_user_pk"), second)
    return spark.read.parquet(path, second).select("user_id", "load_src")


@query("v02_sat_user_names", f"SELECT {data.uuid_sql('user_id')} AS h_user_pk, username, userlogin, {STAMP_SQL}, {joined('user_id', 'username', 'userlogin')} AS hk_user_names_hashdiff FROM (SELECT DISTINCT user_id, username, userlogin FROM {LINES})")
def sat_user_names(spark, base):
    return _stamped(vault(spark, base)["s_user_names"], "h_user_pk", "username", "userlogin", "hk_user_names_hashdiff")


@query("v02_sat_restaurant_names", f"SELECT {data.uuid_sql('restaurant_id')} AS h_restaurant_pk, restaurantname, {STAMP_SQL}, {joined('restaurant_id', 'restaurantname')} AS hk_restaurant_names_hashdiff FROM (SELECT DISTINCT restaurant_id, restaurantname FROM {LINES})")
def sat_restaurant_names(spark, base):
    return _stamped(vault(spark, base)["s_restaurant_names"], "h_restaurant_pk", "restaurantname", "hk_restaurant_names_hashdiff")


@query("v02_sat_product_names", f"SELECT {data.uuid_sql('product_id')} AS h_product_pk, productname, {STAMP_SQL}, {joined('product_id', 'productname')} AS hk_product_names_hashdiff FROM (SELECT DISTINCT product_id, productname FROM {LINES})")
def sat_product_names(spark, base):
    return _stamped(vault(spark, base)["s_product_names"], "h_product_pk", "productname", "hk_product_names_hashdiff")


@query("v02_sat_order_status", f"SELECT {data.uuid_sql('order_id')} AS h_order_pk, status, {STAMP_SQL}, {joined('order_id', 'status')} AS hk_order_status_hashdiff FROM (SELECT DISTINCT order_id, status FROM {LINES})")
def sat_order_status(spark, base):
    return _stamped(vault(spark, base)["s_order_status"], "h_order_pk", "status", "hk_order_status_hashdiff")


@query("v02_sat_order_cost", f"SELECT {data.uuid_sql('order_id')} AS h_order_pk, cost AS ordercost, cost AS payment, {STAMP_SQL}, {joined('order_id', COST_TEXT, COST_TEXT)} AS hk_order_cost_hashdiff FROM (SELECT DISTINCT order_id, cost FROM {LINES})")
def sat_order_cost(spark, base):
    return _stamped(vault(spark, base)["s_order_cost"], "h_order_pk", "ordercost", "payment", "hk_order_cost_hashdiff")


@query("v03_link_order_product", f"SELECT {joined('order_id', 'product_id')} AS hk_order_product_pk, {data.uuid_sql('order_id')} AS h_order_pk, {data.uuid_sql('product_id')} AS h_product_pk, {STAMP_SQL} FROM (SELECT DISTINCT order_id, product_id FROM {LINES})")
def link_order_product(spark, base):
    return _stamped(vault(spark, base)["l_order_product"], "hk_order_product_pk", "h_order_pk", "h_product_pk")


@query("v03_link_order_user", f"SELECT {joined('order_id', 'user_id')} AS hk_order_user_pk, {data.uuid_sql('order_id')} AS h_order_pk, {data.uuid_sql('user_id')} AS h_user_pk, {STAMP_SQL} FROM (SELECT DISTINCT order_id, user_id FROM {LINES})")
def link_order_user(spark, base):
    return _stamped(vault(spark, base)["l_order_user"], "hk_order_user_pk", "h_order_pk", "h_user_pk")


@query("v03_link_product_category", f"SELECT {joined('product_id', 'category_name')} AS hk_product_category_pk, {data.uuid_sql('product_id')} AS h_product_pk, {data.uuid_sql('category_name')} AS h_category_pk, {STAMP_SQL} FROM (SELECT DISTINCT product_id, category_name FROM {LINES})")
def link_product_category(spark, base):
    return _stamped(vault(spark, base)["l_product_category"], "hk_product_category_pk", "h_product_pk", "h_category_pk")


@query("v03_link_product_restaurant", f"SELECT {joined('product_id', 'restaurant_id')} AS hk_product_restaurant_pk, {data.uuid_sql('product_id')} AS h_product_pk, {data.uuid_sql('restaurant_id')} AS h_restaurant_pk, {STAMP_SQL} FROM (SELECT DISTINCT product_id, restaurant_id FROM {LINES})")
def link_product_restaurant(spark, base):
    return _stamped(vault(spark, base, ["product_id", "restaurant_id"])["l_product_restaurant"], "hk_product_restaurant_pk", "h_product_pk", "h_restaurant_pk")


@query("v04_order_lines", f"""
SELECT {data.uuid_sql('order_id')} AS h_order_pk, {data.uuid_sql('user_id')} AS h_user_pk, {data.uuid_sql('product_id')} AS h_product_pk, productname,
 {data.uuid_sql('category_name')} AS h_category_pk, category_name, status FROM {LINES}""")
def order_line_read(spark, base):
    """From nested messages, as a topic holds them: written once, then the rows of all tables with one narrow shuffle per business key."""
    path = scratch_path(spark, "vault")
    with scratch(spark), lean_writes(spark):
        topic = scratch_path(spark, "orders_topic")
        data.order_messages(spark, base).write.option("compression", "zstd").parquet(topic)
        rows = distinct_vault_rows(spark.read.parquet(topic), data.order_pieces(spark, base), F.lit(LOADED).cast("timestamp"))
        rows.write.partitionBy("table").option("compression", "zstd").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return order_lines({name: vault_table(stored, name, plain=True) for name in VAULT_TABLES}, plain=True)


@query("v05_social_link", "SELECT user_id, group_id FROM (SELECT DISTINCT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS group_id FROM events) WHERE (user_id, group_id) NOT IN (SELECT (user_id, CAST(json_extract(props, '$.k') AS BIGINT)) FROM events WHERE ts < TIMESTAMP '2024-01-10')")
def social_link(spark, base):
    """Links of users and groups that an earlier load has not written."""
    log = data.events_with_k(spark, base).select("user_id", F.col("k").alias("group_id"), "ts")
    links = log.select("user_id", "group_id").distinct().withColumn("hk_l_user_group_activity", link_hash(F.col("group_id"), F.col("user_id")))
    early = log.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")).select(link_hash(F.col("group_id"), F.col("user_id")).alias("hk_l_user_group_activity")).distinct()
    return unseen(links, early, ["hk_l_user_group_activity"]).select("user_id", "group_id")


@query("v05_social_history", f"""
SELECT user_id, k AS group_id, event_type AS event, ts AS event_dt, CASE WHEN event_type = 'signup' THEN value END AS user_value, 's3' AS load_src FROM {data.EVENTS_K_SQL}""")
def social_history(spark, base):
    """History satellite: every log row under the key of its link."""
    log = data.events_with_k(spark, base)
    key = link_hash(F.col("k"), F.col("user_id")).alias("hk_l_user_group_activity")
    links = log.select(key, "user_id", F.col("k").alias("group_id")).distinct()
    history = log.select(key, F.col("event_type").alias("event"), F.col("ts").alias("event_dt"), F.when(F.col("event_type") == "signup", F.col("value")).alias("user_value"), F.lit("s3").alias("load_src"))
    return history.join(links, "hk_l_user_group_activity").drop("hk_l_user_group_activity")
