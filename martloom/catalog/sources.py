"""Sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from martloom.catalog import standins as data
from martloom.catalog.registry import big, query, time_text
from martloom.operators.increments import staged
from martloom.schemas import EVENT_PROPS, SAMPLE_TABLES
from martloom.session import scratch_path
from martloom.sources import files
from martloom.sources.queue import as_messages
from martloom.streaming import runs
from martloom.tables import stream, table


@query("s01_read_delimited", "SELECT r_regionkey, r_name FROM region")
def s01(spark, base):
    path = scratch_path(spark, "region_text")
    files.write_delimited(table(spark, base, "region"), path, ";")
    return files.read_delimited(spark, path, SAMPLE_TABLES["region"], ";")


@query("s02_read_partition", """
SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def s02(spark, base):
    path = scratch_path(spark, "events_by_day")
    files.write_table(table(spark, base, "events").withColumn("date", F.to_date("ts")), path, ["date"])
    day = files.read_partition(spark, path, "date", F.lit("2024-01-15").cast("date"))
    return day.select("event_id", "user_id", "event_type", "value")


@query("s03_parquet_overwrite", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0")
def s03(spark, base):
    path = scratch_path(spark, "customers")
    customers = table(spark, base, "customer").select("c_custkey", "c_name", "c_acctbal")
    files.write_table(customers, path)
    files.write_table(customers.filter(F.col("c_acctbal") >= 0), path)
    return spark.read.parquet(path)


@query("s04_parquet_append", """
SELECT s_suppkey, s_name, d AS run_date FROM supplier, (VALUES ('2024-01-01'), ('2024-01-02')) v(d)""")
def s04(spark, base):
    path = scratch_path(spark, "suppliers")
    suppliers = table(spark, base, "supplier").select("s_suppkey", "s_name")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        files.append_run(suppliers, path, day)
    return spark.read.parquet(path).select("s_suppkey", "s_name", F.col("run_date").cast("string").alias("run_date"))


@query("s07_bulk_load", "SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size FROM part")
def s07(spark, base):
    text = scratch_path(spark, "part_text")
    parts = table(spark, base, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    files.write_delimited(parts, text, ",", quote_all=True)
    schema = StructType([StructField("p_partkey", LongType()), StructField("p_name", StringType()),
                         StructField("p_brand", StringType()), StructField("p_size", IntegerType())])
    loaded = files.bulk_load(spark, text, schema, scratch_path(spark, "part_table"))
    return loaded.withColumn("p_size", big("p_size"))


@query("s08_json_increment", """
SELECT event_id, user_id, event_type FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')""")
def s08(spark, base):
    events = table(spark, base, "events").select("event_id", "user_id", "event_type", "ts")
    landing = scratch_path(spark, "events_json")
    events.drop("ts").write.mode("overwrite").json(landing)
    loaded = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).select("event_id")
    schema = StructType([f for f in SAMPLE_TABLES["events"].fields if f.name in ("event_id", "user_id", "event_type")])
    return files.read_json_increment(spark, landing, schema, "event_id", loaded, "event_id")


@query("s09_stage_clean", """
SELECT event_id, user_id, event_type, 'shipped' AS status FROM events""")
def s09(spark, base):
    events = table(spark, base, "events").select(
        F.col("event_id").alias("id"), F.col("event_id"), "user_id", "event_type")
    doubled = events.unionByName(events.withColumn("id", F.col("id") + 1))
    return staged(doubled, "event_id", ["id"], ["id"], {"status": F.lit("shipped"), "user_id": F.lit(None)}).select(
        "event_id", "user_id", "event_type", "status")


@query("s10_queue_source", f"""
SELECT event_id, user_id, k FROM {data.EVENTS_K_SQL}""")
def s10(spark, base):
    arriving = stream(spark, base, "events")
    messages = as_messages(arriving, "event_id", "user_id", "props")
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()), StructField("props", StringType())])
    rows = messages.select(F.from_json("value", schema).alias("m")).select(
        "m.event_id", "m.user_id", F.from_json("m.props", EVENT_PROPS)["k"].alias("k"))
    path = scratch_path(spark, "queue_rows")
    runs.start(rows, lambda batch, i: runs.write_batch(batch, path, i), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "k")


@query("s11_queue_sink", """
SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def s11(spark, base):
    path = scratch_path(spark, "messages")
    files.write_table(as_messages(table(spark, base, "events"), "event_id", "event_type"), path)
    return spark.read.parquet(path)


@query("s12_two_sinks", """
SELECT 'rows' AS sink, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events
UNION ALL SELECT 'messages', count(*), CAST(sum(event_id) AS BIGINT) FROM events""")
def s12(spark, base):
    rows_path, message_path = scratch_path(spark, "rows"), scratch_path(spark, "messages")
    handle = runs.two_sinks(
        lambda batch, i: runs.write_batch(batch.select("event_id", "event_type"), rows_path, i),
        lambda batch, i: runs.write_batch(as_messages(batch, "event_id"), message_path, i))
    runs.start(stream(spark, base, "events"), handle, scratch_path(spark, "checkpoint"), None).awaitTermination()
    rows = spark.read.parquet(rows_path).select(F.lit("rows").alias("sink"), "event_id")
    sent = spark.read.parquet(message_path).select(
        F.lit("messages").alias("sink"), F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))
    return rows.unionByName(sent).groupBy("sink").agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


@query("s13_named_views", """
SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def s13(spark, base):
    files.named_views({"shop_orders": table(spark, base, "orders")})
    return spark.sql("SELECT o_orderstatus AS status, count(*) AS n FROM shop_orders GROUP BY o_orderstatus")


@query("s14_object_store_read", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation")
def s14(spark, base):
    path = scratch_path(spark, "nation_text")
    files.write_delimited(table(spark, base, "nation"), path)
    # any URI scheme of the cluster's file systems works here; this one is the shared folder
    return files.read_delimited(spark, path, SAMPLE_TABLES["nation"]).select(big("n_nationkey").alias("n_nationkey"), "n_name")


@query("s15_preview", "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 10")
def s15(spark, base):
    return files.preview(table(spark, base, "events").select("event_id", "user_id", "event_type"), [F.col("event_id")])


@query("s05_day_range_scan", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_ts FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-03-02' AND o_orderdate < TIMESTAMP '1998-03-09'""")
def s05(spark, base):
    """The day predicates of the database scan, run against the order table."""
    from martloom.sources.jdbc import day_slices
    days = day_slices("o_orderdate", dt.date(1998, 3, 2), dt.date(1998, 3, 8))
    return table(spark, base, "orders").filter(" OR ".join(f"({d})" for d in days)).select(
        "o_orderkey", "o_custkey", time_text("o_orderdate").alias("order_ts"))
