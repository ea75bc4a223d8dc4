"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martloom.catalog import standins as data
from martloom.catalog.registry import big, day_text, query, time_text
from martloom.functions import geo, keys, messages, text, time
from martloom.schemas import EVENT_PROPS
from martloom.tables import table

AGREEMENT = "concat_ws(':', CAST(p_partkey AS VARCHAR), p_brand, '0.1')"


@query("f01_split", f"""
SELECT p_partkey, CAST(a[1] AS BIGINT) AS first_part, a[2] AS second_part, CAST(a[3] AS DOUBLE) AS third_part FROM (SELECT p_partkey, regexp_split_to_array({AGREEMENT}, ':+') AS a FROM part)""")
def f01(spark, base):
    parts = text.pieces(F.concat_ws(":", F.col("p_partkey").cast("string"), "p_brand", F.lit("0.1")))
    return table(spark, base, "part").select(
        "p_partkey", parts[0].cast("bigint").alias("first_part"), parts[1].alias("second_part"), parts[2].cast("double").alias("third_part"))


@query("f02_concat", "SELECT p_partkey, p_brand || '/' || p_type AS joined, concat_ws(':', p_brand, p_type, p_name) AS listed FROM part")
def f02(spark, base):
    return table(spark, base, "part").select(
        "p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("joined"), F.concat_ws(":", "p_brand", "p_type", "p_name").alias("listed"))


@query("f03_casts", """
SELECT p_partkey, CAST(p_retailprice AS DECIMAL(14,2))::DOUBLE AS price, CAST(substr(p_brand, 7) AS BIGINT) AS brand_no, TRY_CAST(p_type AS BIGINT) AS dirty, substr(p_name, 1, 4) AS short FROM part""")
def f03(spark, base):
    return table(spark, base, "part").select(
        "p_partkey", F.col("p_retailprice").cast("decimal(14,2)").cast("double").alias("price"),
        F.substring("p_brand", 7, 10).cast("bigint").alias("brand_no"), F.col("p_type").try_cast("bigint").alias("dirty"),
        F.substring("p_name", 1, 4).alias("short"))


@query("f04_coalesce", "SELECT event_id, coalesce(CASE WHEN value > 100 THEN event_type END, 'low') AS label FROM events")
def f04(spark, base):
    return table(spark, base, "events").select("event_id", F.coalesce(F.when(F.col("value") > 100, F.col("event_type")), F.lit("low")).alias("label"))


@query("f05_least", "SELECT event_id, least(value, 100.0::DOUBLE, CASE WHEN user_id > 50 THEN 20.0::DOUBLE END) AS capped FROM events")
def f05(spark, base):
    return table(spark, base, "events").select("event_id", F.least("value", F.lit(100.0), F.when(F.col("user_id") > 50, 20.0)).alias("capped"))


@query("f06_abs", "SELECT c_custkey, abs(c_acctbal) AS size FROM customer")
def f06(spark, base):
    return table(spark, base, "customer").select("c_custkey", F.abs("c_acctbal").alias("size"))


@query("f07_distance", f"""
SELECT event_id, round({data.distance_sql('lat', 'lon', '-33.8688::DOUBLE', '151.2093::DOUBLE')}, 4) AS km,
 round(12742.0::DOUBLE * asin(sqrt(pow(sin(radians(-33.8688::DOUBLE - lat)), 2) + cos(radians(-33.8688::DOUBLE)) * cos(radians(lat)) * pow(sin(radians(151.2093::DOUBLE - lon) / 2), 2))), 4) AS km_whole_angle
FROM {data.GEO_SQL}""")
def f07(spark, base):
    at = (F.col("lat"), F.col("lon"), F.lit(-33.8688), F.lit(151.2093))
    return data.geo_events(spark, base).select(
        "event_id", F.round(geo.distance_km(*at), 4).alias("km"), F.round(geo.distance_km(*at, half_angle=False), 4).alias("km_whole_angle"))


@query("f08_decimal_comma", "SELECT p_partkey, p_retailprice AS price FROM part")
def f08(spark, base):
    written = F.regexp_replace(F.col("p_retailprice").cast("string"), r"\.", ",")
    return table(spark, base, "part").select("p_partkey", text.decimal_comma(written).alias("price"))


@query("f09_date_trunc", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week FROM orders""")
def f09(spark, base):
    return table(spark, base, "orders").select(
        "o_orderkey", day_text(F.date_trunc("month", "o_orderdate")).alias("month"), day_text(F.date_trunc("week", "o_orderdate")).alias("week"))


@query("f10_date_arithmetic", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 10, '%Y-%m-%d') AS earlier, CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS days FROM orders""")
def f10(spark, base):
    return table(spark, base, "orders").select(
        "o_orderkey", day_text(F.date_sub(F.to_date("o_orderdate"), 10)).alias("earlier"),
        big(F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))).alias("days"))


@query("f11_extract", """
SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey, year(l_shipdate)::BIGINT AS y, month(l_shipdate)::BIGINT AS m, day(l_shipdate)::BIGINT AS d, week(l_shipdate)::BIGINT AS w,
 CAST(date_diff('second', o_orderdate, l_shipdate) // 86400 AS BIGINT) AS span FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate""")
def f11(spark, base):
    lines, orders = table(spark, base, "lineitem"), table(spark, base, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).filter(F.col("l_shipdate") >= F.col("o_orderdate"))
    ship = F.col("l_shipdate")
    return joined.select(
        "l_orderkey", big("l_linenumber").alias("line"), "l_partkey", big(F.year(ship)).alias("y"), big(F.month(ship)).alias("m"),
        big(F.dayofmonth(ship)).alias("d"), big(F.weekofyear(ship)).alias("w"), time.span_days(ship, F.col("o_orderdate")).alias("span"))


@query("f12_local_time", """
SELECT event_id, strftime(timezone('Australia/Sydney', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local_time FROM events""")
def f12(spark, base):
    return table(spark, base, "events").select("event_id", time_text(time.local_time(F.col("ts"))).alias("local_time"))


@query("f13_as_of", """
SELECT event_id, CAST(date_diff('second', ts, TIMESTAMP '2024-02-01 00:00:00') AS BIGINT) // 3600 AS hours_before FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def f13(spark, base):
    """The time of the run is an argument, so the same run can be repeated."""
    as_of = F.unix_seconds(F.lit("2024-02-01").cast("timestamp"))
    seconds = as_of - F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, base, "events").select("event_id", F.floor(seconds / 3600).alias("hours_before"))


@query("f14_calendar", """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, strftime(d, '%Y-%m-%d') AS day, week(d)::BIGINT AS week_of_year, coalesce(n, 0) AS orders
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) ON d = day""")
def f14(spark, base):
    days = time.calendar(spark, "1998-01-01", "1998-12-31")
    counts = table(spark, base, "orders").groupBy(F.to_date("o_orderdate").alias("date_actual")).agg(F.count("*").alias("n"))
    return days.join(counts, "date_actual", "left").select(
        "date_id", day_text("date_actual").alias("day"), "week_of_year", F.coalesce("n", F.lit(0)).alias("orders"))


@query("f15_arrays_overlap", """
SELECT doc_id, list_has_any(regexp_extract_all(lower(text), '\\p{L}+'), ['data', 'model', 'the']) AS overlaps FROM documents""")
def f15(spark, base):
    return table(spark, base, "documents").select(
        "doc_id", F.arrays_overlap(text.words(F.col("text")), F.array(F.lit("data"), F.lit("model"), F.lit("the"))).alias("overlaps"))


@query("f16_from_json", f"SELECT event_id, k, false AS broken FROM {data.EVENTS_K_SQL} WHERE k % 10 <> 0 UNION ALL SELECT event_id, NULL, true FROM {data.EVENTS_K_SQL} WHERE k % 10 = 0")
def f16(spark, base):
    """One body in ten is cut off, to show that such rows are kept aside."""
    events = data.events_with_k(spark, base)
    body = F.when(F.col("k") % 10 == 0, F.concat(F.lit("{"), F.col("event_id").cast("string"))).otherwise(
        F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"k":'), F.col("k").cast("string"), F.lit("}")))
    schema = StructType([*EVENT_PROPS.fields, StructField("id", LongType())])
    good, bad = messages.split_malformed(events.select(body.alias("value")), schema)
    return good.select(F.col("event.id").alias("event_id"), "event.k", F.lit(False).alias("broken")).unionByName(
        bad.select(F.regexp_extract("value", r"(\d+)", 1).cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("k"), F.lit(True).alias("broken")))


@query("f17_to_json", """SELECT n_nationkey::BIGINT AS n_nationkey, '{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS value FROM nation""")
def f17(spark, base):
    return table(spark, base, "nation").select(big("n_nationkey").alias("n_nationkey"), messages.json_value("n_name", "n_regionkey"))


@query("f18_explode", "SELECT vec_id, pos - 1 AS place, CAST(embedding[pos] AS DOUBLE) AS value FROM embeddings, generate_series(1, 64) t(pos)")
def f18(spark, base):
    return table(spark, base, "embeddings").select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("place", "value")).withColumn("place", big("place"))


@query("f19_uuid5", f"SELECT c_custkey, {data.uuid_sql('c_name')} AS single, {data.uuid_sql(chr(39) + 'Ж' + chr(39) + ' || ' + chr(39) + '#$#' + chr(39) + ' || c_custkey')} AS joined FROM customer")
def f19(spark, base):
    return table(spark, base, "customer").select(
        "c_custkey", keys.uuid5(F.col("c_name")).alias("single"), keys.joined_key(F.lit("Ж"), F.col("c_custkey")).alias("joined"))


@query("f20_link_hash", "SELECT count(*) AS pairs, count(*) AS keys FROM (SELECT DISTINCT user_id, event_type FROM events)")
def f20(spark, base):
    """The hash values are the engine's own; as many keys as pairs is what counts."""
    pairs = table(spark, base, "events").select("user_id", "event_type").distinct()
    return pairs.agg(F.count("*").alias("pairs"), F.countDistinct(keys.link_hash(F.col("user_id"), F.col("event_type"))).alias("keys"))


@query("f21_age_day_part", """
SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped, day(age(l_shipdate + to_minutes(CAST(317 * l_linenumber AS INT)), o_orderdate + to_minutes(CAST(o_custkey % 1440 AS INT))))::BIGINT AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def f21(spark, base):
    joined = table(spark, base, "lineitem").join(table(spark, base, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    end = F.col("l_shipdate") + F.expr("make_dt_interval(0, 0, 317 * l_linenumber)")
    start = F.col("o_orderdate") + F.expr("make_dt_interval(0, 0, cast(o_custkey % 1440 as int))")
    return joined.select("l_orderkey", big("l_linenumber").alias("line"), "l_partkey", day_text("l_shipdate").alias("shipped"), time.age_day_part(end, start).alias("days"))


@query("f22_epoch", "SELECT event_id, strftime(make_timestamp((1700000000 + user_id * 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def f22(spark, base):
    return table(spark, base, "events").select("event_id", time_text(time.epoch_seconds(F.lit(1700000000) + F.col("user_id") * 3600)).alias("stamp"))
