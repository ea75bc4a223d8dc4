import datetime as dt
import json
import re
import uuid
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martloom.catalog import QUERIES
from martloom.functions.numeric import plain_number
from martloom.operators import vault as vaults
from martloom.operators.vault import VAULT_TABLES, append_unseen, distinct_vault_rows, message_lines, order_lines, order_vault, vault_rows, vault_table
from martloom.plans import couriers, customers, geography, groups, money, shipping
from martloom.schemas import ORDER_LINE_MESSAGE, ORDER_MESSAGE
from martloom.sources.queue import as_messages
from martloom.streaming import jobs, runs, state

T = dt.datetime
BASE, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_rfm_keeps_users_without_orders(frame):
    users = frame([(i,) for i in range(5)], "user_id long")
    orders = frame([(1, T(2022, 5, 1), 10.0, "Closed"), (2, T(2022, 6, 1), 30.0, "Closed"), (2, T(2022, 7, 1), 5.0, "Cancelled"),
                    (3, T(2021, 7, 1), 99.0, "Closed"), (4, T(2023, 1, 1), 20.0, "Closed")], "user_id long, order_ts timestamp_ntz, payment double, status string")
    assert rows(customers.rfm_segments(users, orders)) == [(0, 1, 1, 1), (1, 3, 3, 3), (2, 4, 4, 5), (3, 2, 2, 2), (4, 5, 5, 4)]
    assert {r[0] for r in rows(customers.rfm_segments(users, orders, strict=True))} == {1, 2, 4}


def test_one_status_per_order_when_times_tie(frame):
    orders = frame([(1, "x"), (2, "y")], "order_id long, note string")
    log = frame([(1, 4, T(2022, 1, 2)), (1, 5, T(2022, 1, 2)), (2, 3, T(2022, 1, 1))], "order_id long, status_id long, dttm timestamp_ntz")
    assert rows(customers.orders_with_status(orders, log), "order_id", "status") == [(1, 5), (2, 3)]


def test_retention_counts_customers_once(frame):
    week, other = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    sales = frame([(week, 1, 10, "shipped", 5.0), (week, 1, 11, "shipped", 7.0), (week, 1, 11, "shipped", 8.0), (week, 1, 12, "refunded", 3.0), (other, 1, 10, "refunded", 4.0)],
                  "week date, item_id long, customer_id long, status string, payment_amount double")
    mart = customers.weekly_retention(sales)
    assert rows(mart, "period_start", "new_customers_count", "returning_customers_count", "refunded_customer_count", "new_customers_revenue", "returning_customers_revenue", "customers_refunded") == [
        (week, 1, 1, 1, 5.0, 15.0, 3.0), (other, 0, 0, 1, None, None, 4.0)]


LOG = "shippingid long, vendorid long, payment_amount decimal(14,2), shipping_plan_datetime timestamp_ntz, shipping_country string, shipping_country_base_rate decimal(14,3), vendor_agreement_description string, shipping_transfer_description string, shipping_transfer_rate decimal(14,3), status string, state string, state_datetime timestamp_ntz"


def shipping_log(frame):
    common = ("norway", Decimal("0.040"), "0:vspn-1:1.0:0.02", "1p:train", Decimal("0.020"))
    def state(ship, status, name, at):
        return (ship, 1, Decimal("100.00"), T(2022, 4, 1), *common, status, name, at)
    return frame([state(1, "in_progress", "booked", T(2022, 1, 31)), state(1, "finished", "recieved", T(2022, 3, 5)),
                  state(2, "in_progress", "booked", T(2022, 1, 1)), state(2, "in_progress", "pending", T(2022, 1, 1))], LOG)


def test_shipping_mart_and_its_stored_form_agree(frame):
    log = shipping_log(frame)
    direct = shipping.shipping_datamart(log)
    assert [r.asDict() for r in direct.orderBy("shipping_id").collect()] == [
        {"shipping_id": 1, "vendor_id": 1, "transfer_type": "1p", "full_day_at_shipping": 33, "is_delay": 1, "is_shipping_finish": 1, "delay_day_at_shipping": 5,
         "payment_amount": Decimal("100.00"), "vat": Decimal("106.00000"), "profit": Decimal("2.0000")},
        {"shipping_id": 2, "vendor_id": 1, "transfer_type": "1p", "full_day_at_shipping": 0, "is_delay": 0, "is_shipping_finish": 0, "delay_day_at_shipping": 0,
         "payment_amount": Decimal("100.00"), "vat": Decimal("106.00000"), "profit": Decimal("2.0000")}]
    rates, agreed, kinds = shipping.country_rates(log), shipping.agreements(log), shipping.transfers(log)
    info = shipping.shipping_info(log, rates, agreed, kinds)
    assert rows(shipping.datamart_from_tables(info, shipping.shipping_status(log), rates, agreed, kinds)) == rows(direct)
    assert rows(shipping.shipping_datamart(log, plan_based=True), "shipping_id", "is_delay") == [(1, 0), (2, 0)]


def test_shipping_status_has_one_row_when_times_tie(frame):
    assert rows(shipping.shipping_status(shipping_log(frame)), "shipping_id", "state") == [(1, "recieved"), (2, "pending")]


def test_courier_tiers_floors_and_months(frame):
    def order(courier, month, rate, amount):
        return (courier, f"c{courier}", T(2023, month, 5), Decimal(rate), Decimal(amount), Decimal("10"))
    df = frame([order(1, 1, "3.9", "1000"), order(1, 1, "3.9", "3000"), order(1, 2, "4.0", "1000"), order(2, 1, "4.5", "10000"), order(3, 1, "4.9", "1000")],
               "courier_id long, courier_name string, order_ts timestamp_ntz, rate decimal(4,2), sum decimal(14,2), tip_sum decimal(14,2)")
    mart = couriers.courier_ledger(df)
    assert rows(mart, "courier_id", "settlement_month", "orders_count", "courier_order_sum", "order_processing_fee", "courier_reward_sum") == [
        (1, 1, 2, 250.0, 1000.0, 269.0), (1, 2, 1, 150.0, 250.0, 159.5), (2, 1, 1, 800.0, 2500.0, 809.5), (3, 1, 1, 200.0, 250.0, 209.5)]


def test_group_conversion(frame):
    members = frame([(1, 1), (1, 2), (2, 3), (1, 1)], "group_id long, user_id long")
    history = frame([(1, 1, "add"), (1, 1, "add"), (1, 2, "add"), (2, 3, "add"), (2, 4, "leave")], "group_id long, user_id long, event string")
    registered = frame([(1, T(2020, 1, 1)), (2, T(2020, 1, 2)), (3, T(2020, 1, 3))], "group_id long, registration_dt timestamp_ntz")
    mart = groups.group_conversion(members, frame([(1,)], "user_id long"), history, registered, n=2)
    assert [tuple(r) for r in mart.select("group_id", "cnt_added_users", "group_conversion").collect()] == [(1, 2, 0.5), (2, 1, None)]


PLACES = [(1, "Sydney", -33.865, 151.2094), (2, "Melbourne", -37.8136, 144.9631)]


def test_travel_comes_home(frame):
    places = frame(PLACES, "id long, city string, lat double, lng double")
    at = {"S": (-33.9, 151.2), "M": (-37.8, 145.0)}
    walk = [("S", T(2024, 1, 1, 9)), ("S", T(2024, 1, 1, 10)), ("S", T(2024, 1, 2)), ("M", T(2024, 1, 3)), ("S", T(2024, 1, 4))]
    messages = frame([(7, ts, i, *at[c]) for i, (c, ts) in enumerate(walk)], "user_id long, ts timestamp_ntz, event_id long, lat double, lon double")
    users, lists = geography.user_travel(messages, places, 27)
    row = users.first()
    assert (row.act_city, row.travel_count, row.home_city) == ("Sydney", 3, "Sydney")
    assert lists.first().travel_array == ["Sydney", "Melbourne", "Sydney"]
    assert row.local_time == T(2024, 1, 4, 11)
    users, pages = geography.user_travel(messages, places, 27, page_elements=2)
    assert users.count() == 1 and rows(pages.select("page", F.size("travel_array"))) == [(0, 2), (1, 1)]


def test_friends_are_near_strangers_with_a_shared_channel(frame):
    places = frame(PLACES, "id long, city string, lat double, lng double")
    spot = {1: (-33.9, 151.2), 2: (-33.9, 151.201), 3: (-33.9, 151.202), 4: (-33.9, 151.203), 5: (-33.95, 151.2), 6: (-33.9, 151.2)}
    sent = [(1, 3), (4, 1), (2, 99), (3, 99), (5, 99), (6, 99)]
    messages = frame([(i, u, to, T(2024, 1, 2), *spot[u]) for i, (u, to) in enumerate(sent)] + [(50, 2, 99, T(2024, 1, 1), -37.8, 145.0)],
                     "event_id long, user_id long, message_to long, ts timestamp_ntz, lat double, lon double")
    subscriptions = frame([(u, 5) for u in (1, 2, 3, 4, 5)] + [(6, 8)], "user_id long, channel long")
    found = geography.friend_suggestions(messages, subscriptions, places)
    pairs = {(a, b) for a, b, zone in rows(found)}
    assert pairs == {(1, 2), (2, 1), (2, 3), (3, 2), (2, 4), (4, 2), (3, 4), (4, 3)}
    assert {zone for *_, zone in rows(found)} == {1}


def test_zone_activity_splits_weeks_and_months(frame):
    places = frame(PLACES, "id long, city string, lat double, lng double")
    events = frame([(1, "message", 1, T(2024, 1, 30), -33.9, 151.2), (2, "message", 1, T(2024, 1, 10), -33.9, 151.2), (3, "reaction", 2, T(2024, 1, 30), -33.9, 151.2),
                    (4, "message", 2, T(2024, 2, 1), -37.8, 145.0), (5, "subscription", 3, T(2024, 1, 30), None, 145.0)],
                   "event_id long, event_type string, user_id long, ts timestamp_ntz, lat double, lon double")
    mart = geography.zone_activity(events, places).select(F.date_format("month", "MM").alias("m"), F.date_format("week", "MM-dd").alias("w"), "zone_id", "week_message", "week_user", "month_message", "month_user", "month_subscription")
    assert rows(mart) == [("01", "01-08", 1, 1, 1, 2, 1, 0), ("01", "01-29", 1, 1, 0, 2, 1, 0), ("01", "01-29", None, 0, 0, 0, 0, 1), ("02", "01-29", 2, 1, 1, 1, 1, 0)]


def test_currency_metrics(frame):
    def move(frm, to, code, status, kind, amount, hour):
        return (frm, to, code, status, kind, float(amount), T(2022, 10, 1, hour))
    df = frame([move(1, 2, 420, "done", "sbp_incoming", -100, 1), move(1, 2, 430, "done", "sbp_incoming", 50, 2), move(1, 2, 430, "done", "sbp_outgoing", 50, 23),
                move(3, -1, 430, "done", "sbp_outgoing", 10, 3), move(-1, 3, 430, "done", "sbp_outgoing", 10, 3), move(4, 5, 430, "queued", "sbp_outgoing", 10, 3),
                move(4, 5, 430, "done", "authorisation", 10, 3), move(4, 5, 440, "done", "sbp_outgoing", 10, 3)],
               "account_number_from long, account_number_to long, currency_code long, status string, transaction_type string, amount double, transaction_dt timestamp_ntz")
    day = dt.date(2022, 10, 1)
    rates = frame([(day, 430, 2.0), (day, 420, 9.0)], "day date, currency_code long, rate double")
    both = money.currency_metrics(df, rates, "2022-10-01", "2022-10-01")
    assert rows(both) == [(day, 420, 100.0, 1, 1.0, 1), (day, 430, 200.0, 2, 2.0, 1)]
    raw = frame([(T(2022, 10, 1), 430, 420, 2.0), (T(2022, 10, 1), 430, 440, 7.0)],
                "date_update timestamp_ntz, currency_code long, currency_code_with long, currency_with_div double")
    assert rows(money.currency_metrics(df, raw)) == rows(both)
    one = money.currency_metrics(df, rates, "2022-10-01", "2022-10-01", both_sides=False)
    assert rows(one) == [(day, 420, 100.0, 1, 1.0, 1), (day, 430, 220.0, 3, 1.5, 2)]


def order_message(order, date, status, products, user="Олег"):
    return json.dumps({"payload": {"id": order, "date": date, "status": status, "cost": 300.5, "payment": 300.5, "user": {"id": "u1", "name": user, "login": "oleg"},
                                   "restaurant": {"id": "r1", "name": "Кафе"}, "products": [{"id": p, "name": n, "category": c} for p, n, c in products]}}, ensure_ascii=False)


def messages_frame(frame, *bodies):
    df = frame([(b,) for b in bodies], "value string")
    return df.select(F.from_json("value", ORDER_MESSAGE).alias("m")).select("m.payload")


def test_vault_of_a_repeated_order(frame):
    soup, tea = ("p1", "Борщ", "Супы"), ("p2", "Окрошка", "Супы")
    messages = messages_frame(frame, order_message("7", "2024-01-01T10:00:00", "OPEN", [soup, tea]), order_message("7", "2024-01-01T11:00:00", "CLOSED", [soup, tea]))
    vault = order_vault(messages, F.lit("2024-01-02").cast("timestamp"))
    counts = {name: table.count() for name, table in vault.items()}
    assert counts["h_order"] == 1 and counts["h_product"] == 2 and counts["h_category"] == 1
    assert counts["s_order_status"] == 2 and counts["l_order_product"] == 2 and counts["l_product_category"] == 2
    key = lambda s: str(uuid.uuid5(uuid.NAMESPACE_DNS, s))
    assert rows(vault["h_user"], "h_user_pk", "user_id") == [(key("u1"), "u1")]
    assert rows(vault["s_user_names"], "hk_user_names_hashdiff") == [(key("u1#$#Олег#$#oleg"),)]
    assert rows(vault["l_order_user"], "hk_order_user_pk") == [(key("7#$#u1"),)]
    assert append_unseen(vault["h_product"], vault["h_product"], "h_product_pk").count() == 0
    assert order_lines(vault).count() == 2
    assert rows(message_lines(messages), "productname", "status") == [("Борщ", "CLOSED"), ("Окрошка", "CLOSED")]


def test_one_pass_gives_the_tables_built_apart(frame):
    """Also for an order without products, a missing user and a product without a name."""
    odd = json.loads(order_message("8", "2024-01-03T00:00:00", "OPEN", []))
    lone = json.loads(order_message("9", "2024-01-03T00:00:00", "OPEN", [("p1", None, "Супы"), ("p1", None, "Супы")]))
    lone["payload"]["user"]["id"] = None
    messages = messages_frame(frame, json.dumps(odd), json.dumps(lone), order_message("7", "2024-01-01T10:00:00", "OPEN", [("p1", "Борщ", "Супы")]))
    moment = F.lit("2024-01-02").cast("timestamp")
    typed = vault_rows(messages, moment).dropDuplicates(["table", "key"])
    for name, built in order_vault(messages, moment).items():
        assert rows(vault_table(typed, name)) == rows(built), name


def test_vault_rows_move_with_short_keys(frame):
    """Hashes, longer than what they are made of, appear only in the tables that are read."""
    messages = messages_frame(frame, order_message("7", "2024-01-01T10:00:00", "OPEN", [("p1", "Борщ", "Супы")]))
    moved = vault_rows(messages, F.lit("2024-01-02").cast("timestamp"))
    keys = dict(rows(moved, "table", "key"))
    assert keys["h_order"] == "7" and keys["l_order_product"] == "7#$#p1" and keys["s_order_status"] == "7#$#OPEN"
    plain = {name: vault_table(moved, name, plain=True) for name in VAULT_TABLES}
    hashed = {name: vault_table(moved, name) for name in VAULT_TABLES}
    assert rows(order_lines(plain, plain=True)) == rows(order_lines(hashed)) != []


def test_distinct_vault_rows_are_the_rows_once(frame):
    """Also where a key has no owner, or can be taken apart in two ways; each business key is shuffled once for a side."""
    twins = [json.loads(order_message(*given)) for given in
             [("x#$", "2024-01-01T10:00:00", "OPEN", [("y", "a", "k"), ("y", "b", "k"), ("y", "a", "k")]), ("x", "2024-01-01T10:00:00", "OPEN", [("$#$#y", "a", "k")]),
              ("None", "2024-01-03T00:00:00", "OPEN", [("p", None, None)]), (None, "2024-01-03T00:00:00", "OPEN", [("p", None, None)]), ("8", "2024-01-03T00:00:00", "OPEN", [])]]
    twins[2]["payload"]["user"]["id"] = None
    messages = messages_frame(frame, *[json.dumps(t) for t in [*twins, *twins]], "{}")
    moment = F.lit("2024-01-02").cast("timestamp")
    made, once = distinct_vault_rows(messages, 7, moment), vault_rows(messages, moment).dropDuplicates(["table", "key"])
    assert made.schema.simpleString() == once.schema.simpleString() and rows(made, "table", "key") == rows(once, "table", "key")
    assert set(rows(made)) <= set(rows(vault_rows(messages, moment)))
    dealt = re.findall(r"hashpartitioning\(.*, 7\)", made._jdf.queryExecution().executedPlan().toString())
    assert len(set(dealt)) == 6  # orders, users, restaurants; orders, products, categories of lines


def test_rows_on_their_way_to_the_state_are_short(spark, frame, tmp_path):
    """Values that a key spells out do not travel beside it, nor the stamp; all come back, whatever the parts of a key hold."""
    odd = json.loads(order_message("8#$#", "2024-01-03T00:00:00", "#$", [("p1", None, ""), ("", "None", "x#")]))
    odd["payload"]["user"]["id"] = None
    messages = messages_frame(frame, json.dumps(odd), order_message("7", "2024-01-01T10:00:00", "OPEN", [("p1", "Борщ", "Супы")]))
    whole = vault_rows(messages, F.lit("2024-01-02").cast("timestamp"))
    short = vaults._short(whole)
    assert rows(vaults._long(short)) == rows(whole.drop("load_dt", "load_src"))
    held = {r["table"]: r for r in short.collect() if r["key"].startswith("7")}
    assert held["l_order_product"][2:] == (True, None, None, None) and held["h_order"]["second"] is not None
    frame([(order_message("7", "2024-01-01T10:00:00", "OPEN", [("p1", "a", "b")]),)], "value string").write.parquet(str(tmp_path / "topic"))
    stream = jobs.vault_stream(spark.readStream.schema("value string").parquet(str(tmp_path / "topic")))
    kept = stream._jdf.queryExecution().analyzed().toString().split("Deduplicate")
    assert "load_src" in kept[0] and "spelt" in kept[1] and "load_src" not in kept[1]


def test_order_lines_leave_no_shuffle_files(spark):
    """What the messages and the vault were made from is gone when they are read: no shuffle files are left behind."""
    def shuffled():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in Path(d).glob("*/shuffle_*.data")}
    before = shuffled()
    QUERIES["v04_order_lines"](spark, SMALL)
    assert shuffled() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_campaigns_running_at_a_moment(frame):
    def campaign(i, start, end):
        return (i, T.fromisoformat(start), T.fromisoformat(end))
    df = frame([campaign(1, "2024-01-02", "2024-01-03"), campaign(2, "2024-01-01", "2024-01-01"), campaign(3, "2023-01-01", "2023-12-31"), campaign(4, "2023-12-01", "2024-02-01")],
               "restaurant_id long, adv_campaign_datetime_start timestamp, adv_campaign_datetime_end timestamp")
    moment = F.lit("2024-01-01").cast("timestamp")
    running = jobs.active_campaigns(df, moment)
    assert rows(running, "restaurant_id") == [(2,), (4,)]
    sent = jobs.notifications(running, frame([(2, "a"), (2, "b"), (9, "c")], "restaurant_id long, client_id string"), moment)
    assert rows(sent, "restaurant_id", "client_id", "feedback") == [(2, "a", None), (2, "b", None)]


def test_notifications_meet_pages_of_subscribers(spark, frame, monkeypatch):
    """Whatever the pages, and repeated or lone rows kept; messages are those made of the rows."""
    monkeypatch.setattr(jobs, "PAGE_SUBSCRIBERS", 3)
    moment = F.lit("2024-01-01").cast("timestamp")
    campaigns = frame([(1, "a \"{x}\"", None), (1, "b", T(2024, 1, 1)), (2, None, None), (None, "n", None), (7, "lone", None)],
                      "restaurant_id long, content string, starts timestamp")
    subscribers = frame([(1, f"c{i % 9}") for i in range(20)] + [(2, None), (2, "}"), (None, "x"), (8, "lone")], "restaurant_id long, client_id string")
    plain = campaigns.join(subscribers, "restaurant_id").withColumn("trigger_datetime_created", moment)
    made = jobs.notifications(campaigns, subscribers, moment)
    assert made.columns == [*plain.columns, "feedback"] and rows(made.drop("feedback")) == rows(plain)
    assert "Generate" in made._jdf.queryExecution().optimizedPlan().toString()
    assert rows(jobs.notification_messages(campaigns, subscribers, moment)) == rows(as_messages(plain))


def test_notifications_of_one_restaurant_are_dealt_out(spark, frame, monkeypatch):
    """One restaurant has nearly all rows, its subscribers and campaigns are copies: no task makes more than a few cells."""
    for name, value in {"PAGE_SUBSCRIBERS": 10, "BLOCK_CAMPAIGNS": 10, "TASK_ROWS": 500}.items():
        monkeypatch.setattr(jobs, name, value)
    monkeypatch.setattr(jobs, "broadcast_if_bounded", lambda df: df)
    campaigns = frame([(1, "same")] * 100 + [(2, "other"), (3, "lone"), (None, "none")], "restaurant_id long, content string")
    subscribers = frame([(1, "copy")] * 199 + [(1, None), (2, "a"), (2, "a"), (4, "lone"), (None, "x")], "restaurant_id long, client_id string")
    made = jobs.notifications(campaigns, subscribers, F.lit("2024-01-01").cast("timestamp"))
    assert rows(made.groupBy("restaurant_id", "content", "client_id").count()) == [(1, "same", "copy", 19_900), (1, "same", None, 100), (2, "other", "a", 2)]
    by_task = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) > 20 and max(by_task) < 4_000
    assert rows(jobs.notifications(campaigns.limit(0), subscribers)) == [] == rows(jobs.notifications(campaigns, subscribers.limit(0)))


@pytest.mark.parametrize("turned", [False, True])
def test_vault_stream_over_several_batches(spark, frame, tmp_path, turned):
    """An order sent twice, with products of its own each time, equals the batch form in either order of arrival."""
    first = [order_message("o1", "2024-01-01 10:00:00", "CLOSED", [("p1", "Чай", "напитки"), ("p2", "Суп", "супы")]),
             order_message("o2", "2024-01-01 11:00:00", "OPEN", [("p1", "Чай", "напитки")])]
    second = [order_message("o1", "2024-01-01 10:00:00", "CLOSED", [("p1", "Чай", "напитки"), ("p3", "Сок", "напитки")]),
              order_message("o2", "2024-01-01 11:00:00", "CLOSED", [("p1", "Чай", "напитки")])]
    source, topic = (str(tmp_path / name) for name in ("source", "topic"))
    vault, keys = jobs.vault_store(spark, str(tmp_path / "vault")), ["category_name"]
    counters = state.FoldedTable(spark, str(tmp_path / "counters"), keys, "sum")
    for turn, bodies in enumerate([second, first] if turned else [first, second]):
        frame([(b,) for b in bodies], "value string").coalesce(1).write.mode("append").parquet(source)
        arriving = jobs.vault_stream(spark.readStream.schema("value string").parquet(source))
        runs.start(arriving, jobs.vault_batch(vault, topic), str(tmp_path / "c1"), None).awaitTermination()
        sent = spark.readStream.schema("value string").parquet(f"{topic}/batch_id=*").select(F.from_json("value", ORDER_LINE_MESSAGE).alias("l")).select("l.*")
        runs.start(jobs.counted_lines(sent), jobs.counter_batch(counters, keys), str(tmp_path / "c2"), None).awaitTermination()
    whole = order_vault(messages_frame(frame, *first, *second))
    for name, rows_ in whole.items():
        loaded = vault_table(vault.read(), name)
        assert loaded.columns == rows_.columns and loaded.drop("load_dt").dtypes == rows_.drop("load_dt").dtypes
        kept = [c for c in rows_.columns if c != "load_dt"]
        assert rows(loaded, *kept) == rows(rows_, *kept), name
    counts = counters.read()
    # o1: two drinks and a soup; o2: one drink, once it is closed
    assert rows(counts) == [("напитки", 3), ("супы", 1)]
    lines = spark.read.json(spark.read.parquet(topic).filter("batch_id = 1").rdd.map(lambda r: r.value))
    assert lines.select("h_order_pk", "h_product_pk").distinct().count() == 4


def test_numbers_in_hashes_are_plain_text(frame):
    values = frame([(1.0e7,), (300.5,), (300.0,), (0.0,), (0.25,), (None,)], "v double")
    assert [r[0] for r in values.select(plain_number(F.col("v"))).collect()] == ["10000000", "300.5", "300", "0", "0.25", None]


@pytest.mark.parametrize("key", ["v02_sat_order_cost", "v03_link_order_product", "v03_link_product_restaurant", "m06_shipping_datamart",
                                 "m06_shipping_datamart_planned"])
def test_pieces_of_a_query_follow_its_input(spark, monkeypatch, key):
    """Every shuffle of a large table has as many parts as the input has pieces, whatever the session's number; a key's text is hashed once."""
    monkeypatch.setattr("martloom.catalog.standins.pieces_of", lambda *inputs: 40)
    plan = QUERIES[key](spark, BASE)._jdf.queryExecution()
    parts = re.findall(r"hashpartitioning\(.*, (\d+)\)", plan.executedPlan().toString())
    assert parts and set(parts) == {"40"}
    hashes = {"v02_sat_order_cost": 2, "v03_link_order_product": 3, "v03_link_product_restaurant": 3}
    assert plan.optimizedPlan().toString().count("sha1(") == hashes.get(key, 0)
