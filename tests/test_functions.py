import datetime as dt
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martloom.functions import geo, keys, messages, numeric, text, time
from martloom.schemas import CAMPAIGN_MESSAGE


def test_uuid5_equals_the_standard_one(frame):
    names = ["1", "abc", "Пельмени", "id#$#name", ""]
    made = {r.n: r.k for r in frame([(n,) for n in names], "n string").select("n", keys.uuid5(F.col("n")).alias("k")).collect()}
    assert made == {n: str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names}


def test_joined_key_writes_missing_parts_out(frame):
    made = frame([("7", None)], "a string, b string").select(keys.joined_key(F.col("a"), F.col("b"))).first()[0]
    assert made == str(uuid.uuid5(uuid.NAMESPACE_DNS, "7#$#None"))


@pytest.mark.parametrize("end, start, days", [
    ("2024-02-29 00:00:00", "2024-01-31 00:00:00", 29),
    ("2024-03-05 00:00:00", "2024-01-31 00:00:00", 5),
    ("2024-03-05 10:00:00", "2024-03-04 12:00:00", 0),
    ("2024-03-04 10:00:00", "2024-02-04 12:00:00", 28),
    ("2024-01-31 00:00:00", "2024-03-05 00:00:00", -5),
    ("2024-05-01 00:00:00", "2024-05-01 00:00:00", 0),
])
def test_age_day_part(frame, end, start, days):
    df = frame([(end, start)], "e string, s string").select(F.col("e").cast("timestamp").alias("e"), F.col("s").cast("timestamp").alias("s"))
    assert df.select(time.age_day_part(F.col("e"), F.col("s"))).first()[0] == days


def test_span_days_counts_whole_days(frame):
    df = frame([(dt.datetime(2024, 3, 5, 11), dt.datetime(2024, 1, 31, 12))], "e timestamp, s timestamp")
    assert df.select(time.span_days(F.col("e"), F.col("s"))).first()[0] == 33


def test_day_range_is_half_open_and_pushed_down(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 23:59:59' AS ts UNION ALL SELECT timestamp_ntz'2024-01-02 00:00:00'")
    df.write.parquet(str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t")).filter(time.in_day(F.col("ts"), "2024-01-01"))
    assert kept.count() == 1
    assert "GreaterThanOrEqual(ts" in kept._jdf.queryExecution().toString()


def test_calendar(spark):
    days = time.calendar(spark, "2024-12-30", "2025-01-01")
    assert rows(days, "date_id", "week_of_year") == [(20241230, 1), (20241231, 1), (20250101, 1)]


def test_decimal_comma_and_place_name(frame):
    df = frame([("-33,8688", "  Sankt - Peterburg!")], "n string, p string")
    assert df.select(text.decimal_comma(F.col("n")), text.place_name(F.col("p"))).first() == (-33.8688, "sankt peterburg")


def test_distance_forms(frame):
    df = frame([(0.0, 0.0, 1.0, 0.0)], "a double, b double, c double, d double")
    at = [F.col(c) for c in "abcd"]
    true, literal = df.select(geo.distance_km(*at), geo.distance_km(*at, half_angle=False)).first()
    assert true == pytest.approx(111.19, abs=0.01)
    assert literal == pytest.approx(2 * true, rel=1e-3)


def test_tiered_pay_takes_the_floor(frame):
    df = frame([(1000.0, 3.9), (5000.0, 3.9), (1000.0, 4.0), (1000.0, 4.95)], "amount double, score double")
    pay = numeric.tiered_pay(F.col("amount"), F.col("score"), [(4, 0.05, 100.0), (4.9, 0.08, 175.0), (None, 0.1, 200.0)])
    assert [r[0] for r in df.select(pay).collect()] == [100.0, 250.0, 175.0, 200.0]


def test_ratio_of_zero_is_null(frame):
    assert frame([(7, 2), (7, 0)], "a long, b long").select(numeric.safe_ratio(F.col("a"), F.col("b"))).collect() == [(3.5,), (None,)]


def test_malformed_messages_are_kept_aside(frame):
    df = frame([('{"restaurant_id": 1}',), ("{broken",)], "value string")
    good, bad = messages.split_malformed(df, CAMPAIGN_MESSAGE)
    assert rows(good.select("event.restaurant_id")) == [(1,)]
    assert rows(bad) == [("{broken",)]
