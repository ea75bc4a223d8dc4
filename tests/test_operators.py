import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators import aggregates, checks, geo, increments, joins, ordering, sets, windows
from martloom.sizing import broadcast_if_bounded, rows_if_bounded, spread_if_small


def hot_frame(spark, n=600):
    """A third of the rows belong to one key, another third share one value."""
    made = [(i, 0 if i % 3 == 0 else i % 7, 5 if i % 3 == 1 else i * 37 % 101, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 5 % 997)) for i in range(n)]
    return spark.createDataFrame(made, "id long, key long, value long, ts timestamp_ntz")


@pytest.mark.parametrize("tiles", [1, 3, 5, 7, 1000])
def test_global_ntile_equals_the_window(spark, tiles):
    df = hot_frame(spark)
    ours = ordering.global_ntile(df, tiles, [F.col("value"), F.col("id")], "tile").select("id", "tile")
    theirs = df.select("id", F.ntile(tiles).over(Window.orderBy("value", "id")).cast("bigint").alias("tile"))
    assert rows(ours) == rows(theirs)


def test_global_row_number_and_running_totals(spark):
    df = hot_frame(spark)
    order = Window.orderBy("value", "id")
    numbered = ordering.global_row_number(df, [F.col("value"), F.col("id")], "n").select("id", "n")
    assert rows(numbered) == rows(df.select("id", F.row_number().over(order).cast("bigint")))
    totals = ordering.running_totals(df, [F.col("value"), F.col("id")], {"t": F.col("value")}).select("id", "t")
    assert rows(totals) == rows(df.select("id", F.sum("value").over(order)))


def test_order_helpers_accept_empty_frames(spark):
    empty = hot_frame(spark).filter("id < 0")
    assert ordering.global_ntile(empty, 5, [F.col("id")]).count() == 0
    assert ordering.exact_quantiles(empty, "value", [0.5]).count() == 0


def test_exact_quantiles_equal_numpy(spark):
    df = hot_frame(spark)
    values = [r.value for r in df.collect()]
    shares = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    ours = {r.share: r.quantile for r in ordering.exact_quantiles(df, "value", shares).collect()}
    assert ours == pytest.approx({s: float(np.quantile(values, s)) for s in shares})


def test_lag_and_numbers_by_slices_equal_the_window(spark):
    df = hot_frame(spark)
    order = Window.partitionBy("key").orderBy("ts", "id")
    lagged = windows.lag_in_slices(df, ["key"], ["ts", "id"], "value", F.to_date("ts"))
    assert rows(lagged, "id", "previous") == rows(df.select("id", F.lag("value").over(order)))
    numbered = windows.number_in_slices(df, ["key"], ["ts", "id"], F.to_date("ts"))
    assert rows(numbered, "id", "number") == rows(df.select("id", F.row_number().over(order).cast("bigint")))


@pytest.mark.parametrize("parts", [1, 3, 20, None])
def test_slices_do_not_change_the_result(spark, parts):
    df = hot_frame(spark)
    sliced = windows.order_slices(df, ["key"], ["ts", "id"], parts=parts)
    order = Window.partitionBy("key").orderBy("ts", "id")
    lagged = windows.lag_in_slices(sliced, ["key"], ["ts", "id"], "value", F.col("_slice"))
    assert rows(lagged, "id", "previous") == rows(df.select("id", F.lag("value").over(order)))


def test_equal_times_of_one_key_are_spread(spark):
    df = spark.range(1000).select(F.lit(1).alias("key"), F.lit(0).alias("ts"), "id")
    sizes = [r[1] for r in windows.order_slices(df, ["key"], ["ts", "id"], parts=8).groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 300


def test_equal_facts_of_a_hot_key_are_spread(spark):
    """A key with a third of identical one-column rows; its rows come from several input partitions."""
    facts = spark.range(0, 3000, 1, 30).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"))
    lookup = spark.range(3000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    joined = joins.salted_join(facts, lookup, ["key"], piece_rows=100).cache()
    assert rows(joined) == rows(facts.join(lookup, "key"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    pieces = facts.withColumn("p", F.pmod(F.xxhash64("key", F.spark_partition_id()), F.lit(10))).filter("key = 0").groupBy("p").count()
    assert pieces.count() >= 8 and pieces.agg(F.max("count")).first()[0] < 400
    nulls = facts.select(F.when(F.col("key") > 5, F.col("key")).alias("key"))
    assert rows(joins.salted_join(nulls, lookup, ["key"], "left", 100)) == rows(nulls.join(lookup, "key", "left"))


def test_latest_row_breaks_ties_by_the_last_key(frame):
    log = frame([(1, 10, "a"), (1, 10, "b"), (2, 5, "c")], "id long, ts long, s string")
    assert rows(windows.latest_per_key(log, ["id"], ["ts", "s"])) == [(1, 10, "b"), (2, 5, "c")]
    assert rows(windows.first_per_key(log, ["id"], ["ts", "s"])) == [(1, 10, "a"), (2, 5, "c")]


def test_rank_by_day_counts_ties(frame):
    df = frame([("u", "d1"), ("u", "d1"), ("u", "d2"), ("u", "d3")], "u string, d string")
    assert rows(windows.rank_by_day(df, ["u"], "d"), "d", "rank") == [("d1", 1), ("d2", 3), ("d3", 4)]


def test_islands_survive_repeated_days_and_other_cities(frame):
    day = lambda n: dt.date(2024, 1, n)
    df = frame([("u", "A", day(1)), ("u", "A", day(1)), ("u", "A", day(2)), ("u", "B", day(2)), ("u", "A", day(3)), ("u", "A", day(7)), ("u", "B", day(8))],
               "u string, city string, day date")
    islands = windows.day_islands(df, ["u", "city"], "day")
    assert rows(islands) == [("u", "A", day(1), day(3)), ("u", "A", day(7), day(7)), ("u", "B", day(2), day(2)), ("u", "B", day(8), day(8))]
    assert rows(windows.best_island(islands, ["u"], "city", 27)) == [("u", "A")]
    assert rows(windows.best_island(islands, ["u"], "city", 0)) == [("u", "B")]


def test_lists_come_in_pages_without_loss(spark):
    df = hot_frame(spark)
    pages = aggregates.ordered_lists(df, ["key"], ["ts", "id"], "id", F.to_date("ts"), "ids", page_elements=50).collect()
    assert max(len(p.ids) for p in pages) == 50
    for key in {p.key for p in pages}:
        joined = [i for p in sorted((p for p in pages if p.key == key), key=lambda p: p.page) for i in p.ids]
        assert joined == [r.id for r in df.filter(F.col("key") == key).orderBy("ts", "id").collect()]


def test_nested_pages_split_only_large_keys(spark):
    pages = aggregates.nested_pages(hot_frame(spark), ["key"], F.col("id"), "ids", page_elements=150).collect()
    assert {p.key for p in pages if p.page > 0} == {0}
    assert sorted(i for p in pages for i in p.ids) == list(range(600))


def test_not_in_follows_null_rules(frame):
    df = frame([(1,), (2,), (None,)], "k long")
    assert rows(joins.not_in(df, "k", frame([(1,)], "x long"), "x")) == [(2,)]
    assert rows(joins.not_in(df, "k", frame([(1,), (None,)], "x long"), "x")) == []
    assert rows(joins.not_in(df, "k", frame([], "x long"), "x")) == [(1,), (2,), (None,)]


def test_not_in_is_not_forced_into_a_broadcast(spark, frame):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.not_in(frame([(1,)], "k long"), "k", frame([(2,)], "x long"), "x")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in plan


def test_lookup_join_is_the_same_within_and_beyond_its_bound(spark):
    facts = hot_frame(spark)
    lookup = spark.createDataFrame([(k, f"name {k}") for k in range(5)], "key long, name string")
    for how in ("inner", "left"):
        small, large = joins.lookup_join(facts, lookup, ["key"], how), joins.lookup_join(facts, lookup, ["key"], how, bound=2)
        assert rows(small, "id", "name") == rows(large, "id", "name")
        assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()


def test_pairs_and_edges(frame):
    df = frame([(1, "z"), (2, "z"), (3, "y"), (2, "y")], "u long, k string")
    assert rows(joins.pairs_sharing(df, ["k"], "u")) == [(1, 2), (2, 1), (2, 3), (3, 2)]
    assert rows(joins.partner_counts(df, ["k"], "u"), "k", "u", "partners") == [("y", 2, 1), ("y", 3, 1), ("z", 1, 1), ("z", 2, 1)]
    edges = frame([(1, 2), (2, 1), (3, 3)], "a long, b long")
    assert rows(sets.symmetric_edges(edges, "a", "b")) == [(1, 2), (2, 1), (3, 3)]


def brute_distance(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 12742.0 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("centre, spread, radius", [((-33.0, 151.0), 0.2, 5.0), ((89.9, 0.0), 0.1, 8.0), ((10.0, 179.95), 0.1, 4.0), ((0.0, 0.0), 60.0, 900.0)])
def test_within_distance_equals_brute_force(spark, centre, spread, radius):
    draw = random.Random(7)
    wrap = lambda lng: (lng + 180.0) % 360.0 - 180.0
    points = [(i, max(-90.0, min(90.0, centre[0] + draw.uniform(-spread, spread))), wrap(centre[1] + draw.uniform(-spread, spread) * (1800 if centre[0] > 80 else 1))) for i in range(120)]
    left = spark.createDataFrame(points, "a long, lat1 double, lng1 double")
    right = spark.createDataFrame(points, "b long, lat2 double, lng2 double")
    found = geo.within_distance(left, right, radius, ("lat1", "lng1"), ("lat2", "lng2")).select("a", "b")
    expected = sorted((p[0], q[0]) for p in points for q in points if brute_distance(p[1:], q[1:]) <= radius)
    assert sorted((r.a, r.b) for r in found.collect()) == expected


def crowded(seed=3, n=900):
    """A third of the points at one spot, a third in one cell, the rest around it."""
    draw = random.Random(seed)
    at = [(10.0, 20.0)] * (n // 3) + [(10.0 + draw.uniform(0, 0.004), 20.0 + draw.uniform(0, 0.004)) for _ in range(n // 3)]
    at += [(10.0 + draw.uniform(-0.03, 0.03), 20.0 + draw.uniform(-0.03, 0.03)) for _ in range(n - len(at))]
    return [(i, lat, lng, i % 2) for i, (lat, lng) in enumerate(at)]


@pytest.mark.parametrize("tile_rows", [20, 10_000])
def test_crowded_cells_are_split_and_lose_nothing(spark, tile_rows):
    points = crowded()
    left = spark.createDataFrame(points, "a long, lat1 double, lng1 double, k int")
    right = spark.createDataFrame(points, "b long, lat2 double, lng2 double, k int")
    at = ("lat1", "lng1"), ("lat2", "lng2")
    expected = sorted((p[0], q[0]) for p in points for q in points if p[3] == q[3] and brute_distance(p[1:], q[1:]) <= 1.0)
    found = geo.within_distance(left, right, 1.0, *at, on=["k"], tile_rows=tile_rows)
    assert sorted((r.a, r.b) for r in found.collect()) == expected  # each pair once
    once = geo.within_distance(left, right, 1.0, *at, on=["k"], once=("a", "b"), tile_rows=tile_rows)
    assert sorted(tuple(sorted((r.a, r.b))) for r in once.collect()) == [p for p in expected if p[0] < p[1]]
    for side in geo.tiled(left, right, 1.0, *at, ["k"], None, tile_rows):
        keys = [c for c in ("k", "_cell", "_tile") if c in side.columns]
        assert side.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 1.6 * tile_rows


def test_parts_out_of_reach_are_left_out(spark):
    """The left copies of a crowded cell go to the parts they may reach, not to all."""
    points = crowded(n=3_000)
    left = spark.createDataFrame(points, "a long, lat1 double, lng1 double, k int")
    right = spark.createDataFrame(points, "b long, lat2 double, lng2 double, k int")
    near, placed = geo.tiled(left, right, 1.0, ("lat1", "lng1"), ("lat2", "lng2"), [], None, 50)
    tested = near.groupBy("_cell", "_tile").count().join(placed.groupBy("_cell", "_tile").count().withColumnRenamed("count", "other"), ["_cell", "_tile"])
    pairs = tested.agg(F.sum(F.col("count") * F.col("other"))).first()[0]
    whole, cells = geo.tiled(left, right, 1.0, ("lat1", "lng1"), ("lat2", "lng2"), [], None, 10 ** 6)
    assert pairs < 0.95 * whole.join(cells, "_cell").count()


def test_pairs_of_a_hot_key_are_formed_in_tiles(spark):
    rows_ = [(u, 0) for u in range(300)] + [(u, u % 40) for u in range(300)]
    df = spark.createDataFrame(rows_, "u long, k long").distinct()
    held = {}
    for u, k in {*rows_}:
        held.setdefault(k, set()).add(u)
    expected = sorted({(a, b) for us in held.values() for a in us for b in us if a != b})
    for tile_rows in (16, 100, 4_096):
        assert [tuple(r) for r in joins.pairs_sharing(df, ["k"], "u", tile_rows=tile_rows).sort("left", "right").collect()] == expected
        for side in joins.pair_tiles(df, ["k"], "u", tile_rows):
            assert side.groupBy("k", "_tile").count().agg(F.max("count")).first()[0] <= 2 * tile_rows


def test_nearest_place_rules(spark, frame):
    places = frame([(2, 0.0, 10.0), (1, 0.0, -10.0), (3, 50.0, 50.0)], "id long, lat double, lng double")
    points = frame([(1, 0.0, 0.0), (2, None, 5.0), (3, 49.0, 50.0), (4, 0.0, 9.0)], "event_id long, lat double, lon double")
    expected = [(1, 1), (2, None), (3, 3), (4, 2)]  # a tie goes to the lowest id, zero is a place, null is none
    assert rows(geo.nearest_place(points, places, "event_id"), "event_id", "zone_id") == expected
    assert rows(geo.nearest_place(points, places, "event_id", bound=2), "event_id", "zone_id") == expected


@pytest.mark.parametrize("half_angle", [True, False])
def test_nearest_place_is_the_same_on_every_path(frame, half_angle):
    """Repeated and null keys, and more places than the bound."""
    places = frame([(2, 0.0, 10.0), (1, 0.0, -10.0), (3, 50.0, 50.0), (4, -60.0, 170.0)], "id long, lat double, lng double")
    points = frame([(1, 0.0, 9.0), (1, 49.0, 50.0), (None, 0.0, -9.0), (None, None, 1.0), (5, -80.0, -175.0), (6, 60.0, -120.0)],
                   "event_id long, lat double, lon double")
    literal = geo.nearest_place(points, places, "event_id", half_angle=half_angle)
    for bound in (1, 2, 3):
        assert rows(geo.nearest_place(points, places, "event_id", half_angle=half_angle, bound=bound)) == rows(literal)


def test_nearest_by_grid_equals_brute_force(spark):
    draw = random.Random(3)
    places = [(i, draw.uniform(-80, 80), draw.uniform(-180, 180)) for i in range(40)]
    points = [(i, draw.uniform(-89, 89), draw.uniform(-180, 180)) for i in range(60)]
    found = geo.nearest_by_grid(spark.createDataFrame(points, "k long, lat double, lon double"), spark.createDataFrame(places, "id long, lat double, lng double"), first_radius_km=400.0)
    expected = {p[0]: min((brute_distance(q[1:], p[1:]), q[0]) for q in places)[1] for p in points}
    assert {r.k: r.zone_id for r in found.collect()} == expected


def test_nearest_by_grid_listed_or_tiled(frame):
    """Few places are looked up where the points lie, without a shuffle of the points; many meet them in tiles: the same rows."""
    draw = random.Random(4)
    places = frame([(i, draw.uniform(40, 50), draw.uniform(0, 10)) for i in range(30)] + [(30, 45.0, 5.0), (31, 45.0, 5.0)], "id long, lat double, lng double")
    points = frame([(i, draw.uniform(38, 52), draw.uniform(-2, 12)) for i in range(300)] + [(0, 45.0, 5.0), (None, None, 5.0), (None, -70.0, -170.0)],
                   "k long, lat double, lon double")
    listed = geo.nearest_by_grid(points, places, first_radius_km=60.0)
    assert rows(listed) == rows(geo.nearest_by_grid(points, places, first_radius_km=60.0, most_listed=0)) == rows(geo.nearest_place(points, places, "k"))
    near = points.filter("lat > 0")
    assert "Exchange" not in geo.nearest_by_grid(near, places)._jdf.queryExecution().executedPlan().toString()


def test_partner_counts_work_out_their_input_once(spark, frame):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def member(value):
        made.add(1)
        return value

    found = joins.partner_counts(frame([(k % 2, k) for k in range(10)], "k long, v long").select("k", member("v").alias("u")), ["k"], "u")
    assert {r.partners for r in found.collect()} == {4} and made.value == 10


def test_checks(frame):
    df = frame([(1, 5), (1, None), (2, -1)], "k long, v long")
    assert rows(checks.rule_violations(df, {"positive": F.col("v") > 0})) == [("positive", 1)]
    assert rows(checks.null_violations(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    assert rows(checks.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(checks.orphans(df, "k", frame([(2,)], "p long"), "p")) == [(1, 2)]


def test_increment_loads_everything_into_an_empty_target(frame):
    source, empty, some = frame([(1,), (2,), (3,)], "id long"), frame([], "id long"), frame([(2,)], "id long")
    assert increments.past_watermark(source, "id", empty, "id").count() == 3
    assert rows(increments.past_watermark(source, "id", some, "id")) == [(3,)]


def test_staging_drops_copies_and_fills_status(frame):
    df = frame([(1, "a", 5), (2, "a", 6), (3, "b", 7)], "id long, uniq_id string, v long")
    staged = increments.staged(df, "uniq_id", ["id"], ["id"], {"status": F.lit("shipped")})
    assert rows(staged, "uniq_id", "v", "status") == [("a", 5, "shipped"), ("b", 7, "shipped")]


def test_size_checks(spark):
    df = spark.range(10)
    assert rows_if_bounded(df, 9) is None and len(rows_if_bounded(df, 10)) == 10
    hint = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hint(broadcast_if_bounded(df, 10)) and not hint(broadcast_if_bounded(df, 9))
    assert spread_if_small(df, 0) is df
