import datetime as dt
import os

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from martloom import session, sizing
from martloom.models import corpus, describe, hypothesis, metrics, moments, neighbours, splits, training
from martloom.sources import files, geo_events, jdbc, queue
from martloom.streaming import jobs, runs, state


def test_quoted_text_round_trip(spark, frame, tmp_path):
    df = frame([(1, 'a "quoted", text'), (2, None)], "id long, note string")
    path = str(tmp_path / "text")
    files.write_delimited(df, path, ";", quote_all=True)
    assert rows(files.read_delimited(spark, path, df.schema, ";")) == rows(df)


def test_repeated_run_replaces_its_own_partition(spark, frame, tmp_path):
    path = str(tmp_path / "runs")
    for value, day in ((1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")):
        files.append_run(frame([(value,)], "v long"), path, day)
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,)]


def test_day_slices_are_half_open():
    assert jdbc.day_slices("ts", dt.date(2022, 2, 28), dt.date(2022, 3, 1)) == [
        "ts >= TIMESTAMP '2022-02-28 00:00:00' AND ts < TIMESTAMP '2022-03-01 00:00:00'",
        "ts >= TIMESTAMP '2022-03-01 00:00:00' AND ts < TIMESTAMP '2022-03-02 00:00:00'"]


def test_queue_options_hold_only_what_was_given():
    assert queue.queue_options("host:1", "subscribe", "in") == {"kafka.bootstrap.servers": "host:1", "subscribe": "in"}
    assert queue.queue_options("host:1", "topic", "out", "SASL_SSL", "SCRAM-SHA-512", "login")["kafka.sasl.jaas.config"] == "login"


def test_keyed_stream_write_is_idempotent(spark, frame, tmp_path):
    handle = jobs.unseen_batch(spark, str(tmp_path / "hub"), "k")
    for batch_id, keys in ((0, [1, 1, 2]), (1, [2, 3]), (1, [2, 3]), (0, [1, 1, 2])):
        handle(frame([(k,) for k in keys], "k long"), batch_id)
    assert rows(spark.read.parquet(str(tmp_path / "hub")), "k") == [(1,), (2,), (3,)]


def test_work_per_batch_follows_the_batch(spark, frame, tmp_path):
    """Twenty batches of ten rows: a batch updates its own new keys, and a row is written once per tier."""
    source, written = str(tmp_path / "in"), []
    for n in range(20):
        frame([((n * 5 + k) % 73,) for k in range(10)], "k long").coalesce(1).write.mode("append").parquet(source)
    table = state.FoldedTable(spark, str(tmp_path / "hub"), ["k"], "first", fan=4)
    write = table._write
    table._write = lambda rows_, tier, run: (write(rows_, tier, run), written.append(spark.read.schema("k long").parquet(table._folder(tier, run)).count()))
    stream = spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).parquet(source)
    query = runs.start(state.first_arrivals(stream, ["k"]), table.add, str(tmp_path / "cp"), None)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert len(progress) == 20 and all(p.stateOperators[0].numRowsUpdated <= 10 for p in progress)
    assert progress[-1].stateOperators[0].numRowsTotal == 73
    assert sorted(r.k for r in table.read().collect()) == list(range(73))
    assert table.runs() <= 3 + 3 and sum(written) <= 73 * 3  # tiers 0, 1 and 2


@pytest.mark.parametrize("fold, expected", [("sum", {1: 4, 2: 2, 3: 4, 4: 4}), ("latest", {1: 1, 2: 1, 3: 2, 4: 4})])
def test_folded_table_takes_a_repeated_batch_once(spark, frame, tmp_path, fold, expected):
    batches = [[(1, 1), (2, 1)], [(1, 2), (2, 1)], [(1, 1), (3, 2)], [(3, 2), (4, 4)]]
    table = state.FoldedTable(spark, str(tmp_path / "t"), ["k"], fold, fan=2)
    for batch_id in (0, 0, 1, 0, 1, 2, 2, 1, 3, 3, 0, 2):
        table.add(frame(batches[batch_id], "k long, n long"), batch_id)
    assert {r.k: r.n for r in table.read().collect()} == expected
    assert table.runs() == 1
    table.add(frame([], "k long, n long"), 4)
    again = state.FoldedTable(spark, str(tmp_path / "t"), ["k"], fold, fan=2)
    assert {r.k: r.n for r in again.read().collect()} == expected and again.runs() == 2


def test_broken_off_fold_is_hidden(spark, frame, tmp_path):
    """Runs that a complete higher run covers are not read, even if they were not deleted."""
    table = state.FoldedTable(spark, str(tmp_path / "t"), ["k"], "sum", fan=2)
    table.add(frame([(1, 5)], "k long, n long"), 0)
    table.add(frame([(1, 7)], "k long, n long"), 1)
    table._write(frame([(1, 5, 0)], "k long, n long, batch_id long"), 0, 0)
    assert [r.n for r in table.read().collect()] == [12]


def test_two_files_make_two_batches_and_absolute_counts(spark, frame, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for n in (1, 2):
        frame([("a",)] * n, "k string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k string").option("maxFilesPerTrigger", 1).parquet(source)
    counts = jobs.running_counts(stream, ["k"])
    runs.start(counts, lambda b, i: runs.write_batch(b, sink, i), str(tmp_path / "cp"), None, "update").awaitTermination()
    table = spark.read.parquet(sink)
    assert table.select("batch_id").distinct().count() == 2
    assert rows(runs.latest_state(table, ["k"], ["order_cnt"])) == [("a", 3)]


@pytest.mark.parametrize("t, dof, alternative, p", [(2.228139, 10, "two-sided", 0.05), (1.812461, 10, "greater", 0.05), (1.644854, 10_000_000, "greater", 0.05), (-12.7062, 1, "two-sided", 0.05), (0.0, 5, "less", 0.5)])
def test_p_values_of_the_tables(frame, t, dof, alternative, p):
    tested = hypothesis.with_p_value(frame([(t, float(dof))], "t double, dof double"), alternative)
    assert tested.first().p_value == pytest.approx(p, abs=2e-6)


def test_t_tests(frame):
    df = frame([(1.0, True), (2.0, True), (4.0, True), (3.0, False), (5.0, False), (9.0, False)], "v double, first boolean")
    row = hypothesis.two_samples(df, F.col("v"), F.col("first")).first()
    a, b = np.array([1, 2, 4.0]), np.array([3, 5, 9.0])
    pooled = (a.var(ddof=1) + b.var(ddof=1)) / 2
    assert row.t == pytest.approx((a.mean() - b.mean()) / np.sqrt(pooled * 2 / 3)) and row.dof == 4


def test_imputation_and_profile(frame):
    df = frame([(1.0, "a", None), (3.0, None, "x"), (None, "b", "y"), (5.0, "b", "y")], "n double, s string, c string")
    assert rows(describe.missing_profile(df, ["n", "s"])) == [("n", 1, 0.25), ("s", 1, 0.25)]
    assert rows(describe.impute(df, ["n"], ["s"], {"c": "unk"})) == [(1.0, "a", "unk"), (3.0, "b", "x"), (3.0, "b", "y"), (5.0, "b", "y")]


def test_collinear_columns_are_dropped(spark):
    df = spark.range(50).select(F.col("id").alias("a"), (F.col("id") * 2 + 1).alias("b"), F.pmod(F.xxhash64("id"), F.lit(100)).alias("c"))
    assert describe.uncorrelated_columns(df, ["a", "b", "c"]) == ["a", "c"]


def test_ranking_metrics(frame):
    df = frame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "label int, score double")
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.875)
    assert metrics.threshold_for(df, 0.0).first().threshold == 0.9


def test_errors_from_moments_are_those_of_the_rows(spark):
    """Rolling-origin and left-out folds with five features against least squares on the rows."""
    draw = np.random.default_rng(8)
    x = draw.normal(3, 2, (400, 5))
    y, fold = x @ [1.0, -2.0, 0.5, 0.0, 4.0] + 7 + draw.normal(0, 1, 400), draw.integers(0, 4, 400)
    df = spark.createDataFrame([(int(f), *map(float, row), float(v)) for f, row, v in zip(fold, x, y)], "fold int, a double, b double, c double, d double, e double, y double")
    held = moments.fold_moments(df, list("abcde"), "y")

    def by_hand(train, test, penalty):
        ones = lambda rows_: np.column_stack([np.ones(rows_.sum()), x[rows_]])
        a = ones(train)
        w = np.linalg.solve(a.T @ a + penalty * np.diag([0.0] + [1.0] * 5), a.T @ y[train])
        miss = y[test] - ones(test) @ w
        return [*w, np.sqrt((miss ** 2).mean()), 1 - (miss ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum(), np.sqrt(((y[test] - y[train].mean()) ** 2).mean())]

    for trained, past in ((moments.rolling_origin(held), True), (moments.left_out(held), False)):
        results = moments.validated(trained, 5, [0.0, 50.0]).collect()
        assert len(results) == (6 if past else 8)
        for r in results:
            expected = by_hand(fold < r.fold if past else fold != r.fold, fold == r.fold, r.penalty)
            assert [*r.coefficients, r.rmse, r.r2, r.mean_rmse] == pytest.approx(expected, rel=1e-8)
    assert moments.best_penalty(moments.validated(moments.left_out(held), 5, [0.0, 50.0])).first().penalty == 0.0


def test_best_splits_equal_brute_force(spark):
    """Many distinct values, a value shared by a third of the rows, gaps, and a node that cannot be split."""
    draw = np.random.default_rng(4)
    x = np.column_stack([draw.normal(0, 1, 150).round(2), np.where(np.arange(150) % 3 == 0, 5.0, draw.normal(5, 2, 150))])
    y = np.where(x[:, 1] > 5.5, 10.0, 0.0) + x[:, 0] + draw.normal(0, 0.1, 150)
    made = [(i % 2, None if i % 11 == 0 else float(x[i, 0]), float(x[i, 1]), float(y[i])) for i in range(150)] + [(7, 1.0, 1.0, 3.0), (7, 1.0, 1.0, 4.0)]
    found = {r.node: r for r in splits.best_splits(spark.createDataFrame(made, "node int, a double, b double, y double"), ["a", "b"], "y").collect()}
    assert set(found) == {0, 1}
    for node, row in found.items():
        best = []
        for column, name in ((1, "a"), (2, "b")):
            held = [(r[column], r[3]) for r in made if r[0] == node and r[column] is not None]
            error = lambda values: sum((v - sum(values) / len(values)) ** 2 for v in values)
            for cut in sorted({v for v, _ in held})[:-1]:
                left, right = [t for v, t in held if v <= cut], [t for v, t in held if v > cut]
                best.append((-(error(left + right) - error(left) - error(right)) / len(held), name, cut, len(left), len(right)))
        loss, name, cut, n_left, n_right = min(best)
        assert (row.feature, row.threshold, row.n_left, row.n_right) == (name, cut, n_left, n_right) and row.gain == pytest.approx(-loss)


def test_moments_of_one_fold_and_of_repeated_features(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (0, 2.0, 4.0)], "fold int, a double, y double")
    held = moments.fold_moments(df, ["a", "a"], "y")
    assert moments.validated(moments.rolling_origin(held), 2).count() == 0 and moments.validated(moments.left_out(held), 2).count() == 0
    both = moments.fold_moments(df.union(df.selectExpr("1 AS fold", "a", "y")), ["a", "a"], "y")
    assert moments.validated(moments.left_out(both), 2).first().rmse == pytest.approx(0.0, abs=1e-6)


@pytest.mark.parametrize("block_rows, cell_rows", [(4_096, 30), (20, 60), (4_096, 10_000)])
def test_cells_give_the_rows_of_the_blocks(spark, block_rows, cell_rows):
    """Clustered points, a third of them at one spot, and fewer rows than neighbours in some cells."""
    draw = np.random.default_rng(5)
    points = np.concatenate([draw.normal(c, 0.3, (40, 3)) for c in range(0, 100, 10)] + [np.full((200, 3), 50.0), draw.normal(500, 1, (2, 3))])
    df = spark.createDataFrame([(i, p.tolist(), i % 3) for i, p in enumerate(points)], "id long, vector array<double>, label int")
    columns = ["query_id", "neighbour_id", "distance", "label"]
    expected = rows(neighbours.nearest(df.select("id", "vector"), df, 5), *columns)
    found, work = neighbours.nearest_by_cells(df.select("id", "vector"), df, 5, block_rows, cell_rows)
    assert rows(found, *columns) == expected
    pairs, everything = sum(r.pairs for r in work.collect()), work.first().all_pairs
    assert everything == len(points) ** 2
    if cell_rows == 30:
        assert pairs < 0.35 * everything  # the spot alone has a tenth of all pairs
    if cell_rows == 10_000:
        assert pairs == everything


def test_cells_are_visited_in_groups(spark):
    """A query is sent to a group of cells once, however many of its cells it visits: at most once per group, not per cell."""
    points = np.random.default_rng(6).normal(size=(300, 20))
    df = spark.createDataFrame([(i, p.tolist(), i % 3) for i, p in enumerate(points)], "id long, vector array<double>, label int")
    columns = ["query_id", "neighbour_id", "distance", "label"]
    expected = rows(neighbours.nearest(df.select("id", "vector"), df, 5), *columns)
    for group_rows in (40, 150, 10_000):
        assert rows(neighbours.nearest_by_cells(df.select("id", "vector"), df, 5, 20, 10, group_rows)[0], *columns) == expected
    rings = [(c, 10, 0.0, 9.0) for c in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([p.tolist() for p in points[:2]]), pa.array([0, 7], pa.int32()), pa.array([9.0, 9.0])], ["id", "vector", "cell", "reach"])
    sent = [r for b in neighbours._onward(points[:30], rings, 5, neighbours._groups(points[:30], rings, 100))([batch]) for r in b.to_pylist()]
    assert len(sent) == len({(r["id"], r["part"]) for r in sent}) <= 2 * 3 and sum(len(r["cells"]) for r in sent) == 2 * 29


@pytest.mark.parametrize("scale", [1.0, 1e-25, 3e18])
def test_cells_are_exact_at_any_scale(spark, scale):
    """Products in single precision only sift: copies, ties and a repeated id come out as they do block by block."""
    import numpy as np

    spots = np.random.default_rng(5).normal(size=(40, 6)) * scale
    data = [(i % 310, [float(x) for x in spots[i % 40] * (1 + (i % 3) * 1e-9)], i % 4) for i in range(320)]
    df = spark.createDataFrame(data, "id long, vector array<double>, label long")
    columns = ["query_id", "neighbour_id", "distance", "label"]
    expected = rows(neighbours.nearest(df.select("id", "vector").limit(300), df, 3), *columns)
    assert len(expected) == 900
    assert rows(neighbours.nearest_by_cells(df.select("id", "vector").limit(300), df, 3, 20, 10, 50)[0], *columns) == expected


def test_a_task_gives_back_only_what_may_count():
    """Rows beyond the distance a query has reached elsewhere are not sent on; before, every task gave back ``k`` rows."""
    import pyarrow as pa

    queries = pa.table({"id": [1, 2], "vector": [[0.0], [10.0]], "cells": [[0, 1], [1]], "reach": pa.array([2.0, None], pa.float64())})
    train = pa.table({"neighbour_id": [1, 3, 4, 5, 6], "point": [[0.0], [2.0], [2.5], [9.0], [50.0]], "label": [0, 1, None, 0, 0], "cell": pa.array([0, 0, 0, 1, 1], pa.int32())})
    found = neighbours.best_in_cells(queries, train, 2, 2).to_pylist()
    assert [(r["query_id"], r["neighbour_id"], r["distance"], r["label"]) for r in found] == [(1, 3, 2.0, 1), (2, 5, 1.0, 0), (2, 6, 40.0, 0)]


def test_cells_without_training_rows(spark):
    none = spark.createDataFrame([], "id long, vector array<double>, label int")
    found, work = neighbours.nearest_by_cells(none.select("id", "vector"), none, 5)
    assert found.collect() == [] and work.collect() == []
    one = spark.createDataFrame([(1, [0.0], 4)], "id long, vector array<double>, label int")
    assert neighbours.nearest_by_cells(one.select("id", "vector"), one, 5)[0].collect() == []


def test_neighbours_equal_brute_force_over_blocks(spark):
    made = np.random.default_rng(5).normal(size=(90, 6))
    made[10] = made[20]  # copies tie at distance zero
    df = spark.createDataFrame([(i, [float(x) for x in v], i % 3) for i, v in enumerate(made)], "id long, vector array<double>, label int")
    found = neighbours.nearest(df.select("id", "vector"), df, 4, block_rows=25).select("query_id", "neighbour_id")
    distance = np.sqrt(((made[:, None] - made[None]) ** 2).sum(-1))
    expected = sorted((q, n) for q in range(90) for n in sorted((i for i in range(90) if i != q), key=lambda i: (distance[q, i], i))[:4])
    assert rows(found) == sorted(expected, key=lambda t: tuple((False, str(v)) for v in t))


def test_permuted_column_keeps_its_values(spark):
    df = spark.range(200).select("id", (F.col("id") * 3).alias("v"), F.lit(1).alias("w"))
    mixed = training.permuted(df, "id", "v").collect()
    assert sorted(r.v for r in mixed) == [3 * i for i in range(200)]
    assert sum(r.v == 3 * r.id for r in mixed) < 20


def test_columns_dealt_anew_keep_their_values_in_one_order(spark):
    df = spark.range(200).select("id", (F.col("id") * 3).alias("v"), (F.col("id") * 5).alias("w"))
    mixed = training.dealt_anew(df, "id", ["v", "w"]).collect()
    assert [sorted(r[c] for r in mixed) for c in ("v_anew", "w_anew")] == [[3 * i for i in range(200)], [5 * i for i in range(200)]]
    assert all((r.v, r.w, 5 * r.v_anew) == (3 * r.id, 5 * r.id, 3 * r.w_anew) for r in mixed)


def _repeated(spark):
    return spark.range(4000).select("id", F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("double")).alias("x"), (F.col("id") % 3).cast("string").alias("c"),
                                    (F.col("id") % 5 * 2 + F.col("id") % 3).cast("double").alias("label"), F.when(F.col("id") % 15 > 8, 1.0).otherwise(0.0).alias("large"))


def test_models_fitted_on_counted_rows_equal_those_on_all_rows(spark):
    """The last stage gets each distinct row once, and learns what it learns from all of them."""
    df = _repeated(spark).drop("id", "large")
    for kind in ("linear", "tree"):
        stages = [*training.preparation(["x"], ["c"]), training.model(kind)]
        every, counted = training.fit(stages, df), training.fit_counted(stages, df)
        if kind == "linear":
            assert counted.stages[-1].summary.numInstances == 15 and every.stages[-1].summary.numInstances == 4000
        expected = {(r.x, r.c): r.prediction for r in every.transform(df).select("x", "c", "prediction").distinct().collect()}
        found = {(r.x, r.c): r.prediction for r in counted.transform(df).select("x", "c", "prediction").distinct().collect()}
        assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k], abs=1e-6) for k in expected)


def test_search_on_counted_rows(spark):
    """The metric of each setting is that of fits on all rows of the other folds."""
    df = _repeated(spark).withColumn("fold", F.when(F.col("id") < 1000, 0).when(F.col("id") < 2500, 1).otherwise(2)).drop("id", "label")
    stages = [*training.preparation(["x"], ["c"]), training.model("logistic", labelCol="large")]
    evaluator = BinaryClassificationEvaluator(labelCol="large")
    best, tried = training.search(stages, training.grid_of(regParam=[0.3, 0.01]), evaluator, df)
    for setting, metric in tried:
        last = stages[-1].copy({stages[-1].regParam: setting["regParam"]})
        parts = [evaluator.evaluate(training.fit([*stages[:-1], last], df.filter(F.col("fold") != f)).transform(df.filter(F.col("fold") == f))) for f in range(3)]
        assert metric == pytest.approx(sum(parts) / 3, abs=1e-6)
    assert best.stages[-1].getRegParam() == max(tried, key=lambda t: t[1])[0]["regParam"]


def test_split_is_stable_and_complete(spark):
    df = spark.range(1000)
    train, test = training.split(df, "id")
    assert train.count() + test.count() == 1000 and 180 < test.count() < 320
    assert train.join(test, "id").count() == 0


def test_term_weights(frame):
    docs = frame([(1, "Red red fox and the dog"), (2, "Red house")], "d long, text string")
    weights = {(r.d, r.term): (r.n, r.weight) for r in corpus.tf_idf(docs, "d", "text").collect()}
    assert set(weights) == {(1, "red"), (1, "fox"), (1, "dog"), (2, "red"), (2, "house")}
    assert weights[1, "red"] == (2, 0.0) and weights[1, "fox"][1] == pytest.approx(np.log(1.5))


def test_scratch_tables_are_deleted(spark, frame):
    df = frame([(1,)], "k long")
    with session.scratch(spark):
        kept = session.cut_lineage(df)
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
        assert kept.count() == 1 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_shuffles_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        df = spark.range(1_000_000)
        assert session.fit_shuffles(spark, df, target_bytes=100_000) >= 80
        assert session.fit_shuffles(spark, df) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pieces_stay_small_as_the_input_grows(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = {n: sizing.spread_in_pieces(spark.range(n)).rdd.getNumPartitions() for n in (10, 1_000_000, 40_000_000)}
    assert parts[10] == parts[1_000_000] == cores and parts[40_000_000] >= 40_000_000 * 8 // sizing.PIECE_BYTES > cores


def test_city_file_and_nested_events(spark, frame, tmp_path):
    (tmp_path / "geo.csv").write_text("id;city;lat;lng\n1;Sydney;-33,865;151,2094\n")
    assert rows(geo_events.city_file(spark, str(tmp_path / "geo.csv"))) == [(1, "Sydney", -33.865, 151.2094)]
    raw = frame([("message", (5, 6, None, None, None, None, "2022-01-02 03:04:05"), 1.0, 2.0), ("subscription", (None, None, None, "7", 9, "2022-01-01 00:00:00", None), None, None)],
                "event_type string, event struct<message_from:long,message_to:long,reaction_from:string,user:string,subscription_channel:long,datetime:string,message_ts:string>, lat double, lon double")
    assert rows(geo_events.flat_events(raw), "event_type", "user_id", "message_to", "channel", "ts", "lat") == [
        ("message", 5, 6, None, dt.datetime(2022, 1, 2, 3, 4, 5), 1.0), ("subscription", 7, None, 9, dt.datetime(2022, 1, 1), None)]


def test_terms_are_counted_where_the_texts_lie(spark):
    """Only texts whose key is repeated, null ones too, are shuffled to be counted together."""
    rows = [(1, "The cat, a CAT"), (2, "cat dog"), (2, "dog bird the"), (None, "x y"), (None, "x"), (3, None), (4, ""), (5, "the a")]
    docs = spark.createDataFrame(rows, "d long, t string")
    found = sorted(map(tuple, corpus.term_counts(docs, "d", "t").collect()), key=str)
    assert found == sorted([(1, "cat", 2), (2, "cat", 1), (2, "dog", 2), (2, "bird", 1), (None, "x", 2), (None, "y", 1)], key=str)
    alone = corpus.term_counts(docs.filter("d <> 2"), "d", "t")
    assert sorted(map(tuple, alone.collect())) == [(1, "cat", 2)]
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
