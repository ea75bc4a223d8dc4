"""Exact k nearest neighbours, by blocks or, where distances can rule rows out, by the cells of pivots."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import cut_lineage

# Rows per block and queries per matrix product; two blocks and their distances fit easily into one task.
# Training rows per cell, and most pivots: they go to every task.  Cells travel in groups of about as many training rows,
# so that a row meets a group once, whatever the number of cells it visits there; what is sent is the square of the rows by
# the rows of a group, which are fewer where there would be too few tasks otherwise.
BLOCK_ROWS = 4_096
PIECE_ROWS = 256
CELL_ROWS = 512
MOST_PIVOTS = 4_096
GROUP_ROWS = 65_536
LEAST_GROUP_ROWS = 4_096
DENSE = 0.5  # part of all pairs of a task from which on it multiplies whole blocks instead of cells


def nearest(queries: DataFrame, train: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nearest training rows of each query: ``query_id, neighbour_id, distance, label``.

    ``queries`` has ``id, vector``; ``train`` has ``id, vector, label``.  Both sides are
    dealt into blocks of bounded size by the hash of their id.  A task gets one block of
    each, computes the distances as a matrix product and gives back only the best ``k``
    per query; the blocks of a query are then merged.  A row is not its own neighbour.
    """
    query_blocks = max(1, -(-queries.count() // block_rows))
    train_blocks = max(1, -(-train.count() // block_rows))
    def blocks(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    def own(n):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    asked = queries.select("id", "vector", own(query_blocks).alias("qb"), blocks(train_blocks).alias("tb"))
    # renamed, so that both sides may come from the same frame
    known = train.select(F.col("id").alias("neighbour_id"), F.col("vector").alias("point"), F.col("label").cast("bigint").alias("label"),
                         own(train_blocks).alias("train_block"), blocks(query_blocks).alias("query_block"))
    found = asked.groupBy("qb", "tb").cogroup(known.groupBy("query_block", "train_block")).applyInPandas(
        lambda q, t: best_in_block(q, t, k), "query_id long, neighbour_id long, distance double, label long")
    # at most k rows per training block reach one query
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    return found.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def nearest_by_cells(queries: DataFrame, train: DataFrame, k: int, block_rows: int = BLOCK_ROWS,
                     cell_rows: int = CELL_ROWS, group_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``nearest`` by way of pivots, and the work this took: ``round, pairs, all_pairs``.

    About one training row in ``cell_rows`` is a pivot (``MOST_PIVOTS`` at most), chosen by hash,
    and every row belongs to the cell of its nearest pivot.  A first round compares each query with its
    own cell.  The distance of its ``k``-th neighbour so far, or the distance within which the counted
    radii of the nearest cells promise ``k`` rows, then rules out by the triangle inequality every
    cell whose ring of distances from its pivot lies farther away; a second round visits the others.
    Near cells form groups of about ``group_rows`` training rows: a query is sent to a group once, with the list of the
    cells to visit there and the distance of its ``k``-th neighbour so far.  Groups with more than ``group_rows`` rows of a side are compared
    in blocks of that many, and these by ``block_rows`` training rows at a time within the task.
    """
    rows = train.count()
    group_rows = group_rows or _group_rows(rows, queries.sparkSession.sparkContext.defaultParallelism)
    wanted = max(1, min(MOST_PIVOTS, rows // cell_rows))
    drawn = train.orderBy(F.xxhash64("id"), "id").limit(4 * wanted).select("vector").collect()
    pivots = list(dict.fromkeys(tuple(r.vector) for r in drawn))[:wanted]  # equal pivots would leave cells empty
    if not pivots:
        return nearest(queries, train, k, block_rows), _work(queries, [], 0, rows)
    centres = np.array(pivots, float)
    known = cut_lineage(_in_cells(train.select("id", "vector", F.col("label").cast("bigint").alias("label")), centres))
    asked = cut_lineage(_in_cells(queries.select("id", "vector"), centres))
    rings = known.groupBy("cell").agg(F.count("*").alias("n"), F.min("away").alias("inner"), F.max("away").alias("outer"))
    held = sorted((r.cell, r.n, r.inner, r.outer) for r in rings.collect())  # one row per pivot

    group_of = _groups(centres, held, group_rows)

    own = F.array("cell").alias("cells")
    lookup = F.broadcast(queries.sparkSession.createDataFrame([(int(c), int(g)) for c, g in enumerate(group_of)], "cell int, part int"))
    known = known.join(lookup, "cell")
    first, first_pairs = _compared(asked.join(lookup, "cell").select("id", "vector", "part", own, F.lit(None).cast("double").alias("reach")), known, k, block_rows, group_rows)
    first = cut_lineage(first)
    reached = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("distance")).alias("reach"))
    open_queries = asked.join(reached.withColumnRenamed("query_id", "id"), "id", "left")
    onward = cut_lineage(open_queries.select("id", "vector", "cell", "reach").mapInArrow(
        _onward(centres, held, k, group_of), _schema(asked, "id", "vector") + ", part int, cells array<int>, reach double"))
    second, second_pairs = _compared(onward, known, k, block_rows, group_rows)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    found = first.unionByName(second).withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")
    return found, _work(queries, [first_pairs, second_pairs], queries.count(), rows)


def _schema(df: DataFrame, *columns: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"{c} {kinds[c]}" for c in columns)


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), -1)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """All distances between points and centres, by products and therefore rough in the last digits."""
    squares = (points * points).sum(axis=1)[:, None] - 2.0 * (points @ centres.T) + (centres * centres).sum(axis=1)
    return np.sqrt(np.maximum(squares, 0.0))


def _in_cells(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """``rows`` with the number of the nearest pivot and the distance to it."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(at, PIECE_ROWS)
                points = _matrix(piece["vector"])
                cell = _distances(points, centres).argmin(axis=1)
                away = np.sqrt(((points - centres[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(cell, pa.int32()), pa.array(away)], [*piece.schema.names, "cell", "away"])

    return rows.mapInArrow(place, f"{_schema(rows, *rows.columns)}, cell int, away double")


def _group_rows(rows: int, cores: int) -> int:
    """Rows of a group, so that their pairs make four tasks a core where there are many cells to visit."""
    return min(GROUP_ROWS, max(LEAST_GROUP_ROWS, math.ceil(rows / (2 * math.sqrt(cores)))))


def _groups(centres: np.ndarray, rings: list[tuple], group_rows: int) -> np.ndarray:
    """The group of each cell: that of the nearest among the first few pivots, about one in ``group_rows`` training rows."""
    wanted = max(1, min(len(centres), sum(n for _, n, _, _ in rings) // group_rows))
    return _distances(centres, centres[:wanted]).argmin(axis=1)


def _onward(centres: np.ndarray, rings: list[tuple], k: int, group_of: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each query the further cells that may hold one of its ``k`` nearest, as one list for each group of cells."""
    cells, counts, inner, outer = (np.array(column) for column in zip(*rings))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(at, PIECE_ROWS)
                away = _distances(_matrix(piece["vector"]), centres[cells])
                # a cell lies wholly within this; the query itself may be one of the rows counted
                within = away + outer
                order = np.argsort(within, axis=1)
                enough = np.cumsum(counts[order], axis=1) > k
                last = np.where(enough.any(axis=1), enough.argmax(axis=1), len(cells) - 1)
                promised = np.where(enough.any(axis=1), np.take_along_axis(within, order, axis=1)[np.arange(len(last)), last], np.inf)
                reach = np.minimum(promised, piece["reach"].fill_null(np.inf).to_numpy(zero_copy_only=False))
                nearest_row = np.maximum(away - outer, inner - away)
                slack = 1e-6 * (1.0 + away)  # far above the rounding of the distances
                row, column = np.nonzero((nearest_row <= reach[:, None] + slack) & (cells != piece["cell"].to_numpy()[:, None]))
                part = group_of[cells[column]]
                order = np.lexsort((part, row))
                row, column, part = row[order], column[order], part[order]
                begin = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(part) != 0))[:len(row)])
                taken = piece.select(["id", "vector"]).take(pa.array(row[begin]))
                listed = pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)), pa.int32()), pa.array(cells[column], pa.int32()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(part[begin], pa.int32()), listed, piece["reach"].take(pa.array(row[begin]))],
                                                 ["id", "vector", "part", "cells", "reach"])

    return visit


def _compared(asked: DataFrame, known: DataFrame, k: int, block_rows: int, group_rows: int) -> tuple[DataFrame, DataFrame]:
    """The best ``k`` rows of the listed cells for every query row, and ``pairs``: how many distances that takes."""
    def dealt(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("part").agg(F.ceil(F.count("*") / group_rows).cast("int").alias(f"{name}_blocks"))

    # at most one row per pivot
    sizes = F.broadcast(cut_lineage(dealt(asked, "asked").join(dealt(known, "known"), "part")))
    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    left = asked.join(sizes, "part").select("id", "vector", "cells", "reach", F.col("part").alias("qp"), own("asked_blocks").alias("qb"), numbers("known_blocks").alias("tb"))
    right = known.join(sizes, "part").select(
        F.col("id").alias("neighbour_id"), F.col("vector").alias("point"), "label", "cell", F.col("part").alias("train_part"),
        own("known_blocks").alias("train_block"), numbers("asked_blocks").alias("query_block"))
    found = left.groupBy("qp", "qb", "tb").cogroup(right.groupBy("train_part", "query_block", "train_block")).applyInArrow(
        lambda q, t: best_in_cells(q, t, k, block_rows), "query_id long, neighbour_id long, distance double, label long")
    visits = asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("asked_rows"))
    held = known.groupBy("cell").agg(F.count("*").alias("known_rows"))
    return found, visits.join(held, "cell").agg(F.coalesce(F.sum(F.col("asked_rows") * F.col("known_rows")), F.lit(0)).alias("pairs"))


def _work(queries: DataFrame, pairs: list[DataFrame], asked: int, known: int) -> DataFrame:
    rounds = [p.select(F.lit(n).alias("round"), "pairs", F.lit(asked * known).alias("all_pairs")) for n, p in enumerate(pairs, 1)]
    if not rounds:
        return queries.sparkSession.createDataFrame([], "round int, pairs long, all_pairs long")
    return reduce(DataFrame.unionByName, rounds)


def best_in_cells(queries: pa.Table, train: pa.Table, k: int, block_rows: int) -> pa.Table:
    """Best ``k`` of the training rows of its listed ``cells`` for each query, no farther away than its ``reach``.

    Distances are roughly known from matrix products in single precision; what may be among the best ``k`` so far by
    more than their rounding is measured again.
    """
    best = _Best(queries, train.take(pa.array(np.argsort(train["cell"].to_numpy(), kind="stable"))), k, block_rows)
    cells = train["cell"].to_numpy()
    if not len(cells) or not queries.num_rows:
        return best.table()
    held, begin, size = np.unique(np.sort(cells), return_index=True, return_counts=True)
    listed = queries["cells"].combine_chunks()
    asked, visited = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy())), listed.flatten().to_numpy()
    place = np.minimum(np.searchsorted(held, visited), len(held) - 1)
    known = held[place] == visited
    asked, place = asked[known], place[known]
    if size[place].sum() >= DENSE * queries.num_rows * len(cells):
        open_cells = np.zeros((queries.num_rows, len(held)), bool)
        open_cells[asked, place] = True
        best.meet(np.arange(queries.num_rows), 0, len(cells), open_cells, np.repeat(np.arange(len(held)), size))
        return best.table()
    order = np.argsort(place, kind="stable")
    asked, place = asked[order], place[order]
    for cell in np.unique(place):
        first, last = np.searchsorted(place, [cell, cell + 1])
        best.meet(asked[first:last], begin[cell], begin[cell] + size[cell])
    return best.table()


class _Best:
    """The nearest ``k`` training rows that each query of a task has met."""

    def __init__(self, queries: pa.Table, train: pa.Table, k: int, block_rows: int) -> None:
        self.k, self.block_rows = k, block_rows
        self.ids, self.train_ids, self.labels = queries["id"].to_numpy(), train["neighbour_id"].to_numpy(), train["label"].combine_chunks()
        self.asked, self.known = (_matrix(c.combine_chunks()) if len(c) else np.zeros((0, 0)) for c in (queries["vector"], train["point"]))
        count = queries.num_rows
        self.distance, self.neighbour = np.full((count, k), np.inf), np.zeros((count, k), int)  # the latter by place
        self.limit = queries["reach"].fill_null(np.inf).to_numpy().copy()
        if not count or not train.num_rows:
            return
        # scaled by a power of two, so that no product leaves single precision
        largest = max(np.abs(self.asked).max(initial=0.0), np.abs(self.known).max(initial=0.0))
        self.scale = 2.0 ** -np.ceil(np.log2(largest)) if 0.0 < largest < np.inf else 1.0
        asked, known = self.asked * self.scale, self.known * self.scale
        self.squares = (asked * asked).sum(axis=1)
        squares = (known * known).sum(axis=1)
        # a last column adds the square of the training row to the product
        self.left = np.column_stack([-2.0 * asked, np.ones(count)]).astype(np.float32)
        self.right = np.column_stack([known, squares]).astype(np.float32)
        # the rounding of inputs, products and sums, with a factor to spare
        width = self.left.shape[1]
        self.error = 4.0 * (width + 4) * 2.0 ** -24 * (np.sqrt(self.squares * squares.max()) + squares.max() + self.squares) + 1e-30

    def meet(self, rows: np.ndarray, begin: int, end: int, open_cells: np.ndarray | None = None, cell: np.ndarray | None = None) -> None:
        """Compare queries with a run of training rows, or only with those whose ``cell`` is open to them."""
        for at in range(0, len(rows), PIECE_ROWS):
            piece = rows[at:at + PIECE_ROWS]
            left, low = self.left[piece], begin
            while low < end:  # a short run first, which brings the limits down
                high = min(end, low + (min(PIECE_ROWS, self.block_rows) if low == begin else self.block_rows))
                rough = left @ self.right[low:high].T
                unlimited = np.flatnonzero(np.isinf(self.limit[piece]))
                if len(unlimited) and high - low >= self.k:
                    closed = self.ids[piece[unlimited], None] == self.train_ids[low:high]
                    if open_cells is not None:
                        closed |= ~open_cells[piece[unlimited]][:, cell[low:high]]
                    kth = np.partition(np.where(closed, np.inf, rough[unlimited]), self.k - 1, axis=1)[:, self.k - 1]
                    some = piece[unlimited]
                    self.limit[some] = np.sqrt(np.maximum(kth + self.squares[some] + self.error[some], 0.0)) / self.scale * (1 + 1e-9)
                limit = ((self.limit[piece] * self.scale) ** 2 - self.squares[piece] + self.error[piece]).astype(np.float32)
                near = np.flatnonzero(rough <= limit[:, None])
                if len(near):
                    row, column = piece[near // (high - low)], near % (high - low) + low
                    wanted = self.ids[row] != self.train_ids[column]
                    if open_cells is not None:
                        wanted &= open_cells[row, cell[column]]
                    self._add(row[wanted], column[wanted])
                low = high

    def _add(self, row: np.ndarray, column: np.ndarray) -> None:
        for at in range(0, len(row), PIECE_ROWS * self.block_rows // 8):  # what is measured at once stays bounded
            some, other = row[at:at + PIECE_ROWS * self.block_rows // 8], column[at:at + PIECE_ROWS * self.block_rows // 8]
            exact = np.sqrt(((self.known[other] - self.asked[some]) ** 2).sum(axis=1))
            near = exact <= self.limit[some]
            some, other, exact = some[near], other[near], exact[near]
            touched = np.unique(some)
            if not len(touched):
                continue
            kept = np.isfinite(self.distance[touched])
            some = np.concatenate([some, np.repeat(touched, kept.sum(axis=1))])
            other = np.concatenate([other, self.neighbour[touched][kept]])
            exact = np.concatenate([exact, self.distance[touched][kept]])
            order = np.lexsort((self.train_ids[other], exact, some))
            some, other, exact = some[order], other[order], exact[order]
            turn = np.arange(len(some)) - np.searchsorted(some, some)
            first = turn < self.k
            some, other, exact, turn = some[first], other[first], exact[first], turn[first]
            self.distance[some, turn], self.neighbour[some, turn] = exact, other
            self.limit[touched] = np.minimum(self.limit[touched], self.distance[touched, -1])

    def table(self) -> pa.Table:
        row, turn = np.nonzero(np.isfinite(self.distance))
        other = self.neighbour[row, turn]
        return pa.table({"query_id": pa.array(self.ids[row], pa.int64()), "neighbour_id": pa.array(self.train_ids[other], pa.int64()),
                         "distance": pa.array(self.distance[row, turn], pa.float64()), "label": self.labels.take(pa.array(other)).cast(pa.int64())})


def best_in_block(queries: pd.DataFrame, train: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best ``k`` of one training block for each query of one block, from matrix products of ``PIECE_ROWS`` queries."""
    columns = ["query_id", "neighbour_id", "distance", "label"]
    if queries.empty or train.empty:
        return pd.DataFrame(columns=columns)
    points, known = np.stack(queries["vector"]).astype(float), np.stack(train["point"]).astype(float)
    query_ids, train_ids, labels = queries["id"].to_numpy(), train["neighbour_id"].to_numpy(), train["label"].to_numpy()
    squares = (known * known).sum(axis=1)
    found = []
    for at in range(0, len(points), PIECE_ROWS):
        piece, ids = points[at:at + PIECE_ROWS], query_ids[at:at + PIECE_ROWS]
        rough = squares - 2.0 * (piece @ known.T)
        rough[ids[:, None] == train_ids] = np.inf
        take = min(k, len(known))
        limit = np.partition(rough, take - 1, axis=1)[:, take - 1]
        # the product form is rough in the last digits: measure everything near the limit again
        near = np.isfinite(rough) & (rough <= np.where(np.isfinite(limit), limit + 1e-6 * (1.0 + np.abs(limit)), np.inf)[:, None])
        asked, place = np.nonzero(near)
        exact = np.sqrt(((known[place] - piece[asked]) ** 2).sum(axis=1))
        order = np.lexsort((train_ids[place], exact, asked))
        asked, place, exact = asked[order], place[order], exact[order]
        turn = np.arange(len(asked)) - np.searchsorted(asked, asked)
        best = turn < k
        found.append(pd.DataFrame({"query_id": ids[asked[best]], "neighbour_id": train_ids[place[best]],
                                   "distance": exact[best], "label": labels[place[best]]}))
    return pd.concat(found)


def classify(queries: DataFrame, train: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Majority label of the ``k`` nearest rows; ties go to the smallest label."""
    found, _ = nearest_by_cells(queries, train, k, block_rows)
    votes = found.groupBy("query_id", "label").agg(F.count("*").alias("votes"))
    return votes.groupBy("query_id").agg(F.min(F.struct(-F.col("votes"), F.col("label").alias("label")))["label"].alias("prediction"))
