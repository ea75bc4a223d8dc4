"""Hard negatives for contrastive training: rows of another label that an anchor nearly takes for its positives.

Anchors and candidates are dealt into chunks and every chunk of anchors meets every chunk of
candidates once, each pair of chunks in a task of its own.  Inside it the vectors, as 64-bit
integers, are multiplied tile by tile with Strassen's recursion: odd sides get a zero row or
column, the seven products and their sums are exact integers.  Bounded heaps keep the best
entries of each anchor (pass one: positives; pass two: one window per positive) and merge by
anchor across tasks, so a task holds its two chunks and the heaps of one of them, nothing else.

Defined cases:

* rows with a null id, a null label, a null vector or any null or non-finite component take no part;
* vectors of different lengths are compared as if the shorter ended in zeros; an empty vector scores 0;
* equal scores rank by the smaller id; rows with the anchor's own id are neither positive nor negative;
* rows that repeat an id each count as candidates; an id that repeats among anchors is one
  anchor, that of the smallest label, then the smallest vector;
* an anchor without a positive, or a positive without a negative in its window, has no rows;
* a table whose scores could leave 64 bits (times 100) is refused with an error, never wrapped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = 32  # no side of a product is split below this
TILE_ANCHORS, TILE_CANDIDATES = 256, 4096  # one product of 8 MB
ANCHOR_CHUNK, CANDIDATE_CHUNK = 8 << 20, 64 << 20  # bytes of integers a task holds of each side
LOWEST = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact product of two integer matrices by seven half-size products per level."""
    n, d = a.shape
    m = b.shape[1]
    if min(n, d, m) <= LEAF:
        return a @ b
    if n % 2 or d % 2:
        a = np.pad(a, ((0, n % 2), (0, d % 2)))
    if d % 2 or m % 2:
        b = np.pad(b, ((0, d % 2), (0, m % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * j), a.dtype)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


class Heaps:
    """The ``k`` best entries of each of ``n`` heaps: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores = np.full((n, k), LOWEST)
        self.ids = np.full((n, k), _NO_ID)

    def floor(self, heaps: np.ndarray | slice) -> np.ndarray:
        """Scores below this cannot enter."""
        return self.scores[heaps, -1]

    def push(self, heaps: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Add entries in any order; with the entries of other heaps this merges them."""
        if not len(heaps):
            return
        met = np.unique(heaps)
        which = np.concatenate([np.repeat(met, self.k), heaps])
        scores = np.concatenate([self.scores[met].ravel(), scores])
        ids = np.concatenate([self.ids[met].ravel(), ids])
        order = np.lexsort((ids, ~scores, which))  # unlike the negative, the complement of the lowest number exists
        which, scores, ids = which[order], scores[order], ids[order]
        starts = np.searchsorted(which, met)
        place = np.arange(len(which)) - np.repeat(starts, np.diff(np.append(starts, len(which))))
        best = place < self.k
        self.scores[met] = scores[best].reshape(-1, self.k)
        self.ids[met] = ids[best].reshape(-1, self.k)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Heap number, score and id of every entry."""
        heaps, places = np.nonzero(self.scores != LOWEST)
        return heaps, self.scores[heaps, places], self.ids[heaps, places]


def _best_of_tile(scores: np.ndarray, fit: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the fitting entries that can still be among the ``k`` best of their row."""
    fit = fit & (scores >= floor[:, None])
    if np.count_nonzero(fit) > 4 * k * len(scores) and scores.shape[1] > k:
        kth = np.partition(np.where(fit, scores, LOWEST), scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        fit &= scores >= kth[:, None]
    return np.nonzero(fit)


def _matrix(vectors: pa.ChunkedArray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of every component, short vectors ended by zeros."""
    listed = vectors.combine_chunks()
    if isinstance(listed, pa.ChunkedArray):
        listed = pa.concat_arrays(listed.chunks)
    lengths = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(scale * listed.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def _tiles(a: np.ndarray, c: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    for i in range(0, len(a), TILE_ANCHORS):
        for j in range(0, len(c), TILE_CANDIDATES):
            rows, columns = slice(i, min(i + TILE_ANCHORS, len(a))), slice(j, min(j + TILE_CANDIDATES, len(c)))
            yield rows, columns, strassen(a[rows], c[columns].T)


def _positives_of(k: int, scale: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Pass one on two chunks: the best other rows of the same label."""

    def run(anchors: pa.Table, others: pa.Table) -> pa.Table:
        a, c = _same_width(_matrix(anchors["_vector"], scale), _matrix(others["_c_vector"], scale))
        a_id, a_label, c_id, c_label = (t[n].to_numpy() for t, n in (
            (anchors, "_id"), (anchors, "_label"), (others, "_c_id"), (others, "_c_label")))
        heaps = Heaps(len(a), k)
        for label in np.intersect1d(a_label, c_label):
            mine, theirs = np.flatnonzero(a_label == label), np.flatnonzero(c_label == label)
            for rows, columns, scores in _tiles(a[mine], c[theirs]):
                at, ids = mine[rows], c_id[theirs[columns]]
                r, s = _best_of_tile(scores, ids[None, :] != a_id[at][:, None], heaps.floor(at), k)
                heaps.push(at[r], scores[r, s], ids[s])
        at, scores, ids = heaps.entries()
        return pa.table({"_id": a_id[at], "_other": ids, "_score": scores})

    return run


def _negatives_of(k: int, low: int, high: int, scale: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Pass two on two chunks: per anchor and positive the best rows of another label inside the window."""

    def run(anchors: pa.Table, others: pa.Table) -> pa.Table:
        a, c = _same_width(_matrix(anchors["_vector"], scale), _matrix(others["_c_vector"], scale))
        a_id, a_label, c_id, c_label = (t[n].to_numpy() for t, n in (
            (anchors, "_id"), (anchors, "_label"), (others, "_c_id"), (others, "_c_label")))
        positives = anchors["_positives"].to_pylist()
        slots = max(map(len, positives), default=0)
        # a slot that an anchor lacks gets an empty window
        score = np.array([[p["score"] for p in held] + [0] * (slots - len(held)) for held in positives], np.int64)
        least, most = -((-low * score) // 100), (high * score) // 100
        for at, held in enumerate(positives):
            most[at, len(held):] = least[at, len(held):] - 1
        heaps = Heaps(len(a) * slots, k)
        for rows, columns, scores in _tiles(a, c):
            ids, at = c_id[columns], np.arange(rows.start, rows.stop)
            other = c_label[columns][None, :] != a_label[rows][:, None]
            for slot in range(slots):
                bound = np.maximum(least[rows, slot], heaps.floor(at * slots + slot))
                r, s = _best_of_tile(scores, other & (scores <= most[rows, slot][:, None]), bound, k)
                heaps.push(at[r] * slots + slot, scores[r, s], ids[s])
        heap, scores, ids = heaps.entries()
        at, slot = (heap // slots, heap % slots) if slots else (heap, heap)
        return pa.table({"_id": a_id[at], "_slot": (slot + 1).astype(np.int64), "_other": ids, "_score": scores})

    return run


def _met(anchors: DataFrame, others: DataFrame, parts: tuple[int, int], run: Callable, schema: str) -> DataFrame:
    """Every chunk of anchors with every chunk of the other rows, each pair of chunks in one call."""
    # row numbers deal equal rows evenly too, and a scan that is repeated numbers them alike
    dealt = F.monotonically_increasing_id()
    for_anchors, for_others = (F.sequence(F.lit(0), F.lit(n - 1)) for n in parts)
    left = anchors.withColumn("_a", F.pmod(dealt, F.lit(parts[0])).cast("int")).withColumn("_c", F.explode(for_others))
    right = others.withColumn("_c", F.pmod(dealt, F.lit(parts[1])).cast("int")).withColumn("_a", F.explode(for_anchors))
    return left.groupBy("_a", "_c").cogroup(right.groupBy("_a", "_c")).applyInArrow(run, schema)


def _chunks(rows: int, width: int, size: int, least: int) -> int:
    return max(1, min(rows, max(least, -(-rows * 8 * max(width, 1) // size))))


def hard_negatives(vectors: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding",
                   positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Per anchor and positive, its ``negatives`` best rows of another label between ``low`` and ``high`` percent
    of the positive's score.

    A component ``x`` counts as the integer ``floor(scale * x)`` and a score is the inner product
    of two rows.  The positives of an anchor are its ``positives`` best other rows of the same label.  Returns
    ``anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score``.
    ``vectors`` is read twice and should be a table.
    """
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.filter(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(id).cast("bigint").alias("_id"), F.col(label).cast("bigint").alias("_label"),
        F.col(vector).alias("_vector"), is_anchor.alias("_anchor"))
    count, marked, width, largest = rows.agg(
        F.count("*"), F.count_if("_anchor"), F.max(F.size("_vector")),
        F.max(F.array_max(F.transform("_vector", lambda x: F.abs(x.cast("double")))))).first()
    width = width or 0
    if 100 * max(width, 1) * (scale * (largest or 0.0) + 1) ** 2 >= 2.0 ** 62:
        raise ValueError(f"scores of {width} components up to {largest} do not fit 64 bits")
    spread = vectors.sparkSession.sparkContext.defaultParallelism
    parts = _chunks(marked, width, ANCHOR_CHUNK, 1), _chunks(count, width, CANDIDATE_CHUNK, spread)

    anchors = (rows.filter("_anchor").groupBy("_id").agg(F.min(F.struct("_label", "_vector")).alias("_first"))
               .select("_id", "_first._label", "_first._vector"))
    # names of their own, as the anchors come from the same rows
    others = rows.select(F.col("_id").alias("_c_id"), F.col("_label").alias("_c_label"), F.col("_vector").alias("_c_vector"))

    best = Window.partitionBy("_id").orderBy(F.desc("_score"), "_other")
    found = (_met(anchors, others, parts, _positives_of(positives, scale), "_id long, _other long, _score long")
             .withColumn("_slot", F.row_number().over(best)).filter(F.col("_slot") <= positives))
    # at most ``positives`` entries per anchor
    held = found.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("_slot").alias("slot"), F.col("_other").alias("id"), F.col("_score").alias("score")))).alias("_positives"))
    asking = anchors.join(held, "_id")

    inside = Window.partitionBy("_id", "_slot").orderBy(F.desc("_score"), "_other")
    mined = (_met(asking, others, parts, _negatives_of(negatives, low, high, scale), "_id long, _slot long, _other long, _score long")
             .withColumn("_rank", F.row_number().over(inside)).filter(F.col("_rank") <= negatives))
    positive = found.select("_id", F.col("_slot").cast("bigint").alias("_slot"), F.col("_other").alias("positive_id"),
                            F.col("_score").alias("positive_score"))
    return mined.join(positive, ["_id", "_slot"]).select(
        F.col("_id").alias("anchor_id"), "positive_id", F.col("_slot").alias("positive_rank"), F.col("_rank").alias("rank"),
        F.col("_other").alias("negative_id"), "positive_score", F.col("_score").alias("negative_score"))
