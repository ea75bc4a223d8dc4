"""The trie of conversation prefixes: every distinct sequence of first turns is a node.

Nodes.  Turns are range-sorted by conversation and place.  A scan gives each its depth and the
digest of the prefix it ends; what a conversation brings from earlier partitions is one small state per
partition, so a conversation may be spread over any number of tasks.  Equal digests (polynomials over
the turns' SHA-256 in a field of 2**127 - 1 elements) are one node.

Runs.  Where a node and its only child have the same members, they lie on one run.  All of a
run's nodes have the same smallest member and number of members, and no other run has both.  A trie of n
conversations has fewer than 2 n runs, however long the conversations are.

Totals of subtrees, by time-forward processing.  A run's totals travel to the run above it as a
message.  Runs with more members than a bound are the crown; below it hang shards, whole subtrees.
Each task sorts the runs of its shards in reverse level order and reads them once, with the
messages in a priority queue that spills.  What arrives at shard roots is added up per crown run, and the
crown, whose size depends on the number of partitions and not on the data, is read in the same way.

Digests of the ends are taken over ids in range order, joined in tasks to blocks of bounded size; SHA-256
cannot be split, so one task then reads the blocks of a node in turn.

Defined cases: rows with a null conversation id take no part; null roles and texts are empty; a null
turn number comes first; equal turn numbers follow in the order of the turns' digests, and rows that
repeat are turns of their own; an empty table gives an empty trie without a root; further columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import cut_lineage, shared_dir
from martloom.sizing import broadcast_if_bounded

_FIELD = 2 ** 127 - 1
_POINT = 0x5A17C3E96B08D4F1729E4B60C8D3F5A7
QUEUE_HELD = 200_000  # messages a task keeps in memory
BLOCK_IDS = 100_000  # ids in one block of a digest
MOST_HEADS = 8
_OUT = 8_192  # rows of an Arrow batch made here

State = tuple[int, int, int]  # turns so far, value of the polynomial, bytes so far


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, number, digest, n_bytes``: the turns of each conversation, numbered from 1; texts go no further."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    whole = F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said)
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("_turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"), F.octet_length(said[1]).cast("bigint").alias("n_bytes"))
    # the last key cuts through rows that repeat
    order = [F.col("conv"), F.col("_turn").asc_nulls_first(), F.col("digest"), F.col("_row")]
    numbered = _scanned(rows.withColumn("_row", F.monotonically_increasing_id()), order)
    return numbered.select("conv", F.col("depth").alias("number"), "digest", "n_bytes")


def heads_of(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its five."""
    return F.crc32(conv.cast("string").cast("binary")) % (MOST_HEADS + 1)


def spliced(turns: DataFrame) -> DataFrame:
    """Every conversation with its first turns replaced by those of the conversation ``conv - conv % 5``.

    It takes that one's first ``heads_of`` turns, or all if there are fewer, and goes on with its own turns
    after as many.  ``number`` keeps the order but may have gaps.
    """
    own = turns.filter(F.col("number") > heads_of(F.col("conv")))
    near = turns.filter((F.col("conv") % 5 == 0) & (F.col("number") <= MOST_HEADS)).withColumn(
        "_to", F.explode(F.array(*[F.try_add(F.col("conv"), F.lit(k).cast("bigint")) for k in range(-4, 5)])))
    lent = near.filter((F.col("_to") - F.col("_to") % 5 == F.col("conv")) & (F.col("number") <= heads_of(F.col("_to"))))
    there = turns.filter("number = 1").select(F.col("conv").alias("_to"))
    taken = lent.join(there, "_to", "left_semi").select(F.col("_to").alias("conv"), "number", "digest", "n_bytes")
    return own.unionByName(taken)


def prefix_trie(turns: DataFrame, members: DataFrame, bound: int | None = None, held: int = QUEUE_HELD) -> DataFrame:
    """All nodes of the trie of ``turns`` (``conv, number, digest, n_bytes``) and of ``members`` (``conv``), which lists
    every conversation once, those without turns included.

    Returns ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` and
    ``ends_sha256``.  ``bound`` parts the crown from the shards and ``held`` is what a queue keeps in
    memory; neither changes the result.
    """
    spark = turns.sparkSession
    roots = members.select("conv", F.lit(0).cast("bigint").alias("number"), F.lit(None).cast("binary").alias("digest"),
                           F.lit(0).cast("bigint").alias("n_bytes"))
    places = cut_lineage(_scanned(turns.select("conv", "number", "digest", "n_bytes").unionByName(roots),
                                  [F.col("conv"), F.col("number")]).drop("digest"))
    # all but the prefix depend on it
    nodes = cut_lineage(places.groupBy("prefix", "depth", "parent", "n_bytes", "upto")
                        .agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")))
    if bound is None:
        shards = 8 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        bound = max(1, members.count() // shards)

    runs = cut_lineage(nodes.groupBy("conv_id", "n_convs").agg(
        F.max_by("prefix", "depth").alias("prefix"), F.min_by("parent", "depth").alias("parent"),
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max("upto").alias("bottom_upto"),
        ((F.col("n_convs") - 1) * (F.max("upto") - F.min(F.col("upto") - F.col("n_bytes")))).alias("weight")))
    totals = _subtree_totals(places, nodes, runs, bound, held)

    above = runs.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("above_conv"))
    known = (runs.join(totals, "prefix").join(above, "parent", "left")
             .select("conv_id", "n_convs", "top", "bottom", "bottom_upto", "n_leaves", "below", "above_conv",
                     F.col("n_children").alias("bottom_children")))
    ends = _end_digests(places.filter("is_last").select("prefix", "conv"))
    after = F.col("bottom_upto") - F.col("upto") + F.col("n_bytes")
    return nodes.join(ends, "prefix", "left").join(known, ["conv_id", "n_convs"]).select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"),
        F.when(F.col("depth") == F.col("top"), F.col("above_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(F.col("depth") == F.col("bottom"), F.col("bottom_children")).otherwise(1).alias("n_children"),
        "n_leaves", (F.col("below") + (F.col("n_convs") - 1) * after).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def _joined(first: State, second: State) -> State:
    """The state after two stretches of turns."""
    return first[0] + second[0], (first[1] * pow(_POINT, second[0], _FIELD) + second[1]) % _FIELD, first[2] + second[2]


def _after(state: State, digest: bytes | None, n_bytes: int) -> State:
    """The state after one more turn; a row without a digest only stands for its conversation."""
    if digest is None:
        return state
    return state[0] + 1, (state[1] * _POINT + int.from_bytes(digest) % _FIELD + 1) % _FIELD, state[2] + n_bytes


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes | None, int, int]]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in ("conv", "digest", "n_bytes", "part")))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of bounded size."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_STRETCHES = pa.schema([("part", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("first_state", pa.binary()), ("last_state", pa.binary())])
_PLACES = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("prefix", pa.binary()),
                     ("parent", pa.binary()), ("upto", pa.int64()), ("is_last", pa.bool_())])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per partition: its first and its last conversation and what it holds of them."""
    first = last = opening = part = None
    state: State = (0, 0, 0)
    for conv, digest, n_bytes, part in _turns(batches):
        if conv != last:
            if last is None:
                first = conv
            elif opening is None:
                opening = state
            last, state = conv, (0, 0, 0)
        state = _after(state, digest, n_bytes)
    if last is not None:
        row = part, first, last, pickle.dumps(opening or state), pickle.dumps(state)
        yield from _batches(iter([row]), _STRETCHES)


def _scanned(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in ``order`` (conversation first) with depth, prefix, parent prefix, bytes up to here and whether they are
    their conversation's last.

    The sorted rows are checkpointed, so that both scans see the same partitions.  One row per
    partition comes to the driver, and goes back where a conversation crosses into a partition.
    """
    shared_dir(rows.sparkSession)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "digest", "n_bytes", F.spark_partition_id().alias("part")).checkpoint()
    parts = sorted(tuple(r) for r in placed.mapInArrow(
        _stretches, "part long, first long, last long, first_state binary, last_state binary").collect())
    carried, goes_on, conv, state = {}, set(), None, (0, 0, 0)
    for place, (part, first, last, opening, closing) in enumerate(parts):
        if first == conv:
            carried[part] = state
            goes_on.add(parts[place - 1][0])
        state = _joined(state, pickle.loads(opening)) if first == last == conv else pickle.loads(closing)
        conv = last

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            state, before, waiting, part = (0, 0, 0), None, None, None
            for conv, digest, n_bytes, part in _turns(batches):
                if before is None:
                    state = carried.get(part, state)
                elif conv != before:
                    state = (0, 0, 0)
                if waiting is not None:
                    yield *waiting, conv != before
                parent, state, before = state, _after(state, digest, n_bytes), conv
                waiting = (conv, state[0], digest, n_bytes, state[1].to_bytes(16), parent[1].to_bytes(16) if digest is not None else None, state[2])
            if waiting is not None:
                yield *waiting, part not in goes_on

        yield from _batches(found(), _PLACES)

    return placed.mapInArrow(scan, "conv long, depth long, digest binary, n_bytes long, prefix binary, parent binary, upto long, is_last boolean")


class SpillingQueue:
    """A priority queue of tuples that keeps ``held`` of them in memory and the others in sorted temporary files.

    The files have no name and belong to one task, like the spills of Spark's own sort.
    """

    def __init__(self, held: int = QUEUE_HELD, most_files: int = 32) -> None:
        self.held, self.most_files = held, most_files
        self._heap: list[tuple] = []
        self._files: list[tuple] = []  # heap of (head, number, the rest)
        self._number = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self.held:
            self._spill(iter(sorted(self._heap)))
            self._heap = []
            if len(self._files) > self.most_files:
                files, self._files = self._files, []
                self._spill(heapq.merge(*(itertools.chain([head], rest) for head, _, rest in files)))

    def _spill(self, items: Iterator[tuple]) -> None:
        file = tempfile.TemporaryFile()
        for item in items:
            pickle.dump(item, file)
        file.seek(0)
        self._number += 1
        rest = _read(file)
        heapq.heappush(self._files, (next(rest), self._number, rest))

    def first(self) -> tuple | None:
        """The smallest item, still in the queue."""
        heads = [h for h in (self._heap[0] if self._heap else None, self._files[0][0] if self._files else None) if h is not None]
        return min(heads, default=None)

    def pop(self) -> tuple:
        if not self._files or self._heap and self._heap[0] <= self._files[0][0]:
            return heapq.heappop(self._heap)
        head, number, rest = self._files[0]
        after = next(rest, None)
        if after is None:
            heapq.heappop(self._files)
        else:
            heapq.heapreplace(self._files, (after, number, rest))
        return head


def _read(file) -> Iterator[tuple]:
    with file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


_TOTALS = pa.schema([("prefix", pa.binary()), ("parent", pa.binary()), ("is_root", pa.bool_()), ("n_children", pa.int64()),
                     ("n_leaves", pa.int64()), ("below", pa.int64()), ("total", pa.int64())])
_SENT = ["prefix", "parent", "top", "bottom", "weight", "is_root", "in_children", "in_leaves", "in_saved"]


def _passed_up(held: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of runs that arrive in reverse level order, by messages to the run above."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        queue = SpillingQueue(held)
        for batch in batches:
            for prefix, parent, top, bottom, weight, is_root, children, leaves, below in zip(*(batch[c].to_pylist() for c in _SENT)):
                # what was sent to this run stands at the head, as runs and messages have one order
                while (head := queue.first()) is not None and head[:2] == (-bottom, prefix):
                    queue.pop()
                    children, leaves, below = children + 1, leaves + head[2], below + head[3]
                leaves = leaves or 1
                if not is_root:
                    queue.push((1 - top, parent, leaves, below + weight))
                yield prefix, parent, is_root, children, leaves, below, below + weight

    return lambda batches: _batches(totals(batches), _TOTALS)


def _subtree_totals(places: DataFrame, nodes: DataFrame, runs: DataFrame, bound: int, held: int) -> DataFrame:
    """``prefix, n_children, n_leaves, below`` per run: children of its last node, leaves, and what is saved below it."""
    schema = "prefix binary, parent binary, is_root boolean, n_children long, n_leaves long, below long, total long"
    in_order = [F.desc("bottom"), F.col("prefix")]
    none = {name: F.lit(0).cast("bigint") for name in ("in_children", "in_leaves", "in_saved")}
    # the shard of a run is the first node below the crown on the way of its smallest member
    crown = broadcast_if_bounded(nodes.filter(F.col("n_convs") > bound).select("prefix", F.lit(True).alias("_crown")))
    shards = (places.select("conv", "depth", "prefix").join(crown, "prefix", "left").filter(F.col("_crown").isNull())
              .groupBy(F.col("conv").alias("conv_id")).agg(F.min(F.struct("depth", "prefix")).alias("_root")))
    light = (runs.filter(F.col("n_convs") <= bound).join(shards, "conv_id")
             .withColumn("is_root", F.col("top") == F.col("_root.depth")).withColumns(none)
             .repartition(F.col("_root.prefix")).sortWithinPartitions(*in_order).select(*_SENT))
    low = cut_lineage(light.mapInArrow(_passed_up(held), schema))
    sent = (low.filter("is_root AND parent IS NOT NULL").groupBy(F.col("parent").alias("prefix"))
            .agg(F.count("*").alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("total").alias("in_saved")))
    high = (runs.filter(F.col("n_convs") > bound).join(sent, "prefix", "left").fillna(0, list(none))
            .withColumn("is_root", F.col("parent").isNull())
            .repartition(1).sortWithinPartitions(*in_order).select(*_SENT).mapInArrow(_passed_up(held), schema))
    return low.unionByName(high).select("prefix", "n_children", "n_leaves", "below")


_BLOCKS = pa.schema([("prefix", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
_DIGESTS = pa.schema([("prefix", pa.binary()), ("ends_sha256", pa.string())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of a node in order, joined by commas, in blocks."""

    def joined() -> Iterator[tuple]:
        node, ids = None, []
        for batch in batches:
            for prefix, conv in zip(batch["prefix"].to_pylist(), batch["conv"].to_pylist()):
                if ids and (prefix != node or len(ids) == BLOCK_IDS):
                    yield node, ids[0], ",".join(map(str, ids))
                    ids = []
                node = prefix
                ids.append(conv)
        if ids:
            yield node, ids[0], ",".join(map(str, ids))

    yield from _batches(joined(), _BLOCKS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its blocks, which arrive in order."""

    def taken() -> Iterator[tuple]:
        node, digest = None, None
        for batch in batches:
            for prefix, ids in zip(batch["prefix"].to_pylist(), batch["ids"]):
                if digest is not None and prefix == node:
                    digest.update(b",")
                else:
                    if digest is not None:
                        yield node, digest.hexdigest()
                    node, digest = prefix, hashlib.sha256()
                digest.update(ids.as_buffer())
        if digest is not None:
            yield node, digest.hexdigest()

    yield from _batches(taken(), _DIGESTS)


def _end_digests(ends: DataFrame) -> DataFrame:
    """``prefix, ends_sha256``: SHA-256 of the ids of the conversations that end at a node."""
    blocks = (ends.repartitionByRange("prefix", "conv").sortWithinPartitions("prefix", "conv")
              .mapInArrow(_blocks, "prefix binary, first long, ids string"))
    return (blocks.repartition("prefix").sortWithinPartitions("prefix", "first").select("prefix", "ids")
            .mapInArrow(_digests, "prefix binary, ends_sha256 string"))
