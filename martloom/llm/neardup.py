"""Near-duplicate groups by circulant MinHash.

A document is the set of its distinct 5-word shingles.  Two fixed permutations make all
signature coordinates: the first scatters the shingles over the universe of 2^32 places,
and coordinate ``k`` is the least value of the second one after a circular shift by ``k``.
Bands of coordinates are the buckets in which similar documents meet.

Work is kept linear in the rows:

* equal sets are one class from the start, so copies never become pairs;
* every member of a bucket is first compared with the bucket's smallest member only;
* what then still lies in different groups of a bucket, members outside its largest group
  against all, is compared in blocks of bounded size; members of a bucket with too many of
  them meet instead where they share one of their rarest shingles, as every pair at the
  threshold does, so no link of such a bucket is lost;
* pairs pass an estimate on one byte per coordinate, set far below the threshold, before
  the exact similarity of their whole sets decides.

A pair at similarity 0.75 is missed by all 40 bands of 5 with probability 2e-5 and by the
estimate with 2e-6; at 0.85 by the bands with 3e-11.  Groups are connected components of the confirmed links.

Empty and null texts have no shingles and are linked with nothing, they are their own
component.  Rows without an id are linked with nothing; their component is null and they are
kept.  Repeated rows give equal results; rows that share an id but not the text are linked
as soon as one of the texts is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import in_slices, mix, shingle_set, sieve, unused, utf8
from martloom.session import cut_lineage
from martloom.sizing import broadcast_if_bounded

BANDS, ROWS = 40, 5
COORDINATES = BANDS * ROWS
PERCENT = 75
# Agreeing coordinates below which the whole sets of a pair are not compared: at similarity 0.75
# the count is 150 with deviation 6.1, so 122 is 4.6 deviations away.
AGREEING = 122
BLOCK = 256
DIVIDE_ABOVE = 2048
PLACES = 1 << 16  # of the table that tells rare shingles from frequent ones
_SEED = np.uint64(0x5851F42D4C957F2D)


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


# the circular shifts of the coordinates; odd steps keep neighbouring shifts apart
_SHIFTS = (np.arange(COORDINATES, dtype=np.uint64) * np.uint64(0x9E3779B1)).astype(np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a non-empty shingle set."""
    places = mix(shingles ^ _SEED).astype(np.uint32)
    out = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    step = max(1, 65_536 // len(places))
    for at in range(0, COORDINATES, step):  # a slice of coordinates that stays in cache
        for low in range(0, len(places), 65_536):
            shifted = places[low:low + 65_536] + _SHIFTS[at:at + step, None]
            np.minimum(out[at:at + step], _second_permutation(shifted).min(axis=1), out=out[at:at + step])
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, bands, marks``: what is known of each text's set."""
    @F.arrow_udf("n_shingles bigint, digest binary, bands array<bigint>, marks binary")
    def sketched(texts: pa.Array) -> pa.Array:
        sizes, digests, bands, marks = [], [], [], []
        for raw in utf8(texts):
            shingles = shingle_set(raw)
            sizes.append(len(shingles))
            if not len(shingles):
                digests.append(None), bands.append(None), marks.append(None)
                continue
            sig = signature(shingles)
            digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            bands.append(np.array([xxhash.xxh3_64_intdigest(sig[b:b + ROWS].tobytes(), seed=b)
                                   for b in range(0, COORDINATES, ROWS)], np.uint64).view(np.int64))
            marks.append(sig.astype(np.uint8).tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
            names=["n_shingles", "digest", "bands", "marks"])
    return docs.select("doc_id", sketched("text").alias("s")).select("doc_id", "s.*")


def _agreeing(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose signatures do not rule out the threshold."""
    @F.arrow_udf("boolean")
    def close(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(side.to_pylist()), np.uint8).reshape(-1, COORDINATES) for side in (left, right))
        return pa.array((a == b).sum(axis=1) >= AGREEING)
    left = marks.select(F.col("rep").alias("a"), F.col("marks").alias("marks_a"))
    right = marks.select(F.col("rep").alias("b"), F.col("marks").alias("marks_b"))
    return pairs.join(left, "a").join(right, "b").filter(close("marks_a", "marks_b")).select("a", "b").distinct()


def reaches(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted shingle sets have the similarity that makes a link."""
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)


def shingle_bytes(texts: DataFrame) -> DataFrame:
    """``rep, shingles``: the whole shingle sets of ``doc_id, text`` as sorted 64-bit numbers."""
    @F.arrow_udf("binary")
    def packed(values: pa.Array) -> pa.Array:
        return pa.array([shingle_set(raw).tobytes() for raw in utf8(values)], pa.binary())
    return texts.select(F.col("doc_id").alias("rep"), packed("text").alias("shingles"))


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole shingle sets reach the threshold, each once."""
    @F.arrow_udf("boolean")
    def similar(left: pa.Array, members: pa.Array) -> pa.Array:
        out = []
        for a, rows in zip(in_slices(left), in_slices(members)):
            sides = [[np.frombuffer(r["shingles"], np.uint64) for r in rows if (r["rep"] == a) == first] for first in (True, False)]
            out.append(any(reaches(x, y) for x in sides[0] for y in sides[1]))
        return pa.array(out, pa.bool_())

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep"), "a", "b")
    return (wanted.join(sets, "rep").groupBy("a", "b").agg(F.collect_list(F.struct("rep", "shingles")).alias("members"))
            .filter(similar("a", "members")).select("a", "b"))


def _several_groups(rows: DataFrame) -> DataFrame:
    """Rows ``key, rep, label`` of buckets with more than one label, with the most frequent one as ``main``.

    ``n`` is the size of the bucket and ``few`` its members outside the main group.
    """
    counts = rows.groupBy("key", "label").agg(F.count("*").alias("c"))
    sizes = cut_lineage(counts.groupBy("key").agg(
        F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top")).filter("n > top.c")
        .select("key", "n", F.col("top.label").alias("main"), (F.col("n") - F.col("top.c")).alias("few")))
    return rows.join(sizes, "key")


def _in_blocks(rows: DataFrame, marks: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Links between different groups within a bucket; without ``sets``, the pairs whose signatures allow one.

    Every such pair has a member outside the bucket's main group.  Those members, in blocks, meet
    all members, in blocks; a task compares the signatures of two blocks and then the whole sets
    of the pairs that these allow.
    """
    blocks_few, blocks_all = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("few", "n"))
    marked = rows.join(marks, "rep")
    marked = marked.withColumn("shingles", F.lit(None).cast("binary")) if sets is None else marked.join(sets, "rep")
    few = (marked.filter("label <> main").withColumn("i", F.pmod(F.xxhash64("rep"), blocks_few).cast("int"))
           .withColumn("j", F.explode(F.sequence(F.lit(0), blocks_all - 1))))
    every = (marked.withColumn("j", F.pmod(F.xxhash64("rep"), blocks_all).cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), blocks_few - 1))))
    columns = ["key", "i", "j", "rep", "label", "marks", "shingles"]
    met = few.select(*columns, F.lit(True).alias("outside")).unionByName(every.select(*columns, F.lit(False).alias("outside")))

    whole = sets is not None

    def compare(group: pa.Table) -> pa.Table:
        rep, label, outside = (group.column(c).to_numpy() for c in ("rep", "label", "outside"))
        sig = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        known = [np.frombuffer(raw or b"", np.uint64) for raw in group.column("shingles").to_pylist()]
        inside, found = np.flatnonzero(~outside), set()
        for x in np.flatnonzero(outside):
            near = inside[((sig[inside] == sig[x]).sum(axis=1) >= AGREEING) & (label[inside] != label[x])]
            found.update((min(rep[x], rep[y]), max(rep[x], rep[y])) for y in near if not whole or reaches(known[x], known[y]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})
    return met.groupBy("key", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()


def remaining_links(members: DataFrame, labels: DataFrame, marks: DataFrame, bands: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that the comparison with the leaders has left open: between different groups in a bucket.

    The leader of a bucket was compared with all its members, so it is done.
    """
    rest = (members.filter((F.col("n") > 2) & (F.col("rep") != F.col("leader"))).join(labels, "rep", "left")
            .select("key", "rep", F.coalesce("label", "rep").alias("label")))
    rows = cut_lineage(_several_groups(cut_lineage(rest)))
    links = _in_blocks(rows.filter(F.col("few") <= DIVIDE_ABOVE), marks, sets)
    crowded = cut_lineage(rows.filter(F.col("few") > DIVIDE_ABOVE).select("rep", "label").distinct())
    if crowded.isEmpty():
        return links
    return links.unionByName(_by_rare_shingles(crowded, marks, bands, sets)).distinct()


def _by_rare_shingles(rows: DataFrame, marks: DataFrame, bands: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different groups among ``rep, label`` for pairs that have a band in common.

    With shingles in one order for all sets, two sets at the threshold share one among the first
    quarter (and one more) of each.  Rare ones go first, so a passage that many texts share does not bring
    them together.  Rareness is counted in a table of fixed size; any counts would give the same links.
    """
    known = cut_lineage(rows.join(sets, "rep"))

    def count(tables):
        total = np.zeros(PLACES, np.int64)
        for table in tables:
            for raw in table.column("shingles").to_pylist():
                total += np.bincount((np.frombuffer(raw, np.uint64) % np.uint64(PLACES)).astype(np.int64), minlength=PLACES)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": pa.array(held, pa.int64()), "n": pa.array(total[held], pa.int64())})

    often = np.zeros(PLACES, np.int64)
    for place, n in known.select("shingles").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n")).collect():
        often[place] = n

    @F.arrow_udf("array<bigint>")
    def rarest(values: pa.Array) -> pa.Array:
        out = []
        for raw in values.to_pylist():
            x = np.frombuffer(raw, np.uint64)
            order = np.lexsort((x, often[(x % np.uint64(PLACES)).astype(np.int64)]))
            out.append(x[order[:len(x) + (-PERCENT * len(x)) // 100 + 1]].view(np.int64))
        return pa.array(out, pa.list_(pa.int64()))

    met = cut_lineage(known.select(F.explode(rarest("shingles")).alias("key"), "rep", "label"))
    pairs = _in_blocks(cut_lineage(_several_groups(met)), marks)
    sides = [bands.select(F.col("rep").alias(c), F.col("bands").alias(f"bands_{c}")) for c in ("a", "b")]
    shared = pairs.join(sides[0], "a").join(sides[1], "b").filter(F.arrays_overlap("bands_a", "bands_b")).select("a", "b")
    return confirm(cut_lineage(shared), sets)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for links ``a, b``: the smallest node reachable.

    Each round takes the least label among the neighbours and then the label of that label,
    and is written to the shared folder; the rounds end when no label changes.
    """
    edges = cut_lineage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut_lineage(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")))
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        over = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = cut_lineage(lower.join(over, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("above", "label")).alias("label")))
        if moved.filter("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
        labels = moved.select("node", "label")


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``."""
    docs = docs.select("doc_id", "text")
    sketches = cut_lineage(sketch(docs))
    known = sketches.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = cut_lineage(known.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"), F.any_value("marks").alias("marks")))
    marks, bands = classes.select("rep", "marks"), classes.select("rep", "bands")

    buckets = bands.select("rep", F.explode("bands").alias("key"))
    sizes = cut_lineage(buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("leader")).filter("n > 1"))
    members = cut_lineage(buckets.join(sizes, "key"))
    pairs = members.filter("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    met = cut_lineage(members.select(F.col("rep").alias("doc_id")).distinct())
    # only texts that meet another one move
    sets = cut_lineage(shingle_bytes(sieve(docs, "doc_id", met).join(met, "doc_id", "left_semi")))

    star = cut_lineage(confirm(_agreeing(pairs, marks), sets))
    labels = components(star)
    rest = remaining_links(members, labels.select(F.col("node").alias("rep"), F.col("component").alias("label")), marks, bands, sets)
    groups = components(labels.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(rest))
    by_digest = (classes.select("digest", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("digest", F.coalesce("component", "rep").alias("component")))
    component = F.coalesce("component", "doc_id")
    return (sketches.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                    (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept")))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does: the smallest id.

    Rows repeated as a whole all have that id and all stay.
    """
    other = unused(docs, "_id")
    dropped = cut_lineage(duplicate_groups(docs).filter(~F.col("kept")).select(F.col("doc_id").alias(other)).distinct())
    return docs.join(broadcast_if_bounded(dropped), F.col("doc_id") == F.col(other), "left_anti")
