"""Joins: skew-safe lookups, null-aware exclusion, scalars, pairs sharing a key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import cut_lineage
from martloom.sizing import BROADCAST_ROWS, broadcast_if_bounded, is_bounded

# Facts of one key that one task takes, most keys that are dealt over several tasks,
# pieces of the facts without a key, and rows of either side in one tile of a self-join.
PIECE_ROWS = 1_000_000
HEAVY_KEYS = 10_000
NULL_PIECES = 64
TILE_ROWS = 4_096


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner",
                bound: int = BROADCAST_ROWS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Join facts to a lookup that has one row per key, whatever the skew of the facts.

    A lookup within its bounds of rows and bytes is broadcast and the facts do not move.
    Otherwise both are shuffled, and only keys with many facts are dealt over several tasks.
    """
    if how not in ("inner", "left"):
        raise ValueError("a lookup keeps the fact side: use inner or left")
    if is_bounded(lookup, bound):
        return facts.join(F.broadcast(lookup), on, how)
    return salted_join(facts, lookup, on, how, piece_rows)


def salted_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner",
                piece_rows: int = PIECE_ROWS, most_heavy: int = HEAVY_KEYS) -> DataFrame:
    """Shuffled join that deals the facts of heavy keys over tasks of about ``piece_rows`` rows.

    Facts are counted per key first, with map-side combine.  A key is heavy with more than
    ``piece_rows`` facts, or more than one in ``most_heavy`` of all, so there are at most
    ``most_heavy`` of them to broadcast, each with its number of pieces.  Only their lookup rows
    are repeated.  The piece of a fact follows from its columns and its input partition, so equal
    facts spread too and a repeated task deals them the same way.  Facts with a null key match
    nothing; in a left join they are dealt at random.
    """
    counts = facts.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    if how == "inner" and (most or 0) <= piece_rows:
        return facts.join(lookup, on, how)
    least = max(piece_rows, (total or 0) // most_heavy)
    heavy = F.broadcast(counts.filter(F.col("_n") > least).select(*on, F.ceil(F.col("_n") / least).cast("int").alias("_pieces")))
    scattered = F.xxhash64(*[F.col(c) for c in facts.columns], F.spark_partition_id())
    known = F.coalesce("_pieces", F.when(_any_null(on), F.lit(NULL_PIECES)).otherwise(1))
    dealt = facts.withColumn("_scattered", scattered).join(heavy, on, "left").withColumn(
        "_piece", F.pmod(F.col("_scattered"), known).cast("int")).drop("_scattered", "_pieces")
    repeated = lookup.join(heavy, on, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_pieces")
    return dealt.join(repeated, [*on, "_piece"], how).drop("_piece")


def join_in_pieces(left: DataFrame, right: DataFrame, on: str, pieces: int, how: str = "inner") -> DataFrame:
    """Join on a key with few rows each, both sides dealt by it over ``pieces``: a task sorts one piece, whatever the session's width.

    The result stays dealt by ``on``, so a grouping that starts from this key needs no further shuffle.
    """
    if how != "left_semi":  # the planner moves a semi join below the shuffle of its left side, which follows the right one
        left = left.repartition(pieces, on)
    return left.join(right.repartition(pieces, on), on, how)


def lookup_in_pieces(facts: DataFrame, lookup: DataFrame, on: str, pieces: int, how: str = "inner") -> DataFrame:
    """The same where a lookup within its bounds of rows and bytes is broadcast and the facts do not move."""
    return facts.join(F.broadcast(lookup), on, how) if is_bounded(lookup) else join_in_pieces(facts, lookup, on, pieces, how)


def _any_null(names: list[str]) -> Column:
    found = F.lit(False)
    for name in names:
        found |= F.col(name).isNull()
    return found


def not_in(df: DataFrame, key: str, excluded: DataFrame, excluded_key: str) -> DataFrame:
    """``key NOT IN (excluded)`` with SQL null rules and without a forced broadcast.

    One null in a non-empty exclusion list leaves nothing; a null key is kept only when
    the list is empty.  The planner's own null-aware anti join always copies the list to
    every task; here the list is shuffled like any other side.
    """
    listed = excluded.select(F.col(excluded_key).alias(key))
    total = listed.agg(F.count("*").alias("n")).scalar()
    known = listed.agg(F.count(key).alias("n")).scalar()
    kept = df.join(listed.filter(F.col(key).isNotNull()), key, "left_anti")
    return kept.filter((total == 0) | (F.col(key).isNotNull() & (known == total))).select(*df.columns)


def has_match(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows with at least one partner (semi join)."""
    return df.join(other.select(*on), on, "left_semi")


def has_no_match(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a partner (anti join); keys must not be null."""
    return df.join(other.select(*on), on, "left_anti")


def partner_counts(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """How many other members share the key with each member, without forming the pairs.

    The members are written once, so that what leads to ``df`` is not worked out again for each use of them.
    """
    members = cut_lineage(df.select(*keys, member).distinct())
    sizes = members.groupBy(*keys).agg((F.count("*") - 1).alias("partners"))
    return lookup_join(members, sizes, keys)


def pairs_sharing(df: DataFrame, keys: list[str], member: str, close: Column | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Pairs ``left, right`` of different members that agree on all ``keys``.

    Meant for keys that already narrow the partners (a zone plus a grid cell plus a
    channel); ``close`` is a further condition over the aliases ``l`` and ``r``, the same both ways, that is
    checked inside the join.  Each unordered pair is formed once and mirrored at the end.
    The pairs of a key with more than ``tile_rows`` rows are formed in tiles, see ``pair_tiles``.
    """
    left, right = (side.alias(name) for name, side in zip("lr", pair_tiles(df, keys, member, tile_rows)))
    one, other = F.col(f"l.{member}"), F.col(f"r.{member}")
    # within one block the smaller member comes first, between blocks the smaller block does
    condition = F.when(F.col("l._tile.i") == F.col("l._tile.j"), one < other).otherwise(one != other)
    for key in [*keys, "_tile"]:
        condition &= F.col(f"l.{key}") == F.col(f"r.{key}")
    if close is not None:
        condition &= close
    once = left.join(right, condition).select(F.least(one, other).alias("left"), F.greatest(one, other).alias("right")).distinct()
    return mirrored(once, "left", "right")


def pair_tiles(df: DataFrame, keys: list[str], member: str, tile_rows: int = TILE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides of a self-join on ``keys`` with ``_tile``, so that every unordered pair of rows meets in one tile.

    A key with more than ``tile_rows`` rows has its members dealt over blocks; a row of block ``b`` stands
    left in the tiles ``(b, j)`` from ``b`` on and right in ``(i, b)`` up to ``b``.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > tile_rows)
    heavy = broadcast_if_bounded(counts.select(*keys, F.ceil(F.col("_n") / tile_rows).cast("int").alias("_blocks")))
    blocks = F.coalesce("_blocks", F.lit(1))
    dealt = df.join(heavy, keys, "left").withColumn("_block", F.pmod(F.xxhash64(member), blocks).cast("int"))

    def side(first: Column, last: Column, tile: Callable[[Column], Column]) -> DataFrame:
        return (dealt.withColumn("_other", F.explode(F.sequence(first, last)))
                .withColumn("_tile", tile(F.col("_other"))).drop("_other", "_block", "_blocks"))

    own = F.col("_block")
    return (side(own, blocks - 1, lambda j: F.struct(own.alias("i"), j.alias("j"))),
            side(F.lit(0), own, lambda i: F.struct(i.alias("i"), own.alias("j"))))


def mirrored(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Both directions of edges given once each, in one pass."""
    both = F.explode(F.array(
        F.struct(F.col(left).alias(left), F.col(right).alias(right)),
        F.struct(F.col(right).alias(left), F.col(left).alias(right)))).alias("_edge")
    others = [c for c in edges.columns if c not in (left, right)]
    return edges.select(both, *others).select(f"_edge.{left}", f"_edge.{right}", *others)


def merge_by_key(frames: list[DataFrame], key: str) -> DataFrame:
    """Outer-join frames that are already one row per key."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.join(frame, key, "full")
    return merged


def with_base_rate(rates: DataFrame, days: DataFrame, base: int, day: str = "day",
                   code: str = "currency_code", rate: str = "rate") -> DataFrame:
    """Rates plus a rate of 1 for the base currency on each day, replacing its own rows."""
    base_rows = days.select(day, F.lit(base).cast("bigint").alias(code), F.lit(1.0).alias(rate))
    others = rates.filter(F.col(code) != base).select(day, code, rate)
    return others.unionByName(base_rows)


__all__ = ["lookup_join", "salted_join", "join_in_pieces", "lookup_in_pieces", "not_in", "has_match", "has_no_match", "partner_counts",
           "pairs_sharing", "pair_tiles", "mirrored", "merge_by_key", "with_base_rate", "broadcast_if_bounded"]
