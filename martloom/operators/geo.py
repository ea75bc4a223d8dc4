"""Nearest place and within-distance joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from martloom.functions.geo import cells_around, distance_km, fine_cell, home_cell, may_reach
from martloom.session import cut_lineage
from martloom.sizing import BROADCAST_ROWS, LITERAL_ROWS, broadcast_if_bounded, is_bounded, rows_if_bounded

# Widest grid of the nearest-place search, rows of either side that one tile of a distance
# join holds, and times a dense cell's sides are halved.
FAR_KM = 1_600.0
TILE_ROWS = 4_096
LEVELS = 5


def nearest_place(points: DataFrame, places: DataFrame, key: str, lat: str = "lat", lng: str = "lon",
                  half_angle: bool = True, bound: int = LITERAL_ROWS) -> DataFrame:
    """Add ``zone_id``, the id of the nearest place (``id, lat, lng``); ties go to the lowest id.

    Up to ``bound`` places become one constant array of the plan and every point is settled where it
    lies, with no join and no shuffle.  More places than that are searched over a grid, or, for the
    distance with the whole angle, which is not small for near points only, block by block.
    Every path gives the same ids, row by row, whatever ``key`` holds.  A point without
    coordinates gets no place.
    """
    sites = places.select(F.col("id").cast("bigint"), F.col("lat").cast("double"), F.col("lng").cast("double"))
    rows = rows_if_bounded(sites, bound)
    if rows is None:
        return nearest_by_grid(points, sites, lat, lng, bound) if half_angle else _nearest_by_blocks(points, sites, lat, lng, False, bound)
    nearest = _nearest_of(rows, lat, lng, half_angle)["id"] if rows else F.lit(None).cast("bigint")
    return points.withColumn("zone_id", nearest)


def _nearest_of(rows: list[Row], lat: str, lng: str, half_angle: bool) -> Column:
    """Struct ``distance, id`` of the nearest of the listed places; null without coordinates."""
    # made of constants only, so the optimizer folds it into one literal
    listed = F.expr("array(" + ", ".join(
        f"named_struct('id', {row.id}L, 'lat', {row.lat!r}D, 'lng', {row.lng!r}D)" for row in rows) + ")")
    # the point is bound once per row, not worked out again for every place
    here = F.array(F.struct(F.col(lat).alias("lat"), F.col(lng).alias("lng")))
    best = F.transform(here, lambda at: F.array_min(F.transform(listed, lambda p: F.struct(
        distance_km(p["lat"], p["lng"], at["lat"], at["lng"], half_angle).alias("distance"), p["id"].alias("id")))))[0]
    return F.when(F.col(lat).isNotNull() & F.col(lng).isNotNull(), best)


def _nearest_by_blocks(points: DataFrame, places: DataFrame, lat: str, lng: str, half_angle: bool, bound: int) -> DataFrame:
    """Nearest place with the places as constants, ``bound`` of them (by hash of the id) at a time."""
    blocks = max(1, -(-places.count() // max(1, bound // 2)))
    best = points.withColumn("_best", F.lit(None).cast("struct<distance:double,id:bigint>"))
    for block in range(blocks):
        rows = places.filter(F.pmod(F.xxhash64("id", "lat", "lng"), F.lit(blocks)) == block).collect()
        if rows:
            best = best.withColumn("_best", F.least("_best", _nearest_of(rows, lat, lng, half_angle)))
    return best.withColumn("zone_id", F.col("_best.id")).drop("_best")


def nearest_by_grid(points: DataFrame, places: DataFrame, lat: str = "lat", lng: str = "lon", bound: int = LITERAL_ROWS,
                    first_radius_km: float = 25.0, most_listed: int = BROADCAST_ROWS // 9) -> DataFrame:
    """Exact nearest place for any number of places.

    Points look for places within a radius over a grid of that size; whoever finds none goes on
    with four times the radius.  The few that lie farther than ``FAR_KM`` from every place are
    compared with the places block by block, because a grid that coarse has only a few cells.
    Up to ``most_listed`` places are broadcast, listed by the cells they may be reached from, and points
    stay where they lie; more of them meet the points in tiles, see ``within_distance``.
    Rows are told apart by a number of their own, so keys may repeat or be null.
    """
    sites = places.select("id", F.col("lat").alias("_plat"), F.col("lng").alias("_plng"))
    if is_bounded(sites, most_listed):
        return _nearest_by_listed_cells(points, sites, lat, lng, bound, first_radius_km)
    numbered = cut_lineage(points.withColumn("_row", F.monotonically_increasing_id()))
    open_points = numbered.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull()).select("_row", lat, lng)
    found, radius = [], first_radius_km
    while radius <= FAR_KM:
        # the places go to the cells around them, so that each point lies in one cell only
        near = within_distance(sites, open_points, radius, ("_plat", "_plng"), (lat, lng))
        settled = cut_lineage(near.groupBy("_row").agg(F.min(F.struct("distance", "id"))["id"].alias("zone_id")))
        found.append(settled)
        open_points = cut_lineage(open_points.join(settled, "_row", "left_anti"))
        radius *= 4
        if open_points.isEmpty():
            break
    else:
        found.append(_nearest_by_blocks(open_points, places, lat, lng, True, bound).select("_row", "zone_id"))
    zones = reduce(DataFrame.unionByName, found)
    return numbered.join(zones, "_row", "left").drop("_row")


def _nearest_by_listed_cells(points: DataFrame, sites: DataFrame, lat: str, lng: str, bound: int, first_radius_km: float) -> DataFrame:
    """``nearest_by_grid`` for places of bounded number: every radius is one broadcast lookup by the cell of a point."""
    searched, radius, at = points.withColumn("_zone", F.lit(None).cast("bigint")), first_radius_km, (F.col(lat), F.col(lng))
    while radius <= FAR_KM:
        listed = cut_lineage(sites.withColumn("_cell", F.explode(cells_around(F.col("_plat"), F.col("_plng"), radius)))
                             .groupBy("_cell").agg(F.collect_list(F.struct("id", "_plat", "_plng")).alias("_listed")))
        here = F.array(F.struct(at[0].alias("lat"), at[1].alias("lng"), F.col("_listed").alias("listed")))
        near = F.transform(here, lambda p: F.array_min(F.filter(F.transform(p["listed"], lambda q: F.struct(
            distance_km(q["_plat"], q["_plng"], p["lat"], p["lng"]).alias("distance"), q["id"].alias("id"))),
            lambda found: found["distance"] <= radius)))[0]["id"]
        # a point that has its place keeps it and looks nothing up
        searched = (searched.withColumn("_cell", F.when(F.col("_zone").isNull(), home_cell(*at, radius)))
                    .join(F.broadcast(listed), "_cell", "left").withColumn("_zone", F.coalesce("_zone", near)).drop("_cell", "_listed"))
        radius *= 4
    searched = cut_lineage(searched)
    far = F.col("_zone").isNull() & at[0].isNotNull() & at[1].isNotNull()
    if searched.filter(far).isEmpty():
        return searched.withColumnRenamed("_zone", "zone_id")
    places = sites.select("id", F.col("_plat").alias("lat"), F.col("_plng").alias("lng"))
    settled = _nearest_by_blocks(searched.filter(far).drop("_zone"), places, lat, lng, True, bound)
    return searched.filter(~far).withColumnRenamed("_zone", "zone_id").unionByName(settled)


def within_distance(left: DataFrame, right: DataFrame, radius_km: float, left_at: tuple[str, str], right_at: tuple[str, str],
                    on: list[str] | None = None, once: tuple[str, str] | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Pairs not farther apart than ``radius_km``, with their ``distance``; they also agree on the columns ``on``.

    The left side is copied to the (at most nine) cells around it, the right side lies in
    its own cell; the equi-join on the cell is followed by the exact distance test.  Where a cell
    holds more than ``tile_rows`` rows of a side it is split, see ``tiled``; each pair still meets in one place only.

    ``once`` names the ids of the two sides when both hold the same points: each unordered pair then comes once, from
    the smaller cell, or from the smaller id within one cell, and half of the copies are not made.
    """
    near, placed = tiled(left, right, radius_km, left_at, right_at, on, once, tile_rows)
    keys = [*(on or []), "_cell", "_tile"] if "_tile" in near.columns else [*(on or []), "_cell"]
    apart = distance_km(F.col(left_at[0]), F.col(left_at[1]), F.col(right_at[0]), F.col(right_at[1]))
    met = near.join(placed, keys)
    if once:
        met = met.filter((F.col("_home") != F.col("_cell")) | (F.col(once[0]) < F.col(once[1]))).drop("_home")
    return met.withColumn("distance", apart).filter(F.col("distance") <= radius_km).drop("_cell", "_tile")


def tiled(left: DataFrame, right: DataFrame, radius_km: float, left_at: tuple[str, str], right_at: tuple[str, str],
          on: list[str] | None = None, once: tuple[str, str] | None = None, tile_rows: int = TILE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides of a distance join with their keys: ``on``, ``_cell`` and, where some cell is dense, ``_tile``.

    Rows are counted per cell first.  A cell with more than ``tile_rows`` left or right rows becomes a
    quadtree: parts with more than ``tile_rows`` right rows are quartered, up to ``LEVELS`` times, and
    what is denser still is dealt by the hash of the rows.  A left row goes only to the parts it may reach.
    The left rows of a cell are dealt by hash as well, and the right rows are repeated for each
    such block, so no tile has more than about ``tile_rows`` rows of either side.  Rows that agree in all columns stay together.
    """
    keys = [*(on or []), "_cell"]
    spread = left.withColumn("_cell", F.explode(cells_around(F.col(left_at[0]), F.col(left_at[1]), radius_km)))
    if once:
        spread = (spread.withColumn("_home", home_cell(F.col(left_at[0]), F.col(left_at[1]), radius_km))
                  .filter(F.col("_cell") >= F.col("_home")))
    placed = right.withColumn("_cell", home_cell(F.col(right_at[0]), F.col(right_at[1]), radius_km))
    counts = (spread.groupBy(*keys).agg(F.count("*").alias("_left"))
              .join(placed.groupBy(*keys).agg(F.count("*").alias("_right")), keys, "full"))
    crowded = cut_lineage(counts.filter((F.col("_left") > tile_rows) | (F.col("_right") > tile_rows)).select(
        *keys, F.ceil(F.col("_left") / tile_rows).cast("int").alias("_blocks"), (F.col("_left") + F.col("_right")).isNull().alias("_alone")))
    if crowded.isEmpty():
        return spread, placed

    # rows of a crowded cell that the other side does not reach meet nobody
    alone = broadcast_if_bounded(crowded.filter("_alone").select(*keys))
    spread, placed = spread.join(alone, keys, "left_anti"), placed.join(alone, keys, "left_anti")
    dense = crowded.filter("NOT _alone").drop("_alone")
    fine = fine_cell(F.col(right_at[0]), F.col(right_at[1]), radius_km, LEVELS)
    parts = cut_lineage(_leaves(placed.withColumn("_fine", fine).join(broadcast_if_bounded(dense), keys), keys, tile_rows))
    # a few rows per dense cell, tested against each left row near it
    leaves = broadcast_if_bounded(cut_lineage(parts.groupBy(*keys, "_blocks", "_level", "_leaf").agg(F.max("_pieces").alias("_pieces"))))
    whole = F.struct(F.lit(0).alias("level"), F.lit(0).cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("column"),
                     F.lit(0).alias("piece"), F.lit(0).alias("block"))

    def tile(piece: Column, block: Column) -> Column:
        split = F.struct(F.col("_level").alias("level"), F.col("_leaf.row").alias("row"), F.col("_leaf.column").alias("column"),
                         piece.alias("piece"), block.alias("block"))
        return F.when(F.col("_level").isNull(), whole).otherwise(split)

    def numbers(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)) - 1))

    reach = may_reach(F.col(left_at[0]), F.col(left_at[1]), F.col("_leaf.row"), F.col("_leaf.column"),
                      F.pow(F.lit(2.0), F.col("_level")), F.col("_cell.row"), radius_km)
    block = F.pmod(F.xxhash64(*left.columns), F.col("_blocks")).cast("int")
    near = (spread.join(leaves, keys, "left").filter(F.col("_level").isNull() | reach)
            .withColumn("_piece", numbers(F.col("_pieces"))).withColumn("_tile", tile(F.col("_piece"), block)))
    piece = F.pmod(F.xxhash64(*right.columns), F.col("_pieces")).cast("int")
    dealt = (placed.withColumn("_fine", fine).join(broadcast_if_bounded(parts), [*keys, "_fine"], "left")
             .withColumn("_block", numbers(F.col("_blocks"))).withColumn("_tile", tile(piece, F.col("_block"))))
    extra = ["_level", "_leaf", "_pieces", "_piece", "_blocks", "_block", "_fine"]
    return near.drop(*extra), dealt.drop(*extra)


def _leaves(rows: DataFrame, keys: list[str], tile_rows: int) -> DataFrame:
    """The leaf that each occupied finest part of a dense cell belongs to: ``_level``, ``_leaf`` and ``_pieces``.

    A cell has at most ``4 ** LEVELS`` parts, so the windows of the roll-up are bounded; all of
    them lie in the partition of their cell.
    """
    counted = rows.groupBy(*keys, "_blocks", "_fine").agg(F.count("*").alias("_n"))
    level, leaf, most = F.lit(None).cast("int"), F.lit(None).cast("struct<row:bigint,column:bigint>"), F.lit(None).cast("bigint")
    for depth in range(LEVELS + 1):
        up = LEVELS - depth
        counted = counted.withColumns({f"_row{depth}": F.shiftright("_fine.row", up), f"_column{depth}": F.shiftright("_fine.column", up)})
        counted = counted.withColumn(f"_n{depth}", F.sum("_n").over(Window.partitionBy(*keys, f"_row{depth}", f"_column{depth}")))
    for depth in reversed(range(LEVELS + 1)):
        fits = (F.col(f"_n{depth}") <= tile_rows) | F.lit(depth == LEVELS)
        level = F.when(fits, F.lit(depth)).otherwise(level)
        leaf = F.when(fits, F.struct(F.col(f"_row{depth}").alias("row"), F.col(f"_column{depth}").alias("column"))).otherwise(leaf)
        most = F.when(fits, F.col(f"_n{depth}")).otherwise(most)
    return counted.select(*keys, "_blocks", "_fine", level.alias("_level"), leaf.alias("_leaf"),
                          F.ceil(most / tile_rows).cast("int").alias("_pieces"))
