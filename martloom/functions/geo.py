"""Distance on the sphere and grid cells for distance joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius and kilometres per degree of latitude.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.19492664455873


def distance_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column, half_angle: bool = True) -> Column:
    """Great-circle distance by the haversine formula.

    ``half_angle=False`` keeps the whole latitude difference in the first sine, for
    results that must agree with reports computed that way.
    """
    lat_turn = F.radians(lat2 - lat1)
    if half_angle:
        lat_turn = lat_turn / 2
    lat_sin = F.sin(lat_turn)
    lng_sin = F.sin(F.radians(lng2 - lng1) / 2)
    chord = lat_sin * lat_sin + F.cos(F.radians(lat2)) * F.cos(F.radians(lat1)) * lng_sin * lng_sin
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def grid_row(lat: Column, radius_km: float) -> Column:
    """Row of the grid: bands of latitude one radius high."""
    return F.floor((lat + 90.0) * (KM_PER_DEGREE / radius_km)).cast("bigint")


def grid_columns(row: Column, radius_km: float) -> Column:
    """Number of columns in a row, so that a column is never narrower than the radius.

    The narrowest latitude of the row and of both neighbours decides; at the poles one
    column is left.
    """
    step = radius_km / KM_PER_DEGREE
    south = row * step - 90.0 - step
    north = row * step - 90.0 + 2 * step
    edge = F.least(F.greatest(F.abs(south), F.abs(north)), F.lit(90.0))
    width = F.lit(step * 1.01) / F.greatest(F.cos(F.radians(edge)), F.lit(1e-6))
    return F.greatest(F.floor(F.lit(360.0) / width), F.lit(1)).cast("bigint")


def grid_column(lng: Column, columns: Column) -> Column:
    """Column of a longitude in a row with the given number of columns."""
    raw = F.floor((lng + 180.0) * columns / 360.0).cast("bigint")
    return F.pmod(raw, columns)


def home_cell(lat: Column, lng: Column, radius_km: float) -> Column:
    """The one cell a point lies in."""
    row = grid_row(lat, radius_km)
    return F.struct(row.alias("row"), grid_column(lng, grid_columns(row, radius_km)).alias("column"))


def cells_around(lat: Column, lng: Column, radius_km: float) -> Column:
    """All cells that can hold points within the radius: at most nine."""
    row = grid_row(lat, radius_km)
    cells = []
    for row_step in (-1, 0, 1):
        near_row = row + row_step
        columns = grid_columns(near_row, radius_km)
        column = grid_column(lng, columns)
        for column_step in (-1, 0, 1):
            cells.append(F.struct(near_row.alias("row"), F.pmod(column + column_step, columns).alias("column")))
    return F.array_distinct(F.array(*cells))


def fine_cell(lat: Column, lng: Column, radius_km: float, levels: int) -> Column:
    """The part of its cell a point lies in, after halving the cell's sides ``levels`` times.

    Shifting row and column right by one gives the part one level up, and by ``levels`` the cell itself.
    """
    parts = 2 ** levels
    row = grid_row(lat, radius_km)
    fine_row = F.floor((lat + 90.0) * (KM_PER_DEGREE / radius_km) * parts).cast("bigint")
    columns = grid_columns(row, radius_km)
    fine_column = F.pmod(F.floor((lng + 180.0) * columns / 360.0 * parts).cast("bigint"), columns * parts)
    return F.struct(fine_row.alias("row"), fine_column.alias("column"))


def may_reach(lat: Column, lng: Column, row: Column, column: Column, parts: Column, home_row: Column, radius_km: float) -> Column:
    """Whether some point of a part of a cell can lie within the radius: false only where none can.

    ``row`` and ``column`` count parts, of which a cell has ``parts`` by ``parts``; ``home_row`` is the
    row of the cell.  The bound takes the haversine of both gaps, the second at the latitude nearest to a pole.
    """
    height = F.lit(radius_km / KM_PER_DEGREE) / parts
    south = row * height - 90.0
    north = south + height
    lat_gap = F.greatest(F.lit(0.0), south - lat, lat - north)
    width = F.lit(360.0) / (grid_columns(home_row, radius_km) * parts)
    middle = (column + 0.5) * width - 180.0
    turn = F.pmod(lng - middle + 540.0, F.lit(360.0)) - 180.0
    lng_gap = F.least(F.greatest(F.lit(0.0), F.abs(turn) - width / 2), F.lit(180.0))
    edge = F.least(F.greatest(F.abs(lat), F.abs(south), F.abs(north)), F.lit(90.0))
    lat_sin, lng_sin = F.sin(F.radians(lat_gap) / 2), F.sin(F.radians(lng_gap) / 2)
    chord = lat_sin * lat_sin + F.pow(F.cos(F.radians(edge)), 2) * lng_sin * lng_sin
    return chord <= F.pow(F.sin(F.lit(radius_km / EARTH_RADIUS_KM / 2)), 2) * (1 + 1e-9) + 1e-18
