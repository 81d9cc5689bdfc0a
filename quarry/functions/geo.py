"""Distance, bounding boxes, grid cells and polygon tests as Columns."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.7714

# Metres per distance unit.
UNIT_METRES = {
    "millimeters": 0.001,
    "centimeters": 0.01,
    "inch": 0.0254,
    "feet": 0.3048,
    "yards": 0.9144,
    "meters": 1.0,
    "kilometers": 1000.0,
    "miles": 1609.344,
    "nauticalmiles": 1852.0,
}

# Degrees of the cells of each level, half of those of the level before.
CELL_DEGREES = [16.0 / 2**level for level in range(15)]
BOX_CELLS = 12  # a box uses the finest level at which it touches no more


def metres(radius: Column, unit: Column) -> Column:
    factor = F.lit(None).cast("double")
    for name, value in UNIT_METRES.items():
        factor = F.when(F.lower(unit) == name, F.lit(value)).otherwise(factor)
    return radius * factor


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), 2
    )
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


# Cosines differ from exact ones by far less; closer pairs are measured by ``haversine``.
_COSINE_MARGIN = 1e-12


def unit_vector(lat: Column, lon: Column, prefix: str) -> dict[str, Column]:
    """A place as columns ``prefix``x, y, z of a point on the unit sphere."""
    a, b = F.radians(lat), F.radians(lon)
    return {f"{prefix}x": F.cos(a) * F.cos(b), f"{prefix}y": F.cos(a) * F.sin(b), f"{prefix}z": F.sin(a)}


def radius_cosine(radius_m: Column) -> Column:
    """Cosine of the angle of a radius; below every cosine where it reaches round the earth."""
    angle = radius_m / EARTH_RADIUS_M
    return F.when(angle >= math.pi, -2.0).otherwise(F.cos(angle))


def within(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_m: Column, cosine: Column, least_cosine: Column) -> Column:
    """``haversine`` at most ``radius_m``, decided by the cosine of the angle between the places where it is not close."""
    return (
        F.when(cosine > least_cosine + _COSINE_MARGIN, True).when(cosine < least_cosine - _COSINE_MARGIN, False)
        .otherwise(haversine(lat1, lon1, lat2, lon2) <= radius_m)
    )


def circle_box(lat: Column, lon: Column, radius_m: Column) -> dict[str, Column]:
    """Smallest latitude/longitude box around a circle.

    Of a circle across the date line the box runs from ``west`` over 180 degrees to a smaller
    ``east``. One that reaches a pole gets the whole longitude range; the exact distance test
    follows anyway.
    """
    dlat = F.degrees(radius_m / EARTH_RADIUS_M) + 1e-9
    south, north = lat - dlat, lat + dlat
    ratio = F.sin(F.radians(dlat)) / F.cos(F.radians(lat))
    dlon = F.when((F.abs(lat) + dlat < 90) & (ratio < 1), F.degrees(F.asin(ratio)) + 1e-9).otherwise(
        360.0
    )
    whole = (dlon >= 180) | (F.abs(lon) > 180)
    west, east = lon - dlon, lon + dlon
    return {
        "south": F.greatest(south, F.lit(-90.0)),
        "north": F.least(north, F.lit(90.0)),
        "west": F.when(whole, -180.0).when(west < -180, west + 360).otherwise(west),
        "east": F.when(whole, 180.0).when(east > 180, east - 360).otherwise(east),
    }


def in_box(lat: Column, lon: Column) -> Column:
    """Whether a point lies in the box of columns south, north, west, east; west may lie beyond the date line."""
    south, north, west, east = (F.col(c) for c in ("south", "north", "west", "east"))
    across = F.when(west <= east, lon.between(west, east)).otherwise((lon >= west) | (lon <= east))
    return lat.between(south, north) & across


def zone_box(zone: Column) -> dict[str, Column]:
    """Bounding box of a ring of [lon, lat] pairs."""
    lons = F.transform(zone, lambda p: F.get(p, 0))
    lats = F.transform(zone, lambda p: F.get(p, 1))
    return {
        "south": F.array_min(lats),
        "north": F.array_max(lats),
        "west": F.array_min(lons),
        "east": F.array_max(lons),
    }


def point_in_zone(lat: Column, lon: Column, zone: Column) -> Column:
    """Crossing parity of a ring of [lon, lat] pairs; the ring closes itself."""
    rotated = F.concat(F.slice(zone, 2, F.size(zone) - 1), F.slice(zone, 1, 1))
    edges = F.arrays_zip(zone.alias("p"), rotated.alias("q"))

    def crosses(edge: Column) -> Column:
        x1, y1 = F.get(edge.getField("p"), 0), F.get(edge.getField("p"), 1)
        x2, y2 = F.get(edge.getField("q"), 0), F.get(edge.getField("q"), 1)
        return ((y1 > lat) != (y2 > lat)) & (lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)

    return (F.size(zone) >= 3) & (F.size(F.filter(edges, crosses)) % 2 == 1)


# Rings of up to so many corners are tested column by column.
SHORT_RING = 8


def _corner(i: int) -> tuple[str, str]:
    return f"ring_x{i}", f"ring_y{i}"


def ring_columns(zone: Column) -> dict[str, Column]:
    """Corners of a short closed ring as columns, null past its end; ``zone`` stays for longer rings only."""
    n, columns = F.size(zone), {}
    for i in range(SHORT_RING + 1):
        corner = F.when((n <= SHORT_RING) & (n >= i), F.get(zone, F.when(n > i, F.lit(i)).otherwise(F.lit(0))))
        columns |= {name: F.get(corner, at) for at, name in enumerate(_corner(i))}
    return columns | {"zone": F.when(n > SHORT_RING, zone)}


def point_in_ring(lat: Column, lon: Column) -> Column:
    """``point_in_zone`` of ``ring_columns``, which generated code can do without arrays."""

    def crosses(i: int) -> Column:
        (x1, y1), (x2, y2) = (map(F.col, _corner(j)) for j in (i, i + 1))
        return F.when(((y1 > lat) != (y2 > lat)) & (lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1), 1).otherwise(0)

    crossings = reduce(lambda a, b: a + b, [crosses(i) for i in range(SHORT_RING)])
    return F.when(F.col("zone").isNull(), crossings % 2 == 1).otherwise(point_in_zone(lat, lon, F.col("zone")))


def _row(lat: Column, step) -> Column:
    return F.floor((lat + 90) / step).cast("int")


def _col(lon: Column, step) -> Column:
    return F.floor((lon + 180) / step).cast("int")


def cells_of_point(lat: Column, lon: Column, levels: list[int]) -> Column:
    """The point's cell at each level asked for."""
    return F.array(*[
        F.named_struct(F.lit("level"), F.lit(n), F.lit("row"), _row(lat, CELL_DEGREES[n]), F.lit("col"), _col(lon, CELL_DEGREES[n])) for n in levels
    ])


def _n_cells(south: Column, north: Column, west: Column, east: Column, step) -> Column:
    columns = _col(east, step) - _col(west, step) + 1
    across = columns + F.ceil(F.lit(360.0) / step).cast("int") + 1
    rows = (_row(north, step) - _row(south, step) + 1).cast("bigint")
    return rows * F.when(west <= east, columns).otherwise(across)


def level_of_box(south: Column, north: Column, west: Column, east: Column) -> Column:
    """The finest level at which a box touches few cells, the coarsest for the largest boxes."""
    level = F.lit(0)
    for n, step in enumerate(CELL_DEGREES):
        level = F.when(_n_cells(south, north, west, east, step) <= BOX_CELLS, F.lit(n)).otherwise(level)
    return level


def cells_of_box(south: Column, north: Column, west: Column, east: Column, level: Column) -> Column:
    """The cells of its level that a box touches, on both sides of the date line where it lies across."""
    step = F.element_at(F.array(*[F.lit(d) for d in CELL_DEGREES]), level + 1)
    rows = F.sequence(_row(south, step), _row(north, step))
    last = _col(F.lit(180.0), step)
    cols = F.when(west <= east, F.sequence(_col(west, step), _col(east, step))).otherwise(
        F.array_union(F.sequence(_col(west, step), last), F.sequence(F.lit(0), _col(east, step)))
    )
    return F.flatten(
        F.transform(
            rows,
            lambda r: F.transform(
                cols,
                lambda c: F.named_struct(
                    F.lit("level"), level, F.lit("row"), r, F.lit("col"), c
                ),
            ),
        )
    )
