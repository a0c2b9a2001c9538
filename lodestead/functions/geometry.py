"""Points, rings and the grid, as column expressions.

Coordinates are degrees (WGS84), distances metres on the sphere.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in metres.
EARTH_RADIUS_M = 6_371_008.8


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


# --- GeoJSON ---------------------------------------------------------------


def geojson_type(geometry: Column) -> Column:
    return F.get_json_object(geometry, "$.type")


def geojson_point(geometry: Column) -> Column:
    """``[lon, lat]`` of a point, null for other geometries."""
    return F.when(
        geojson_type(geometry) == "Point",
        F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<double>"),
    )


def geojson_rings(geometry: Column) -> Column:
    """All rings of a polygon or multipolygon: outer ones and holes alike."""
    coordinates = F.get_json_object(geometry, "$.coordinates")
    rings = F.when(
        geojson_type(geometry) == "Polygon", F.from_json(coordinates, "array<array<array<double>>>")
    ).when(
        geojson_type(geometry) == "MultiPolygon",
        F.flatten(F.from_json(coordinates, "array<array<array<array<double>>>>")),
    )
    return F.transform(
        rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    )


def rings_bounds(rings: Column) -> Column:
    xs = F.flatten(F.transform(rings, lambda r: r["x"]))
    ys = F.flatten(F.transform(rings, lambda r: r["y"]))
    return F.struct(
        F.array_min(xs).alias("west"), F.array_min(ys).alias("south"),
        F.array_max(xs).alias("east"), F.array_max(ys).alias("north"),
    )


def _segments(ring: Column) -> Column:
    following = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.arrays_zip(F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))).alias("a"), following.alias("b"))


def rings_segments(rings: Column) -> Column:
    """Closed rings to segments ``(x1, y1, x2, y2)``."""
    pairs = F.flatten(F.transform(rings, _segments))
    return F.transform(
        pairs,
        lambda s: F.struct(
            s["a"]["x"].alias("x1"), s["a"]["y"].alias("y1"), s["b"]["x"].alias("x2"), s["b"]["y"].alias("y2")
        ),
    )


def _at(s: Column, lat: Column) -> Column:
    """Where a side, carried on, meets a parallel."""
    return s["x1"] + F.try_divide((s["x2"] - s["x1"]) * (lat - s["y1"]), s["y2"] - s["y1"])


def _spans(s: Column, lat: Column) -> Column:
    return (s["y1"] > lat) != (s["y2"] > lat)


def segments_contain(segments: Column, lon: Column, lat: Column) -> Column:
    """Even-odd rule over all rings: a ray to the east crosses an odd number of sides."""
    return F.size(F.filter(segments, lambda s: _spans(s, lat) & (lon < _at(s, lat)))) % 2 == 1


def turns_along(s: Column | Mapping[str, Column], from_x: Column, from_y: Column, lat: Column) -> Column:
    """Whether a side changes the even-odd rule on the way along a meridian, from one parallel to another.

    Ties are decided as the ray to the east decides them: the side counts by where its eastern end lies.
    """
    east_end = F.when(s["x1"] > from_x, s["y1"]).otherwise(s["y2"])

    def beyond(y: Column) -> Column:
        """How the part east of the meridian, up to the eastern end, is met at a parallel."""
        return (_spans(s, y) & F.coalesce(_at(s, y) > from_x, F.lit(False))) != (east_end > y)

    return ((s["x1"] > from_x) != (s["x2"] > from_x)) & (beyond(lat) != beyond(from_y))


def turns_across(s: Column | Mapping[str, Column], from_x: Column, lon: Column, lat: Column) -> Column:
    """Whether a side changes the even-odd rule on the way west along a parallel, from a meridian to a point."""
    at = _at(s, lat)
    return _spans(s, lat) & F.coalesce((lon < at) & (at <= from_x), F.lit(False))


def segments_between(segments: Column, from_x: Column, from_y: Column, lon: Column, lat: Column) -> Column:
    """Whether the even-odd rule differs between two points, the second not east of the first.

    The way goes along the first point's meridian, then west.  Only sides that
    touch the rectangle between the points matter, so a cell's own sides are
    enough for points of the cell.
    """
    turns = lambda s: turns_along(s, from_x, from_y, lat) != turns_across(s, from_x, lon, lat)
    return F.size(F.filter(segments, turns)) % 2 == 1


def touches(s: Column | Mapping[str, Column], west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether a side touches a rectangle that its bounds touch; with a margin, so that none is missed by rounding."""
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    # Else the rectangle's centre is farther from the side's line than the rectangle reaches across it.
    off = F.abs(dx * ((south + north) / 2 - s["y1"]) - dy * ((west + east) / 2 - s["x1"]))
    reach = (F.abs(dx) * (north - south) + F.abs(dy) * (east - west)) / 2
    return off <= reach * (1 + 1e-9) + (F.abs(dx) + F.abs(dy)) * 1e-12


def rings_centroid(rings: Column) -> Column:
    """Area-weighted centre of the outer ring (the first one)."""
    sides = rings_segments(F.slice(rings, 1, 1))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, s: Column) -> Column:
        cross = s["x1"] * s["y2"] - s["x2"] * s["y1"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (s["x1"] + s["x2"]) * cross).alias("x"),
            (acc["y"] + (s["y1"] + s["y2"]) * cross).alias("y"),
        )

    return F.aggregate(
        sides, zero, add,
        lambda t: F.struct(
            F.try_divide(t["x"], 3 * t["a"]).alias("lon"), F.try_divide(t["y"], 3 * t["a"]).alias("lat")
        ),
    )


# --- grid ------------------------------------------------------------------
# Level L cuts the globe into square cells of 360 / 2**L degrees.


def cell_step(level: int) -> float:
    return 360.0 / 2**level


def cell_x(lon: Column, level: int) -> Column:
    return F.pmod(F.floor((lon + 180.0) / cell_step(level)), F.lit(2**level)).cast("bigint")


def cell_y(lat: Column, level: int) -> Column:
    return F.floor((lat + 90.0) / cell_step(level)).cast("bigint")


def cell_center(x: Column, y: Column, step: Column) -> tuple[Column, Column]:
    return (x + 0.5) * step - 180.0, (y + 0.5) * step - 90.0


def cell_reach(lat_center: Column, step: Column) -> Column:
    """No point of a cell is farther than this from its centre.

    Half a cell along a parallel plus half a cell along a meridian, with a
    margin for rounding.
    """
    nearest = F.greatest(F.abs(lat_center) - step / 2, F.lit(0.0))
    half = F.radians(step / 2) * EARTH_RADIUS_M
    return half * (1 + F.cos(F.radians(nearest))) * (1 + 1e-9) + 1e-3
