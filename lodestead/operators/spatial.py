"""Areas containing a point, points of interest nearby, nearest point.

All three work on distinct coordinates and join the result back, so many
listings at one coordinate cost as much as one.  Candidate pairs come from
equality joins on grid cells, never from a join on distance.  Crowded cells
are split into smaller ones instead of being paired point by point.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.geometry import (
    EARTH_RADIUS_M,
    cell_center,
    cell_reach,
    cell_step,
    cell_x,
    cell_y,
    haversine,
    rings_bounds,
    rings_segments,
    segments_between,
    segments_contain,
    touches,
    turns_across,
    turns_along,
)
from lodestead.operators.projections import union_all
from lodestead.session import written_once

_FINEST = 20
_SPLIT = 3  # levels per split: a cell becomes 8 x 8 cells
_FEW_CELLS = 9  # up to this level the globe has at most 132,000 cells


def _places(df: DataFrame, lon: str, lat: str) -> DataFrame:
    return df.select(F.col(lon).alias("lon"), F.col(lat).alias("lat")).na.drop().distinct()


def _join_back(df: DataFrame, per_place: DataFrame, lon: str, lat: str) -> DataFrame:
    renamed = per_place.withColumnRenamed("lon", "_lon").withColumnRenamed("lat", "_lat")
    return df.join(renamed, (F.col(lon) == F.col("_lon")) & (F.col(lat) == F.col("_lat")), "left").drop("_lon", "_lat")


# --- areas containing a point ----------------------------------------------

_DEEPEST = 42  # cells of 360 / 2 ** 42 degrees; doubles tell little more apart


_SIDE = ("x1", "y1", "x2", "y2")
_AREA_CELL = ["_a", "level", "x", "y"]


def area_cells(areas: DataFrame, columns: Sequence[str], rings: str = "rings", leaf_segments: int = 32) -> DataFrame:
    """Outlines cut into cells: (columns, level, x, y, east, south, corner, segments).

    An area begins in the at most four cells, of about its own size, that its
    bounds touch.  A cell with more than ``leaf_segments`` sides is cut into
    8 x 8, and each part has the sides that touch it.  A part without any lies
    wholly inside, and answers without a test, or wholly outside, and is left
    out.  ``corner`` tells whether the south-eastern corner is inside; from
    there the sides of the cell are enough to decide for every point of it.

    Sides are rows, dealt by cell, so one long outline is work for many tasks.
    There are as many rounds as the densest place of an outline needs.
    """
    own = areas.select(*columns, rings_segments(F.col(rings)).alias("_s"), rings_bounds(F.col(rings)).alias("_b"))
    own = written_once(own.filter("_b.west is not null").withColumn("_a", F.monotonically_increasing_id()), "areas")
    extent = F.greatest(F.col("_b.east") - F.col("_b.west"), F.col("_b.north") - F.col("_b.south"))
    level = F.least(F.lit(_FINEST), F.floor(F.log2(F.lit(360.0) / F.greatest(extent, F.lit(1e-9))))).cast("int")
    placed = own.select("_a", "_s", "_b", level.alias("level"))
    first = placed.select("*", F.explode(_cell_range("_b.west", "_b.east", 180.0)).alias("x"))
    first = _with_edges(first.select("*", F.explode(_cell_range("_b.south", "_b.north", 90.0)).alias("y")))
    cells = first.select(*_AREA_CELL, "east", "south", segments_contain(F.col("_s"), F.col("east"), F.col("south")).alias("corner"))
    sides = _touched(placed.select("_a", "level", F.explode("_s").alias("_e")).select("_a", "level", "_e.*"))
    done = []
    while True:
        sides = written_once(sides, "area-sides")
        counted = cells.join(sides.groupBy(*_AREA_CELL).agg(F.count("*").alias("n")), _AREA_CELL, "left")
        counted = written_once(counted.filter("n is not null or corner"), "area-cells")
        crowded = (F.coalesce("n", F.lit(0)) > leaf_segments) & (F.col("level") + _SPLIT <= _DEEPEST)
        whole = counted.filter(~crowded)
        lists = sides.join(whole.select(*_AREA_CELL), _AREA_CELL, "left_semi").groupBy(*_AREA_CELL).agg(
            F.collect_list(F.struct(*_SIDE)).alias("segments")
        )
        done.append(whole.join(lists, _AREA_CELL, "left"))
        cut = counted.filter(crowded).select(*_AREA_CELL, "east", "south", "corner")
        if cut.isEmpty():
            break
        sides = sides.join(cut.select(*_AREA_CELL), _AREA_CELL, "left_semi")
        cells, sides = _parts_of(cut, sides), _touched(sides.withColumn("level", F.col("level") + _SPLIT), within=True)
    found = union_all(done)
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    return found.join(own.select("_a", *columns), "_a").select(
        *columns, "level", "x", "y", "east", "south", "corner", F.coalesce("segments", none).alias("segments")
    )


def _level_step() -> Column:
    return F.lit(360.0) / F.pow(F.lit(2.0), F.col("level"))


def _cell_range(low: str, high: str, shift: float) -> Column:
    """The cells from one coordinate to another, with both neighbours of a border."""
    return F.sequence(
        F.ceil((F.col(low) + shift) / _level_step() - 1e-9).cast("bigint") - 1,
        F.floor((F.col(high) + shift) / _level_step() + 1e-9).cast("bigint"),
    )


def _with_edges(cells: DataFrame) -> DataFrame:
    step = _level_step()
    return cells.withColumns({
        "west": F.col("x") * step - 180.0, "south": F.col("y") * step - 90.0,
        "east": (F.col("x") + 1) * step - 180.0, "north": (F.col("y") + 1) * step - 90.0,
    })


def _touched(sides: DataFrame, within: bool = False) -> DataFrame:
    """A row for each side and cell of ``level`` that it touches; with ``within`` only parts of the cell it is in."""
    ends = sides.withColumns({
        "w": F.least("x1", "x2"), "e": F.greatest("x1", "x2"), "s": F.least("y1", "y2"), "n": F.greatest("y1", "y2"),
    })
    known = ends.withColumnsRenamed({"x": "_x", "y": "_y"}) if within else ends
    cells = known.withColumn("x", F.explode(_cell_range("w", "e", 180.0)))
    if within:
        cells = cells.filter(F.shiftright("x", _SPLIT) == F.col("_x"))
    cells = cells.withColumn("y", F.explode(_cell_range("s", "n", 90.0)))
    if within:
        cells = cells.filter(F.shiftright("y", _SPLIT) == F.col("_y"))
    side = {c: F.col(c) for c in _SIDE}
    edges = [F.col(c) for c in ("west", "south", "east", "north")]
    return _with_edges(cells).filter(touches(side, *edges)).select(*_AREA_CELL, *_SIDE)


def _parts_of(cut: DataFrame, sides: DataFrame) -> DataFrame:
    """The 8 x 8 parts of cells, each with its corner, which follows from the cell's corner and sides."""
    side = 2**_SPLIT
    held = sides.join(cut.select(*_AREA_CELL, "east", "south"), _AREA_CELL)
    step = _level_step() / side
    row = F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias("j")
    rows = held.select("*", row).select("*", ((F.col("y") * side + F.col("j")) * step - 90.0).alias("lat"))
    s = {c: F.col(c) for c in _SIDE}
    along = turns_along(s, F.col("east"), F.col("south"), F.col("lat"))
    across = [turns_across(s, F.col("east"), (F.col("x") * side + i + 1) * step - 180.0, F.col("lat")) for i in range(side)]
    turns = rows.groupBy(*_AREA_CELL, "j").agg(F.array(*[F.count_if(along != c) % 2 == 1 for c in across]).alias("turned"))
    parts = cut.select("*", row).join(turns, [*_AREA_CELL, "j"], "left").select(
        "*", F.posexplode(F.coalesce("turned", F.array_repeat(F.lit(False), side))).alias("i", "_turned")
    )
    parts = parts.select(
        "_a", (F.col("level") + _SPLIT).alias("level"), (F.col("x") * side + F.col("i")).alias("x"),
        (F.col("y") * side + F.col("j")).alias("y"), (F.col("corner") != F.col("_turned")).alias("corner"),
    )
    return _with_edges(parts).select(*_AREA_CELL, "east", "south", "corner")


def areas_containing(
    listings: DataFrame, areas: DataFrame, columns: Sequence[str], rings: str = "rings",
    lon: str = "lon", lat: str = "lat", leaf_segments: int = 32,
) -> DataFrame:
    """Left join of each listing with the areas whose rings contain it (even-odd rule).

    The outlines are cut into cells (:func:`area_cells`), which are written
    once; a point looks into its cell at each level in use and is tested with
    that cell's sides at most.
    """
    cells = written_once(area_cells(areas, columns, rings, leaf_segments), "area-cells").select(
        *columns, *[F.col(c).alias(f"_{c}") for c in ("level", "x", "y", "east", "south", "corner", "segments")]
    )
    # At most 43 values.
    levels = sorted(r[0] for r in cells.select("_level").distinct().collect())
    if not levels:
        return listings.select("*", *[F.lit(None).cast(t).alias(c) for c, t in areas.select(*columns).dtypes])
    at = F.array(
        *[
            F.struct(
                F.lit(n).alias("_level"),
                F.floor((F.col("lon") + 180.0) / cell_step(n)).alias("_x"),
                F.floor((F.col("lat") + 90.0) / cell_step(n)).alias("_y"),
            )
            for n in levels
        ]
    )
    places = _places(listings, lon, lat).select("lon", "lat", F.explode(at).alias("_c")).select("lon", "lat", "_c.*")
    turned = segments_between(F.col("_segments"), F.col("_east"), F.col("_south"), F.col("lon"), F.col("lat"))
    inside = F.when(F.size("_segments") == 0, F.col("_corner")).otherwise(F.col("_corner") != turned)
    found = places.join(cells, ["_level", "_x", "_y"]).filter(inside).select("lon", "lat", *columns)
    return _join_back(listings, found, lon, lat)


# --- cell tables -----------------------------------------------------------


def _with_cells(points: DataFrame, levels: Sequence[int]) -> DataFrame:
    cells = F.array(
        *[
            F.struct(
                F.lit(n).alias("level"), cell_x(F.col("lon"), n).alias("x"), cell_y(F.col("lat"), n).alias("y")
            )
            for n in levels
        ]
    )
    return points.withColumn("_c", F.explode(cells)).select("*", "_c.*").drop("_c")


def _cell_table(points: DataFrame, levels: Sequence[int], sums: Sequence[str]) -> DataFrame:
    """Per cell and level: number of distinct coordinates and the summed counts."""
    return (
        _with_cells(points, levels)
        .groupBy("level", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums])
    )


def _center_distance() -> tuple[Column, Column]:
    step = F.lit(360.0) / F.pow(F.lit(2.0), F.col("level"))
    lon_c, lat_c = cell_center(F.col("x"), F.col("y"), step)
    return haversine(F.col("lon"), F.col("lat"), lon_c, lat_c), cell_reach(lat_c, step)


# --- counts within a radius ------------------------------------------------


def poi_counts(
    listings: DataFrame, pois: DataFrame, category: str, categories: Sequence[str], radii: Sequence[int],
    lon: str = "lon", lat: str = "lat", leaf_points: int = 64, splits: int = 3,
) -> DataFrame:
    """Adds ``count_<category>_<radius>m`` for every category and radius.

    Cells of places are paired with the cells of points that their circles
    touch.  A pair that is nearer than the radius as a whole adds the cell's
    stored count to all of the places at once, and one that is farther is
    dropped.  A crowded pair on the edge is cut, both cells into 8 x 8, and
    only the last, small pairs are compared point by point.  The counts are
    exact.
    """
    sums = [f"c{i}" for i in range(len(categories))]
    points = (
        pois.filter(F.col(category).isin(list(categories)))
        .select(F.col(lon).alias("lon"), F.col(lat).alias("lat"), category)
        .na.drop()
        .groupBy("lon", "lat")
        .agg(*[F.count_if(F.col(category) == c).alias(s) for c, s in zip(categories, sums)])
    )
    points = written_once(points, "poi-points")
    places = written_once(_places(listings, lon, lat), "poi-places")
    first = {r: _level_for(r) for r in radii}
    last = {r: min(first[r] + _SPLIT * splits, 30) for r in radii}
    per_radius = {r: list(range(first[r], last[r] + 1, _SPLIT)) for r in radii}
    levels = sorted({n for ns in per_radius.values() for n in ns})

    place_cells = written_once(_cell_table(places, levels, []), "poi-place-cells")
    cells = written_once(_cell_table(points, levels, sums), "poi-cells")
    rows = _touched_cells(place_cells, {r: (first[r], per_radius[r][-1]) for r in radii})
    rows = rows.join(_side(cells, sorted(set(first.values())), "t_"), _CELL["t_"])
    pairs, done = _classify_pairs(rows, leaf_points), []
    for k in range(1, splits + 1):
        at = sorted({per_radius[r][k] for r in radii if k < len(per_radius[r])})
        if at:
            pairs = written_once(pairs, "poi-pairs")
            done.append(pairs.filter(~F.col("open")))
            # Few and small rows are much work, so they are dealt out over all tasks.
            still = pairs.filter("open").repartition(_tasks(pairs))
            for side, own in (("p_", place_cells), ("t_", cells)):
                still = _classify_pairs(_cut(still, own, side, at, leaf_points), leaf_points)
            pairs = still
    pairs = union_all([*done, written_once(pairs, "poi-pairs")])

    # Whole pairs: the points' counts are added up by cell of places first.
    stored = cells.select(*[F.col(c).alias(f"t_{c}") for c in ("level", "x", "y")], *sums)
    by_cell = pairs.filter("whole").join(stored, _CELL["t_"]).groupBy("radius", *_CELL["p_"]).agg(*[F.sum(s).alias(s) for s in sums])
    most = _CROWD * leaf_points**2
    own = _with_cells(places, levels).withColumnsRenamed({c: f"p_{c}" for c in ("level", "x", "y")})
    inside = own.join(by_cell, _CELL["p_"]).select("lon", "lat", "radius", *sums)

    # Pairs on the edge: point by point.
    edge = pairs.filter(~F.col("whole")).repartition(_tasks(pairs), *_CELL["p_"]).select("radius", *_CELL["p_"], *_CELL["t_"])
    ends = [n[-1] for n in per_radius.values()]
    near = edge.join(_cell_lists(points, cells, levels, ends, most, "t_", sums), _CELL["t_"])
    near = near.join(_cell_lists(places, place_cells, levels, ends, most, "p_", []), _CELL["p_"])
    near = near.select("radius", "t_items", F.explode("p_items").alias("p")).select("radius", "p.*", F.explode("t_items").alias("t"))
    near = near.filter(haversine(F.col("lon"), F.col("lat"), F.col("t.lon"), F.col("t.lat")) <= F.col("radius"))
    near = near.select("lon", "lat", "radius", *[F.col(f"t.{s}").alias(s) for s in sums])

    names = {(s, r): f"count_{c}_{r}m" for c, s in zip(categories, sums) for r in radii}
    per_place = inside.unionByName(near).groupBy("lon", "lat").agg(
        *[F.sum(F.when(F.col("radius") == r, F.col(s))).alias(n) for (s, r), n in names.items()]
    )
    joined = _join_back(listings, per_place, lon, lat)
    known = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    return joined.withColumns(
        {n: F.when(known, F.coalesce(F.col(n), F.lit(0))).cast("bigint") for n in names.values()}
    )


def _tasks(df: DataFrame) -> int:
    return max(4 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _level_for(radius: float) -> int:
    """Finest level whose cells are at least as tall as the circle."""
    return max(1, math.floor(math.log2(360.0 / math.degrees(2 * radius / EARTH_RADIUS_M))))


def _touched_cells(place_cells: DataFrame, radii: dict[int, tuple[int, int]]) -> DataFrame:
    """One row per first-level cell of places, radius and cell that the bounds of its places' circles touch."""
    specs = F.array(
        *[
            F.struct(
                F.lit(float(r)).alias("radius"), F.lit(level).alias("p_level"), F.lit(last).alias("last"),
                F.lit(cell_step(level)).alias("step"), F.lit(2**level).cast("bigint").alias("across"),
                F.lit(math.degrees(r / EARTH_RADIUS_M) + 1e-9).alias("dlat"),
            )
            for r, (level, last) in radii.items()
        ]
    )
    firsts = _side(place_cells, sorted({level for level, _ in radii.values()}), "p_")
    rows = firsts.withColumn("_s", F.explode(specs)).filter("p_level = _s.p_level").select(*firsts.columns, "_s.radius", "_s.last", "_s.step", "_s.across", "_s.dlat")
    low, high = F.col("p_y") * F.col("step") - 90.0, (F.col("p_y") + 1) * F.col("step") - 90.0
    widest = F.greatest(F.abs(low), F.abs(high))  # where a degree of longitude is shortest
    pole = widest + F.col("dlat") >= 89.9
    dlon = F.when(pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.try_divide(
            F.sin(F.radians(F.col("dlat"))), F.cos(F.radians(widest)))))) + 1e-9
    )
    rows = rows.withColumn("dlon", dlon)
    # Places on a border are filed on one of its sides: 1e-9 of a cell more takes in both.
    west = F.floor(F.col("p_x") - F.col("dlon") / F.col("step") - 1e-9)
    east = F.floor(F.col("p_x") + 1 + F.col("dlon") / F.col("step") + 1e-9)
    xs = F.sequence(west, F.least(east, west + F.col("across") - 1))
    south = F.greatest(F.floor((low - F.col("dlat") + 90.0) / F.col("step") - 1e-9), F.lit(0).cast("bigint"))
    north = F.floor((high + F.col("dlat") + 90.0) / F.col("step") + 1e-9)
    return (
        rows.withColumn("t_x", F.explode(xs))
        .withColumn("t_x", F.pmod("t_x", "across"))
        .withColumn("t_y", F.explode(F.sequence(south, north)))
        .select("radius", "last", *_CELL["p_"], "p_n", F.col("p_level").alias("t_level"), "t_x", "t_y")
    )


#: Pairs of cells of up to this times the square of ``leaf_points`` are compared point by point.
_CROWD = 16


def _classify_pairs(rows: DataFrame, leaf_points: int) -> DataFrame:
    """Pairs of cells that circles touch: ``whole`` ones lie inside, ``open`` ones are to be cut."""
    steps = {s: F.lit(360.0) / F.pow(F.lit(2.0), F.col(f"{s}level")) for s in ("p_", "t_")}
    (p_lon, p_lat), (t_lon, t_lat) = (cell_center(F.col(f"{s}x"), F.col(f"{s}y"), steps[s]) for s in ("p_", "t_"))
    pair = ["radius", "last", *_CELL["p_"], "p_n", *_CELL["t_"], "t_n"]
    measured = rows.select(
        *pair, haversine(p_lon, p_lat, t_lon, t_lat).alias("_d"),
        (cell_reach(p_lat, steps["p_"]) + cell_reach(t_lat, steps["t_"])).alias("_r"),
    )
    whole = F.col("_d") + F.col("_r") <= F.col("radius")
    crowded = F.col("p_n") * F.col("t_n") > _CROWD * leaf_points**2
    able = [(F.col(f"{s}n") > leaf_points) & (F.col(f"{s}level") < F.col("last")) for s in ("p_", "t_")]
    return measured.filter(F.col("_d") - F.col("_r") <= F.col("radius")).select(
        *pair, whole.alias("whole"), (~whole & crowded & (able[0] | able[1])).alias("open")
    )


def _cut(pairs: DataFrame, cells: DataFrame, side: str, levels: Sequence[int], leaf_points: int) -> DataFrame:
    """The pairs with one side's crowded cells replaced by their non-empty parts, which are of ``levels``."""
    parts = cells.filter(F.col("level").isin(list(levels))).select(
        F.lit(True).alias("_cut"), (F.col("level") - _SPLIT).alias(f"{side}level"),
        F.shiftright("x", _SPLIT).alias(f"{side}x"), F.shiftright("y", _SPLIT).alias(f"{side}y"),
        F.col("level").alias("_level"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("n").alias("_n"),
    )
    if max(levels) <= _FEW_CELLS:
        # Bounded by the number of cells on the globe, however many points there are.
        parts = F.broadcast(parts)
    own = [*_CELL[side], f"{side}n"]
    crowded = F.col("open") & (F.col(f"{side}n") > leaf_points) & (F.col(f"{side}level") < F.col("last"))
    others = [c for c in pairs.columns if c not in (*own, "whole", "open")]
    marked = pairs.withColumn("_cut", crowded)
    return marked.join(parts, ["_cut", *_CELL[side]], "left").select(
        *others, *[F.when(F.col("_cut"), F.col(f"_{c}")).otherwise(F.col(f"{side}{c}")).alias(f"{side}{c}") for c in ("level", "x", "y", "n")]
    )


#: Points of a cell in one list.
_LISTED = 256


def _cell_lists(
    points: DataFrame, cells: DataFrame, levels: Sequence[int], last_levels: Sequence[int], most: int, side: str,
    sums: Sequence[str],
) -> DataFrame:
    """The points of each cell that can be compared point by point, in lists of about ``_LISTED``.

    A side of a crowded pair is left whole only where it has few points or is
    of a last level, so other cells of more than ``most`` points are left out.
    """
    few = cells.filter((F.col("n") <= most) | F.col("level").isin(list(last_levels))).select("level", "x", "y", "n")
    filed = _with_cells(points, levels).join(few, ["level", "x", "y"])
    lists = F.pmod(F.xxhash64("lon", "lat"), F.ceil(F.col("n") / _LISTED))
    return filed.groupBy("level", "x", "y", lists.alias("_list")).agg(
        F.collect_list(F.struct("lon", "lat", *sums)).alias(f"{side}items")
    ).drop("_list").withColumnsRenamed({c: f"{side}{c}" for c in ("level", "x", "y")})


def _leaf_points(points, cells, levels, last_levels, leaf_points, sums) -> DataFrame:
    """Points under each cell that can be compared point by point.

    Crowded cells above the last level are never compared, so their points are
    left out here: no cell key gathers a large share of the points.
    """
    above = [n for n in levels if n not in last_levels]
    filed = _with_cells(points, levels)
    if above:
        crowded = cells.filter(F.col("level").isin(above) & (F.col("n") > leaf_points)).select("level", "x", "y")
        filed = filed.join(crowded, ["level", "x", "y"], "left_anti")
    return filed.select(
        "level", "x", "y", F.col("lon").alias("p_lon"), F.col("lat").alias("p_lat"),
        *[F.col(s).alias(f"p_{s}") for s in sums],
    )


# --- nearest point ---------------------------------------------------------


def nearest_distance(
    listings: DataFrame, points: DataFrame, name: str, lon: str = "lon", lat: str = "lat", leaf_points: int = 64,
) -> DataFrame:
    """Adds the distance to the nearest point, however far it is.

    Cells of places are paired with cells of points, from coarse to fine.  A
    cell of places keeps the cells of points that can still hold the nearest
    point of one of its places: those whose least possible distance does not
    exceed the greatest possible one of the best.  Cells are cut until they
    hold few places and few points, however dense these lie.  Then every place
    picks among the cells that its cell has kept, and only points of the picked
    ones are measured.
    """
    places = written_once(_places(listings, lon, lat), "nearest-places")
    targets = written_once(_places(points, lon, lat), "nearest-points")
    finest = max(_uncrowded_level(places, leaf_points), _uncrowded_level(targets, leaf_points))
    place_cells, place_levels = _all_cells(places, finest, leaf_points)
    target_cells, target_levels = _all_cells(targets, finest, leaf_points)
    levels = max(place_levels, target_levels, key=len)
    first = levels[0]
    every_x = F.sequence(F.lit(0).cast("bigint"), F.lit(2**first - 1).cast("bigint"))
    every_y = F.sequence(F.lit(0).cast("bigint"), F.lit(2 ** (first - 1)).cast("bigint"))
    # At most 40 cells on each side, by construction.
    rows = (
        _side(place_cells, [first], "p_")
        .select("*", F.lit(first).alias("t_level"), F.explode(every_x).alias("t_x"))
        .select("*", F.explode(every_y).alias("t_y"))
        .join(F.broadcast(_side(target_cells, [first], "t_")), ["t_level", "t_x", "t_y"])
    )
    last = {"p_": place_levels[-1], "t_": target_levels[-1]}
    rows = _keep_pairs(rows, leaf_points, last)
    for level in levels[1:]:
        rows = _split_side(rows, place_cells, "p_", level)
        rows = _split_side(rows, target_cells, "t_", level)
        rows = _keep_pairs(rows, leaf_points, last)
    kept = rows.select(*_CELL["p_"], *_CELL["t_"])

    # Each place among its cell's candidates.
    own = _with_cells(places, levels).withColumnsRenamed({c: f"p_{c}" for c in ("level", "x", "y")})
    near = own.join(kept, _CELL["p_"]).select("lon", "lat", *[F.col(f"t_{c}").alias(c) for c in ("level", "x", "y")])
    distance, reach = _center_distance()
    best = F.min(F.col("_d") + F.col("_r")).over(Window.partitionBy("lon", "lat"))  # a place has few candidates left
    picked = near.select("*", distance.alias("_d"), reach.alias("_r")).select("*", best.alias("_best"))
    picked = picked.filter(F.col("_d") - F.col("_r") <= F.col("_best")).select("lon", "lat", "level", "x", "y")
    leaves = _leaf_points(targets, target_cells, target_levels, {target_levels[-1]}, leaf_points, [])
    metres = haversine(F.col("lon"), F.col("lat"), F.col("p_lon"), F.col("p_lat"))
    per_place = picked.join(leaves, ["level", "x", "y"]).groupBy("lon", "lat").agg(F.min(metres).alias(name))
    return _join_back(listings, per_place, lon, lat)


_CELL = {side: [f"{side}level", f"{side}x", f"{side}y"] for side in ("p_", "t_")}


def _uncrowded_level(points: DataFrame, leaf_points: int, level: int = 18) -> int:
    """A level where no cell is crowded, the first one for most data, or the deepest one."""
    while level < _DEEPEST and (_cell_table(points, [level], []).agg(F.max("n")).first()[0] or 0) > leaf_points:
        level += 4 * _SPLIT
    return level


def _all_cells(points: DataFrame, finest: int, leaf_points: int) -> tuple[DataFrame, list[int]]:
    """The cells of every third level with their numbers of points, and the levels down to where none is crowded.

    The points are counted at the finest level; coarser cells are sums of finer ones.
    """
    levels = list(range(_SPLIT, finest + 1, _SPLIT))
    ups = F.explode(F.array(*[F.lit(finest - n) for n in levels])).alias("_up")
    cells = _cell_table(points, [finest], []).select("x", "y", "n", ups).groupBy(
        (F.lit(finest) - F.col("_up")).alias("level"), F.expr("shiftright(x, _up)").alias("x"), F.expr("shiftright(y, _up)").alias("y")
    ).agg(F.sum("n").alias("n"))
    cells = written_once(cells, "cells")
    crowded = cells.filter(F.col("n") > leaf_points).agg(F.max("level")).first()[0] or 0
    return cells, [n for n in levels if n <= crowded + _SPLIT]


def _side(cells: DataFrame, levels: Sequence[int], side: str) -> DataFrame:
    return cells.filter(F.col("level").isin(list(levels))).select(*[F.col(c).alias(side + c) for c in ("level", "x", "y", "n")])


def _split_side(rows: DataFrame, cells: DataFrame, side: str, level: int) -> DataFrame:
    """Replace the open cells of one side by their parts at ``level``."""
    parts = cells.filter(F.col("level") == level).select(
        F.lit(True).alias(f"{side}open"), (F.col("level") - _SPLIT).alias(f"{side}level"),
        F.shiftright("x", _SPLIT).alias(f"{side}x"), F.shiftright("y", _SPLIT).alias(f"{side}y"),
        F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("n").alias("_n"),
    )
    if level <= _FEW_CELLS:
        # Bounded by the number of cells on the globe, however many points there are.
        parts = F.broadcast(parts)
    own, opened = [*_CELL[side], f"{side}n"], F.col(f"{side}open")
    found = {
        f"{side}level": F.when(opened, F.lit(level)).otherwise(F.col(f"{side}level")),
        **{f"{side}{c}": F.when(opened, F.col(f"_{c}")).otherwise(F.col(f"{side}{c}")) for c in ("x", "y", "n")},
    }
    others = [c for c in rows.columns if c not in (*own, f"{side}open")]
    return rows.join(parts, [f"{side}open", *_CELL[side]], "left").select(*others, *[c.alias(n) for n, c in found.items()])


def _keep_pairs(rows: DataFrame, leaf_points: int, last: dict[str, int]) -> DataFrame:
    """Pairs that can still matter, and which of their cells are to be cut.

    A cell of places is cut as long as one of its points' cells is: beside a
    small cell of points a large one of places would bound nothing.
    """
    steps = {s: F.lit(360.0) / F.pow(F.lit(2.0), F.col(f"{s}level")) for s in ("p_", "t_")}
    (p_lon, p_lat), (t_lon, t_lat) = (cell_center(F.col(f"{s}x"), F.col(f"{s}y"), steps[s]) for s in ("p_", "t_"))
    cells = [*_CELL["p_"], "p_n", *_CELL["t_"], "t_n"]
    measured = rows.select(
        *cells, haversine(p_lon, p_lat, t_lon, t_lat).alias("_d"),
        (cell_reach(p_lat, steps["p_"]) + cell_reach(t_lat, steps["t_"])).alias("_r"),
        ((F.col("t_n") > leaf_points) & (F.col("t_level") < last["t_"])).alias("t_open"),
    )
    per_cell = Window.partitionBy(*_CELL["p_"])  # few candidates are left for each
    best = measured.select("*", F.min(F.col("_d") + F.col("_r")).over(per_cell).alias("_best"))
    kept = best.filter(F.col("_d") - F.col("_r") <= F.col("_best"))
    beside_open = F.max("t_open").over(per_cell)
    return kept.select(*cells, "t_open", (beside_open | ((F.col("p_n") > leaf_points) & (F.col("p_level") < last["p_"]))).alias("p_open"))
