"""Grid joins against brute force, on even and on crowded data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestead.functions.geometry import EARTH_RADIUS_M
from lodestead.operators import spatial


def metres(a, b):
    (lon1, lat1), (lon2, lat2) = a, b
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


def crowded(rng, n):
    """A third at one spot, a third within 60 m, the rest over 20 km."""
    spot = (-8.61, 41.15)
    near = [(spot[0] + rng.gauss(0, 3e-4), spot[1] + rng.gauss(0, 3e-4)) for _ in range(n // 3)]
    wide = [(spot[0] + rng.uniform(-0.1, 0.1), spot[1] + rng.uniform(-0.1, 0.1)) for _ in range(n // 3)]
    return [spot] * (n // 3) + near + wide


def edges(rng, n):
    """Around the date line, the poles and the origin."""
    out = []
    for lon, lat in ((179.999, 0.0), (-179.999, 10.0), (0.0, 89.995), (45.0, -89.99), (0.0, 0.0)):
        out += [(((lon + rng.uniform(-0.01, 0.01)) + 180) % 360 - 180, max(-90.0, min(90.0, lat + rng.uniform(-0.01, 0.01))))
                for _ in range(n // 5)]
    return out


@pytest.mark.parametrize("shape", [crowded, edges])
def test_counts_and_nearest_equal_brute_force(spark, shape):
    rng = random.Random(11)
    listings, pois = shape(rng, 90), [(p, rng.choice("ab")) for p in shape(rng, 150)]
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(listings)] + [(-1, None, 1.0)], "id int, lon double, lat double")
    pdf = spark.createDataFrame([(c, *p) for p, c in pois], "kind string, lon double, lat double")
    counted = spatial.poi_counts(ldf, pdf, "kind", ["a", "b"], [40, 1500], leaf_points=4)
    got = {r.id: r for r in counted.collect()}
    for i, p in enumerate(listings):
        for kind in "ab":
            for radius in (40, 1500):
                want = sum(1 for q, c in pois if c == kind and metres(p, q) <= radius)
                assert got[i][f"count_{kind}_{radius}m"] == want, (p, kind, radius)
    assert got[-1]["count_a_40m"] is None and len(got) == len(listings) + 1
    nearest = {r.id: r.d for r in spatial.nearest_distance(ldf, pdf.filter("kind = 'a'"), "d", leaf_points=4).collect()}
    for i, p in enumerate(listings):
        assert nearest[i] == pytest.approx(min(metres(p, q) for q, c in pois if c == "a"), abs=1e-6)
    assert nearest[-1] is None


def test_places_of_a_cell_are_counted_together(spark, monkeypatch):
    """4,000 places and points within 3 km: pairs of cells are few beside the cells that each circle would touch."""
    rng = np.random.default_rng(3)
    xy = np.round(rng.normal((-8.6, 41.1), 0.012, (4000, 2)), 6)
    df = spark.createDataFrame([(i, float(x), float(y), "ab"[i % 2]) for i, (x, y) in enumerate(xy)], "id int, lon double, lat double, kind string")
    kept, written = [], spatial.written_once
    monkeypatch.setattr(spatial, "written_once", lambda d, label: kept.append((label, written(d, label))) or kept[-1][1])
    counted = {r.id: r.count_a_1000m for r in spatial.poi_counts(df, df, "kind", ["a"], [1000], leaf_points=8).collect()}
    assert sum(d.count() for label, d in kept if label == "poi-pairs") < 25 * 4000
    lon, lat = np.radians(xy).T
    for i in range(0, 4000, 97):
        h = np.sin((lat - lat[i]) / 2) ** 2 + np.cos(lat) * np.cos(lat[i]) * np.sin((lon - lon[i]) / 2) ** 2
        assert counted[i] == np.count_nonzero(2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(h))[::2] <= 1000)


def test_no_plan_pairs_everything(spark):
    ldf = spark.createDataFrame([(1, -8.6, 41.1)], "id int, lon double, lat double")
    pdf = spark.createDataFrame([("a", -8.6, 41.1)], "kind string, lon double, lat double")
    for df in (spatial.poi_counts(ldf, pdf, "kind", ["a"], [500]), spatial.nearest_distance(ldf, pdf, "d")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def inside(rings, lon, lat):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > lat) != (y2 > lat) and lon < x1 + (x2 - x1) * (lat - y1) / (y2 - y1):
                odd = not odd
    return odd


def test_areas_of_all_sizes(spark):
    rng = random.Random(5)
    areas = {}
    for i, size in enumerate([0.001, 0.01, 0.3, 5, 5, 40]):
        cx, cy = rng.uniform(-9, -7), rng.uniform(38, 41)
        turn = sorted(rng.uniform(0, 2 * math.pi) for _ in range(9))
        outer = [(cx + size * math.cos(t), cy + size * math.sin(t)) for t in turn]
        hole = [(cx + size / 9 * math.cos(t), cy + size / 9 * math.sin(t)) for t in turn]
        areas[f"a{i}"] = [outer + outer[:1], hole + hole[:1]]
    adf = spark.createDataFrame(
        [(n, [[{"x": x, "y": y} for x, y in r] for r in rings]) for n, rings in areas.items()] + [("none", None)],
        "area string, rings array<array<struct<x:double,y:double>>>",
    )
    points = [(rng.uniform(-12, -4), rng.uniform(36, 44)) for _ in range(200)] + [(-8.0, 39.0)] * 50
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(-1, None, None)], "id int, lon double, lat double")
    got = {}
    for r in spatial.areas_containing(ldf, adf, ["area"]).collect():
        got.setdefault(r.id, set()).add(r.area)
    for i, p in enumerate(points):
        want = {n for n, rings in areas.items() if inside(rings, *p)}
        assert got[i] == (want or {None})
    assert got[-1] == {None}


def test_without_any_area(spark):
    ldf = spark.createDataFrame([(1, -8.6, 41.1)], "id int, lon double, lat double")
    adf = spark.createDataFrame([], "area string, rings array<array<struct<x:double,y:double>>>")
    assert spatial.areas_containing(ldf, adf, ["area"]).first()["area"] is None


def star(n, cx, cy, size, rng, rough=0.2):
    """A closed outline of n vertices around a centre."""
    turn = [2 * math.pi * (i + rng.random() * 0.8) / n for i in range(n)]
    far = [size * (0.55 + 0.25 * math.sin(9 * t) + rough * rng.random()) for t in turn]
    ring = [(cx + r * math.cos(t), cy + r * math.sin(t)) for r, t in zip(far, turn)]
    return ring + ring[:1]


def area_frame(spark, areas):
    return spark.createDataFrame(
        [(n, [[{"x": x, "y": y} for x, y in r] for r in rings]) for n, rings in areas.items()],
        "area string, rings array<array<struct<x:double,y:double>>>",
    )


@pytest.mark.parametrize("leaf", [4, 32])
def test_cells_equal_the_even_odd_rule(spark, leaf):
    """Also on vertices, on sides, on borders of cells, with holes and with sides along parallels and meridians."""
    rng = random.Random(leaf)
    square = [(0.0, 0.0), (45.0, 0.0), (45.0, 22.5), (22.5, 22.5), (22.5, 45.0), (0.0, 45.0), (0.0, 0.0)]
    diamond = [(11.25, 0.0), (22.5, 11.25), (11.25, 22.5), (0.0, 11.25), (11.25, 0.0)]
    bow = [(-10.0, -10.0), (10.0, 10.0), (10.0, -10.0), (-10.0, 10.0), (-10.0, -10.0)]
    areas = {
        "square": [square, diamond], "bow": [bow], "star": [star(300, -8.2, 40.1, 0.4, rng), star(40, -8.2, 40.1, 0.1, rng)],
        "tiny": [star(12, -8.0, 40.0, 1e-7, rng)], "line": [[(1.0, 1.0), (5.0, 5.0), (1.0, 1.0)]],
        "wide": [[(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0), (-180.0, -90.0)]],
    }
    grid = [i * 5.625 for i in range(-4, 10)]
    points = [(x, y) for x in grid for y in grid] + [p for rings in areas.values() for r in rings for p in r[:60]]
    points += [((a + c) / 2, (b + d) / 2) for (a, b), (c, d) in zip(square, square[1:])]
    points += [(rng.uniform(-9, -7.5), rng.uniform(39.5, 40.7)) for _ in range(500)] + [(-8.0 + rng.uniform(-1e-7, 1e-7), 40.0 + rng.uniform(-1e-7, 1e-7)) for _ in range(60)]
    ldf = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, lon double, lat double")
    got = {}
    for r in spatial.areas_containing(ldf, area_frame(spark, areas), ["area"], leaf_segments=leaf).collect():
        got.setdefault(r.id, set()).add(r.area)
    for i, p in enumerate(points):
        assert got[i] == ({n for n, rings in areas.items() if inside(rings, *p)} or {None}), p


def test_a_long_outline_is_tested_in_parts(spark):
    """100,000 sides and points of which most lie in one spot: no point meets more than a cell's sides."""
    rng = random.Random(3)
    rings = [star(100_000, -8.0, 39.5, 0.8, rng, 2e-5)]
    areas = area_frame(spark, {"long": rings})
    sizes = [(r.n, r.corner) for r in spatial.area_cells(areas, ["area"]).select(F.size("segments").alias("n"), "corner").collect()]
    assert max(n for n, _ in sizes) <= 32 and sum(n == 0 and corner for n, corner in sizes) > 100
    points = [(-8.0 + rng.gauss(0, 0.4), 39.5 + rng.gauss(0, 0.4)) for _ in range(150)] + [rings[0][i] for i in range(0, 100_000, 2000)]
    points += [(rings[0][77][0] + rng.gauss(0, 1e-6), rings[0][77][1] + rng.gauss(0, 1e-6)) for _ in range(50)] + [(-8.0, 39.5)] * 300
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lon double, lat double")
    got = {r.id: r.area for r in spatial.areas_containing(ldf, areas, ["area"]).collect()}
    known = {p: inside(rings, *p) for p in set(points)}
    assert got == {i: "long" if known[p] else None for i, p in enumerate(points)}


def test_nearest_among_many_in_one_spot(spark):
    """100,000 points within 150 m, and places in their midst and far away."""
    rng = random.Random(4)
    spot = (-8.61, 41.15)
    pois = [(spot[0] + rng.uniform(-7e-4, 7e-4), spot[1] + rng.uniform(-7e-4, 7e-4)) for _ in range(100_000)]
    places = [(spot[0] + rng.uniform(-8e-4, 8e-4), spot[1] + rng.uniform(-8e-4, 8e-4)) for _ in range(120)]
    places += [(0.0, 0.0), (179.9, -80.0), (spot[0] + 0.3, spot[1])] + pois[:5]
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "id int, lon double, lat double")
    pdf = spark.createDataFrame(pois, "lon double, lat double")
    found = spatial.nearest_distance(ldf, pdf, "d")
    got = {r.id: r.d for r in found.collect()}
    lon, lat = (np.radians([p[k] for p in pois]) for k in (0, 1))
    for i, (x, y) in enumerate(np.radians(places)):
        h = np.sin((lat - y) / 2) ** 2 + np.cos(lat) * np.cos(y) * np.sin((lon - x) / 2) ** 2
        assert got[i] == pytest.approx(2 * EARTH_RADIUS_M * math.asin(math.sqrt(h.min())), abs=1e-6)
    # Cells are cut until they are small, below the level of 150 m.
    finest = spatial._uncrowded_level(pdf, 64)
    cells, levels = spatial._all_cells(pdf, finest, 64)
    assert finest > 18 and levels[-1] > 18 and cells.filter(F.col("level") == levels[-1]).agg(F.max("n")).first()[0] <= 64
