"""Areas by name and by location, points of interest nearby."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.operators import places as by_name
from lodestead.operators import spatial
from lodestead.queries.registry import query, table


@query("""
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'FURNITURE' THEN n_name END AS area,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN n_regionkey END AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def name_join(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' city text in another spelling against the nation names."""
    nation = table(spark, sf, "nation")
    city = F.when(F.col("c_mktsegment") == "FURNITURE", "nowhere").otherwise(
        F.concat(F.lit(" \t"), F.initcap("n_name"), F.lit(" "))
    )
    listings = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", city.alias("city")
    )
    areas = nation.select("n_name", F.col("n_name").alias("area"), F.col("n_regionkey").alias("region"))
    return by_name.join_by_name(listings, areas, "city", "n_name", ["area", "region"]).drop("city")


@query("""
    WITH l AS (SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN r_name WHEN 'BUILDING' THEN 'nowhere'
                      ELSE n_name END AS city
               FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    a AS (SELECT n_name AS freguesia, r_name AS municipio FROM nation JOIN region ON n_regionkey = r_regionkey),
    one AS (SELECT l.*, a.freguesia, a.municipio FROM l LEFT JOIN a ON lower(city) = lower(a.freguesia)),
    two AS (SELECT one.c_custkey, a.freguesia, a.municipio FROM one LEFT JOIN a ON lower(city) = lower(a.municipio)
            WHERE one.freguesia IS NULL)
    SELECT one.c_custkey, coalesce(one.freguesia, two.freguesia) AS freguesia,
           coalesce(one.municipio, two.municipio) AS municipio
    FROM one LEFT JOIN two USING (c_custkey)
""")
def fallback_join(spark: SparkSession, sf: str) -> DataFrame:
    """City text against nation names, else against region names with all their nations."""
    areas = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("freguesia"), F.col("r_name").alias("municipio"), "n_nationkey")
    )
    segment = F.col("c_mktsegment")
    city = F.when(segment == "AUTOMOBILE", F.col("municipio")).when(segment == "BUILDING", "nowhere").otherwise(
        F.upper("freguesia")
    )
    listings = table(spark, sf, "customer").join(areas, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", city.alias("city")
    )
    columns = ["freguesia", "municipio"]
    return by_name.join_by_name_with_fallback(listings, areas, "city", columns, columns).drop("city")


def _points(spark: SparkSession, sf: str, scale: float) -> DataFrame:
    """Vectors as places: the first two dimensions, scaled to degrees around (-8, 40)."""
    dim = lambda i: F.get("embedding", F.lit(i)).cast("double") * scale
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", (dim(0) - 8).alias("lon"), (dim(1) + 40).alias("lat")
    )


_POINTS = """
    SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) * {scale} - 8 AS lon,
           CAST(embedding[2] AS DOUBLE) * {scale} + 40 AS lat
    FROM embeddings
"""
_METRES = """2 * 6371008.8 * asin(least(1.0, sqrt(
    pow(sin(radians(b.lat - a.lat) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"""


@query(f"""
    WITH p AS ({_POINTS.format(scale=100)}),
    a AS (SELECT n_name AS area, -32.0 + 12 * (n_nationkey % 5) AS x, 16.0 + 12 * (n_nationkey // 5) AS y FROM nation)
    SELECT vec_id, area FROM p LEFT JOIN a
        ON abs(lon - x) + abs(lat - y) < 7 AND NOT (abs(lon - x) < 2 AND abs(lat - y) < 2)
""")
def point_in_polygon(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors in overlapping diamonds with a square hole, one per nation."""
    x = F.lit(-32.0) + 12 * (F.col("n_nationkey") % 5)
    y = F.lit(16.0) + 12 * F.floor(F.col("n_nationkey") / 5)
    ring = lambda corners: F.array(
        *[F.struct((x + dx).alias("x"), (y + dy).cast("double").alias("y")) for dx, dy in corners]
    )
    outer = ring([(7, 0), (0, 7), (-7, 0), (0, -7), (7, 0)])
    hole = ring([(2, 2), (-2, 2), (-2, -2), (2, -2), (2, 2)])
    areas = table(spark, sf, "nation").select(F.col("n_name").alias("area"), F.array(outer, hole).alias("rings"))
    return spatial.areas_containing(_points(spark, sf, 100), areas, ["area"]).select("vec_id", "area")


@query(f"""
    WITH p AS ({_POINTS.format(scale=0.2)})
    SELECT a.vec_id,
           CAST(count(*) FILTER (b.label = 0 AND d <= 500) AS BIGINT) AS count_0_500m,
           CAST(count(*) FILTER (b.label = 0 AND d <= 2000) AS BIGINT) AS count_0_2000m,
           CAST(count(*) FILTER (b.label = 7 AND d <= 500) AS BIGINT) AS count_7_500m,
           CAST(count(*) FILTER (b.label = 7 AND d <= 2000) AS BIGINT) AS count_7_2000m
    FROM p a, (SELECT * FROM p) b, LATERAL (SELECT {_METRES} AS d) m GROUP BY a.vec_id
""")
def poi_counts_radius(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of two labels counted around every vector."""
    points = _points(spark, sf, 0.2)
    pois = points.select("lon", "lat", F.col("label").cast("string").alias("category"))
    counted = spatial.poi_counts(points, pois, "category", ["0", "7"], [500, 2000], leaf_points=8)
    return counted.drop("label", "lon", "lat")


@query(f"""
    WITH p AS ({_POINTS.format(scale=0.2)})
    SELECT a.vec_id, round(min({_METRES}), 3) AS nearest_m FROM p a, (SELECT * FROM p WHERE label = 3) b GROUP BY a.vec_id
""")
def nearest_poi(spark: SparkSession, sf: str) -> DataFrame:
    """Distance from every vector to the nearest one of a label."""
    points = _points(spark, sf, 0.2)
    negative = points.filter("label = 3").select("lon", "lat")
    return spatial.nearest_distance(points, negative, "nearest_m", leaf_points=8).select(
        "vec_id", F.round("nearest_m", 3).alias("nearest_m")
    )
