"""Administrative boundaries and points of interest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead import schemas
from lodestead.functions.geometry import geojson_rings, geojson_point, geojson_type


def read_pois(spark: SparkSession, path: str, geometry_type: str | None = None) -> DataFrame:
    """GeoJSON lines as (geometry, properties, id); any bad line fails the read."""
    lines = spark.read.schema(schemas.POI_FEATURE).option("mode", "FAILFAST").json(path)
    return pois(lines, geometry_type)


def parse_poi_lines(lines: DataFrame, value: str = "value", geometry_type: str | None = None) -> DataFrame:
    """The same from lines that were cleaned before."""
    parsed = F.from_json(value, schemas.POI_FEATURE, {"mode": "FAILFAST"})
    return pois(lines.select(parsed.alias("p")).select("p.*"), geometry_type)


def pois(features: DataFrame, geometry_type: str | None = None) -> DataFrame:
    """Adds lon and lat; other geometries than points have none."""
    if geometry_type:
        features = features.filter(geojson_type(F.col("geometry")) == geometry_type)
    point = geojson_point(F.col("geometry"))
    return features.withColumn("lon", F.get(point, F.lit(0))).withColumn("lat", F.get(point, F.lit(1)))


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON lines to the 12-column boundary table plus the rings of the geometry."""
    return boundaries(spark.read.schema(schemas.BOUNDARY_FEATURE).option("mode", "FAILFAST").json(path))


def parse_boundary_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    parsed = F.from_json(value, schemas.BOUNDARY_FEATURE, {"mode": "FAILFAST"})
    return boundaries(lines.select(parsed.alias("b")).select("b.*"))


def boundaries(features: DataFrame) -> DataFrame:
    return features.select(
        "properties.*", "geometry", geojson_rings(F.col("geometry")).alias("rings")
    )
