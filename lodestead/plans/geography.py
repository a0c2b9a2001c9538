"""Reference geography and the enrichment of listings with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.operators import filters
from lodestead.operators.places import join_by_name_with_fallback
from lodestead.operators.projections import tag_columns
from lodestead.operators.spatial import areas_containing, nearest_distance, poi_counts
from lodestead.sources.geography import parse_poi_lines, read_boundaries
from lodestead.sources.json_files import read_geojson_sequence, valid_lines
from lodestead.sources.sinks import replace_table

# Boundary columns given to a listing.
AREA_COLUMNS = ("freguesia", "municipio", "distrito_ilha", "nuts1", "nuts2", "nuts3", "area_ha", "perimetro_km")


def load_pois(spark: SparkSession, path: str, table: str, location: str | None = None) -> None:
    """Cleaned GeoJSON lines to the point table, replacing it."""
    lines = valid_lines(read_geojson_sequence(spark, path), require_some=True)
    replace_table(parse_poi_lines(lines), table, location)


def load_boundaries(spark: SparkSession, path: str, table: str, location: str | None = None) -> None:
    replace_table(read_boundaries(spark, path), table, location)


def relevant_pois(pois: DataFrame) -> DataFrame:
    """Points with a whitelisted tag, their tag columns and their category."""
    tagged = tag_columns(pois, "properties", filters.POI_TAGS)
    return filters.points_of_interest(tagged).withColumn("category", filters.poi_category())


def add_areas_by_name(listings: DataFrame, boundaries: DataFrame, city: str = "city") -> DataFrame:
    """Parish by city name, else municipality by city name."""
    return join_by_name_with_fallback(listings, boundaries, city, ["freguesia", "municipio"], AREA_COLUMNS)


def add_areas_by_location(listings: DataFrame, boundaries: DataFrame) -> DataFrame:
    return areas_containing(listings, boundaries, AREA_COLUMNS)


def add_poi_features(listings: DataFrame, pois: DataFrame, categories: Sequence[str],
                     radii: Sequence[int]) -> DataFrame:
    """Counts per category and radius, and the distance to the nearest negative point."""
    counted = poi_counts(listings, pois, "category", categories, radii)
    negative = pois.filter(F.col("amenity").isin(*filters.NEGATIVE_AMENITIES))
    return nearest_distance(counted, negative, "nearest_negative_m")
