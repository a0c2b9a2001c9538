"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.functions.casts import to_double
from lodestead.functions.text import blank_to_null
from lodestead.operators.projections import require_columns

# JSON key of each tag and the column it becomes.
POI_TAGS = (
    ("amenity", "amenity"),
    ("shop", "shop"),
    ("leisure", "leisure"),
    ("highway", "highway"),
    ("railway", "railway"),
    ("public_transport", "public_transport"),
    ("tourism", "tourism"),
    ("natural", "natural_"),
    ("office", "office"),
    ("building", "building"),
)

# The tag values that make a point of interest.
POI_VALUES: Mapping[str, Sequence[str]] = {
    "amenity": (
        "school", "university", "college", "kindergarten", "hospital", "clinic", "doctors", "pharmacy",
        "restaurant", "cafe", "fast_food", "bar", "pub", "bank", "atm", "post_office", "library",
        "cinema", "theatre", "marketplace", "parking",
        "police", "fire_station", "townhall",
        "waste_disposal", "recycling",
    ),
    "shop": (
        "supermarket", "convenience", "mall", "department_store", "bakery", "butcher", "clothes", "hardware",
    ),
    "leisure": (
        "park", "playground", "sports_centre", "fitness_centre", "swimming_pool", "nature_reserve",
        "dog_park", "garden", "stadium",
    ),
    "highway": ("bus_stop", "traffic_signals", "crossing", "motorway_junction"),
    "railway": ("station", "stop", "subway_entrance", "tram_stop", "level_crossing"),
    "public_transport": ("station", "stop_position", "platform"),
    "tourism": ("museum", "attraction", "gallery", "viewpoint", "hotel", "guest_house"),
    "natural_": ("beach", "water", "wood"),
    "building": (
        "apartments", "house", "residential", "commercial", "industrial", "retail", "school", "hospital",
    ),
}
# Columns where any value counts, and the amenities people keep away from.
POI_ANY_VALUE = ("office",)
NEGATIVE_AMENITIES = ("waste_disposal", "recycling")


def _tag_matches(values: Mapping[str, Sequence[str]], any_value: Sequence[str]) -> list[tuple[str, Column]]:
    return [(c, F.col(c).isin(list(v))) for c, v in values.items()] + [
        (c, F.col(c).isNotNull()) for c in any_value
    ]


def points_of_interest(
    df: DataFrame, values: Mapping[str, Sequence[str]] = POI_VALUES, any_value: Sequence[str] = POI_ANY_VALUE
) -> DataFrame:
    """Rows with a listed value in any tag column."""
    return df.filter(reduce(lambda a, b: a | b, [m for _, m in _tag_matches(values, any_value)]))


def poi_category(
    values: Mapping[str, Sequence[str]] = POI_VALUES, any_value: Sequence[str] = POI_ANY_VALUE
) -> Column:
    """The first tag column that lists the row."""
    return F.coalesce(*[F.when(m, F.lit(c)) for c, m in _tag_matches(values, any_value)])


def drop_incomplete(
    df: DataFrame, target: str, required: Sequence[str] = (), strategy: str = "drop_target_nan"
) -> DataFrame:
    """Drop rows without a target, then rows with a blank or null required value."""
    if strategy != "drop_target_nan":
        raise NotImplementedError(strategy)
    require_columns(df, [target, *required])
    types = dict(df.dtypes)
    blanks = {c: blank_to_null(F.col(c)) for c in required if types[c] == "string"}
    out = df.na.drop(subset=[target])
    if blanks:
        out = out.withColumns(blanks)
    return out.na.drop("any", subset=list(required)) if required else out


def numeric_target(df: DataFrame, target: str) -> DataFrame:
    """The target as a number; rows where it is not one are dropped."""
    return df.withColumn(target, to_double(F.col(target))).filter(F.col(target).isNotNull())


def parsed_only(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())
