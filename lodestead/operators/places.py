"""Administrative areas by place name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.text import normalise


def _one_area_per_name(areas: DataFrame, order: Sequence[str]) -> DataFrame:
    first = Window.partitionBy("_name").orderBy(*order)
    return areas.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def _named_areas(areas: DataFrame, name: str, columns: Sequence[str], on_multiple: str,
                 order: Sequence[str]) -> DataFrame:
    named = areas.select(normalise(F.col(name)).alias("_name"), *columns).filter("_name is not null")
    if on_multiple == "first":
        return _one_area_per_name(named, order or list(columns))
    if on_multiple != "all":
        raise ValueError(f"on_multiple must be all or first, not {on_multiple}")
    return named


def join_by_name(
    listings: DataFrame, areas: DataFrame, city: str, name: str, columns: Sequence[str],
    on_multiple: str = "all", order: Sequence[str] = (),
) -> DataFrame:
    """Left join on the cleaned name.  Areas sharing a name give one row each.

    The join is a plain equality: Spark broadcasts the areas while they are
    below its size threshold, and otherwise splits a hot city by its adaptive
    skew handling.  ``on_multiple="first"`` keeps one area per name.
    """
    named = _named_areas(areas, name, columns, on_multiple, order)
    return listings.withColumn("_name", normalise(F.col(city))).join(named, "_name", "left").drop("_name")


def join_by_name_with_fallback(
    listings: DataFrame, areas: DataFrame, city: str, names: Sequence[str], columns: Sequence[str],
    on_multiple: str = "all", order: Sequence[str] = (),
) -> DataFrame:
    """Match the city against ``names`` in turn; the first level that knows it wins.

    Which level a city matches depends on its name alone.  So the levels are
    folded into one lookup table in which a name of a later level is kept only
    when no earlier level has it, and the listings are joined once.
    """
    lookup = None
    for name in names:
        level = _named_areas(areas, name, columns, on_multiple, order)
        if lookup is None:
            lookup = level
        else:
            lookup = lookup.unionByName(level.join(lookup.select("_name").distinct(), "_name", "left_anti"))
    return listings.withColumn("_name", normalise(F.col(city))).join(lookup, "_name", "left").drop("_name")
