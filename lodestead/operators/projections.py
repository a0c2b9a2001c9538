"""Schema-driven projections and reshaping."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from lodestead import schemas
from lodestead.functions.casts import convert, run_date as run_date_column
from lodestead.functions.text import path_part


# --- schema checks ---------------------------------------------------------


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail before any work when a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df


def present_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The expected columns that exist, with a warning about the others."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        warnings.warn(f"expected columns not found: {missing}", stacklevel=2)
    return [c for c in columns if c in df.columns]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def field(schema: StructType, path: str) -> tuple[Column, str]:
    """Nested field by path with its type; null when the path or any value on it is missing."""
    here: DataType = schema
    for name in path.split("."):
        if not isinstance(here, StructType) or name not in here.names:
            return F.lit(None), "void"
        here = here[name].dataType
    return F.col(path), here.simpleString()


# --- listings --------------------------------------------------------------


def stage_listings(df: DataFrame, run_date: str | dt.date | None = None) -> DataFrame:
    """Search results to the 39 typed staging columns, in table order."""
    tops = [c.path.split(".")[0] for c in schemas.STAGING_COLUMNS if c.path]
    require_columns(df, list(dict.fromkeys(tops)))

    def target(c: schemas.StagingColumn) -> Column:
        if c.name == "ingestionDate":
            return run_date_column(run_date)
        if not c.path:
            return F.lit(None).cast(c.type)
        return convert(*field(df.schema, c.path), c.type)

    return df.select(*[target(c).alias(c.name) for c in schemas.STAGING_COLUMNS])


# --- generic reshaping -----------------------------------------------------


def flatten_structs(df: DataFrame, sep: str = "_", **constants: str) -> DataFrame:
    """Every nested struct field as a top-level column ``a_b``; lists stay lists.

    ``constants`` are added as text columns, e.g. the location key of the file.
    """

    def leaves(schema: StructType, prefix: tuple[str, ...] = ()):
        for f in schema.fields:
            path = (*prefix, f.name)
            if isinstance(f.dataType, StructType):
                yield from leaves(f.dataType, path)
            else:
                quoted = ".".join(f"`{p}`" for p in path)
                yield F.col(quoted).alias(sep.join(path))

    return df.select(*leaves(df.schema), *[F.lit(v).alias(k) for k, v in constants.items()])


def _rebuild(c: Column, data_type: DataType, name: str) -> Column:
    if schemas.without_field(data_type, name) == data_type:
        return c
    if isinstance(data_type, StructType):
        kept = [_rebuild(c[f.name], f.dataType, name).alias(f.name) for f in data_type.fields if f.name != name]
        return F.when(c.isNotNull(), F.struct(*kept)) if kept else F.lit(None)
    if isinstance(data_type, ArrayType):
        return F.transform(c, lambda x: _rebuild(x, data_type.elementType, name))
    if isinstance(data_type, MapType):
        return F.transform_values(c, lambda _, v: _rebuild(v, data_type.valueType, name))
    return c


def drop_field_everywhere(df: DataFrame, name: str) -> DataFrame:
    """Remove a field such as ``__typename`` at every depth."""
    return df.select(
        *[_rebuild(F.col(f"`{f.name}`"), f.dataType, name).alias(f.name) for f in df.schema.fields if f.name != name]
    )


def flatten_location_tree(df: DataFrame, objects: str = "data.locationTree.locationTreeObjects",
                          district: Column | None = None) -> DataFrame:
    """Each municipality followed by its parts, one catalog row each.

    The municipality id must be ``district/municipality``.  Rows of all
    districts go through one plan, so no per-district frames are concatenated;
    ``district`` overrides the name taken from the id.
    """
    place = ["id", "name", "detailedLevel", "parentIds"]
    extra = [] if district is None else [district.alias("given_district")]
    municipalities = df.select(F.explode(objects).alias("m"), *extra)

    def as_place(c: Column) -> Column:
        ids = F.coalesce(c["parentIds"], F.array().cast("array<string>"))
        return F.struct(*[c[p].alias(p) for p in place[:3]], ids.alias("parentIds"))

    parts = F.coalesce(F.col("m.sublocations"), F.expr("filter(array(m.sublocations[0]), x -> false)"))
    places = F.concat(F.array(as_place(F.col("m"))), F.transform(parts, as_place))
    own = path_part(F.col("m.id"), 0)
    return municipalities.select(
        (own if district is None else F.col("given_district")).alias("district"),
        path_part(F.col("m.id"), 1).alias("municipality"),
        F.explode(places).alias("p"),
    ).select("district", "municipality", "p.*")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def concat_pages(df: DataFrame, key: str, items: str) -> DataFrame:
    """Items of all result pages of a key, one row per item; no order contract."""
    return df.select(key, F.explode(items).alias("item"))


def tag_columns(df: DataFrame, properties: str, tags: Sequence[tuple[str, str]]) -> DataFrame:
    """Scalar tags out of a JSON object, parsed once per row.

    ``tags`` pairs the JSON key with the column name.
    """
    schema = ", ".join(f"`{key}` string" for key, _ in tags)
    parsed = df.withColumn("_tags", F.from_json(F.col(properties).cast("string"), schema))
    kept = [c for c in df.columns if c != properties]
    return parsed.select(*kept, *[F.col("_tags")[key].alias(name) for key, name in tags])
