"""Casts that turn bad input into null instead of failing the job."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.functions.text import strip

# Characters of plain decimal notation.  A bare try_cast would also take 1d, 0x1p3 or Infinity.
_NUMBER_CHARACTERS = "0123456789.+-eE"
_WHOLE_CHARACTERS = "0123456789+-"


def _only(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "") == ""


def to_text(c: Column) -> Column:
    return c.cast("string")


def to_double(c: Column) -> Column:
    text = strip(c.cast("string"))
    return F.when(_only(text, _NUMBER_CHARACTERS), text.try_cast("double"))


def to_long(c: Column) -> Column:
    """Whole numbers, also written as 12.0 or 1e3; fractions become null.  No digit is lost above 2^53."""
    text = strip(c.cast("string"))
    number = text.try_cast("decimal(38,18)")
    return F.when(_only(text, _WHOLE_CHARACTERS), text.try_cast("bigint")).when(
        _only(text, _NUMBER_CHARACTERS) & (number == F.floor(number)), number.try_cast("bigint")
    )


def to_whole_text_number(c: Column) -> Column:
    """Only digits with an optional sign; 2.0 is rejected."""
    text = strip(c.cast("string"))
    return F.when(_only(text, _WHOLE_CHARACTERS), text.try_cast("bigint"))


def to_boolean(c: Column) -> Column:
    """true/false/1/0 in any case, everything else null."""
    text = F.lower(c.cast("string"))
    return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)


def to_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def epoch_to_date_text(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.timestamp_seconds(c), pattern)


def date_from_file_name(path: Column) -> Column:
    """``name_2025-05-02.parquet`` -> 2025-05-02, also for a part file below it; else null."""
    return F.regexp_extract(path, r"_(\d{4}-\d{2}-\d{2})\.[^./]+(?:/[^/]*)?$", 1).try_cast("date")


def run_date(value: str | dt.date | None = None) -> Column:
    """The load date: given for reproducible runs, today otherwise."""
    return F.current_date() if value is None else F.lit(str(value)).cast("date")


CASTS = {
    "string": to_text,
    "double": to_double,
    "long": to_long,
    "boolean": to_boolean,
    "timestamp": to_timestamp,
    "date": to_date,
}


# Source types that need no text on the way to the target type.
_DIRECT = {
    ("int", "long"), ("bigint", "long"), ("int", "double"), ("bigint", "double"), ("float", "double"),
    ("double", "double"), ("boolean", "boolean"), ("date", "date"), ("timestamp", "timestamp"),
}
_SPARK_NAMES = {"long": "bigint"}


def convert(c: Column, source: str, target: str) -> Column:
    """Cast from a known source type; only other sources are parsed as text."""
    if (source, target) in _DIRECT:
        return c.cast(_SPARK_NAMES.get(target, target))
    return CASTS[target](c)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Convert the listed columns; unknown columns are reported and skipped."""
    missing = [c for c in types if c not in df.columns]
    if missing:
        warnings.warn(f"columns to convert not found: {missing}", stacklevel=2)
    sources = dict(df.dtypes)
    return df.withColumns({c: convert(F.col(c), sources[c], t) for c, t in types.items() if c not in missing})


def lossy_cast_counts(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """How many present values each conversion turns into null."""
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & CASTS[t](F.col(c)).isNull()).alias(c)
            for c, t in types.items()
            if c in df.columns
        ]
    )
