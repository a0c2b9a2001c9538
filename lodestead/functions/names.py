"""Column names from free text."""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name of a text without any usable character.
EMPTY_NAME = "_invalid_name_"


def column_name(text: object) -> str:
    """ASCII, lower case, runs of other characters as ``_``, no leading digit."""
    plain = unicodedata.normalize("NFKD", str(text)).encode("ascii", "ignore").decode()
    name = re.sub(r"[^a-z0-9_]+", "_", plain.lower()).strip("_")
    if not name:
        return EMPTY_NAME
    return f"col_{name}" if name[0].isdigit() else name


def _column_name_batch(text: pd.Series) -> pd.Series:
    return text.map(column_name, na_action="ignore")


def column_name_of(c: Column) -> Column:
    """Python-backed because Spark has no NFKD; call it on distinct values only."""
    return F.pandas_udf(_column_name_batch, "string")(c.cast("string"))


# Send the helpers with the task, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
