"""JSON text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An escape counts only after an even number of backslashes.
_ESCAPE = r"(?<!\\)((?:\\\\)*)\\u"
_HIGH = r"[dD][89abAB][0-9a-fA-F]{2}"
_LOW = r"[dD][c-fC-F][0-9a-fA-F]{2}"
_LONE_HIGH = rf"{_ESCAPE}{_HIGH}(?!\\u{_LOW})"
_LONE_LOW = rf"(?<!\\u{_HIGH}){_ESCAPE}{_LOW}"


def repair_surrogates(raw_json: Column, replacement: str = r"�") -> Column:
    """Replace lone surrogate escapes in raw JSON text; valid pairs stay.

    Runs before parsing, because the JSON reader would replace a lone half
    with ``?`` on its own.
    """
    # In a replacement text a literal backslash needs another one.
    escaped = "$1" + replacement.replace("\\", "\\\\")
    repaired = F.regexp_replace(F.regexp_replace(raw_json, _LONE_HIGH, escaped), _LONE_LOW, escaped)
    # Few texts hold any such escape; a plain search spares the others the patterns.
    suspect = F.contains(raw_json, F.lit(r"\ud")) | F.contains(raw_json, F.lit(r"\uD"))
    return F.when(suspect, repaired).otherwise(raw_json)


# Closes the list that is_json puts around a text; not expected in data.
_END = "\\u0001end\\u0001"


def is_json(c: Column) -> Column:
    """Does the text hold exactly one JSON value and nothing after it.

    The JSON reader stops at the end of the first value and ignores the rest.
    Inside a list with a closing mark the mark is only found in its place when
    the text is one whole value.
    """
    text = F.concat(F.lit("["), c, F.lit(f',"{_END}"]'))
    listed = F.from_json(text, "array<string>", {"allowSingleQuotes": "false"})
    whole = (F.size(listed) == 2) & (F.get(listed, F.lit(1)) == "\u0001end\u0001")
    return F.coalesce(whole, F.lit(False))


def variant_text(v: Column) -> Column:
    """Text of one open value: text as is, objects as JSON, null as empty, True/False."""
    text = F.try_variant_get(v, "$", "string")
    flag = text.isin("true", "false") & (F.schema_of_variant(v) == "BOOLEAN")
    return F.coalesce(F.when(flag, F.initcap(text)).otherwise(text), F.lit(""))


def variant_list_text(v: Column) -> Column:
    """Array of texts from an open list; anything but a list gives an empty one."""
    items = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(F.transform(items, variant_text), F.array().cast("array<string>"))


def line_states(lines: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``state``: blank, bad or ok."""
    text = F.regexp_replace(F.col(value), r"(?U)^\s+|\s+$", "")
    state = F.when(text == "", "blank").when(is_json(text), "ok").otherwise("bad")
    return lines.withColumn("state", state)
