"""Text cleaning and text-derived flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Without whitespace at either end; a bare trim would only remove spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalise(c: Column) -> Column:
    """Lower-case and strip, the form used for matching names."""
    return F.lower(strip(c))


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def clean_category(c: Column) -> Column:
    return blank_to_null(normalise(c.cast("string")))


def is_present(c: Column) -> Column:
    """Not null and not the empty text."""
    return c.isNotNull() & (c.cast("string") != "")


def clean_suffix(c: Column) -> Column:
    """``/mês`` -> ``mês``; a missing or empty suffix is null."""
    return F.when(c != "", strip(F.replace(c, F.lit("/"), F.lit(""))))


def bedrooms_from_typology(c: Column) -> Column:
    """``T3`` -> 3 when the text starts with T and digits, in any case."""
    return F.regexp_extract(F.upper(c), r"^T(\d+)", 1).try_cast("bigint")


def path_part(c: Column, index: int, parts: int = 2, sep: str = "/") -> Column:
    """One part of a path that must have exactly ``parts`` parts."""
    pieces = F.split(c, sep)
    return F.when(F.size(pieces) == parts, F.get(pieces, F.lit(index))).otherwise(
        F.raise_error(F.concat(F.lit("unexpected path: "), c)).cast("string")
    )


# The first phrase found decides.
BEDROOM_PHRASES: Sequence[tuple[str, int]] = (("3 quartos", 3), ("2 quartos", 2), ("1 quarto", 1))

# A text starting with this marker is a placeholder, not a description.
PLACEHOLDER_PREFIX = "HTML Description"

# Phrases per amenity; the first phrase found decides.
AMENITY_PHRASES: Mapping[str, Sequence[tuple[str, object]]] = {
    "garage": (("garagem fechada", "Closed"), ("garagem", "Yes")),
    "heating": (("aquecimento central", "Central Heating"), ("aquecimento", "Yes")),
    "fireplace": (("lareira", True),),
    "balcony": (("varanda", True),),
    "suite": (("suite", True),),
    "kitchen_equipment": (("cozinha semi-equipada", "Semi-equipped"), ("cozinha equipada", "Equipped")),
}


def first_phrase(text: Column, phrases: Sequence[tuple[str, object]]) -> Column:
    """Value of the first phrase contained in the lower-cased text, else null."""
    lowered = F.lower(text)
    return F.coalesce(*[F.when(F.contains(lowered, F.lit(p)), F.lit(v)) for p, v in phrases])


def is_description(text: Column) -> Column:
    return (text != "") & ~F.startswith(text, F.lit(PLACEHOLDER_PREFIX))


def bedrooms_from_text(text: Column, phrases: Sequence[tuple[str, int]] = BEDROOM_PHRASES) -> Column:
    return F.when(is_description(text), first_phrase(text, phrases)).cast("bigint")


def amenity_columns(
    text: Column, phrases: Mapping[str, Sequence[tuple[str, object]]] = AMENITY_PHRASES
) -> dict[str, Column]:
    """Flags are true or null, never false: a missing phrase says nothing."""
    return {name: F.when(is_description(text), first_phrase(text, p)) for name, p in phrases.items()}


def keyword_flags(text: Column, keywords: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """One boolean per flag: does the text hold any of its keywords."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return {
        flag: reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w.lower())) for w in words])
        for flag, words in keywords.items()
    }
