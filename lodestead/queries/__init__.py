"""Queries over the provided tables, each with the SQL that must give the same rows."""

from lodestead.queries import analysis, files, keyed, learning, nested, places, scalars  # noqa: F401
from lodestead.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
