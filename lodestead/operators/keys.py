"""Keyed operators: distinct keys, one row per key, existing and new rows."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.text import is_present


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values that are neither null nor empty."""
    return df.filter(is_present(F.col(column))).select(column).distinct()


def latest_per_key(
    df: DataFrame, keys: Sequence[str], latest_by: str, tie_break: Sequence[str]
) -> DataFrame:
    """Newest row per key, nulls last; rows without a key are left out.

    The rank filter lets Spark keep one row per key in every map task before
    the shuffle, so a hot key sends at most one row per task.
    """
    present = df
    for k in keys:
        present = present.filter(is_present(F.col(k)))
    order = [F.col(latest_by).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    return _top_row(present, keys, order)


def _top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def one_per_key(
    df: DataFrame,
    key: str,
    sort: str | None,
    keep: str = "last",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """First or last row per key in ``sort`` order with nulls first.

    Missing keys (null, empty, the text ``nan``) are dropped before the key
    becomes text.  Without the sort column any one row per key is kept.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep}")
    if key not in df.columns:
        raise KeyError(f"missing columns: [{key!r}]")
    text = F.col(key).cast("string")
    known = df.filter(is_present(F.col(key)) & (F.lower(text) != "nan")).withColumn(key, text)
    if sort is None or sort not in df.columns:
        warnings.warn(f"sort column {sort!r} not found, keeping any row per key", stacklevel=2)
        return known.dropDuplicates([key])
    if keep == "first":
        order = [F.col(c).asc_nulls_first() for c in (sort, *tie_break)]
    else:
        order = [F.col(c).desc_nulls_last() for c in (sort, *tie_break)]
    return _top_row(known, [key], order)


class DateRange(NamedTuple):
    """All days from ``first`` to ``last``, for batches of more dates than a list should hold."""

    first: str
    last: str


def of_dates(target: DataFrame, dates: Iterable[str] | DateRange | None, date_column: str = "ingestionDate") -> DataFrame:
    """The partitions of some load dates; all for None."""
    if dates is None:
        return target
    if isinstance(dates, DateRange):
        return target.filter(F.col(date_column).between(*[F.lit(d).cast("date") for d in dates]))
    return target.filter(F.col(date_column).isin([F.lit(str(d)).cast("date") for d in dates]))


def existing_keys(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], dates: Iterable[str] | DateRange | None = None,
    date_column: str = "ingestionDate", multiply: bool = False,
) -> DataFrame:
    """Batch keys that the target already holds.

    ``dates`` limits the target scan to the partitions of the batch.  One row
    per key; ``multiply=True`` gives one per matching target row instead.
    No broadcast is forced: Spark picks one only below its size threshold.
    """
    held = of_dates(target, dates, date_column)
    held = held.select(*keys) if multiply else distinct_keys(held, keys)
    return held.join(distinct_keys(batch, keys), list(keys), "left_semi")


def new_rows(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], dates: Iterable[str] | DateRange | None = None,
    date_column: str = "ingestionDate",
) -> DataFrame:
    """Batch rows whose key is not in the target.  Rows with a null key stay.

    Only the key columns of the target are read, reduced to one row per key
    before the shuffle.
    """
    return batch.join(distinct_keys(of_dates(target, dates, date_column), keys), list(keys), "left_anti")


def batch_numbers(df: DataFrame, key: str, batch_size: int, number: str = "batch_no") -> DataFrame:
    """Number the distinct keys in full batches of ``batch_size``.

    Keys are put in the order of their MD5 text, whose prefix cuts them into
    65,536 even ranges whatever the keys look like.  Each range is numbered on
    its own and shifted by the size of the ranges before it, so no task sees
    all keys.
    """
    keys = distinct_values(df, key).withColumn("_hash", F.md5(F.col(key).cast("string")))
    keys = keys.withColumn("_range", F.substring("_hash", 1, 4))
    # At most 65,536 rows, by construction.
    before = keys.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range",
        (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"),
    )
    within = Window.partitionBy("_range").orderBy("_hash", key)
    return (
        keys.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(before), "_range")
        .select(
            key,
            F.floor((F.col("_before") + F.col("_row") - 1) / F.lit(batch_size)).cast("bigint").alias(number),
        )
    )


def lists_per_key(df: DataFrame, key: str, value: str, max_items: int = 10_000) -> DataFrame:
    """Sorted lists of the values of each key, cut into lists of about ``max_items``.

    A key with few values has one list, numbered 0.  A key with many is spread
    over as many lists as it needs by the hash of the value; copies of one
    value are counted first and dealt out over the lists in turn.  So no task
    builds a list of unbounded length, and nothing is left out.
    """
    counted = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_copies"))
    dealt = deal_copies(counted, [key], F.col(value), max_items, "list_no")
    return dealt.groupBy(key, "list_no").agg(
        F.sort_array(F.flatten(F.collect_list(F.array_repeat(F.col(value), F.col("_copies"))))).alias("items")
    )


def deal_copies(counted: DataFrame, group: Sequence[str], spread_by: Column, max_items: int, number: str) -> DataFrame:
    """Deal distinct rows with a count ``_copies`` into numbered parts of about ``max_items``.

    A row is split into one row per part that gets some of its copies, with
    ``_copies`` now the share of that part.
    """
    parts = counted.groupBy(*group).agg(F.ceil(F.sum("_copies") / F.lit(max_items)).alias("_parts"))
    turns = F.sequence(F.lit(0).cast("bigint"), F.least("_copies", "_parts") - 1)
    share = F.floor((F.col("_copies") - F.col("_turn") + F.col("_parts") - 1) / F.col("_parts"))
    return (
        counted.join(parts, list(group))
        .withColumn("_turn", F.explode(turns))
        .withColumn(number, F.pmod(hash_bucket(spread_by, F.col("_parts")) + F.col("_turn"), F.col("_parts")))
        .withColumn("_copies", share.cast("int"))
        .drop("_turn", "_parts")
    )


def hash_bucket(c: Column, buckets: Column | int) -> Column:
    """Stable bucket of a value: first eight MD5 digits modulo the bucket count."""
    digits = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(digits, F.lit(buckets) if isinstance(buckets, int) else buckets).cast("bigint")
