"""The daily loads: newest snapshot -> staging rows -> new rows only -> append."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodestead.operators.details import stage_details
from lodestead.operators.keys import DateRange, existing_keys, new_rows, of_dates
from lodestead.operators.projections import require_columns, stage_listings
from lodestead.plans.ledger import folder_name, forget_rows, part_path, read_entry, rows_before, write_entry
from lodestead.session import remove_folder, scratch_path, setting
from lodestead.sources.pages import embedded_json
from lodestead.sources.sinks import Layout, append_table, create_table, in_buckets, table_layout
from lodestead.sources.snapshots import newest_snapshot, newest_snapshot_row, read_snapshot, read_table
from lodestead.functions.casts import date_from_file_name


def one_per_batch_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key of the batch, the last in ``order``; rows with a null in the key are left out.

    The rank is taken in every map task before the shuffle, so a hot key sends
    one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return with_key(batch, keys).withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def with_key(batch: DataFrame, keys: Sequence[str], present: bool = True) -> DataFrame:
    """The rows whose key has no null, or with ``present=False`` the others."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return batch.filter(whole if present else ~whole)


#: The key columns of a row as one value.
_KEY = "_key"


def new_of_batch(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str],
    dates: Iterable[str] | DateRange | None = None, date_column: str = "ingestionDate",
) -> DataFrame:
    """One row per key of the batch, as in :func:`one_per_batch_key`, if the target does not hold the key.

    The key columns are one struct until the end.  Apart, a date that is a
    literal in the batch or in the target would be a key of the dedup but none
    of the join, and the join would move the whole rows a second time.
    """
    held = of_dates(target, dates, date_column)
    kinds = [[f.dataType for f in df.select(*keys).schema] for df in (batch, held)]
    if kinds[0] != kinds[1]:  # columns are cast for a join, fields of a struct are not
        return new_rows(one_per_batch_key(batch, keys, order), held, keys)
    packed = F.struct(*[F.col(k).alias(k) for k in keys])
    unique = one_per_batch_key(
        with_key(batch, keys).withColumn(_KEY, packed).drop(*keys), [_KEY],
        [f"{_KEY}.{c}" if c in keys else c for c in order],
    )
    new = new_rows(unique, with_key(held, keys).select(packed.alias(_KEY)), [_KEY])
    others = [F.col(f"`{c}`") for c in new.columns if c != _KEY]
    return new.select(*[F.col(f"{_KEY}.{k}").alias(k) for k in keys], *others)


#: Load dates of one batch that are looked up one by one in the target; a batch of more looks up all days between.
MAX_DATES = 400


class Profile(NamedTuple):
    """What a load must know of a batch before it starts."""

    received: int
    without_key: int
    dates: Iterable[str] | DateRange | None


def batch_profile(batch: DataFrame, keys: Sequence[str], date_column: str = "ingestionDate") -> Profile:
    """Rows, rows without a key, and load dates, in one pass over the key columns."""
    nullable = reduce(or_, [F.col(k).isNull() for k in keys])
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(nullable).alias("keyless")]
    if date_column not in batch.columns:
        return Profile(*batch.agg(*counts).first(), None)
    day = F.col(date_column).cast("string").alias("d")
    found = batch.groupBy(day).agg(*counts).limit(MAX_DATES + 2).collect()  # null may be one of them
    dates = [r["d"] for r in found if r["d"] is not None]
    if len(dates) <= MAX_DATES:
        return Profile(sum(r["rows"] for r in found), sum(r["keyless"] for r in found), dates)
    rows, keyless, first, last = batch.agg(*counts, F.min(day), F.max(day)).first()
    return Profile(rows, keyless, DateRange(first, last))


def keyed_append(
    batch: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], dates: Iterable[str] | None = None,
    date_column: str = "ingestionDate", dedup: bool = True, quarantine: str | None = None,
    ledger: str | None = None, load: str | None = None,
) -> dict[str, int]:
    """Append the batch rows whose key the table does not hold; returns the counters.

    One plan: dedup, anti join against the keys of the batch's partitions.  Both
    are dealt by the same key, so the batch is moved once for both, and by the
    buckets of a bucketed table, which is then read without an exchange.  What
    it chooses is kept as files and appended from there: the counters are those
    of committed rows, whichever tasks were run twice.

    Rows with a null in the key could never be found again: they are counted
    and, with a ``quarantine`` table (:func:`create_quarantine`), stored there.

    A ``load`` with a name in a ``ledger`` folder happens once.  If it is done,
    its counters come back and nothing is written; if it broke off, it goes on
    with the rows that it had chosen.  ``table_rows`` is then counted as well.
    Without a ledger the content of the rows without a key names the load in
    the quarantine, so that the same batch again adds nothing there either.
    """
    spark = batch.sparkSession
    if (ledger is None) != (load is None):
        raise ValueError("a ledger needs the name of the load, and a load a ledger")
    done = ledger and read_entry(spark, ledger, "done", load)
    if done:
        return _counters(done)
    begun = read_entry(spark, ledger, "begun", load) if ledger else None
    chosen = part_path(ledger, "rows", load) if ledger else scratch_path(spark, "chosen-rows")
    target, layout = read_table(spark, table), table_layout(spark, table)
    profile = batch_profile(batch, keys, date_column)
    dates = profile.dates if dates is None else dates
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        if begun is None:
            new = _new_of_batch(batch, target, layout, keys, order, dates, date_column, dedup)
            new.write.mode("overwrite").parquet(chosen)
        # A load that broke off may have appended already: its keys are then found.
        rows = spark.read.schema(batch.schema).parquet(chosen)
        added = begun["appended"] if begun else rows.count()
        counters = {"received": profile.received, "without_key": profile.without_key, "appended": added}
        if begun:
            counters = _counters(begun) | {"appended": added}
            rows = new_rows(rows, target, keys, dates, date_column)
        elif ledger:
            before = rows_before(spark, ledger, table)
            counters["table_rows"] = (target.count() if before is None else before) + added
            write_entry(spark, ledger, "begun", load, table, counters)
        if added:
            append_table(rows, table, layout)
    if quarantine and counters["without_key"]:
        set_aside(with_key(batch, keys, present=False), quarantine, load)
    if ledger:
        if not begun or (rows_before(spark, ledger, table) or 0) < counters["table_rows"]:  # others may have come since
            write_entry(spark, ledger, "totals", table, table, counters)
        write_entry(spark, ledger, "done", load, table, counters)
        forget_rows(spark, ledger, load)
    else:
        remove_folder(spark, chosen)
    return counters


def _counters(entry: Row) -> dict[str, int]:
    return {c: entry[c] for c in ("received", "without_key", "appended", "table_rows")}


def _new_of_batch(
    batch: DataFrame, target: DataFrame, layout: Layout, keys: Sequence[str], order: Sequence[str], dates,
    date_column: str, dedup: bool,
) -> DataFrame:
    if layout.bucket_by and set(layout.bucket_by) <= set(keys):
        batch = in_buckets(batch, layout)
    elif dedup:
        return new_of_batch(batch, target, keys, order, dates, date_column)
    unique = one_per_batch_key(batch, keys, order) if dedup else with_key(batch, keys)
    return new_rows(unique, target, keys, dates, date_column)


#: Partition column of a quarantine: the load that set the rows aside.
LOAD = "load_id"


def create_quarantine(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """A table for the rows of ``schema`` that have no key, partitioned by the load that brought them."""
    create_table(spark, name, StructType([*schema.fields, StructField(LOAD, StringType())]), path, [LOAD])


def set_aside(rows: DataFrame, quarantine: str, load: str | None = None) -> None:
    """Store rows as the partition of their load, in place of what an earlier run of it has stored.

    A load without a name is named by its rows' content.
    """
    spark = rows.sparkSession
    if LOAD not in spark.table(quarantine).columns:
        raise ValueError(f"{quarantine} has no column {LOAD}; make it by create_quarantine")
    if load is None:
        hashes = rows.select(F.xxhash64(*[F.to_json(F.struct(c)) for c in rows.columns]).alias("h"))
        n, total, mix = hashes.agg(F.count("*"), F.sum(F.col("h").cast("decimal(20,0)")), F.bit_xor("h")).first()
        load = f"{n}:{total}:{mix}"
    named = rows.withColumn(LOAD, F.lit(folder_name(load))).select(*spark.table(quarantine).columns)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        named.write.insertInto(quarantine, overwrite=True)


def load_catalog_snapshot(
    spark: SparkSession, folder: str, table: str, pattern: str = "*.parquet", run_date: str | dt.date | None = None,
    keys: Sequence[str] = ("slug", "ingestionDate"), order: Sequence[str] = ("dateCreated", "id"),
    ledger: str | None = None,
) -> dict[str, int] | None:
    """Newest search-result snapshot into the staging table; None without a snapshot.

    With a ``ledger`` a snapshot is loaded once for each run date, and once more if it was written again.
    """
    newest = newest_snapshot_row(spark, folder, pattern)
    if newest is None:
        return None
    path, load = newest["path"], None
    day = str(run_date or dt.datetime.now(dt.timezone.utc).date())
    staged = stage_listings(require_columns(read_snapshot(spark, path), ["id", "slug"]), day)
    if ledger:
        load = f"{path}@{newest['modified'].isoformat()}@{day}"
    return keyed_append(staged, table, keys, order, [day], ledger=ledger, load=load)


def load_detail_snapshot(
    spark: SparkSession, folder: str, table: str, pattern: str = "*.parquet", props: str = "props",
    keys: Sequence[str] = ("id", "ingestionDate"), order: Sequence[str] = ("modified_at", "slug"),
) -> dict[str, int] | None:
    """Newest detail snapshot into its staging table, dated by its file name."""
    path = newest_snapshot(spark, folder, pattern)
    if path is None:
        return None
    raw = read_snapshot(spark, path)
    day = spark.range(1).select(date_from_file_name(F.lit(path)).alias("d")).first()["d"]
    if day is not None:
        raw = raw.withColumn("ingestionDate", F.lit(str(day)))
    staged = stage_details(raw, props)
    return keyed_append(staged, table, keys, order, None if day is None else [str(day)])


def detail_pages(pages: DataFrame, run_date: str | dt.date | None = None) -> DataFrame:
    """Landed pages to the rows of a detail snapshot: props as JSON text, date, URL."""
    return embedded_json(pages, run_date=run_date).select(
        F.get_json_object("page", "$.props").alias("props"), "ingestionDate", "sourceUrl"
    )


def already_loaded(spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str],
                   dates: Iterable[str] | None = None) -> DataFrame:
    """Keys of the batch that a load would skip."""
    return existing_keys(read_table(spark, table), batch, keys, dates)
