"""Writers and table maintenance."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from lodestead.operators.keys import deal_copies
from lodestead.session import remove_folder
from lodestead.sources.snapshots import read_table, snapshot_name


class Layout(NamedTuple):
    """How a table's files are dealt out, and the columns that must not be null."""

    partition_by: tuple[str, ...]
    bucket_by: tuple[str, ...]
    buckets: int
    keys: tuple[str, ...]


#: Table property that names the key columns.
KEYS = "key_columns"


def create_table(
    spark: SparkSession, name: str, schema: StructType, path: str | None = None,
    partition_by: Sequence[str] = ("ingestionDate",), keys: Sequence[str] = (), bucket_by: Sequence[str] = (),
    buckets: int = 64,
) -> None:
    """An empty Parquet table partitioned by load date.

    :func:`append_table` refuses rows with a null in ``keys``.  The files of a
    table with ``bucket_by`` hold one bucket each and are sorted by it, so a
    join or a group by on these columns reads the table without an exchange.
    """
    writer = spark.createDataFrame([], schema).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if keys:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{KEYS}' = '{','.join(keys)}')")


def table_layout(spark: SparkSession, name: str) -> Layout:
    columns = spark.catalog.listColumns(name)
    bucket_by = tuple(c.name for c in columns if c.isBucket)
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()} if bucket_by else {}
    keys = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == KEYS).collect()
    return Layout(
        tuple(c.name for c in columns if c.isPartition), bucket_by, int(told.get("Num Buckets", 0)),
        tuple(keys[0]["value"].split(",")) if keys else (),
    )


def laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows of one partition together and sorted, so row groups can be skipped by key.

    Rebalancing, unlike a plain repartition, lets adaptive execution split a
    date that holds a large share of the rows over several tasks and files.
    """
    together = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return together.sortWithinPartitions(*partition_by, *sort_by)


def in_buckets(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows dealt as the table's buckets are: a task has one bucket, whatever its date."""
    return df.repartition(layout.buckets, *layout.bucket_by)


def append_table(df: DataFrame, name: str, layout: Layout | None = None) -> None:
    """Append by column name to a table that must exist, in the table's layout, which is looked up if it is not given.

    A row that lacks one of the table's key columns fails the write, which then
    leaves the table as it was.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    layout = layout or table_layout(spark, name)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    rows = rows.withColumns({
        c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.lit(f"{name}: {c} is null")).cast(kinds[c]))
        for c in layout.keys
    })
    if layout.bucket_by:
        rows = in_buckets(rows, layout).sortWithinPartitions(*layout.partition_by, *layout.bucket_by)
    elif layout.partition_by:
        rows = laid_out(rows, layout.partition_by, [c for c in layout.keys if c not in layout.partition_by])
    rows.write.insertInto(name)


# --- versioned replace -----------------------------------------------------

_VERSION = "__v"


def table_versions(spark: SparkSession, name: str) -> list[str]:
    """The version tables of a replaced table, oldest first."""
    *database, short = name.split(".")
    place = f" IN {'.'.join(database)}" if database else ""
    found = spark.sql(f"SHOW TABLES{place} LIKE '{short}{_VERSION}*'").collect()
    prefix = f"{'.'.join(database)}." if database else ""
    return sorted(prefix + r["tableName"] for r in found)


def replace_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = (), keep: int = 2
) -> str:
    """Full refresh: write a new version, then turn the view ``name`` to it; returns the version's table.

    Readers never meet an absent table.  One that has resolved the name keeps
    the version that it saw; a failed write leaves the view where it was.  The
    ``keep`` newest versions stay, so the version before is still there for
    readers that are at work.  Two writers at once: the second to begin fails,
    since a version's number is taken once.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table; a replaced table is a view of its newest version")
    older = table_versions(spark, name)
    number = int(older[-1].rsplit(_VERSION, 1)[1]) + 1 if older else 1
    version = f"{name}{_VERSION}{number:06d}"
    writer = df.write.mode("error").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        # A write that failed may have left files: each attempt has a folder of its own.
        writer = writer.option("path", f"{path.rstrip('/')}/{number:06d}-{uuid.uuid4().hex}")
    writer.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in older[: max(len(older) + 1 - keep, 0)]:
        drop_version(spark, old)
    return version


def drop_version(spark: SparkSession, version: str) -> None:
    """Drop a version's table and its files."""
    described = spark.sql(f"DESCRIBE EXTENDED {version}").filter("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE {version}")
    if described:
        remove_folder(spark, described["data_type"])


def table_rows(spark: SparkSession, name: str) -> int:
    return read_table(spark, name).count()


def write_snapshot(df: DataFrame, folder: str, source: str, day: str | dt.date, if_exists: str = "overwrite") -> str:
    """Dated snappy snapshot ``folder/source_YYYY-MM-DD.parquet``; returns its path.

    ``if_exists="ignore"`` leaves an existing snapshot as it is.  The commit
    protocol makes the files visible only when the job is complete.
    """
    path = f"{folder.rstrip('/')}/{snapshot_name(source, day)}"
    df.write.mode(if_exists).option("compression", "snappy").parquet(path)
    return path


#: Copies of one item on a line of a document.
_COPIES_PER_LINE = 1000


def district_documents(
    df: DataFrame, district: str, location: str, items_per_document: int = 10_000, as_lines: bool = False
) -> DataFrame:
    """JSON documents ``{location: [listing, ...]}``, several for a large district.

    A location's listings are spread over documents by the hash of the row,
    copies of one row in turn, so that no document grows beyond about
    ``items_per_document`` listings however many a district, a location or a
    group of copies has.

    A row is a document, which a task holds as one value.  For documents of
    any size ``as_lines`` gives (district, document_no, value) with an item on
    each row and the brackets beside it.  A document's rows lie in one
    partition in order, so text partitioned by its two columns is one file for
    each document.
    """
    listing = F.struct(*[c for c in df.columns if c not in (district, location)])
    items = df.select(district, location, listing.alias("_item")).withColumn("_text", F.to_json("_item"))
    kept = [] if as_lines else [F.any_value("_item").alias("_item")]
    counted = items.groupBy(district, location, "_text").agg(*kept, F.count(F.lit(1)).alias("_copies"))
    dealt = deal_copies(counted, [district], F.col("_text"), items_per_document, "document_no")
    if as_lines:
        return _document_lines(dealt, district, location)
    items = dealt.groupBy(district, "document_no", location).agg(
        F.flatten(F.collect_list(F.array_repeat(F.col("_item"), F.col("_copies")))).alias("items")
    )
    return items.groupBy(district, "document_no").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(location, "items")))).alias("value")
    )


def _document_lines(dealt: DataFrame, district: str, location: str) -> DataFrame:
    """Rows with a text and its number of copies to the lines of their documents."""
    last_line = F.floor((F.col("_copies") - 1) / _COPIES_PER_LINE)
    # Neither part of the file's path may be nullable: the writer would put another column in
    # its place and sort by that, and the order within a document would be lost.
    lines = dealt.select(
        F.coalesce(district, F.lit("")).alias(district), F.coalesce("document_no", F.lit(0)).alias("document_no"),
        F.coalesce(F.col(location).cast("string"), F.raise_error(F.lit("a location is null")).cast("string")).alias("_key"),
        "_text", "_copies", F.explode(F.sequence(F.lit(0).cast("bigint"), last_line)).alias("_line"),
    )
    document = [district, "document_no"]
    order = [*document, "_key", "_text", "_line"]
    within = Window.partitionBy(*document).orderBy("_key", "_text", "_line")
    before, last = F.lag("_key").over(within), F.lead("_key").over(within).isNull()
    opened = F.concat(F.regexp_replace(F.to_json(F.array("_key")), r"^\[|\]$", ""), F.lit(":["))
    start = F.when(before.isNull(), F.concat(F.lit("{"), opened)).when(before == F.col("_key"), ",").otherwise(
        F.concat(F.lit("],"), opened)
    )
    copies = F.least(F.col("_copies") - F.col("_line") * _COPIES_PER_LINE, F.lit(_COPIES_PER_LINE)).cast("int")
    value = F.concat(start, F.array_join(F.array_repeat("_text", copies), ","), F.when(last, "]}").otherwise(""))
    return lines.select(*order, value.alias("value")).sortWithinPartitions(*order).select(*document, "value")


def write_district_documents(df: DataFrame, path: str, district: str, location: str,
                             items_per_document: int = 10_000) -> None:
    """One JSON document per line, one folder per district."""
    docs = district_documents(df, district, location, items_per_document)
    docs.select(district, "value").write.mode("overwrite").partitionBy(district).text(path)


def write_district_lines(df: DataFrame, path: str, district: str) -> None:
    """The flat form: one listing per line, one folder per district."""
    df.write.mode("overwrite").partitionBy(district).json(path)


def write_catalog(df: DataFrame, path: str) -> None:
    """CSV with a header; lists and structs as JSON text."""
    columns = [
        (F.to_json(f.name) if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f.name)).alias(f.name)
        for f in df.schema.fields
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def open_payload(df: DataFrame, json_column: str, payload: str = "payload") -> DataFrame:
    """Keep nested JSON as one VARIANT value.

    Parquet has no empty struct; an open value stores ``{}`` as it is, so
    nothing has to be patched before writing.
    """
    return df.withColumn(payload, F.try_parse_json(json_column)).drop(json_column)
