"""Dated snapshot files and tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestead import schemas
from lodestead.functions.casts import date_from_file_name
from lodestead.operators.keys import distinct_values
from lodestead.operators.projections import require_columns


def list_snapshots(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per snapshot directly below ``folder``: path, modified, bytes, snapshot_date.

    A snapshot is a file, or the folder of part files that a Spark job wrote.
    Only the file listing is read, never the content.  Empty entries are left
    out.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(f"{folder.rstrip('/')}/{pattern}")
        .select("path", "modificationTime", "length")
    )
    # The entry below the folder, whatever scheme prefix the path came back with.
    tail = folder.rstrip("/").split("://")[-1].replace("file:", "").lstrip("/")
    entry = F.regexp_extract("path", rf"^(.*?/\Q{tail}\E/[^/]+)", 1)
    return (
        files.groupBy(entry.alias("path"))
        .agg(F.max("modificationTime").alias("modified"), F.sum("length").alias("bytes"))
        .filter("bytes > 0")
        .withColumn("snapshot_date", date_from_file_name(F.col("path")))
    )


def newest_snapshots(snapshots: DataFrame, n: int = 5, ties: str = "last") -> DataFrame:
    """The ``n`` newest snapshots.  Equal times: ``first`` or ``last`` path name wins."""
    path: Column = F.col("path").asc() if ties == "first" else F.col("path").desc()
    return snapshots.orderBy(F.col("modified").desc(), path).limit(n)


def newest_snapshot(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", on_empty: str = "none", ties: str = "last"
) -> str | None:
    """Path of the newest snapshot; None or an error when there is none."""
    row = newest_snapshot_row(spark, folder, pattern, ties)
    if row is None and on_empty == "error":
        raise FileNotFoundError(f"no snapshot like {pattern} in {folder}")
    return row and row["path"]


def newest_snapshot_row(spark: SparkSession, folder: str, pattern: str = "*.parquet", ties: str = "last") -> Row | None:
    """The newest snapshot of :func:`list_snapshots`; None when there is none."""
    try:
        return newest_snapshots(list_snapshots(spark, folder, pattern), 1, ties).first()
    except Exception as error:  # a pattern without a match is reported as a missing path
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def read_snapshot(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One snapshot; unused columns and non-matching row groups are not read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly work per row on an input of few files.

    A file with one row group is one task, however many cores are idle.  An
    input that already has a task per core is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_slugs(spark: SparkSession, path: str, column: str = "slug") -> DataFrame:
    """Distinct non-empty keys of a snapshot."""
    return distinct_values(require_columns(spark.read.parquet(path), [column]), column)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now: another session, such as a stream, may have added files."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The location catalog, a CSV file with a header and JSON lists."""
    return (
        spark.read.schema(schemas.CATALOG)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
        .withColumn("parentIds", F.from_json("parentIds", "array<string>"))
    )


def snapshot_name(source: str, day: str | dt.date, extension: str = "parquet") -> str:
    return f"{source}_{day}.{extension}"
