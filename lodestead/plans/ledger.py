"""A ledger of loads: which are done, what they counted, and what a broken one was about to append.

A ledger is a folder.  ``done`` holds one small Parquet folder for each load
that is complete, ``begun`` one for each whose rows are chosen, ``rows`` the
chosen rows until the load is done, ``totals`` one for each target, written
anew by each load.  Spark's commit shows each of them as a
whole or not at all, so a load that stops anywhere goes on from the last one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lodestead.session import remove_folder

ENTRY = "load string, target string, received bigint, without_key bigint, appended bigint, table_rows bigint, at timestamp"


def folder_name(load: str) -> str:
    """A load may be named by a path or anything else."""
    return hashlib.md5(load.encode()).hexdigest()


def part_path(ledger: str, part: str, load: str) -> str:
    return f"{ledger.rstrip('/')}/{part}/{folder_name(load)}"


def read_entry(spark: SparkSession, ledger: str, part: str, load: str) -> Row | None:
    try:
        return spark.read.schema(ENTRY).parquet(part_path(ledger, part, load)).first()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def write_entry(spark: SparkSession, ledger: str, part: str, load: str, target: str, counters: dict[str, int]) -> None:
    fields = [counters.get(c) for c in ("received", "without_key", "appended", "table_rows")]
    row = spark.createDataFrame([(load, target, *fields)], ENTRY.rsplit(",", 1)[0]).withColumn("at", F.current_timestamp())
    row.coalesce(1).write.mode("overwrite").parquet(part_path(ledger, part, load))


def forget_rows(spark: SparkSession, ledger: str, load: str) -> None:
    """Remove what a load kept for going on, once it is done."""
    for part in ("begun", "rows"):
        remove_folder(spark, part_path(ledger, part, load))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row (``ENTRY``) for each load that is done."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{ledger.rstrip('/')}/done/*")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], ENTRY)


def rows_before(spark: SparkSession, ledger: str, target: str) -> int | None:
    """The rows that a target had after the last load of the ledger into it; one small file, however many loads there were."""
    entry = read_entry(spark, ledger, "totals", target)
    return entry and entry["table_rows"]
