"""File-arrival ingest with the same projection and keyed load as the batch job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodestead.plans.loads import keyed_append


def arriving_files(
    spark: SparkSession, folder: str, schema: StructType | str, pattern: str = "*.parquet",
    files_per_batch: int | None = 1000,
) -> DataFrame:
    """New Parquet files below a folder, each seen exactly once per checkpoint.

    A backlog is taken in batches of ``files_per_batch``.  Folder and pattern play the part of the event filter: other prefixes and
    suffixes never enter the stream.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_arrivals(
    stream: DataFrame, project: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Project and append everything available, then stop.

    Every run into one ``path`` must name the same ``checkpoint``: the sink
    skips batch numbers that it has seen, so a fresh one would lose files.
    """
    writer = project(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def load_arrivals(
    stream: DataFrame, project: Callable[[DataFrame], DataFrame], table: str, keys: Sequence[str],
    order: Sequence[str], checkpoint: str, quarantine: str | None = None, ledger: str | None = None,
) -> StreamingQuery:
    """Keyed load per micro-batch, each of which happens once.

    The ledger, by default ``checkpoint``/loads, knows the stream's batches by
    number: one that is run again after it was done changes neither target,
    quarantine nor counters, and one that broke off is carried to its end.
    Runs that name the same ``checkpoint`` read each file once.
    """
    ledger = ledger or f"{checkpoint.rstrip('/')}/loads"

    def load(batch: DataFrame, number: int) -> None:
        keyed_append(project(batch), table, keys, order, quarantine=quarantine, ledger=ledger, load=f"{checkpoint}#{number}")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
