"""Shared pieces for texts: word pattern, chunks of bounded size for vectorised work, scratch tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 32 << 20) -> None:
    """Lowers the session's rows and bytes in an Arrow batch, which are texts here: 10,000 of them take too much of a worker."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        if not 0 < int(spark.conf.get(name).rstrip("b")) <= most:
            spark.conf.set(name, str(most))


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """n whole numbers that ``repartition(n, key)`` deals to n different partitions, so that no task gets two of few keys."""
    place, found, start = F.pmod(F.hash("id"), F.lit(n)), {}, 0
    while len(found) < n:
        size = 16 * n + 64
        rows = spark.range(start, start + size, 1, 1).groupBy(place.alias("place")).agg(F.min("id").alias("id")).collect()
        found = {r["place"]: r["id"] for r in rows} | found
        start += size
    return [found[i] for i in range(n)]


def give_back() -> None:
    """Returns a worker's freed memory to the system at a task's end: the next operator uses the same worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        pass


def encoded(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 bytes of texts; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of items of about ``limit`` in sum; a larger item is a run of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def words(text: Column) -> Column:
    """The runs of other than ASCII white space (``WORD``), without a regular expression."""
    for c in WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text; null and empty differ."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text, F.lit(11)).alias("h2")]
