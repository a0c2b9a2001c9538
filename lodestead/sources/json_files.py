"""JSON documents, JSON lines and GeoJSON text sequences."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestead import schemas
from lodestead.functions.json_text import is_json, line_states
from lodestead.sources.json_stream import PIECE, JsonDocuments


def read_documents(
    spark: SparkSession, path: str, document: str = schemas.DISTRICT_DOCUMENT, whole_file: bool = True,
    key: str = "location_id", on_bad: str = "fail",
) -> DataFrame:
    """Documents ``{key: [item, ...]}`` to one row per item.

    ``whole_file=True`` reads one document per file, the form of foreign files,
    item by item (:mod:`json_stream`): a file is one task's work, but of any
    size.  The writer of this package puts one bounded document on each line,
    which ``whole_file=False`` reads in parallel.  The item's own id and the key
    are both kept.  A document that does not parse fails the job, or is left
    out with ``on_bad="skip"`` and can be looked up with :func:`bad_documents`.
    """
    if on_bad not in ("fail", "skip"):
        raise ValueError(f"on_bad must be fail or skip, not {on_bad}")
    if whole_file:
        item = StructType.fromDDL(f"document {document}")["document"].dataType.valueType.elementType
        items = read_document_items(spark, path, on_bad)
        return items.select(F.col("key").alias(key), F.from_json("item", item).alias("item")).select(key, "item.*")
    docs = spark.read.text(path)
    parsed = docs.select(F.when(is_json(F.col("value")), F.from_json("value", document)).alias("doc"))
    if on_bad == "fail":
        checked = F.when(F.col("doc").isNotNull(), F.col("doc")).otherwise(
            F.raise_error(F.lit("a document is not valid JSON")).cast(document)
        )
        parsed = parsed.select(checked.alias("doc"))
    return (
        parsed.select(F.explode("doc").alias(key, "items"))
        .select(key, F.explode("items").alias("item"))
        .select(key, "item.*")
    )


def read_document_items(spark: SparkSession, path: str, on_bad: str = "fail", piece: int = PIECE) -> DataFrame:
    """(path, key, item) of each item of the documents below ``path``, the item as JSON text."""
    spark.dataSource.register(JsonDocuments)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = [r["path"] for r in listing.filter("length > 0").select("path").collect()]  # names only
    reader = spark.read.format("json_documents").option("files", json.dumps(sorted(files)))
    return reader.option("on_bad", on_bad).option("piece", str(piece)).load()


def bad_documents(
    spark: SparkSession, path: str, document: str = schemas.DISTRICT_DOCUMENT, whole_file: bool = True
) -> DataFrame:
    docs = spark.read.text(path, wholetext=whole_file)
    return docs.select(F.col("_metadata.file_path").alias("path"), "value").filter(
        ~is_json(F.col("value")) | F.from_json("value", document).isNull()
    )


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its state: ``blank``, ``bad`` or ``ok``."""
    return line_states(spark.read.text(path))


def read_geojson_sequence(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a GeoJSON text sequence with their state and without the record mark."""
    return sequence_states(spark.read.text(path))


def sequence_states(lines: DataFrame, value: str = "value") -> DataFrame:
    return line_states(lines.withColumn(value, F.regexp_replace(value, "^\u001e+", "")), value)


def valid_lines(states: DataFrame, require_some: bool = False) -> DataFrame:
    """The valid lines; with ``require_some`` an input without any is an error."""
    valid = states.filter("state = 'ok'").drop("state")
    if require_some and valid.isEmpty():
        raise ValueError("no valid line in the input")
    return valid


def quarantine(states: DataFrame) -> DataFrame:
    return states.filter("state = 'bad'").drop("state")
