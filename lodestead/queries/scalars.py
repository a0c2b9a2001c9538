"""Casts, filters and flags on text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.functions import casts, text
from lodestead.operators import features, filters
from lodestead.queries.registry import query, spread_table, table


@query("""
    WITH d AS (SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE ' ' || upper(lang) || ' ' END AS lang,
                      CASE WHEN source = 'src1' THEN '  ' ELSE source END AS source, quality,
                      CASE WHEN n_chars > 2000 THEN 'many' ELSE CAST(n_chars AS VARCHAR) END AS size_text
               FROM documents LEFT JOIN labels USING (doc_id))
    SELECT doc_id, lower(trim(lang)) AS lang, source, quality, CAST(size_text AS DOUBLE) AS size
    FROM d WHERE quality IS NOT NULL AND lang IS NOT NULL AND trim(source) <> '' AND size_text <> 'many'
""")
def required_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without label, language or source are dropped, then those without a numeric size."""
    rows = (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .select(
            "doc_id",
            F.when(F.col("lang") != "de", F.concat(F.lit(" "), F.upper("lang"), F.lit(" "))).alias("lang"),
            F.when(F.col("source") == "src1", "  ").otherwise(F.col("source")).alias("source"),
            "quality",
            F.when(F.col("n_chars") > 2000, "many").otherwise(F.col("n_chars").cast("string")).alias("size"),
        )
    )
    complete = filters.numeric_target(filters.drop_incomplete(rows, "quality", ["lang", "source"]), "size")
    return filters.parsed_only(complete, "size").withColumn("lang", text.clean_category(F.col("lang")))


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE l_returnflag WHEN 'A' THEN l_extendedprice WHEN 'N' THEN CAST(l_linenumber * 1000 AS DOUBLE) END AS amount,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS pieces,
           CASE WHEN l_linestatus = 'F' THEN TRUE WHEN l_returnflag = 'A' THEN FALSE END AS flag,
           CASE WHEN l_returnflag = 'A' THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M') END AS shipped,
           CASE WHEN l_returnflag = 'A' THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ship_date,
           strftime(l_shipdate, '%Y-%m-%d') AS from_epoch, CAST(l_linenumber AS VARCHAR) AS number_text,
           CAST(9007199254740993 + l_linenumber AS BIGINT) AS large
    FROM lineitem
""")
def type_coercion(spark: SparkSession, sf: str) -> DataFrame:
    """Text columns with junk, cast by a column -> type table."""
    flag = F.col("l_returnflag")
    shipped = F.when(flag == "A", "31/12/99").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    rows = spread_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(flag == "A", F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(18,2)")))
        .when(flag == "N", F.concat(F.col("l_linenumber"), F.lit("e3"))).otherwise("1d").alias("amount"),
        F.when(flag == "R", F.concat(F.col("l_quantity").cast("bigint"), F.lit(".5")))
        .otherwise(F.col("l_quantity").cast("string")).alias("pieces"),
        F.when(F.col("l_linestatus") == "F", F.when(flag == "A", "TRUE").otherwise("1"))
        .when(flag == "A", "False").otherwise("yes").alias("flag"),
        shipped.alias("shipped"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day_text"), shipped.alias("ship_date"),
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("epoch"),
        F.col("l_linenumber").alias("number_text"),
        F.concat(F.lit(9007199254740993) + F.col("l_linenumber"), F.lit(".0")).alias("large"),
    )
    typed = casts.cast_columns(rows, {
        "amount": "double", "pieces": "long", "flag": "boolean", "shipped": "timestamp", "ship_date": "date",
        "number_text": "string", "large": "long",
    })
    return typed.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "amount", "pieces", "flag",
        F.date_format("shipped", "yyyy-MM-dd HH:mm").alias("shipped"), F.col("ship_date").cast("string").alias("ship_date"),
        casts.epoch_to_date_text(F.col("epoch")).alias("from_epoch"), "number_text", "large",
    )


@query("""
    SELECT CAST(count(*) FILTER (l_returnflag = 'R') AS BIGINT) AS pieces,
           CAST(count(*) FILTER (l_linestatus = 'O' AND l_returnflag <> 'A') AS BIGINT) AS flag
    FROM lineitem
""")
def lossy_casts(spark: SparkSession, sf: str) -> DataFrame:
    """How many values two conversions cannot keep."""
    rows = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", "2.5").otherwise(F.col("l_linenumber").cast("string")).alias("pieces"),
        F.when(F.col("l_linestatus") == "F", "1").when(F.col("l_returnflag") == "A", "0").otherwise("yes").alias("flag"),
    )
    return casts.lossy_cast_counts(rows, {"pieces": "long", "flag": "boolean"})


@query("""
    WITH d AS (SELECT doc_id, CASE WHEN source = 'src1' THEN 'HTML Description ' || text ELSE text END AS t,
                      lower(text) AS raw FROM documents),
    l AS (SELECT doc_id, CASE WHEN starts_with(t, 'HTML Description') OR t = '' THEN NULL ELSE lower(t) END AS t, raw FROM d)
    SELECT doc_id,
           CASE WHEN contains(t, 'the') THEN 'Closed' WHEN contains(t, 'th') THEN 'Yes' END AS garage,
           CASE WHEN contains(t, 'que') THEN TRUE END AS balcony,
           CASE WHEN contains(t, 'en') THEN CAST(3 AS BIGINT) WHEN contains(t, 'er') THEN CAST(2 AS BIGINT) END AS bedrooms,
           contains(raw, 'sch') OR contains(raw, 'und') AS near_hospital, contains(raw, 'copyright') AS historic
    FROM l
""")
def text_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Amenity and keyword flags with phrases that occur in the documents."""
    t = F.when(F.col("source") == "src1", F.concat(F.lit("HTML Description "), F.col("text"))).otherwise(F.col("text"))
    amenities = text.amenity_columns(t, {"garage": (("the", "Closed"), ("th", "Yes")), "balcony": (("que", True),)})
    keywords = text.keyword_flags(F.col("text"), {"near_hospital": ["sch", "und"], "historic": ["Copyright"]})
    return table(spark, sf, "documents").select(
        "doc_id", *[c.alias(n) for n, c in amenities.items()],
        text.bedrooms_from_text(t, (("en", 3), ("er", 2))).alias("bedrooms"),
        *[c.alias(n) for n, c in keywords.items()],
    )


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday_created,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_on_market,
           CASE WHEN l_linenumber = 1 THEN '0' ELSE CAST(l_linenumber AS VARCHAR) END AS floor,
           CASE WHEN l_linenumber = 1 THEN 0.0 ELSE CAST(l_linenumber AS DOUBLE) END AS floor_number
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def date_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread_table(
        spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    ).join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    floor = F.when(F.col("l_linenumber") == 1, "Rés do chão").otherwise(F.col("l_linenumber").cast("string"))
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        features.day_of_week(F.col("o_orderdate")).alias("weekday_created"),
        features.days_on_market(F.col("o_orderdate"), F.col("l_shipdate")).alias("days_on_market"),
        features.floor_category(floor).alias("floor"), features.floor_number(floor).alias("floor_number"),
    )


@query("""
    SELECT o_orderkey, o_orderpriority,
           CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3
                WHEN '1-URGENT' THEN 4 ELSE 0 END AS rank
    FROM orders
""")
def ordinal_rank(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit(" "), F.lower("o_orderpriority"))
    order = ("5-low", "3-medium", "2-high", "1-urgent")
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", features.ordinal_rank(raw, order).alias("rank")
    )


@query("""
    SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20 AS is_test
    FROM orders
""")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", features.in_test_split(F.col("o_orderkey")).alias("is_test"))


@query("""
    SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(current_date AS DATE)) AS INTEGER) AS days,
           CAST(CAST(current_date AS DATE) AS VARCHAR) AS loaded
    FROM orders
""")
def loaded_today(spark: SparkSession, sf: str) -> DataFrame:
    """A load without a run date has today's; days since the order was first seen."""
    return table(spark, sf, "orders").select(
        "o_orderkey", features.days_on_market(F.to_date("o_orderdate"), casts.run_date()).alias("days"),
        casts.run_date().cast("string").alias("loaded"),
    )
