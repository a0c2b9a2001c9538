"""Value counts, profiles, medians."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.operators import features, quality
from lodestead.queries.registry import query, spread_table, table


@query("""
    SELECT props, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY props ORDER BY count DESC, props LIMIT 10
""")
def value_counts_top(spark: SparkSession, sf: str) -> DataFrame:
    return quality.top_values(table(spark, sf, "events"), "props", 10)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 5
""")
def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return quality.preview(lines, 5, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"])


_SUMMARY = """
    SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 5) AS mean,
           round(stddev_samp({c}), 5) AS std, CAST(min({c}) AS DOUBLE) AS min,
           round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
           round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max
    FROM lineitem
"""


@query(" UNION ALL ".join(_SUMMARY.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    summary = quality.column_summary(table(spark, sf, "lineitem"), columns)
    # Sums of doubles differ in the last digits with the order of the rows.
    digits = {"mean": 5, "std": 5, "q25": 6, "q50": 6, "q75": 6}
    return summary.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("""
    SELECT 'doc_id' AS "column", 'bigint' AS type, CAST(count(*) AS BIGINT) AS rows, CAST(count(doc_id) AS BIGINT) AS non_null FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'lang', 'string', count(*), count(lang) FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'quality', 'int', count(*), count(quality) FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'toxic', 'int', count(*), count(toxic) FROM documents LEFT JOIN labels USING (doc_id)
""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return quality.null_profile(rows)


_MEDIAN = "(SELECT median(CASE WHEN p_type <> 'PROMO' THEN p_size END) FROM part)"


@query(f"""
    SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN CAST(p_size AS DOUBLE) ELSE {_MEDIAN} END AS bathrooms,
           CASE WHEN p_type = 'SMALL' THEN 'unknown' ELSE p_brand END AS heating
    FROM part
""")
def median_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_type") != "PROMO", F.col("p_size").cast("string")).alias("bathrooms"),
        F.when(F.col("p_type") != "SMALL", F.col("p_brand")).alias("heating"),
    )
    return features.fill_median(features.fill_constants(rows, {"heating": "unknown"}), ["bathrooms"])


@query("""
    SELECT doc_id, CAST(CASE WHEN source = 'src1' THEN 0 ELSE len(string_split(text, chr(10))) END AS INTEGER) AS features_count
    FROM documents
""")
def list_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Number of lines per document; no list counts as none."""
    lines = F.when(F.col("source") != "src1", F.split("text", "\n"))
    return table(spark, sf, "documents").select("doc_id", features.list_length(lines).alias("features_count"))


@query("""
    SELECT event_id, CAST(event_type = 'click' AS INTEGER) AS feat_cat_acao_click,
           CAST(event_type = 'error' AS INTEGER) AS feat_cat_acao_error,
           CAST(event_type = 'purchase' AS INTEGER) AS feat_cat_acao_purchase,
           CAST(event_type = 'signup' AS INTEGER) AS feat_cat_acao_signup,
           CAST(event_type <> 'view' AND value > 20 AS INTEGER) AS feat_cat_valor_col_20_mais
    FROM events
""")
def multi_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Events as labelled feature lists; two spellings fall on one column, views are malformed."""
    spelled = F.when(F.col("event_id") % 2 == 0, F.lit("20 máis")).otherwise(F.lit("20-MAIS"))
    lists = F.array(
        F.struct(F.lit("Ação").alias("label"), F.array("event_type").alias("values")),
        F.struct(
            F.lit("valor").alias("label"),
            F.when(F.col("value") > 20, F.array(spelled)).otherwise(F.array().cast("array<string>")).alias("values"),
        ),
    )
    text = F.when(F.col("event_type") == "view", '{"label": "x"}').otherwise(F.to_json(lists))
    rows = spread_table(spark, sf, "events", "event_id", "event_type", "value").select("event_id", text.alias("json"))
    paired = rows.withColumn("pairs", features.label_value_pairs("json"))
    return features.multi_hot(paired, "pairs", features.feature_vocabulary(paired, "pairs")).drop("json", "pairs")


@query("""
    SELECT DISTINCT user_id, 'feat_cat_k_' || 'col_' || json_extract_string(props, '$.k') AS feature FROM events
""")
def multi_hot_long(spark: SparkSession, sf: str) -> DataFrame:
    """The long form, for vocabularies of any width."""
    k = F.array(F.struct(F.lit("k").alias("label"), F.array(F.get_json_object("props", "$.k")).alias("values")))
    rows = spread_table(spark, sf, "events", "user_id", "props").select("user_id", F.to_json(k).alias("json"))
    return features.features_long(rows.withColumn("pairs", features.label_value_pairs("json")), "user_id", "pairs")


@query("""
    SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS rows,
           CAST(2 AS BIGINT) AS hot, (SELECT count(DISTINCT event_type) + count(DISTINCT props) FROM events) AS features
    FROM events GROUP BY 1, 2
""")
def multi_hot_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse 0/1 vectors of two features of each event, of one length, told apart by their entries."""
    entry = lambda label, value: F.struct(F.lit(label).alias("label"), F.array(value).alias("values"))
    lists = F.array(entry("type", F.col("event_type")), entry("k", F.get_json_object("props", "$.k")))
    rows = spread_table(spark, sf, "events", "event_type", "props").select("event_type", "props", F.to_json(lists).alias("json"))
    paired = rows.withColumn("pairs", features.label_value_pairs("json"))
    vectors = features.multi_hot_vector(paired, "pairs", features.feature_index(paired, "pairs"))
    dense = vector_to_array(F.col(features.VECTOR))
    told = vectors.select(
        "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"), F.col(features.VECTOR).alias("v"),
        F.size(F.filter(dense, lambda x: x == 1.0)).cast("bigint").alias("hot"), F.size(dense).cast("bigint").alias("features"),
    )
    return told.groupBy("v", "event_type", "k", "hot", "features").agg(F.count("*").alias("rows")).drop("v")
