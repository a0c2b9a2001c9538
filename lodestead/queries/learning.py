"""Regression metrics, boosted trees, the model table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.operators import details, features, model
from lodestead.queries.nested import FLAT_SQL, part_lines
from lodestead.queries.registry import query, table


@query("""
    WITH p AS (SELECT p_type, p_retailprice AS y, CASE WHEN p_size <= 40 THEN 900 + p_size END AS yhat FROM part)
    SELECT p_type, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae,
           round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) FILTER (yhat IS NOT NULL) * count(yhat)), 6) AS r2
    FROM p GROUP BY p_type
""")
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Large parts have no prediction."""
    predicted = F.when(F.col("p_size") <= 40, F.lit(900) + F.col("p_size"))
    rows = table(spark, sf, "part").withColumn("predicted", predicted)
    metrics = model.regression_metrics(rows, "p_retailprice", "predicted", ["p_type"])
    return metrics.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "r2")})


@query(f"""
    WITH f AS ({FLAT_SQL})
    SELECT ad_id, price, area, area_unit, rooms_num_clean, rooms_num_raw, bathrooms_num, build_year, construction_status, floor_no,
           ad_category_name, ad_category_type, round(latitude, 6) AS latitude, longitude, location_address_city,
           location_address_county, location_address_province, location_parish_full, energy_certificate, heating, windows_type,
           advertiser_type, CAST(1 AS INTEGER) AS image_count, CAST(3 AS INTEGER) AS features_count,
           CAST(ad_category_name = 'ECONOMY' AS INTEGER) AS feat_cat_extras_economy,
           CAST(ad_category_name = 'LARGE' AS INTEGER) AS feat_cat_extras_large,
           CAST(ad_category_name = 'MEDIUM' AS INTEGER) AS feat_cat_extras_medium,
           CAST(ad_category_name = 'PROMO' AS INTEGER) AS feat_cat_extras_promo,
           CAST(ad_category_name = 'SMALL' AS INTEGER) AS feat_cat_extras_small,
           CAST(ad_category_name = 'STANDARD' AS INTEGER) AS feat_cat_extras_standard
    FROM f
""")
def model_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.model_table(details.flat_rows(part_lines(spark, sf))).withColumn("latitude", F.round("latitude", 6))


@query("""
    SELECT o_custkey AS label, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1
""")
def category_means(spark: SparkSession, sf: str) -> DataFrame:
    """A category of as many labels as there are customers with orders, by the mean price of each."""
    rows = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("label"), F.col("o_totalprice").cast("double").alias("price"))
    found = model.category_means(rows, "label", "price")
    return found.select(F.col("label").cast("bigint").alias("label"), F.round("mean", 6).alias("mean"))


_PART_BUCKET = "CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 100 < 20"


@query(f"""
    WITH p AS (SELECT {_PART_BUCKET.format(key="CAST(p_partkey AS VARCHAR)")} AS is_test, p_partkey FROM part)
    SELECT is_test, CAST(count(*) AS BIGINT) AS rows, true AS fits, 'latitude' AS top_feature, true AS shares_are_whole,
           'area,energy_certificate,latitude' AS numeric_features, 'ad_category_name,location_address_city' AS categories
    FROM p GROUP BY is_test
""")
def boosted_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Part prices, which follow the part's number: split, indexed categories, a category by means, trees, importances.

    ``fits``: on either side of the split the errors are under half of the price's spread.
    """
    rows = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("area"), F.col("p_type").alias("ad_category_name"),
        F.col("p_brand").alias("location_address_city"), F.col("p_retailprice").alias("price"),
        features.ordinal_rank(F.lower("p_type"), ("small", "medium", "large")).alias("energy_certificate"),
        (F.col("p_partkey") % 1000 / 100).alias("latitude"),
    )
    rows = rows.withColumn("is_test", features.in_test_split(F.col("p_partkey")))
    rows = rows.withColumn(
        "is_validation",
        ~F.col("is_test") & features.in_test_split(F.concat(F.lit("v"), F.col("p_partkey"))),
    )
    numeric, categorical = model.feature_columns(rows)
    fitted = model.fit_boosted_trees(
        rows.filter(~F.col("is_test")), numeric, categorical, "price", "is_validation", max_iter=20, max_depth=4,
        step_size=0.3, means=["location_address_city"],
    )
    metrics = model.regression_metrics(fitted.transform(rows), "price", "prediction", ["is_test"])
    spread = rows.groupBy("is_test").agg(F.count("*").alias("rows"), F.stddev("price").alias("spread"))
    best = model.feature_importances(fitted, None)
    told = {"numeric_features": sorted(numeric), "categories": sorted(categorical)}
    return metrics.join(spread, "is_test").select(
        "is_test", "rows", (F.col("rmse") < F.col("spread") / 2).alias("fits"), F.lit(best[0][0]).alias("top_feature"),
        F.lit(abs(sum(gain for _, gain in best) - 1) < 1e-9).alias("shares_are_whole"),
        *[F.lit(",".join(names)).alias(c) for c, names in told.items()],
    )
