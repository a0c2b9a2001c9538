"""Nested records: listings, detail pages, key/value lists, trees, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead import schemas
from lodestead.functions import casts
from lodestead.functions.json_text import repair_surrogates
from lodestead.functions.text import bedrooms_from_typology, clean_suffix
from lodestead.operators import details, filters, projections
from lodestead.plans.loads import new_of_batch
from lodestead.queries.registry import query, spread_table, table


def _j(value: Column, default: str | None = None) -> Column:
    return value.cast("string") if default is None else F.coalesce(value.cast("string"), F.lit(default))


def order_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer and nation as raw search results, parsed from JSON text."""
    rows = (
        spread_table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    low, urgent = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "1-URGENT"
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("c_name").alias("title"),
        F.concat(F.lit("order-"), F.col("o_orderkey")).alias("slug"),
        F.col("c_mktsegment").alias("estate"),
        F.col("o_orderstatus").alias("transaction"),
        F.when(urgent, "2.5").otherwise(F.col("o_custkey").cast("string")).alias("developmentId"),
        F.concat(F.lit("dev "), F.col("c_name")).alias("developmentTitle"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("https://example.org/dev/"), F.col("o_custkey"))).alias("developmentUrl"),
        F.when(
            ~low,
            F.struct(
                F.struct(
                    F.struct(F.col("n_name").alias("name")).alias("city"),
                    F.when(~urgent, F.struct(F.col("c_mktsegment").alias("name"))).alias("province"),
                    F.concat(F.col("n_name"), F.lit(" street")).alias("street"),
                ).alias("address"),
                F.struct(F.concat(F.lit(" "), F.col("c_nationkey"), F.lit(" ")).alias("radius")).alias("mapDetails"),
            ),
        ).alias("location"),
        (F.col("o_orderkey") % 2 == 0).alias("isExclusiveOffer"),
        F.when(~urgent, F.col("o_orderkey") % 3 == 0).alias("isPrivateOwner"),
        (F.col("o_orderstatus") == "F").alias("isPromoted"),
        F.concat(F.lit("site-"), F.col("o_orderstatus")).alias("source"),
        F.when(
            F.col("c_acctbal") >= 0,
            F.struct(
                F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                F.concat(F.lit("agency-"), F.col("c_custkey")).alias("slug"), F.col("c_mktsegment").alias("type"),
                (F.col("c_acctbal") > 5000).alias("brandingVisible"), (F.col("c_acctbal") > 7000).alias("highlightedAds"),
                F.when(F.col("c_acctbal") > 7000, F.concat(F.lit("img-"), F.col("c_custkey"))).alias("imageUrl"),
            ),
        ).alias("agency"),
        F.when(low, "sat, sun").alias("openDays"),
        F.struct(
            F.lit("EUR").alias("currency"),
            F.when(low, "1d").when(urgent, "abc").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("value"),
        ).alias("totalPrice"),
        F.struct(F.lit("USD").alias("currency"), F.concat(F.col("o_custkey"), F.lit(".5")).alias("value")).alias("pricePerSquareMeter"),
        F.concat(F.lit(" "), F.col("o_custkey"), F.lit(".25")).alias("areaInSquareMeters"),
        F.when(urgent, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("terrainAreaInSquareMeters"),
        F.concat(F.lit("ROOMS_"), F.col("o_orderkey") % 5).alias("roomsNumber"),
        (F.col("o_orderkey") % 5 == 0).alias("hidePrice"),
        F.when(low, "GROUND").otherwise("FLOOR_1").alias("floorNumber"),
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd 03:04:05")).otherwise("bad").alias("dateCreated"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'23:59:58").alias("dateCreatedFirst"),
        F.concat(F.col("c_name"), F.lit(" – short")).alias("shortDescription"),
        F.concat(F.length("c_name"), F.lit(".0")).alias("totalPossibleImages"),
    )
    text = F.to_json(item)
    return rows.select(F.from_json(text, schemas.LISTING_ITEM).alias("i")).select("i.*")


_STAGED_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, c_name AS title, 'order-' || o_orderkey AS slug,
           c_mktsegment AS estate, o_orderstatus AS transaction,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS "developmentId", 'dev ' || c_name AS "developmentTitle",
           CASE WHEN o_orderstatus = 'F' THEN 'https://example.org/dev/' || o_custkey END AS "developmentUrl",
           CASE WHEN o_orderpriority <> '5-LOW' THEN n_name END AS city,
           CASE WHEN o_orderpriority NOT IN ('5-LOW', '1-URGENT') THEN c_mktsegment END AS province,
           CASE WHEN o_orderpriority <> '5-LOW' THEN n_name || ' street' END AS street,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(c_nationkey AS DOUBLE) END AS "mapRadius",
           o_orderkey % 2 = 0 AS "isExclusiveOffer",
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey % 3 = 0 END AS "isPrivateOwner",
           o_orderstatus = 'F' AS "isPromoted", 'site-' || o_orderstatus AS source,
           CASE WHEN c_acctbal >= 0 THEN c_custkey END AS "agencyId", CASE WHEN c_acctbal >= 0 THEN c_name END AS "agencyName",
           CASE WHEN c_acctbal >= 0 THEN 'agency-' || c_custkey END AS "agencySlug",
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS "agencyType",
           CASE WHEN c_acctbal >= 0 THEN c_acctbal > 5000 END AS "agencyBrandingVisible",
           CASE WHEN c_acctbal >= 0 THEN c_acctbal > 7000 END AS "agencyHighlightedAds",
           CASE WHEN c_acctbal > 7000 THEN 'img-' || c_custkey END AS "agencyImageUrl",
           CASE WHEN o_orderpriority = '5-LOW' THEN 'sat, sun' END AS "openDays",
           'EUR' AS "totalPriceCurrency",
           CASE WHEN o_orderpriority NOT IN ('5-LOW', '1-URGENT') THEN o_totalprice END AS "totalPriceValue",
           'USD' AS "pricePerSquareMeterCurrency", o_custkey + 0.5::DOUBLE AS "pricePerSquareMeterValue",
           o_custkey + 0.25::DOUBLE AS "areaInSquareMeters",
           CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey AS DOUBLE) END AS "terrainAreaInSquareMeters",
           'ROOMS_' || (o_orderkey % 5) AS "roomsNumber", o_orderkey % 5 = 0 AS "hidePrice",
           CASE WHEN o_orderpriority = '5-LOW' THEN 'GROUND' ELSE 'FLOOR_1' END AS "floorNumber",
           CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 03:04:05' END AS "dateCreated",
           strftime(o_orderdate, '%Y-%m-%d') || ' 23:59:58' AS "dateCreatedFirst",
           c_name || ' – short' AS "shortDescription",
           CAST(length(c_name) AS BIGINT) AS "totalPossibleImages", CAST(NULL AS VARCHAR) AS "additionalInfo",
           '2024-05-02' AS "ingestionDate"
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def _shown(rows: DataFrame) -> DataFrame:
    """All columns; times, dates and open or nested values as text."""
    texts = {
        f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.dataType.typeName() == "timestamp"
        else F.to_json(f.name) if f.dataType.typeName() == "struct" else F.col(f.name).cast("string")
        for f in rows.schema.fields if f.dataType.typeName() in ("timestamp", "date", "variant", "struct")
    }
    lists = {f.name: F.array_join(f.name, "|") for f in rows.schema.fields if f.dataType.typeName() == "array"}
    return rows.withColumns(texts | lists)


@query(_STAGED_SQL)
def staging_projection(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(projections.stage_listings(order_listings(spark, sf), "2024-05-02"))


@query(f"SELECT * FROM ({_STAGED_SQL}) s WHERE estate <> 'BUILDING'")
def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """Scan, project, dedup in the batch (every listing comes twice), keep what the table lacks.

    The table already holds the listings of one segment.
    """
    batch = projections.stage_listings(order_listings(spark, sf), "2024-05-02")
    twice = batch.unionByName(batch)
    held = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"))
        .select(F.concat(F.lit("order-"), F.col("o_orderkey")).alias("slug"), F.lit("2024-05-02").cast("date").alias("ingestionDate"))
    )
    keys = ["slug", "ingestionDate"]
    return _shown(new_of_batch(twice, held, keys, ["dateCreated", "id"], ["2024-05-02"]))


#: Stands for 2.0 as a JSON number, which no Spark type is written as.
_NUMBER = "(2.0)"


def part_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as detail pages: JSON text of the page properties."""
    big = F.col("p_size") > 25
    key_value = lambda key, value, localized, currency=None, suffix=None: F.struct(
        F.lit(key).alias("key"), value.cast("string").alias("value"), localized.cast("string").alias("localizedValue"),
        F.lit(currency).cast("string").alias("currency"), F.lit(suffix).cast("string").alias("suffix"),
    )
    price = F.col("p_retailprice").cast("decimal(18,2)")
    nothing = F.lit(None).cast("string")
    chars = F.array(
        key_value("price", price, nothing, "USD", ""),
        key_value("price", F.when(big, F.lit("n/a")).otherwise((price * 2).cast("string")), nothing, "EUR", "/mês"),
        key_value("m", F.col("p_size"), nothing),
        key_value("rooms_num", F.col("p_size"), F.when(big, F.lit("Loft")).otherwise(F.concat(F.lit("t"), F.col("p_size")))),
        key_value("energy_certificate", nothing, F.lower("p_type")),
        key_value("bathrooms_num", F.when(F.col("p_type") == "PROMO", "2.0").when(F.col("p_type") == "LARGE", _NUMBER).otherwise("3"), nothing),
        key_value("floor_no", nothing, F.lit("Rés do chão")),
        key_value("construction_status", nothing, F.when(big, "new")),
        key_value("build_year", F.col("p_size") + 1950, nothing),
        key_value("heating", nothing, F.lit("gas")),
        key_value("windows_type", nothing, F.when(~big, "wood")),
    )
    description = F.concat(
        F.lit("<p>"), F.col("p_name"), F.lit(" com "),
        F.when(F.col("p_type") == "ECONOMY", "2 quartos").otherwise("sala"),
        F.lit("</p>\n<ul><li>Garagem"), F.when(F.col("p_type") == "PROMO", " fechada").otherwise(""),
        F.lit("</li><li>Cozinha equipada &amp; varanda</li></ul>"),
    )
    ad = F.struct(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("part-"), F.col("p_partkey")).alias("slug"),
        F.concat(F.lit("https://example.org/"), F.col("p_partkey")).alias("url"),
        F.col("p_name").alias("title"),
        F.when(big, "agency").otherwise("private").alias("advertiserType"),
        F.lit("DEVELOPER").alias("advertType"),
        F.lit("active").alias("status"),
        F.lit("2024-01-02T03:04:05").alias("createdAt"),
        F.lit("2024-03-04 05:06:07").alias("pushedUpAt"),
        F.when(big, "not a date").otherwise("2024-02-03 04:05:06").alias("modifiedAt"),
        description.alias("description"),
        F.when(big, F.struct(F.array(F.struct(F.col("p_brand").alias("value"))).alias("name"))).alias("category"),
        F.struct((F.col("p_size") % 3).alias("id"), F.col("p_type").alias("name"), F.lit("SELL").alias("type")).alias("adCategory"),
        chars.alias("characteristics"),
        F.struct(
            price.alias("Price"), F.col("p_size").alias("Area"), F.array(F.lit("1"), F.lit("x")).alias("Bathrooms_num"),
            F.col("p_brand").alias("City"), F.col("p_partkey").alias("City_id"), F.array(F.lit("ready")).alias("Construction_status"),
            F.lit("Portugal").alias("Country"), F.array(F.lower("p_type")).alias("Energy_certificate"),
            F.when(big, F.array(F.lit("floor_1"))).alias("Floor_no"), F.array(F.lit("gas"), F.lit("wood")).alias("Heating"),
            F.lit("sell").alias("OfferType"), F.lit("flat").alias("ProperType"), F.col("p_name").alias("Province"),
            F.array(F.col("p_size").cast("string"), F.lit("9")).alias("Rooms_num"),
            F.array().cast("array<string>").alias("Windows_type"), F.col("p_size").alias("Build_year"),
        ).alias("target"),
        F.array(F.col("p_name"), F.lit(None).cast("string"), F.col("p_type")).alias("features"),
        F.array(F.struct(F.lit("Extras").alias("label"), F.array(F.col("p_type")).alias("values"))).alias("featuresByCategory"),
        F.array(F.struct(F.lit("").alias("large")), F.struct(F.concat(F.lit("u"), F.col("p_partkey")).alias("large"))).alias("images"),
        F.struct(
            F.struct((F.col("p_size") / 10).alias("latitude"), F.lit(-8.5).alias("longitude")).alias("coordinates"),
            F.struct(
                F.struct(F.col("p_brand").alias("name")).alias("city"), F.struct(F.lit("county").alias("name")).alias("county"),
                F.struct(F.col("p_type").alias("name")).alias("province"), F.concat(F.lit("40-"), F.col("p_size")).alias("postalCode"),
            ).alias("address"),
            F.struct(F.col("p_size").alias("radius"), F.lit(12).alias("zoom")).alias("mapDetails"),
            F.struct(F.array(
                F.struct(F.lit("district").alias("locationLevel"), F.lit("x").alias("fullName")),
                F.struct(F.lit("parish").alias("locationLevel"), F.col("p_brand").alias("fullName")),
            ).alias("locations")).alias("reverseGeocoding"),
        ).alias("location"),
        F.struct(F.when(big, F.array(F.lit("111"), F.lit("222"))).alias("phones"), F.col("p_name").alias("name")).alias("contactDetails"),
        F.struct(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"), F.lit("agency").alias("type"),
            F.array(F.lit("333"), F.lit("444")).alias("phones"),
        ).alias("owner"),
        F.struct(F.col("p_name").alias("title"), F.lit("a flat").alias("description")).alias("seo"),
        F.array(F.struct(F.lit("Home").alias("label")), F.struct(F.col("p_type").alias("label"))).alias("breadcrumbs"),
        F.array(
            F.struct(F.lit("lift").alias("label"), F.array(F.lit("::y")).alias("values")),
            F.struct(F.lit("lift").alias("label"), F.array(F.when(big, "::n").otherwise("?")).alias("values")),
        ).alias("additionalInformation"),
        F.struct(
            price.cast("string").alias("ad_price"), F.lit("rent").alias("business"), F.lower("p_brand").alias("city_name"),
            F.lit("private").alias("poster_type"), F.lit("north").alias("region_name"), F.col("p_partkey").alias("seller_id"),
        ).alias("adTrackingData"),
    )
    props = F.to_json(F.struct(F.struct(ad.alias("ad")).alias("pageProps")))
    props = F.replace(props, F.lit(f'"{_NUMBER}"'), F.lit("2.0"))
    return spread_table(spark, sf, "part").select("p_partkey", props.alias("props"), F.lit("2024-05-02").alias("ingestionDate"))


@query("""
    SELECT p_partkey AS id, p_name AS title, 'https://example.org/' || p_partkey AS url,
           p_name || ' com ' || CASE WHEN p_type = 'ECONOMY' THEN '2 quartos' ELSE 'sala' END || '   Garagem' ||
               CASE WHEN p_type = 'PROMO' THEN ' fechada' ELSE '' END || ' Cozinha equipada & varanda' AS description_text,
           'DEVELOPER' AS advert_type, CASE WHEN p_size > 25 THEN 'agency' ELSE 'private' END AS advertiser_type_detail,
           'active' AS status, '2024-01-02 03:04:05' AS created_at,
           CASE WHEN p_size > 25 THEN NULL ELSE '2024-02-03 04:05:06' END AS modified_at,
           CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS property_type,
           'SELL' AS transaction_type,
           CASE WHEN p_size > 25 THEN round(p_retailprice, 2) ELSE round(p_retailprice, 2) * 2 END AS price,
           'EUR' AS price_currency, 'mês' AS price_period, CAST(p_size AS DOUBLE) AS area_m2,
           CASE WHEN p_size > 25 THEN 'Loft' ELSE 't' || p_size END AS typology,
           CASE WHEN p_size <= 25 THEN CAST(p_size AS BIGINT) WHEN p_type = 'ECONOMY' THEN CAST(2 AS BIGINT) END AS bedrooms,
           lower(p_type) AS energy_certificate,
           CASE p_type WHEN 'PROMO' THEN NULL WHEN 'LARGE' THEN CAST(2 AS BIGINT) ELSE CAST(3 AS BIGINT) END AS bathrooms,
           p_brand AS address_city, 'county' AS address_county, p_type AS address_district,
           round(p_size / 10.0, 6) AS latitude, -8.5::DOUBLE AS longitude, p_name AS contact_name,
           CASE WHEN p_size > 25 THEN '111' END AS contact_phone,
           'u' || p_partkey AS image_urls,
           '{"lift":' || (p_size <= 25) || ',"garage":"' || CASE WHEN p_type = 'PROMO' THEN 'Closed' ELSE 'Yes' END
               || '","balcony":true,"kitchen_equipment":"Equipped"}' AS other_features,
           p_name || '||' || p_type AS features, '{"label":"Extras","values":["' || p_type || '"]}' AS "featuresByCategory",
           '' AS "featuresWithoutCategory", '{"radius":' || p_size || ',"zoom":12}' AS map_details,
           '{"locations":[{"fullName":"x","locationLevel":"district"},{"fullName":"' || p_brand || '","locationLevel":"parish"}]}'
               AS reverse_geocoding,
           'part-' || p_partkey AS slug, '2024-05-02' AS "ingestionDate"
    FROM part
""")
def detail_projection(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(details.stage_details(part_pages(spark, sf))).withColumn("latitude", F.round("latitude", 6))


def part_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages as raw lines ``{"props": ...}``."""
    return part_pages(spark, sf).select(F.concat(F.lit('{"props":'), F.col("props"), F.lit("}")).alias("value"))


FLAT_SQL = """
    SELECT p_partkey AS ad_id, 'part-' || p_partkey AS slug, 'https://example.org/' || p_partkey AS url, p_name AS title,
           CASE WHEN p_size > 25 THEN 'agency' ELSE 'private' END AS advertiser_type, 'DEVELOPER' AS advert_type,
           'active' AS status, '2024-01-02 03:04:05' AS created_at,
           CASE WHEN p_size > 25 THEN NULL ELSE '2024-02-03 04:05:06' END AS modified_at, '2024-03-04 05:06:07' AS pushed_up_at,
           '<p>' || p_name || ' com ' || CASE WHEN p_type = 'ECONOMY' THEN '2 quartos' ELSE 'sala' END || '</p>' || chr(10)
               || '<ul><li>Garagem' || CASE WHEN p_type = 'PROMO' THEN ' fechada' ELSE '' END
               || '</li><li>Cozinha equipada &amp; varanda</li></ul>' AS description_raw,
           p_name || ' com ' || CASE WHEN p_type = 'ECONOMY' THEN '2 quartos' ELSE 'sala' END || chr(10) || 'Garagem' ||
               CASE WHEN p_type = 'PROMO' THEN ' fechada' ELSE '' END || chr(10) || 'Cozinha equipada & varanda'
               AS description_clean,
           CASE WHEN p_size > 25 THEN NULL ELSE round(p_retailprice, 2) * 2 END AS price,
           'EUR' AS price_currency, '/mês' AS price_suffix, CAST(p_size AS DOUBLE) AS area, 'm²' AS area_unit,
           CASE WHEN p_size > 25 THEN 'Loft' ELSE 't' || p_size END AS rooms_num_clean, CAST(p_size AS DOUBLE) AS rooms_num_raw,
           CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS bathrooms_num,
           'Rés do chão' AS floor_no, lower(p_type) AS energy_certificate,
           CASE WHEN p_size > 25 THEN 'new' END AS construction_status, p_size + 1950.0::DOUBLE AS build_year, 'gas' AS heating,
           CASE WHEN p_size <= 25 THEN 'wood' END AS windows_type,
           round(p_retailprice, 2) AS target_price, CAST(p_size AS DOUBLE) AS target_area, 1.0::DOUBLE AS target_bathrooms_num,
           p_brand AS target_city, CAST(p_partkey AS VARCHAR) AS target_city_id, 'ready' AS target_construction_status,
           'Portugal' AS target_country, lower(p_type) AS target_energy_certificate,
           CASE WHEN p_size > 25 THEN 'floor_1' END AS target_floor_no, 'gas' AS target_heating, 'sell' AS target_offer_type,
           'flat' AS target_proper_type, p_name AS target_province, CAST(p_size AS DOUBLE) AS target_rooms_num,
           CAST(NULL AS VARCHAR) AS target_windows_type, CAST(p_size AS DOUBLE) AS target_build_year,
           p_name || '||' || p_type AS features,
           '[{"label":"Extras","values":["' || p_type || '"]}]' AS features_by_category, 'u' || p_partkey AS image_urls,
           round(p_size / 10.0, 6) AS latitude, -8.5::DOUBLE AS longitude, p_brand AS location_address_city,
           'county' AS location_address_county, p_type AS location_address_province, '40-' || p_size AS location_address_postal_code,
           p_brand AS location_parish_full, p_partkey AS owner_id, p_brand AS owner_name, 'agency' AS owner_type,
           '333|444' AS owner_phones, p_name AS seo_title, 'a flat' AS seo_description,
           CAST(p_size % 3 AS VARCHAR) AS ad_category_id, p_type AS ad_category_name, 'SELL' AS ad_category_type,
           '[{"label":"Home"},{"label":"' || p_type || '"}]' AS breadcrumbs_json, p_type AS last_breadcrumb_label,
           round(p_retailprice, 2) AS tracking_price, 'rent' AS tracking_business, lower(p_brand) AS tracking_city_name,
           'private' AS tracking_poster_type, 'north' AS tracking_region_name, CAST(p_partkey AS VARCHAR) AS tracking_seller_id
    FROM part
"""


@query(FLAT_SQL)
def flat_training_row(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(details.flat_rows(part_lines(spark, sf))).withColumn("latitude", F.round("latitude", 6))


@query("""
    SELECT CASE p_partkey % 10 WHEN 0 THEN 'bad' WHEN 1 THEN 'blank' WHEN 2 THEN 'no ad' ELSE 'ad' END AS outcome, count(*) AS rows
    FROM part GROUP BY 1
""")
def flat_line_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Page lines of which some are cut short, blank or without an ad: none is left out uncounted."""
    lines = part_pages(spark, sf).select((F.col("p_partkey") % 10).alias("k"), F.concat(F.lit('{"props":'), F.col("props"), F.lit("}")).alias("line"))
    k = F.col("k")
    value = F.when(k == 0, F.expr("left(line, length(line) - 1)")).when(k == 1, " \t ").when(k == 2, '{"props":{}}').otherwise(F.col("line"))
    return details.line_outcomes(lines.select(value.alias("value")))


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE l_extendedprice * 2 END AS price,
           CASE WHEN l_returnflag = 'R' THEN 'USD' ELSE 'EUR' END AS currency,
           CASE WHEN l_linestatus = 'F' THEN 'mês' END AS period,
           l_quantity AS area, CASE WHEN l_returnflag = 'A' THEN 'Loft' ELSE 'T' || l_linenumber END AS typology,
           CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS bedrooms
    FROM lineitem
""")
def kv_pivot_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as key/value lists with a repeated key; the last usable value wins."""
    returned = F.col("l_returnflag") == "R"

    def entry(key, value=None, localized=None, currency=None, suffix=None):
        parts = {"key": F.lit(key), "value": value, "localizedValue": localized, "currency": currency, "suffix": suffix}
        return F.struct(*[F.lit(None).cast("string").alias(n) if c is None else c.cast("string").alias(n) for n, c in parts.items()])

    chars = F.array(
        entry("price", F.col("l_extendedprice"), currency=F.lit("EUR")),
        entry("price", F.when(returned, F.lit("on request")).otherwise((F.col("l_extendedprice") * 2).cast("string")),
              currency=F.when(returned, "USD").otherwise("EUR"),
              suffix=F.when(F.col("l_linestatus") == "F", "/mês").otherwise("")),
        entry("m", F.col("l_quantity")),
        entry("rooms_num", localized=F.when(F.col("l_returnflag") == "A", F.lit("Loft")).otherwise(
            F.concat(F.lit("T"), F.col("l_linenumber")))),
    )
    lines = spread_table(spark, sf, "lineitem").withColumn("chars", chars)
    c = F.col("chars")
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        details.last_parsed(c, "price", casts.to_double).alias("price"),
        details.last_entry(c, "price", "currency").alias("currency"),
        clean_suffix(details.last_entry(c, "price", "suffix")).alias("period"),
        details.last_parsed(c, "m", casts.to_double).alias("area"),
        details.last_entry(c, "rooms_num", "localizedValue").alias("typology"),
        details.last_parsed(c, "rooms_num", bedrooms_from_typology, "localizedValue").alias("bedrooms"),
    )


@query("""
    SELECT c_custkey AS customer_key, c_name AS customer_name, n_name AS customer_nation_name,
           r_name AS customer_nation_region_name, 'all' AS location
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def struct_autoflatten(spark: SparkSession, sf: str) -> DataFrame:
    """Nested customer -> nation -> region with a technical field at every level."""
    rows = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    kind = F.lit("t").alias("__typename")
    region = F.struct(kind, F.col("r_name").alias("name")).alias("region")
    nation = F.struct(kind, F.col("n_name").alias("name"), region).alias("nation")
    nested = rows.select(
        F.struct(kind, F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), nation).alias("customer"),
        F.col("c_acctbal").alias("unwanted"),
    )
    clean = projections.drop_columns(projections.drop_field_everywhere(nested, "__typename"), ["unwanted", "absent"])
    return projections.flatten_structs(clean, location="all")


_TREE_SQL = """
    WITH m AS (SELECT lower(n_name) AS d, 'c' || c_custkey AS p, c_name AS name, c_mktsegment AS seg
               FROM customer JOIN nation ON c_nationkey = n_nationkey
               UNION ALL
               SELECT lower(n_name), 's' || s_suppkey, s_name, 'SUPPLIER'
               FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT d AS district, p AS municipality, d || '/' || p AS id, name, 'MUNICIPALITY' AS level, d AS parents FROM m
    UNION ALL
    SELECT d, p, d || '/' || p || '/' || lower(seg), seg, 'PARISH', '' FROM m WHERE seg <> 'BUILDING'
"""


@query(_TREE_SQL)
def location_tree(spark: SparkSession, sf: str) -> DataFrame:
    """One tree response per place; customers and suppliers are two frames put together."""
    nation = table(spark, sf, "nation")

    def responses(places: DataFrame) -> DataFrame:
        own = F.concat_ws("/", F.lower("n_name"), "place")
        part = F.struct(
            F.concat_ws("/", own, F.lower("segment")).alias("id"), F.col("segment").alias("name"),
            F.lit("PARISH").alias("detailedLevel"),
        )
        municipality = F.struct(
            own.alias("id"), F.col("name"), F.lit("MUNICIPALITY").alias("detailedLevel"),
            F.array(F.lower("n_name")).alias("parentIds"),
            F.when(F.col("segment") != "BUILDING", F.array(part)).alias("sublocations"),
        )
        tree = F.struct(F.struct(F.struct(F.array(municipality).alias("locationTreeObjects")).alias("locationTree")).alias("data"))
        return places.select(F.from_json(F.to_json(tree), schemas.LOCATION_TREE).alias("r")).select("r.*")

    customers = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_name", F.concat(F.lit("c"), F.col("c_custkey")).alias("place"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "n_name", F.concat(F.lit("s"), F.col("s_suppkey")).alias("place"), F.col("s_name").alias("name"),
        F.lit("SUPPLIER").alias("segment"),
    )
    trees = [projections.flatten_location_tree(responses(p)) for p in (customers, suppliers)]
    return projections.union_all(trees).select(
        "district", "municipality", "id", "name", F.col("detailedLevel").alias("level"),
        F.array_join("parentIds", ",").alias("parents"),
    )


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.natural') AS natural_
    FROM events
""")
def json_tags(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "props")
    return projections.tag_columns(events, "props", [("k", "k"), ("natural", "natural_")])


def part_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as tagged map nodes."""
    size = F.col("p_size")
    tags = F.to_json(F.struct(
        F.when(size <= 10, "school").when(size <= 12, "bench").alias("amenity"),
        F.when(size.between(13, 20), F.lower("p_name")).when(size.between(21, 24), "bakery").alias("shop"),
        F.when(size.between(25, 28), "beach").alias("natural"),
        F.when((size > 45) & (F.col("p_type") == "PROMO"), F.col("p_brand")).alias("office"),
        F.when(size > 40, F.when(F.col("p_type") == "LARGE", "house").otherwise("shed")).alias("building"),
    ))
    return table(spark, sf, "part").select("p_partkey", tags.alias("properties"))


@query("""
    WITH t AS (SELECT p_partkey,
        CASE WHEN p_size <= 10 THEN 'school' WHEN p_size <= 12 THEN 'bench' END AS amenity,
        CASE WHEN p_size BETWEEN 13 AND 20 THEN lower(p_name) WHEN p_size BETWEEN 21 AND 24 THEN 'bakery' END AS shop,
        CASE WHEN p_size BETWEEN 25 AND 28 THEN 'beach' END AS natural_,
        CASE WHEN p_size > 45 AND p_type = 'PROMO' THEN p_brand END AS office,
        CASE WHEN p_size > 40 THEN CASE WHEN p_type = 'LARGE' THEN 'house' ELSE 'shed' END END AS building
        FROM part)
    SELECT *, CASE WHEN amenity = 'school' THEN 'amenity' WHEN shop = 'bakery' THEN 'shop'
                   WHEN natural_ = 'beach' THEN 'natural_' WHEN building = 'house' THEN 'building'
                   ELSE 'office' END AS category
    FROM t WHERE amenity = 'school' OR shop = 'bakery' OR natural_ = 'beach' OR office IS NOT NULL OR building = 'house'
""")
def poi_whitelist(spark: SparkSession, sf: str) -> DataFrame:
    tagged = projections.tag_columns(part_tags(spark, sf), "properties", filters.POI_TAGS)
    return filters.points_of_interest(tagged).select(
        "p_partkey", "amenity", "shop", "natural_", "office", "building", filters.poi_category().alias("category")
    )


@query("""
    SELECT doc_id, text || chr(65533) || ' ' || chr(128512) || chr(65533) || '\\ud83d' AS repaired,
           text || '? ' || chr(128512) || '?' || '\\ud83d' AS replaced
    FROM documents
""")
def surrogate_repair(spark: SparkSession, sf: str) -> DataFrame:
    """A lone high half, a valid pair, a lone low half and an escaped backslash behind each document's text."""
    written = F.to_json(F.struct("text"))  # {"text":"..."}, the text from the tenth character on
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("text").isNotNull(), written).alias("w"))
    raw = F.concat(F.lit('{"t":"'), F.expr("substring(w, 10, length(w) - 11)"), F.lit(r'\ud83d 😀\ude00\\ud83d"}'))

    def text(c: Column) -> Column:
        return F.from_json(c, "t string")["t"]

    return docs.select("doc_id", text(repair_surrogates(raw)).alias("repaired"), text(repair_surrogates(raw, "?")).alias("replaced"))
