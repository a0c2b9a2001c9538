"""Sources and sinks: every query writes the form it then reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.functions.geometry import rings_centroid
from lodestead.functions.json_text import variant_text
from lodestead.functions.html import html_to_line, html_to_lines
from lodestead.operators import keys
from lodestead.operators.details import with_file_date
from lodestead.operators.projections import concat_pages, union_all
from lodestead.operators.quality import run_counters
from lodestead.queries.registry import query, spread_table, table
from lodestead.schemas import BOUNDARY_ATTRIBUTES
from lodestead.session import scratch_path
from lodestead.sources import geography, json_files, pages as page_source, sinks, snapshots
from lodestead.streaming.ingest import append_arrivals, arriving_files


@query("""
    SELECT o_orderkey, o_totalprice,
           CASE o_orderstatus WHEN 'F' THEN '2024-03-01' WHEN 'O' THEN '2024-03-02' ELSE '2024-03-03' END AS day,
           o_orderstatus NOT IN ('F', 'O') AS newest
    FROM orders
""")
def snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as three dated snapshots; a repeated write is ignored; the newest is found by listing."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    folder = scratch_path(spark, "snapshots")
    days = {"2024-03-01": "o_orderstatus = 'F'", "2024-03-02": "o_orderstatus = 'O'",
            "2024-03-03": "o_orderstatus NOT IN ('F', 'O')"}
    for day, condition in days.items():
        sinks.write_snapshot(orders.filter(condition), folder, "orders", day)
    sinks.write_snapshot(orders, folder, "orders", "2024-03-01", if_exists="ignore")
    newest = snapshots.newest_snapshot(spark, folder, "orders_*.parquet", on_empty="error")
    every = with_file_date(snapshots.read_snapshot(spark, f"{folder}/orders_*.parquet").select("*", "_metadata"), "day")
    return every.select(
        "o_orderkey", "o_totalprice", F.col("day").cast("string").alias("day"),
        F.contains(F.col("_metadata.file_path"), F.lit(newest.rsplit("/", 1)[-1])).alias("newest"),
    )


@query("""
    WITH d AS (SELECT CAST(o_orderdate AS VARCHAR)[1:4] AS year, o_orderkey % 10 AS part, o_custkey FROM orders)
    SELECT 'newest' AS fact, CAST(part AS VARCHAR) AS name, count(*) AS rows, count(DISTINCT o_custkey) AS slugs
    FROM d WHERE part >= 5 GROUP BY 2
    UNION ALL SELECT 'streamed', 'all', count(*), count(DISTINCT o_custkey) FROM d
""")
def snapshot_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Ten dated snapshots among files of other names: the newest five, their slugs, and what a stream takes of the folder."""
    folder, checkpoint = scratch_path(spark, "listing"), scratch_path(spark, "listing-checkpoint")
    orders = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey")).alias("slug"))
    for part in range(10):
        rows = orders.filter(F.col("o_orderkey") % 10 == part).coalesce(1)
        sinks.write_snapshot(rows, folder, "orders", f"2024-03-{part + 1:02d}")
    sinks.write_snapshot(orders.limit(5), folder, "customers", "2024-04-01")
    orders.limit(5).write.mode("append").json(f"{folder}/orders_2024-03-01.parquet")  # a part of another kind in a snapshot
    listed = snapshots.list_snapshots(spark, folder, "orders_*.parquet/part-*.parquet")
    by_date = listed.withColumn("modified", F.col("snapshot_date").cast("timestamp"))  # the writes lie too close together
    newest = [r["path"] for r in snapshots.newest_snapshots(by_date, 5).collect()]
    facts = [
        snapshots.read_snapshot(spark, path).agg(
            F.lit("newest").alias("fact"), F.lit(str(int(path[-10:-8]) - 1)).alias("name"), F.count("*").alias("rows"),
            F.lit(snapshots.read_slugs(spark, path).count()).cast("bigint").alias("slugs"),
        )
        for path in newest
    ]
    out = scratch_path(spark, "listing-out")
    arrivals = arriving_files(spark, f"{folder}/orders_*", orders.schema)
    append_arrivals(arrivals, lambda df: df, out, checkpoint).awaitTermination()
    facts.append(spark.read.schema(orders.schema).parquet(out).agg(
        F.lit("streamed").alias("fact"), F.lit("all").alias("name"), F.count("*").alias("rows"), F.countDistinct("slug").alias("slugs"),
    ))
    return union_all(facts)


@query("""
    SELECT o_orderstatus AS location_id, o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice
    FROM orders
""")
def json_doc_files(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as JSON documents per priority, keyed by status, and back."""
    path = scratch_path(spark, "documents")
    orders = table(spark, sf, "orders").select(
        "o_orderpriority", "o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice"
    )
    sinks.write_district_documents(orders, path, "o_orderpriority", "o_orderstatus", items_per_document=2_000)
    shape = "map<string,array<struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>>>"
    return json_files.read_documents(spark, path, shape, whole_file=False)


@query("""
    SELECT o_orderpriority || '/' || o_orderstatus AS location_id, l_orderkey, l_linenumber, l_returnflag, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def json_whole_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All line items of a priority as one document of one file, read back item by item."""
    path = scratch_path(spark, "whole-documents")
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    items = lines.select(
        F.col("o_orderpriority").alias("district"), F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("place"),
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice",
    )
    docs = sinks.district_documents(items, "district", "place", items_per_document=10_000_000, as_lines=True)
    docs.write.partitionBy("district", "document_no").text(path)
    item = "struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,l_extendedprice:double>"
    return json_files.read_documents(spark, path, f"map<string,array<{item}>>")


@query("""
    SELECT o_orderpriority AS district, CAST(count(*) AS BIGINT) AS listings,
           CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1
""")
def json_lines_per_district(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "district-lines")
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "district")
    sinks.write_district_lines(orders.select("district", "o_orderkey", "o_custkey"), path, "district")
    back = spark.read.schema("o_orderkey bigint, o_custkey bigint, district string").json(path)
    return back.groupBy("district").agg(F.count("*").alias("listings"), F.sum("o_orderkey").alias("key_sum"))


@query("""
    SELECT CASE event_type WHEN 'error' THEN 'bad' WHEN 'view' THEN 'blank' ELSE 'ok' END AS state,
           CAST(count(*) AS BIGINT) AS rows,
           CAST(sum(CASE WHEN event_type NOT IN ('error', 'view')
                    THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS BIGINT) AS k_sum
    FROM events GROUP BY 1
""")
def jsonl_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Event payloads as text lines, some cut short, some blank; counted by state."""
    path = scratch_path(spark, "lines")
    kind = F.col("event_type")
    quoted = F.translate("props", '"', "'")  # no JSON
    line = F.when((kind == "error") & (F.col("event_id") % 2 == 0), quoted)
    line = line.when(kind == "error", F.regexp_replace("props", r"\}$", "")).when(kind == "view", "  ").otherwise(F.col("props"))
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    states = json_files.read_json_lines(spark, path)
    k = F.when(F.col("state") == "ok", F.get_json_object("value", "$.k").cast("bigint"))
    return states.groupBy("state").agg(F.count("*").alias("rows"), F.sum(k).alias("k_sum"))


@query("""
    SELECT CAST(vec_id AS VARCHAR) AS id, round(CAST(embedding[1] AS DOUBLE) * 100, 6) AS lon,
           round(CAST(embedding[2] AS DOUBLE) * 50, 6) AS lat, CAST(label AS VARCHAR) AS label
    FROM embeddings WHERE label <> 3
""")
def geojsonseq_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Points as a GeoJSON text sequence with record marks; label 3 is written broken."""
    path = scratch_path(spark, "points")
    point = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.col("vec_id").cast("string").alias("id"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.get("embedding", F.lit(0)).cast("double") * 100,
                    F.get("embedding", F.lit(1)).cast("double") * 50).alias("coordinates"),
        ).alias("geometry"),
        F.struct(F.col("label").cast("string").alias("label")).alias("properties"),
    ))
    line = F.concat(F.lit("\u001e"), F.when(F.col("label") == 3, F.concat(point, F.lit("}"))).otherwise(point))
    table(spark, sf, "embeddings").select(line.alias("value")).write.text(path)
    valid = json_files.valid_lines(json_files.read_geojson_sequence(spark, path))
    return geography.parse_poi_lines(valid, geometry_type="Point").select(
        "id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
        F.get_json_object("properties", "$.label").alias("label"),
    )


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS id, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS dtmnfr, s_name AS freguesia,
           CASE WHEN s_acctbal > 0 THEN 'main' END AS tipo_area_administrativa, n_name AS municipio, r_name AS distrito_ilha,
           n_name || ' 3' AS nuts3, n_name || ' 2' AS nuts2, r_name || ' 1' AS nuts1,
           s_acctbal AS area_ha, s_acctbal / 2 AS perimetro_km, CAST(1 AS BIGINT) AS rings,
           CAST(n_nationkey AS DOUBLE) AS center_lon, CAST(n_regionkey AS DOUBLE) AS center_lat
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def boundary_load(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as administrative areas (unit squares) in GeoJSON lines, loaded as a table."""
    path = scratch_path(spark, "boundaries")
    areas = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    x, y = F.col("n_nationkey").cast("double"), F.col("n_regionkey").cast("double")
    ring = F.array(*[F.array(x + dx, y + dy) for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))])
    areas.select(
        F.to_json(F.struct(
            F.lit("Feature").alias("type"),
            F.struct(
                F.col("s_suppkey").cast("string").alias("id"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("dtmnfr"),
                F.col("s_name").alias("freguesia"), F.when(F.col("s_acctbal") > 0, "main").alias("tipo_area_administrativa"),
                F.col("n_name").alias("municipio"), F.col("r_name").alias("distrito_ilha"),
                F.concat("n_name", F.lit(" 3")).alias("nuts3"), F.concat("n_name", F.lit(" 2")).alias("nuts2"),
                F.concat("r_name", F.lit(" 1")).alias("nuts1"), F.col("s_acctbal").alias("area_ha"),
                (F.col("s_acctbal") / 2).alias("perimetro_km"),
            ).alias("properties"),
            F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        )).alias("value")
    ).write.text(path)
    center = rings_centroid(F.col("rings"))
    return geography.read_boundaries(spark, path).select(
        *[name for name, _ in BOUNDARY_ATTRIBUTES],
        F.size("rings").cast("bigint").alias("rings"),
        F.round(center["lon"], 6).alias("center_lon"), F.round(center["lat"], 6).alias("center_lat"),
    )


@query("""
    WITH c AS (SELECT lower(n_name) AS district, lower(n_name) || '/c' || c_custkey AS id
               FROM customer JOIN nation ON c_nationkey = n_nationkey),
    s AS (SELECT district, CAST(ceil(count(*) / 40.0) AS BIGINT) AS lists FROM c GROUP BY 1)
    SELECT district, CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % lists AS list_no,
           CAST(count(*) AS BIGINT) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM c JOIN s USING (district) GROUP BY 1, 2
""")
def csv_catalog_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a location catalog in CSV; ids grouped per district into bounded lists."""
    path = scratch_path(spark, "catalog")
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    district, place = F.lower("n_name"), F.concat(F.lit("c"), F.col("c_custkey"))
    sinks.write_catalog(
        rows.select(
            district.alias("district"), place.alias("municipality"), F.concat_ws("/", district, place).alias("id"),
            F.col("c_name").alias("name"), F.lit("MUNICIPALITY").alias("detailedLevel"),
            F.array(district).alias("parentIds"),
        ),
        path,
    )
    lists = keys.lists_per_key(snapshots.read_catalog(spark, path), "district", "id", max_items=40)
    return lists.select(
        "district", "list_no", F.size("items").cast("bigint").alias("n"), F.array_join("items", ",").alias("ids")
    )


@query(r"""
    SELECT page_id, nullif(regexp_extract(html, '(?is)<script[^>]*>(.*?)</script>', 1), '') AS script,
           regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
           regexp_extract(html, '(?is)<html lang="([^"]*)"', 1) AS lang
    FROM pages
""")
def page_embedded_script(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id",
        page_source.script_body(F.col("html"), None).alias("script"),
        F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", '(?is)<html lang="([^"]*)"', 1).alias("lang"),
    )


@query("""
    SELECT page_id AS ad_id, url AS "sourceUrl", '2024-05-02' AS "ingestionDate", 'b' || page_id AS build_id
    FROM pages WHERE NOT contains(html, 'lang="fr"')
""")
def page_embedded_json(spark: SparkSession, sf: str) -> DataFrame:
    """A data script is put into each page, broken in the French ones, and read back."""
    data = F.to_json(F.struct(
        F.concat(F.lit("b"), F.col("page_id")).alias("buildId"),
        F.struct(F.struct(F.struct(F.col("page_id").alias("id")).alias("ad")).alias("pageProps")).alias("props"),
    ))
    data = F.when(F.contains("html", F.lit('lang="fr"')), F.concat(data, F.lit("]"))).otherwise(data)
    script = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script>"))
    pages = table(spark, sf, "pages").withColumn("html", F.concat("html", script))
    found = page_source.embedded_json(pages, run_date="2024-05-02")
    return found.select(
        F.get_json_object("page", "$.props.pageProps.ad.id").cast("bigint").alias("ad_id"),
        "sourceUrl", "ingestionDate", page_source.build_id(F.col("page")).alias("build_id"),
    )


_NODES = r"""
    SELECT page_id, [regexp_replace(replace(replace(replace(n, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g')
        for n in string_split(regexp_replace(html,
            '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<![^>]*>|<[^>]*>', chr(1), 'g'), chr(1))
        if n <> ''] AS nodes
    FROM pages
"""


@query(rf"""
    WITH t AS ({_NODES})
    SELECT page_id,
           regexp_replace(replace(array_to_string([
               CASE WHEN regexp_matches(n, '\S') THEN n WHEN contains(n, chr(10)) THEN chr(10) ELSE ' ' END
               for n in nodes], ' '), chr(10), ' '), '^\s+|\s+$', '', 'g') AS line,
           array_to_string([regexp_replace(n, '^\s+|\s+$', '', 'g') for n in nodes if regexp_matches(n, '\S')],
               chr(10)) AS lines
    FROM t
""")
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return spread_table(spark, sf, "pages", "page_id", "html").select(
        "page_id", html_to_line(F.col("html")).alias("line"), html_to_lines(F.col("html")).alias("lines")
    )


@query("""
    WITH l AS (SELECT lower(n_name) AS location, CAST(ceil(count(*) / 7.0) AS INTEGER) AS page_count
               FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
    SELECT location, CAST(p AS INTEGER) AS page,
           'https://example.org/b1/' || location || '.json' || CASE WHEN p = 1 THEN '' ELSE '?page=' || p END AS url,
           'https://example.org/ad/' || location || '-' || p AS detail
    FROM l, unnest(range(1, page_count + 1)) AS r(p)
""")
def request_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Result pages per nation, by customer count; pages of all nations in one table."""
    locations = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.lower("n_name").alias("location"))
        .agg(F.ceil(F.count("*") / 7).alias("page_count"))
    )
    plan = page_source.page_requests(locations, "location", "page_count", "https://example.org/b1/%s.json")
    slugs = plan.withColumn("slug", F.concat_ws("-", "location", "page")).withColumnRenamed("url", "page_url")
    return page_source.detail_urls(slugs, "https://example.org/ad/").select(
        "location", "page", F.col("page_url").alias("url"), F.col("url").alias("detail")
    )


@query("""
    SELECT conv_id, CAST(turn AS BIGINT) AS item_turn, role AS item_role FROM conversations
    UNION ALL
    SELECT conv_id, CAST(turn AS BIGINT), 'length ' || length(text) FROM conversations
""")
def page_items(spark: SparkSession, sf: str) -> DataFrame:
    """Item lists of several result pages put together, one row per item."""
    rows = table(spark, sf, "conversations").withColumn(
        "items",
        F.array(
            F.struct("turn", "role"),
            F.struct("turn", F.concat(F.lit("length "), F.length("text")).alias("role")),
        ),
    )
    return concat_pages(rows, "conv_id", "items").select(
        "conv_id", F.col("item.turn").alias("item_turn"), F.col("item.role").alias("item_role")
    )


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k, '{}' AS experiments FROM events
""")
def open_payload(spark: SparkSession, sf: str) -> DataFrame:
    """A payload with an empty object, kept as an open value, written and read back."""
    path = scratch_path(spark, "open")
    payload = F.regexp_replace("props", r"\}$", ',"experiments":{}}')
    events = table(spark, sf, "events").select("event_id", payload.alias("raw"))
    sinks.open_payload(events, "raw").write.parquet(path)
    return spark.read.parquet(path).select(
        "event_id",
        F.try_variant_get("payload", "$.k", "string").alias("k"),
        variant_text(F.try_variant_get("payload", "$.experiments", "variant")).alias("experiments"),
    )


@query("""
    SELECT CASE WHEN event_type = 'error' THEN 'failed' ELSE 'done' END AS outcome, CAST(count(*) AS BIGINT) AS rows,
           CAST(count(*) FILTER (value IS NULL) AS BIGINT) AS without_value,
           CAST(count(*) FILTER (value > 50) AS BIGINT) AS large
    FROM events GROUP BY 1
""")
def run_audit(spark: SparkSession, sf: str) -> DataFrame:
    outcome = F.when(F.col("event_type") == "error", "failed").otherwise("done")
    events = table(spark, sf, "events").withColumn("outcome", outcome)
    return run_counters(
        events, {"without_value": F.col("value").isNull(), "large": F.col("value") > 50}, ["outcome"]
    )
