"""Sources, sinks, streams and whole jobs on small files."""

import datetime as dt
import json
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from lodestead import schemas
from lodestead.operators import details
from lodestead.plans import geography as geo_jobs
from lodestead.plans import loads, training
from lodestead.session import scratch_path, scratch_root
from lodestead.sources import geography, json_files, pages, sinks, snapshots
from lodestead.streaming import ingest


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_newest_snapshot(spark, folder):
    assert snapshots.newest_snapshot(spark, folder, "*.parquet") is None
    with pytest.raises(FileNotFoundError):
        snapshots.newest_snapshot(spark, folder, "*.parquet", on_empty="error")
    for day in ("2025-05-01", "2025-05-02"):
        sinks.write_snapshot(spark.range(3), folder, "listings", day)
        time.sleep(1.1)
    spark.range(1).toPandas().to_parquet(f"{folder}/other.parquet")
    open(f"{folder}/empty_2026-01-01.parquet", "w").close()
    assert snapshots.newest_snapshot(spark, folder, "listings_*.parquet").endswith("listings_2025-05-02.parquet")
    assert snapshots.newest_snapshot(spark, folder).endswith("other.parquet")
    rows = snapshots.list_snapshots(spark, folder).orderBy("path").collect()
    assert [str(r.snapshot_date) for r in rows] == ["2025-05-01", "2025-05-02", "None"]
    newest = snapshots.newest_snapshots(snapshots.list_snapshots(spark, folder), 2).collect()
    assert [os.path.basename(r.path) for r in newest] == ["other.parquet", "listings_2025-05-02.parquet"]


def test_equal_times_follow_the_name(spark, folder):
    for name in "ab":
        spark.range(1).toPandas().to_parquet(f"{folder}/{name}.parquet")
        os.utime(f"{folder}/{name}.parquet", (1, 1))
    assert snapshots.newest_snapshot(spark, folder, ties="first").endswith("a.parquet")
    assert snapshots.newest_snapshot(spark, folder, ties="last").endswith("b.parquet")


def test_slugs_of_a_snapshot(spark, folder):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4)], "slug string, n int")
    path = sinks.write_snapshot(df, folder, "s", "2025-05-02")
    found = snapshots.read_slugs(spark, path)
    assert [r.slug for r in found.collect()] == ["a"]
    assert "ReadSchema: struct<slug:string>" in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(KeyError):
        snapshots.read_slugs(spark, path, "id")
    url = pages.detail_urls(found, "https://example.org/ad/").first()["url"]
    assert url == "https://example.org/ad/a"


def test_existing_snapshot_is_left_alone(spark, folder):
    path = sinks.write_snapshot(spark.range(3), folder, "s", "2025-05-02")
    sinks.write_snapshot(spark.range(9), folder, "s", "2025-05-02", if_exists="ignore")
    assert spark.read.parquet(path).count() == 3


def test_district_documents(spark, folder):
    item = {"slug": "x", "id": "own"}
    with open(f"{folder}/braga.json", "w") as f:
        json.dump({"braga/fafe": [item, item], "braga/guimaraes": [], "braga/vizela": [item]}, f, indent=1)
    rows = json_files.read_documents(spark, f"{folder}/*.json").collect()
    assert sorted((r.location_id, r.id, r.slug) for r in rows) == [
        ("braga/fafe", "own", "x"), ("braga/fafe", "own", "x"), ("braga/vizela", "own", "x")
    ]
    with open(f"{folder}/bad.json", "w") as f:
        f.write('{"a/b": [')
    with pytest.raises(Exception, match="not valid JSON"):
        json_files.read_documents(spark, f"{folder}/*.json").collect()
    assert json_files.read_documents(spark, f"{folder}/*.json", on_bad="skip").count() == 3
    assert json_files.bad_documents(spark, f"{folder}/*.json").first()["path"].endswith("bad.json")


def test_documents_of_a_large_district_are_split(spark, folder):
    df = spark.range(600).select(
        F.lit("braga").alias("district"), F.when(F.col("id") % 3 == 0, "braga/b").otherwise("braga/a").alias("loc"),
        F.col("id").cast("string").alias("slug"),
    )
    docs = sinks.district_documents(df, "district", "loc", 100)
    assert docs.count() == 6
    sinks.write_district_documents(df, f"{folder}/out", "district", "loc", 100)
    back = json_files.read_documents(spark, f"{folder}/out", "map<string,array<struct<slug:string>>>", whole_file=False)
    assert {(r.location_id, r.slug) for r in back.collect()} == {(r.loc, r.slug) for r in df.collect()}


def test_documents_as_lines_are_never_one_value(spark, folder):
    """Two documents of a district, a file each; keys to quote, copies over several lines, a null district is left out."""
    n = spark.range(1200).select(
        F.when(F.col("id") % 100 != 99, "braga").alias("district"), F.when(F.col("id") % 3 == 0, 'b/"x"').otherwise("a, é").alias("loc"),
        F.col("id").cast("string").alias("slug"),
    )
    df = n.unionByName(spark.range(2500).select(F.lit("braga").alias("district"), F.lit("a, é").alias("loc"), F.lit('hot "]}').alias("slug")))
    docs = sinks.district_documents(df, "district", "loc", 2000, as_lines=True)
    assert docs.agg(F.max(F.length("value"))).first()[0] < 25_000
    docs.write.partitionBy("district", "document_no").text(f"{folder}/out")
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{folder}/out") for f in names if f.endswith(".txt")]
    assert len(files) == 2
    for f in files:
        with open(f) as text:
            document = json.load(text)
        assert set(document) == {"a, é", 'b/"x"'} and sum(map(len, document.values())) < 2500
    back = json_files.read_documents(spark, f"{folder}/out", "map<string,array<struct<slug:string>>>")
    want = df.filter("district is not null").groupBy("loc", "slug").count().collect()
    assert {tuple(r) for r in back.groupBy("location_id", "slug").count().collect()} == {tuple(r) for r in want}


def test_json_lines_and_geojson_sequence(spark, folder):
    point = '{"geometry":{"type":"Point","coordinates":[-8.5,41.2]},"properties":{"amenity":"cafe"},"id":"n1","x":1}'
    area = '{"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},"properties":{},"id":"w1"}'
    with open(f"{folder}/p.geojsonl", "w", newline="") as f:
        f.write(f"\x1e{point}\n{area}\n\x1e\n   \n\x1e{{bad\n")
    states = json_files.read_geojson_sequence(spark, folder)
    assert {r.state: r["count"] for r in states.groupBy("state").count().collect()} == {"ok": 2, "blank": 2, "bad": 1}
    valid = json_files.valid_lines(states)
    every = geography.parse_poi_lines(valid).orderBy("id").collect()
    assert [(r.id, r.lon, r.lat) for r in every] == [("n1", -8.5, 41.2), ("w1", None, None)]
    assert geography.parse_poi_lines(valid, geometry_type="Point").count() == 1
    assert json_files.quarantine(states).first()["value"] == "{bad"
    with pytest.raises(ValueError):
        json_files.valid_lines(states.filter("state = 'bad'"), require_some=True)
    name = f"pois_{uuid.uuid4().hex}"
    geo_jobs.load_pois(spark, folder, name, scratch_path(spark, name))
    assert geo_jobs.relevant_pois(spark.table(name)).first()["category"] == "amenity"


def test_boundaries_and_enrichment(spark, folder):
    def line(i, parish, town, x):
        ring = [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]
        return json.dumps({"type": "Feature", "properties": {"id": i, "freguesia": parish, "municipio": town, "area_ha": 2.5},
                           "geometry": {"type": "Polygon", "coordinates": [ring]}})

    with open(f"{folder}/b.geojsonl", "w") as f:
        f.write(line("1", "Azurém", "Guimarães", 0) + "\n" + line("2", "Fafe", "Fafe", 5) + "\n")
    areas = geography.read_boundaries(spark, folder)
    assert areas.columns == [n for n, _ in schemas.BOUNDARY_ATTRIBUTES] + ["geometry", "rings"]
    listings = spark.createDataFrame([("a", "guimarães", 0.5, 0.5), ("b", "x", 5.5, 0.5)], "slug string, city string, lon double, lat double")
    named = {r.slug: r.freguesia for r in geo_jobs.add_areas_by_name(listings, areas).collect()}
    placed = {r.slug: r.freguesia for r in geo_jobs.add_areas_by_location(listings, areas).collect()}
    assert named == {"a": "Azurém", "b": None} and placed == {"a": "Azurém", "b": "Fafe"}
    pois = spark.createDataFrame(
        [("amenity", "cafe", 0.5, 0.501), ("amenity", "recycling", 0.5, 0.6)], "category string, amenity string, lon double, lat double"
    )
    row = geo_jobs.add_poi_features(listings.filter("slug = 'a'"), pois, ["amenity"], [200]).first()
    assert row["count_amenity_200m"] == 1 and row["nearest_negative_m"] == pytest.approx(11119, rel=1e-3)


def test_catalog_csv_roundtrip(spark, folder):
    df = spark.createDataFrame(
        [("braga", "fafe", "braga/fafe", 'O "Fafe", novo', "M", ["braga", "minho"])],
        "district string, municipality string, id string, name string, detailedLevel string, parentIds array<string>",
    )
    sinks.write_catalog(df, f"{folder}/c")
    assert snapshots.read_catalog(spark, f"{folder}/c").collect() == df.collect()


PAGE = "<html><script>var a=1</script><script type='application/json' id=\"__NEXT_DATA__\" x>{}</script></html>"


def test_embedded_json(spark):
    html = [PAGE.format('{"buildId":"b","props":{"pageProps":{"ad":{"id":5,"slug":"s"}}}}'), PAGE.format("{broken"), PAGE.format(""),
            PAGE.format('{"a":1}]'), "<html></html>", "<script id='__NEXT_DATA__2'>{}</script>", None]
    df = spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    found = pages.embedded_json(df, run_date="2025-05-02")
    assert [tuple(r)[1:] for r in found.collect()] == [("u0", "2025-05-02")]
    assert found.select(pages.build_id(F.col("page"))).first()[0] == "b"
    staged = details.stage_details(loads.detail_pages(df, "2025-05-02")).first()
    assert (staged.id, staged.slug, str(staged.ingestionDate)) == (5, "s", "2025-05-02")


def test_page_requests(spark):
    df = spark.createDataFrame([("a/b", 3), ("c", None), ("d", 0)], "id string, n int")
    urls = [r.url for r in pages.page_requests(df, "id", "n", "https://x/%s.json").collect()]
    assert urls == ["https://x/a/b.json", "https://x/a/b.json?page=2", "https://x/a/b.json?page=3", "https://x/c.json", "https://x/d.json"]


def test_empty_objects_survive(spark, folder):
    df = spark.createDataFrame([('{"experiments":{},"l":[]}',), ("bad",)], "raw string")
    sinks.open_payload(df, "raw").write.parquet(f"{folder}/o")
    back = spark.read.parquet(f"{folder}/o").select(F.to_json("payload")).collect()
    assert {r[0] for r in back} == {'{"experiments":{},"l":[]}', None}


def listing(slug, n, created="2025-05-01 10:00:00"):
    return {"id": str(n), "slug": slug, "dateCreated": created, "totalPrice": {"value": str(n), "currency": "EUR"}}


def raw(spark, *rows):
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "v string")
    return lines.select(F.from_json("v", schemas.LISTING_ITEM).alias("i")).select("i.*")


@pytest.fixture
def staging(spark):
    name = f"staging_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, schemas.staging_schema(), scratch_path(spark, name))
    return name


def test_catalog_load(spark, folder, staging):
    assert loads.load_catalog_snapshot(spark, folder, staging) is None
    day = "2025-05-02"
    sinks.write_snapshot(raw(spark, listing("a", 1), listing("a", 2, "2025-05-01 11:00:00"), listing("b", 3)), folder, "l", day)
    assert loads.load_catalog_snapshot(spark, folder, staging, run_date=day) == {"received": 3, "without_key": 0, "appended": 2}
    assert loads.load_catalog_snapshot(spark, folder, staging, run_date=day)["appended"] == 0
    assert loads.load_catalog_snapshot(spark, folder, staging, run_date="2025-05-03")["appended"] == 2
    rows = spark.table(staging).filter("ingestionDate = date'2025-05-02' and slug = 'a'").collect()
    assert [r.totalPriceValue for r in rows] == [2.0] and len(rows[0]) == 39


def test_detail_load_takes_the_date_of_the_file(spark, folder):
    ad = {"id": 7, "slug": "s", "modifiedAt": "2025-05-01T00:00:00", "description": "<p>x</p>"}
    df = spark.createDataFrame([(json.dumps({"pageProps": {"ad": ad}}),)] * 2, "props string")
    sinks.write_snapshot(df, folder, "details", "2025-05-02")
    name = f"details_{uuid.uuid4().hex}"
    empty = details.stage_details(df.limit(0).withColumn("ingestionDate", F.lit("")))
    sinks.create_table(spark, name, empty.schema, scratch_path(spark, name))
    assert loads.load_detail_snapshot(spark, folder, name) == {"received": 2, "without_key": 0, "appended": 1}
    assert loads.load_detail_snapshot(spark, folder, name)["appended"] == 0
    assert spark.table(name).first()["ingestionDate"] == dt.date(2025, 5, 2)


def test_stream_loads_each_file_once(spark, folder, staging):
    def stream():
        return ingest.arriving_files(spark, f"{folder}/in", schemas.LISTING_ITEM, "l_*.parquet")

    def project(df):
        from lodestead.operators.projections import stage_listings

        return stage_listings(df, "2025-05-02")

    checkpoint, keys, order = f"{folder}/ck", ["slug", "ingestionDate"], ["dateCreated", "id"]
    land = lambda df, name: df.toPandas().pipe(lambda p: spark.createDataFrame(p, df.schema)).coalesce(1).write.parquet(f"{folder}/tmp_{name}") or [
        os.rename(f"{folder}/tmp_{name}/{f}", f"{folder}/in/{name}.parquet")
        for f in os.listdir(f"{folder}/tmp_{name}") if f.endswith(".parquet")
    ]
    os.makedirs(f"{folder}/in")
    land(raw(spark, listing("a", 1), listing("a", 1), listing("b", 2)), "l_1")
    land(raw(spark, listing("zzz", 1)), "other_1")
    ingest.load_arrivals(stream(), project, staging, keys, order, checkpoint).awaitTermination()
    assert sinks.table_rows(spark, staging) == 2
    land(raw(spark, listing("b", 2), listing("c", 3)), "l_2")
    for _ in range(2):
        ingest.load_arrivals(stream(), project, staging, keys, order, checkpoint).awaitTermination()
    # A lost checkpoint replays all files; the keys keep the table unchanged.
    ingest.load_arrivals(stream(), project, staging, keys, order, f"{folder}/ck2").awaitTermination()
    assert sorted(r.slug for r in snapshots.read_table(spark, staging).collect()) == ["a", "b", "c"]


def test_cleaner(spark):
    df = spark.createDataFrame(
        [("a", "1", "100.5", "50", " Braga ", "Minho", " FLAT ", "yes"), ("a", "2", "200", "50", "Braga", "Minho", "", "1"),
         ("b", "1", None, "50", "Braga", "Minho", "x", "0"), ("c", "1", "7", "50", "  ", "Minho", "x", "0")],
        "slug string, dateCreated string, totalPriceValue string, areaInSquareMeters string, city string, province string, "
        "estate string, isPrivateOwner string",
    ).withColumn("dateCreated", F.concat(F.lit("2025-01-0"), "dateCreated"))
    with pytest.warns(UserWarning):
        (row,) = training.clean_staging(df).collect()
    assert (row.slug, row.totalPriceValue, row.city, row.estate, row.isPrivateOwner) == ("a", 200.0, "braga", None, True)


def test_price_model(spark):
    def ad(i):
        rooms = i % 4
        return {"id": i, "characteristics": [
            {"key": "price", "value": str(500 * rooms + 3 * i)}, {"key": "m", "value": str(i)},
            {"key": "rooms_num", "localizedValue": f"T{rooms}"}],
            "featuresByCategory": [{"label": "x", "values": ["lift"] if i % 2 else []}],
            "location": {"address": {"city": {"name": f"c{i % 3}"}}}}

    lines = [json.dumps({"props": {"pageProps": {"ad": ad(i)}}}) for i in range(200)]
    with _quiet():
        fitted, metrics = training.train_price_model(spark.createDataFrame([(v,) for v in lines], "value string"), 8)
    assert {r.is_test for r in metrics.collect()} == {True, False}
    from lodestead.operators.model import feature_importances

    top = feature_importances(fitted, 3)
    assert len(top) == 3 and top[0][0] in ("rooms_num_clean", "area")


def _quiet():
    import warnings

    return warnings.catch_warnings()


def test_scratch_follows_the_cluster_setting(spark):
    root = scratch_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root
    assert scratch_path(spark, "x").startswith(root + "/x-") and scratch_path(spark, "x") != scratch_path(spark, "x")
