"""Listings, detail pages, trees: hand-made nested rows."""

import json
import warnings

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from lodestead import schemas
from lodestead.functions.casts import lossy_cast_counts
from lodestead.operators import details, features, filters, model, projections


def items(spark, *rows):
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "v string")
    return lines.select(F.from_json("v", schemas.LISTING_ITEM).alias("i")).select("i.*")


def test_staging_columns_types_and_nulls(spark):
    df = items(
        spark,
        {"id": "7", "slug": "a", "title": None, "developmentId": "2.5", "agency": None,
         "location": {"address": None, "mapDetails": {"radius": "1.5"}}, "totalPrice": {"value": " 12 ", "currency": "EUR"},
         "dateCreated": "bad", "isPromoted": True, "totalPossibleImages": "3"},
        {"id": "8", "slug": "b", "totalPrice": {"value": "1d"}, "dateCreated": "2025-01-02 03:04:05",
         "location": {"address": {"city": {"name": "Braga"}}}, "agency": {"id": "5", "brandingVisible": False}},
    )
    staged = projections.stage_listings(df, "2025-05-02")
    assert len(staged.columns) == 39
    assert staged.schema.simpleString() == schemas.staging_schema().simpleString()
    a, b = staged.orderBy("slug").collect()
    assert (a.title, a.developmentId, a.agencyId, a.city, a.mapRadius) == (None, None, None, None, 1.5)
    assert (a.totalPriceValue, a.dateCreated, a.isPromoted, a.totalPossibleImages) == (12.0, None, True, 3)
    assert (b.totalPriceValue, b.city, b.agencyId, b.agencyBrandingVisible) == (None, "Braga", 5, False)
    assert str(b.ingestionDate) == "2025-05-02" and b.additionalInfo is None and b.isPromoted is None


def test_missing_source_column_fails_before_planning(spark):
    with pytest.raises(KeyError, match="slug"):
        projections.stage_listings(items(spark, {"id": "1"}).drop("slug"), "2025-05-02")


def test_text_booleans_in_the_source(spark):
    df = items(spark, {"id": "1", "slug": "a"}).withColumn("isPromoted", F.lit("yes"))
    assert projections.stage_listings(df).first()["isPromoted"] is None


def test_fractions_are_counted(spark):
    df = spark.createDataFrame([("2.5",), ("3",), (None,)], "n string")
    assert lossy_cast_counts(df, {"n": "long"}).first()["n"] == 1


AD = {
    "id": 12.0, "slug": "s", "url": "u", "title": "T", "description": None,
    "category": {"name": [{"value": "Apartamento"}]}, "adCategory": {"name": "FLAT", "type": "SELL"},
    "characteristics": [
        {"key": "price", "value": "1000", "currency": "EUR", "suffix": "/mês"},
        {"key": "m", "value": "80"}, {"key": "rooms_num", "value": "4", "localizedValue": "T3"},
        {"key": "price", "value": "sob consulta", "currency": "USD", "suffix": None},
        {"key": "bathrooms_num", "value": "2.0"}, {"key": "rooms_num", "value": "1", "localizedValue": "Loft"},
    ],
    "features": ["a", {"b": 1}, None, 5],
    "additionalInformation": [
        {"label": "lift", "values": ["::n"]}, {"label": "lift", "values": []}, {"label": "x", "values": ["::y"]},
    ],
    "location": {"mapDetails": {"radius": 0, "__typename": "M"},
                 "reverseGeocoding": {"__typename": "R", "locations": [{"fullName": "P", "__typename": "L"}]}},
    "contactDetails": {"phones": []},
}


def stage(spark, *ads, **kw):
    rows = [(json.dumps({"pageProps": {"ad": a}}) if isinstance(a, dict) else a, "2025-05-02") for a in ads]
    return details.stage_details(spark.createDataFrame(rows, "props string, ingestionDate string"), **kw)


def test_detail_row(spark):
    df = stage(spark, AD, "not json", {**AD, "description": "<p>tem 2 quartos, lareira</p>", "characteristics": None})
    assert len(df.columns) == 35
    first, broken, third = df.collect()
    assert (first.id, first.description_text, first.property_type, first.price) == (12, "", "Apartamento", 1000.0)
    assert (first.price_currency, first.price_period, first.area_m2) == ("USD", None, 80.0)
    assert (first.typology, first.bedrooms, first.bathrooms) == ("Loft", 3, None)
    assert first.other_features.lift is False and first.contact_phone is None
    assert first.features == ["a", '{"b":1}', "", "5"] and first.featuresByCategory == []
    assert first.map_details.asDict() == {"radius": 0, "zoom": None}
    assert first.reverse_geocoding.locations[0].fullName == "P"
    assert broken.id is None and broken.image_urls == [] and broken.description_text == ""
    assert (third.bedrooms, third.price, third.other_features.fireplace) == (2, None, True)


def test_category_name_can_be_left_out(spark):
    assert stage(spark, AD, keep_category_name=False).first()["property_type"] == "FLAT"


def test_flat_rows(spark):
    lines = [json.dumps({"props": {"pageProps": {"ad": AD}}}), "{}", "bad", ""]
    df = details.flat_rows(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert len(df.columns) == 69
    (row,) = df.collect()
    assert (row.ad_id, row.price, row.price_currency, row.rooms_num_clean, row.rooms_num_raw) == (12, None, "USD", "Loft", 1.0)
    assert row.image_urls == [] and row.breadcrumbs_json is None and row.area_unit == "m²"


def test_flat_rows_parse_each_line_once(spark):
    df = details.flat_rows(spark.createDataFrame([("{}",)], "value string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("ArrowEvalPython") <= 1


def test_drop_field_everywhere_and_flatten(spark):
    df = spark.sql(
        "select named_struct('__typename','x','a',1,'l',array(named_struct('__typename','y','b',2))) s, 1 as __typename"
    )
    clean = projections.drop_field_everywhere(df, "__typename")
    assert "__typename" not in clean.schema.simpleString()
    flat = projections.flatten_structs(clean, location="braga")
    assert flat.columns == ["s_a", "s_l", "location"] and flat.first()["s_l"][0].b == 2


def tree(spark, *municipalities):
    text = json.dumps({"data": {"locationTree": {"locationTreeObjects": list(municipalities)}}})
    df = spark.createDataFrame([(text,)], "v string")
    return df.select(F.from_json("v", schemas.LOCATION_TREE).alias("r")).select("r.*")


def test_location_tree(spark):
    m = {"id": "braga/guimaraes", "name": "Guimarães", "detailedLevel": "M", "parentIds": ["braga"],
         "sublocations": [{"id": "braga/guimaraes/azurem", "name": "Azurém", "detailedLevel": "P"}]}
    rows = projections.flatten_location_tree(tree(spark, m, {"id": "braga/fafe", "name": "Fafe"})).collect()
    assert [(r.district, r.municipality, r.id, r.parentIds) for r in rows] == [
        ("braga", "guimaraes", "braga/guimaraes", ["braga"]),
        ("braga", "guimaraes", "braga/guimaraes/azurem", []),
        ("braga", "fafe", "braga/fafe", []),
    ]
    named = projections.flatten_location_tree(tree(spark, m), district=F.lit("minho"))
    assert {r.district for r in named.collect()} == {"minho"}
    for bad in ("braga", "a/b/c"):
        with pytest.raises(Exception, match="unexpected path"):
            projections.flatten_location_tree(tree(spark, {"id": bad})).collect()


def test_present_columns_warns(spark):
    with pytest.warns(UserWarning, match="zz"):
        assert projections.present_columns(spark.range(1), ["id", "zz"]) == ["id"]


def test_every_whitelisted_tag_is_kept(spark):
    rows = [(json.dumps({key: v}),) for key, col in filters.POI_TAGS for v in filters.POI_VALUES.get(col, [])]
    kept = spark.createDataFrame(rows, "properties string")
    tagged = projections.tag_columns(kept, "properties", filters.POI_TAGS)
    assert filters.points_of_interest(tagged).count() == len(rows) == 72
    others = spark.createDataFrame([('{"office":"lawyer"}',), ("{}",), ('{"amenity":"bench"}',)], "properties string")
    found = filters.points_of_interest(projections.tag_columns(others, "properties", filters.POI_TAGS))
    assert [r[0] for r in found.select(filters.poi_category()).collect()] == ["office"]


def test_incomplete_rows_are_dropped(spark):
    df = spark.createDataFrame(
        [(1.0, "a", "x"), (None, "a", "x"), (2.0, " ", "x"), (3.0, "a", None)], "price double, city string, province string"
    )
    assert [r.price for r in filters.drop_incomplete(df, "price", ["city", "province"]).collect()] == [1.0]
    with pytest.raises(KeyError):
        filters.drop_incomplete(df, "nope")
    with pytest.raises(NotImplementedError):
        filters.drop_incomplete(df, "price", strategy="other")


FEATURES = [
    (1, '[{"label":"Área","values":["Útil","2 quartos"]},{"label":"x"},{"values":["y"]},7]'),
    (2, '[{"label":"area","values":["util"]}]'),
    (3, '{"label":"area"}'), (4, "bad"), (5, None), (6, '[{"label":"area","values":"util"}]'),
]


def test_multi_hot_joins_spellings_and_skips_malformed(spark):
    df = spark.createDataFrame(FEATURES, "id int, json string").withColumn("p", features.label_value_pairs("json"))
    vocabulary = features.feature_vocabulary(df, "p")
    assert list(vocabulary) == ["feat_cat_area_col_2_quartos", "feat_cat_area_util"]
    hot = features.multi_hot(df, "p", vocabulary).drop("json", "p").orderBy("id").collect()
    assert [tuple(r)[1:] for r in hot] == [(1, 1), (0, 1), (0, 0), (0, 0), (0, 0), (0, 0)]
    long = features.features_long(df, "id", "p").collect()
    assert {tuple(r) for r in long} == {(1, "feat_cat_area_util"), (1, "feat_cat_area_col_2_quartos"), (2, "feat_cat_area_util")}
    with pytest.raises(ValueError, match="features_long"):
        features.feature_vocabulary(df, "p", max_pairs=2)


def test_features_have_no_limit(spark):
    n = 5_100
    wide = [(i, json.dumps([{"label": "k", "values": [f"v{3 * i + k}" for k in range(3)] + ["V-0"]}])) for i in range(n // 3)]
    df = spark.createDataFrame([*wide, (n, "bad"), (n + 1, None)], "ad_id int, features_by_category string").repartition(3)
    paired = df.withColumn("p", features.label_value_pairs("features_by_category"))
    vocabulary = features.feature_index(paired, "p")
    number = {r.feature: r["index"] for r in vocabulary.collect()}
    assert sorted(number.values()) == list(range(n + 1)) and "feat_cat_k_v0" in number and "feat_cat_k_v_0" in number
    want = {i: sorted(number[f"feat_cat_k_{v}"] for v in (f"v{3 * i}", f"v{3 * i + 1}", f"v{3 * i + 2}", "v_0")) for i in range(n // 3)}
    want |= {n: [], n + 1: []}
    sparse = features.model_table(df, sparse=True, vocabulary=vocabulary).collect()
    assert {r.ad_id: r.feature_vector.indices.tolist() for r in sparse} == want
    assert {r.feature_vector.size for r in sparse} == {n + 1}
    shown = features.model_table(df)
    hot = [c for c in shown.columns if c.startswith(features.PREFIX)]
    assert hot == sorted(number)
    (row,) = shown.filter("ad_id = 7").collect()
    assert {number[c] for c in hot if row[c]} == set(want[7])


def test_wide_categories_are_hashed_by_argument(spark):
    rows = spark.createDataFrame([(i, f"c{i}", float(i % 7)) for i in range(60)], "area int, city string, price double")
    with pytest.raises(ValueError, match="a category has"):
        model.fit_boosted_trees(rows, ["area"], ["city"], "price", max_iter=1, max_categories=10)
    fitted = model.fit_boosted_trees(rows, ["area"], ["city"], "price", max_iter=1, max_categories=10, hashed={"city": 16})
    assert {c for c, _ in model.feature_importances(fitted)} == {"area", "city"}
    buckets = {r.city_index for r in fitted.transform(rows).select("city_index").collect()}
    assert len(buckets) > 8 and buckets <= {float(i) for i in range(16)}


def test_training_rows(spark):
    rows = [
        ("100", "T4", None, "Rés do chão", "D", None, None),
        ("200", "T2", "1", "2", "a+", "gas", "2001"),
        ("abc", "T1", "3", "3", None, "gas", "2001"),
        ("300", "x", "3", None, "?", "gas", "2001"),
    ]
    df = spark.createDataFrame(
        rows, "price string, rooms_num_clean string, bathrooms_num string, floor_no string, energy_certificate string, "
        "heating string, build_year string"
    )
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = model.training_rows(df.withColumn("area_unit", F.lit("m²"))).orderBy("price").collect()
    assert [r.price for r in out] == [100.0, 200.0, 300.0]
    assert [r.rooms_num_clean for r in out] == [4.0, 2.0, None]
    assert [r.bathrooms_num for r in out] == [2.0, 1.0, 3.0]
    assert [r.floor_no for r in out] == [0.0, 2.0, 0.0]
    assert [r.energy_certificate for r in out] == [8, 13, 0]
    assert [r.heating for r in out] == ["unknown", "gas", "gas"] and "area_unit" not in out[0]


def test_wide_categories_stand_by_their_means(spark):
    """50,000 labels, null among them, and labels that the fit has not seen."""
    n = 50_000
    rows = spark.range(2 * n).select(
        (F.col("id") % 50).cast("int").alias("area"), F.when(F.col("id") % n != 7, F.concat(F.lit("c"), F.col("id") % n)).alias("city"),
        (F.col("id") % n % 97 + F.floor(F.col("id") / n)).cast("double").alias("price"),
    )
    known = {r.city: r["mean"] for r in model.category_means(rows, "city", "price").collect()}
    assert len(known) == n and all(known[f"c{i}"] == i % 97 + 0.5 for i in range(0, n, 501)) and known[None] == 7.5
    drawn = model.category_means(rows.filter("city = 'c5' or area = 3"), "city", "price", smoothing=2.0).filter("city = 'c5'").first()["mean"]
    assert known["c5"] != drawn
    fitted = model.fit_boosted_trees(rows, ["area"], ["city"], "price", max_iter=1, means=["city"])
    best = dict(model.feature_importances(fitted))
    assert set(best) == {"area", "city"} and best["city"] > 0.9
    unseen = spark.createDataFrame([(1, "never", 1.0)], "area int, city string, price double")
    assert fitted.transform(unseen).first()["city_mean"] == pytest.approx(rows.agg(F.avg("price")).first()[0])


def test_means_hold_no_labels(spark):
    """The fitted stages are statements; rows without a number count nowhere and their labels have the mean of all."""
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 6.0), (None, 3.0), ("c", None), ("c", float("nan"))], "city string, price double")
    fitted = Pipeline(stages=model.mean_stages(["city"], "price")).fit(rows)
    assert {type(s).__name__ for s in fitted.stages} == {"SQLTransformer"} and all(len(s.getStatement()) < 1000 for s in fitted.stages)
    assert {tuple(r) for r in model.category_means(rows, "city", "price").collect()} == {("a", 1.5), ("b", 6.0), (None, 3.0), ("c", 3.0)}
    drawn = dict(map(tuple, model.category_means(rows, "city", "price", smoothing=2.0).collect()))
    assert drawn == {"a": pytest.approx(2.25), "b": pytest.approx(4.0), None: pytest.approx(3.0), "c": 3.0}


def test_wide_sparse_features_are_one_jvm_expression(spark):
    n = 20_000
    wide = spark.range(n).select(
        F.col("id").alias("ad_id"),
        F.to_json(F.array(F.struct(F.lit("k").alias("label"), F.array(F.concat(F.lit("v"), "id"), F.lit("all")).alias("values")))).alias("features_by_category"),
    )
    paired = wide.withColumn("p", features.label_value_pairs("features_by_category"))
    vocabulary = features.feature_index(paired, "p")
    number = {r.feature: r["index"] for r in vocabulary.filter("feature in ('feat_cat_k_all', 'feat_cat_k_v7')").collect()}
    table = features.model_table(wide, sparse=True, vocabulary=vocabulary)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and len(plan) < 20_000
    row = table.filter("ad_id = 7").first()
    assert row.feature_vector.size == n + 1 and sorted(row.feature_vector.indices.tolist()) == sorted(number.values())
