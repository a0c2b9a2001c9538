"""Column expressions on hand-made values."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestead.functions import casts, geometry, html, json_text, names, text
from lodestead.operators import features


def values(spark, fn, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_numbers(spark):
    given_ = ["1", " 12 ", "1d", "0x10", "abc", "", None, "1e3", "2.5", "-.5", "Infinity", "1e", "+7"]
    assert values(spark, casts.to_double, given_) == [
        1.0, 12.0, None, None, None, None, None, 1000.0, 2.5, -0.5, None, None, 7.0
    ]
    assert values(spark, casts.to_long, ["12.0", "2.5", "1e3", "9007199254740993", "x", None, " 4\t"]) == [
        12, None, 1000, 9007199254740993, None, None, 4
    ]
    assert values(spark, casts.to_whole_text_number, ["3", "2.0", " 4 ", "", None]) == [3, None, 4, None, None]


def test_booleans_are_strict(spark):
    assert values(spark, casts.to_boolean, ["TRUE", "1", "0", "False", "yes", "t", "", None]) == [
        True, True, False, False, None, None, None, None
    ]


def test_dates(spark):
    assert values(spark, casts.to_timestamp, ["2025-01-02T03:04:05", "bad", None])[1:] == [None, None]
    assert values(spark, casts.to_date, ["2025-01-02", "2025-01-02 10:00:00", "x"]) == [
        dt.date(2025, 1, 2), dt.date(2025, 1, 2), None
    ]
    assert values(spark, casts.date_from_file_name, [
        "gs://b/p/staging_2025-05-02.parquet", "/a/x_2025-05-02.parquet/part-0.snappy.parquet", "/a/x.parquet",
        "/a/x_2025-13-02.parquet",
    ]) == [dt.date(2025, 5, 2), dt.date(2025, 5, 2), None, None]
    assert values(spark, casts.epoch_to_date_text, [0, 86400], "bigint") == ["1970-01-01", "1970-01-02"]


def test_text_cleaning(spark):
    assert values(spark, text.normalise, [" Braga\t", " ÉVORA ", None]) == ["braga", "évora", None]
    assert values(spark, text.blank_to_null, ["", " \n", " a "]) == [None, None, " a "]
    assert values(spark, text.clean_category, [" T2 ", "  "]) == ["t2", None]
    assert values(spark, text.clean_suffix, ["/mês", "", None, " / "]) == ["mês", None, None, ""]
    assert values(spark, text.bedrooms_from_typology, ["T3", "t0", "Loft", "T", None, "T12+1"]) == [
        3, 0, None, None, None, 12
    ]
    assert values(spark, lambda c: text.path_part(c, 1), ["braga/guimaraes"]) == ["guimaraes"]


def test_bedroom_and_amenity_phrases(spark):
    assert values(spark, text.bedrooms_from_text, [
        "com 2 quartos", "1 Quarto e 3 quartos", "HTML Description 2 quartos", "", None
    ]) == [2, 3, None, None, None]
    flags = text.amenity_columns(F.col("v"))
    assert values(spark, lambda c: flags["garage"], ["Garagem fechada", "garagem", "x"]) == ["Closed", "Yes", None]
    assert values(spark, lambda c: flags["kitchen_equipment"], ["cozinha semi-equipada", "cozinha equipada"]) == [
        "Semi-equipped", "Equipped"
    ]
    assert values(spark, lambda c: flags["balcony"], ["Varanda", "x"]) == [True, None]


def test_html(spark):
    page = "<p>Um &amp; dois</p>\n<script>x</script><div> três<br/>quatro </div><!-- c --><style>s</style>"
    assert values(spark, html.html_to_lines, [page, "", None, "sem tags"]) == [
        "Um & dois\ntrês\nquatro", "", "", "sem tags"
    ]
    assert values(spark, html.html_to_line, ["<b>a</b><i>b</i>\n", None, "a\nb"]) == ["a b", "", "a b"]


def test_strict_json(spark):
    items = ['{"a":1}', "[1,2]", "1", '{"a":1}}', '{"a":1}]', "1,2", "{bad", "", " ", None, '{"a":1} x']
    assert values(spark, json_text.is_json, items) == [True, True, True] + [False] * 8


def test_surrogates(spark):
    fix = lambda c: F.from_json(json_text.repair_surrogates(c), "t string")["t"]
    assert values(spark, fix, [
        r'{"t":"a\ud83d"}', r'{"t":"😀"}', r'{"t":"\ud83d😀\ude00"}', r'{"t":"\\ud83d"}',
    ]) == ["a�", "😀", "�😀�", r"\ud83d"]


def test_variant_texts(spark):
    items = ['["a",{"b":1},null,3,true,"true",[1]]', '{"a":1}', "null", "1"]
    assert values(spark, lambda c: json_text.variant_list_text(F.try_parse_json(c)), items) == [
        ["a", '{"b":1}', "", "3", "True", "true", "[1]"], [], [], []
    ]


def test_column_names():
    assert [names.column_name(t) for t in ("Área útil", "2 quartos", "ção-ç", "€", "", 5, "__a__")] == [
        "area_util", "col_2_quartos", "cao_c", "_invalid_name_", "_invalid_name_", "col_5", "a"
    ]


@given(st.text(max_size=30))
@settings(max_examples=200, deadline=None)
def test_column_names_are_clean_and_stable(t):
    name = names.column_name(t)
    assert name and not name[0].isdigit() and set(name) <= set("abcdefghijklmnopqrstuvwxyz0123456789_")
    assert name == "_invalid_name_" or names.column_name(name) == name


def test_ranks_and_floors(spark):
    assert values(spark, features.ordinal_rank, [" A+ ", "d", "isento", "?", None]) == [13, 8, 1, 0, 0]
    assert values(spark, features.floor_number, ["Rés do chão", "3", "cave", None]) == [0.0, 3.0, None, None]
    assert values(spark, features.floor_category, ["Rés do chão", "3.0", " Cave ", None]) == ["0", "3", "cave", None]


def test_dates_of_market(spark):
    df = spark.sql("select date'2025-05-05' as seen, date'2025-05-20' as loaded")
    row = df.select(features.day_of_week(F.col("seen")), features.days_on_market(F.col("seen"), F.col("loaded"))).first()
    assert tuple(row) == (0, 15)


def test_cells_cover_their_points(spark):
    """No point is farther from its cell's centre than the bound says."""
    rng = random.Random(1)
    points = [(rng.uniform(-180, 179.9), rng.uniform(-90, 90)) for _ in range(300)]
    df = spark.createDataFrame(points, "lon double, lat double")
    for level in (1, 4, 9, 15):
        step = F.lit(geometry.cell_step(level))
        x, y = geometry.cell_x(F.col("lon"), level), geometry.cell_y(F.col("lat"), level)
        lon_c, lat_c = geometry.cell_center(x, y, step)
        far = geometry.haversine(F.col("lon"), F.col("lat"), lon_c, lat_c) > geometry.cell_reach(lat_c, step)
        assert df.filter(far).count() == 0


def test_rings_with_hole_and_multipolygon(spark):
    square = "[[0,0],[4,0],[4,4],[0,4],[0,0]]"
    hole = "[[1,1],[3,1],[3,3],[1,3],[1,1]]"
    far = "[[10,10],[12,10],[12,12],[10,12],[10,10]]"
    geo = [
        f'{{"type":"Polygon","coordinates":[{square},{hole}]}}',
        f'{{"type":"MultiPolygon","coordinates":[[{square},{hole}],[{far}]]}}',
        '{"type":"Point","coordinates":[1,2]}',
    ]
    inside = lambda lon, lat: lambda c: geometry.segments_contain(
        geometry.rings_segments(geometry.geojson_rings(c)), F.lit(lon), F.lit(lat)
    )
    assert values(spark, inside(0.5, 0.5), geo) == [True, True, None]
    assert values(spark, inside(2.0, 2.0), geo) == [False, False, None]
    assert values(spark, inside(11.0, 11.0), geo) == [False, True, None]
    center = lambda c: geometry.rings_centroid(geometry.geojson_rings(c))["lon"]
    assert values(spark, center, geo) == [2.0, 2.0, None]
    assert values(spark, geometry.geojson_point, geo)[2] == [1.0, 2.0]
