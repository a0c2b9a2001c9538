"""Keys, loads, names, quantiles; also on data where one key holds a third of the rows."""

import datetime as dt
import json
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestead.operators import keys, places, quality
from lodestead.plans import loads
from lodestead.session import scratch_path
from lodestead.sources import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key(spark):
    d = dt.date
    rows = [("a", d(2025, 1, 1), 1), ("a", d(2025, 1, 3), 2), ("a", d(2025, 1, 3), 3), ("a", None, 9),
            ("b", None, 4), ("", d(2025, 1, 1), 5), (None, d(2025, 1, 1), 6)]
    df = spark.createDataFrame(rows, "slug string, ingestionDate date, n int")
    latest = keys.latest_per_key(df, ["slug"], "ingestionDate", ["n"])
    assert {(r.slug, r.n) for r in latest.collect()} == {("a", 3), ("b", 4)}
    assert plan(keys.latest_per_key(df, ["slug"], "ingestionDate", ["n"])).count("WindowGroupLimit") == 2


def test_one_per_key(spark):
    rows = [("1", 5, "x"), ("1", 7, "y"), ("1", None, "z"), (None, 1, "n"), ("", 1, "e"), ("NaN", 1, "nan")]
    df = spark.createDataFrame(rows, "id string, s int, v string")
    assert keys.one_per_key(df, "id", "s", "last").first()["v"] == "y"
    assert keys.one_per_key(df, "id", "s", "first").first()["v"] == "z"
    with pytest.warns(UserWarning):
        assert keys.one_per_key(df, "id", "absent").count() == 1
    with pytest.raises(KeyError):
        keys.one_per_key(df, "absent", "s")


def test_existing_keys_and_new_rows(spark):
    target = spark.createDataFrame([("a", "2025-01-01"), ("a", "2025-01-01"), (None, "2025-01-01")], "k string, d string")
    batch = spark.createDataFrame(
        [("a", "2025-01-01"), ("b", "2025-01-01"), (None, "2025-01-01"), ("a", "2025-01-02")], "k string, d string"
    )
    cols = ["k", "d"]
    assert keys.existing_keys(target, batch, cols).count() == 1
    assert keys.existing_keys(target, batch, cols, multiply=True).count() == 2
    fresh = keys.new_rows(batch, target, cols)
    assert sorted(map(str, fresh.collect())) == sorted(
        ["Row(k='b', d='2025-01-01')", "Row(k=None, d='2025-01-01')", "Row(k='a', d='2025-01-02')"]
    )
    assert keys.new_rows(fresh.na.drop(), fresh, cols).isEmpty()


SCHEMA = "slug string, ingestionDate date, id bigint"


def skewed(spark, n=3000):
    """A third of the rows share one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("slug"),
        F.lit("2025-05-02").cast("date").alias("ingestionDate"), F.col("id"),
    )


@pytest.fixture
def staging(spark):
    name = f"t_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, StructType.fromDDL(SCHEMA), scratch_path(spark, name))
    return name


def test_load_is_idempotent_and_counts(spark, staging):
    batch = skewed(spark)
    first = loads.keyed_append(batch, staging, ["slug", "ingestionDate"], ["id"], ["2025-05-02"])
    again = loads.keyed_append(batch, staging, ["slug", "ingestionDate"], ["id"], ["2025-05-02"])
    more = loads.keyed_append(
        batch.unionByName(spark.createDataFrame([("new", dt.date(2025, 5, 2), 1)], batch.schema)),
        staging, ["slug", "ingestionDate"], ["id"],
    )
    assert first == {"received": 3000, "without_key": 0, "appended": 2001}
    assert again["appended"] == 0 and more["appended"] == 1
    assert sinks.table_rows(spark, staging) == 2002
    assert spark.table(staging).filter("slug = 'hot'").first()["id"] == 2997


def test_load_without_dedup_and_null_keys(spark, staging):
    d = dt.date(2025, 5, 2)
    rows = spark.createDataFrame([("a", d, 1), ("a", d, 2), (None, d, 3), (None, d, 4)], SCHEMA)
    kept = loads.one_per_batch_key(rows, ["slug", "ingestionDate"], ["id"])
    assert [r.id for r in kept.collect()] == [2]
    counts = loads.keyed_append(rows, staging, ["slug", "ingestionDate"], ["id"], dedup=False)
    assert counts == {"received": 4, "without_key": 2, "appended": 2}
    again = loads.keyed_append(rows, staging, ["slug", "ingestionDate"], ["id"], dedup=False)
    assert again == {"received": 4, "without_key": 2, "appended": 0}
    assert sinks.table_rows(spark, staging) == 2


def test_append_needs_the_table(spark):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        sinks.append_table(skewed(spark), "no_such_table")


def test_target_scan_is_pruned_to_the_batch_date(spark, staging):
    fresh = keys.new_rows(skewed(spark), spark.table(staging), ["slug", "ingestionDate"], ["2025-05-02"])
    assert "PartitionFilters: [isnotnull(ingestionDate" in plan(fresh) and "CartesianProduct" not in plan(fresh)


def test_batch_numbers_are_full_batches(spark):
    df = skewed(spark).unionByName(skewed(spark))
    numbers = keys.batch_numbers(df, "slug", 500)
    sizes = {r.batch_no: r["count"] for r in numbers.groupBy("batch_no").count().collect()}
    assert sizes == {0: 500, 1: 500, 2: 500, 3: 500, 4: 1}


def test_lists_are_bounded_and_whole(spark):
    lists = keys.lists_per_key(skewed(spark).withColumn("id", F.col("id").cast("string")), "slug", "id", 100)
    rows = lists.filter("slug = 'hot'").collect()
    assert len(rows) == 10 and max(len(r["items"]) for r in rows) < 200
    assert sorted(int(i) for r in rows for i in r["items"]) == list(range(0, 3000, 3))
    assert lists.filter("slug = 'k1'").first()["items"] == ["1"]


def test_copies_are_dealt_out(spark):
    """One value makes up a third of the rows: it is spread over the lists, none is lost."""
    df = skewed(spark).select(F.lit("braga").alias("district"), F.col("slug"))
    rows = keys.lists_per_key(df, "district", "slug", 100).collect()
    sizes = [len(r["items"]) for r in rows]
    assert len(rows) == 30 and sum(sizes) == 3000 and max(sizes) < 150
    hot = [sum(1 for i in r["items"] if i == "hot") for r in rows]
    assert sum(hot) == 1000 and max(hot) - min(hot) <= 1
    docs = sinks.district_documents(df.withColumn("loc", F.lit("braga/x")), "district", "loc", 100).collect()
    lengths = [len(json.loads(r["value"])["braga/x"]) for r in docs]
    assert len(docs) == 30 and sum(lengths) == 3000 and max(lengths) < 150


def test_layout_can_split_a_hot_date(spark):
    laid = sinks.laid_out(skewed(spark), ["ingestionDate"], ["slug"])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(laid) and laid.count() == 3000


AREAS = [("Santa Maria ", "Bragança", 1), ("santa maria", "Lisboa", 2), ("Azurém", "Guimarães", 3),
         ("Creixomil", "Guimarães", 4), ("Guimarães", "Outra", 5)]


def test_name_join(spark):
    areas = spark.createDataFrame(AREAS, "freguesia string, municipio string, n int")
    listings = spark.createDataFrame([(1, " SANTA MARIA"), (2, "x"), (3, None)], "id int, city string")
    every = places.join_by_name(listings, areas, "city", "freguesia", ["municipio", "n"])
    assert sorted((r.id, r.n or 0) for r in every.collect()) == [(1, 1), (1, 2), (2, 0), (3, 0)]
    one = places.join_by_name(listings, areas, "city", "freguesia", ["municipio", "n"], "first", ["n"])
    assert sorted((r.id, r.n or 0) for r in one.collect()) == [(1, 1), (2, 0), (3, 0)]


def test_fallback_join_prefers_the_first_level(spark):
    areas = spark.createDataFrame(AREAS, "freguesia string, municipio string, n int")
    listings = spark.createDataFrame([(1, "guimarães"), (2, "lisboa"), (3, "zz"), (4, "bragança")], "id int, city string")
    joined = places.join_by_name_with_fallback(listings, areas, "city", ["freguesia", "municipio"], ["n"])
    assert sorted((r.id, r.n or 0) for r in joined.collect()) == [(1, 5), (2, 2), (3, 0), (4, 1)]
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)


def exact(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo, hi = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
    return lo + (hi - lo) * (at - int(at))


@pytest.mark.parametrize("max_values", [5, 100_000])
def test_exact_quantiles(spark, max_values):
    rng = random.Random(3)
    data = [(rng.random(), 7.0 if i % 3 else float(i), None if i % 5 == 0 else float(i % 11)) for i in range(5000)]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(4)
    found = quality.exact_quantiles(df, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.9, 1.0], accuracy=50, max_values=max_values)
    for i, c in enumerate("abc"):
        column = [r[i] for r in data if r[i] is not None]
        assert found[c] == pytest.approx({p: exact(column, p) for p in (0.0, 0.25, 0.5, 0.9, 1.0)})
    assert quality.exact_quantiles(df.filter("a < 0"), ["a"], [0.5]) == {"a": {0.5: None}}
    assert quality.exact_quantiles(spark.createDataFrame([(1,), (2,)], "v int"), ["v"], [0.5])["v"][0.5] == 1.5


def test_counters_fill_while_writing(spark):
    df, seen = quality.counted(spark.range(10), "audit", {"even": F.col("id") % 2 == 0})
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


@pytest.mark.parametrize("max_values", [50, 5_000])
def test_quantiles_take_three_scans(spark, max_values):
    """Whole numbers above 2 ** 53 come back exactly, NaN does not count, and the input is read three times at most."""
    read = spark.sparkContext.accumulator(0)
    n, big = 20_000, 2**60

    def passed(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.range(0, n, 1, 4).mapInPandas(passed, "id bigint").select(
        F.when(F.col("id") % 7 != 0, F.lit(big) + F.col("id") * 3).alias("large"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.sin("id")).alias("wave"),
        F.when(F.col("id") % 2 == 0, 5).otherwise((F.col("id") % 11).cast("int")).alias("few"),
    )
    found = quality.exact_quantiles(df, ["large", "wave", "few"], [0.0, 0.3, 0.5, 1.0], max_values=max_values)
    assert read.value <= 3 * n
    large = sorted(big + i * 3 for i in range(n) if i % 7)
    assert found["large"][0.0] == large[0] and found["large"][1.0] == large[-1]
    middle = [large[(len(large) - 1) // 2], large[len(large) // 2]]
    assert found["large"][0.5] in (sum(middle) // 2, sum(middle) / 2) and abs(found["large"][0.5] - middle[0]) <= 3
    wave = [math.sin(i) for i in range(n) if i % 3]
    assert found["wave"] == pytest.approx({p: exact(wave, p) for p in (0.0, 0.3, 0.5, 1.0)})
    few = [5 if i % 2 == 0 else i % 11 for i in range(n)]
    assert found["few"] == pytest.approx({p: exact(few, p) for p in (0.0, 0.3, 0.5, 1.0)})
