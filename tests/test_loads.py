"""Replays, retries, versions and buckets: loads that are interrupted, run again, or read meanwhile."""

import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from lodestead.plans import ledger, loads
from lodestead.session import scratch_path, setting
from lodestead.sources import sinks
from lodestead.sources.snapshots import read_table
from lodestead.operators.keys import DateRange, new_rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCHEMA = StructType([StructField("slug", StringType()), StructField("ingestionDate", DateType()), StructField("id", LongType())])
KEYS, ORDER = ["slug", "ingestionDate"], ["id"]


def batch(spark, first, last, day="2025-05-02"):
    """Ids in a range; every tenth has no key, and two ids share one."""
    slug = F.when(F.col("id") % 10 != 0, F.concat(F.lit("s"), F.floor(F.col("id") / 2)))
    return spark.range(first, last).select(slug.alias("slug"), F.lit(day).cast("date").alias("ingestionDate"), "id")


@pytest.fixture
def tables(spark):
    staging, aside = (f"{kind}_{uuid.uuid4().hex}" for kind in ("staging", "aside"))
    sinks.create_table(spark, staging, SCHEMA, scratch_path(spark, staging), keys=KEYS)
    loads.create_quarantine(spark, aside, SCHEMA, scratch_path(spark, aside))
    return staging, aside


def sizes(spark, tables):
    return tuple(read_table(spark, t).count() for t in tables)


def test_a_load_by_name_happens_once(spark, tables):
    staging, aside = tables
    book = scratch_path(spark, "ledger")
    for _ in range(3):
        counts = loads.keyed_append(batch(spark, 0, 100), staging, KEYS, ORDER, quarantine=aside, ledger=book, load="one")
        assert counts == {"received": 100, "without_key": 10, "appended": 50, "table_rows": 50}
        assert sizes(spark, tables) == (50, 10)
    more = loads.keyed_append(batch(spark, 90, 200), staging, KEYS, ORDER, quarantine=aside, ledger=book, load="two")
    assert more == {"received": 110, "without_key": 11, "appended": 50, "table_rows": 100}
    assert sizes(spark, tables) == (100, 21)
    assert {r.load: r.appended for r in ledger.read_ledger(spark, book).collect()} == {"one": 50, "two": 50}


def test_without_a_ledger_the_content_names_the_load(spark, tables):
    for _ in range(3):
        loads.keyed_append(batch(spark, 0, 100), tables[0], KEYS, ORDER, quarantine=tables[1])
    assert sizes(spark, tables) == (50, 10)
    loads.keyed_append(batch(spark, 0, 110), tables[0], KEYS, ORDER, quarantine=tables[1])
    assert sizes(spark, tables) == (55, 21)


@pytest.mark.parametrize("broken", ["append_table", "set_aside", "write_entry", "after_append"])
def test_a_load_that_broke_off_goes_on(spark, tables, monkeypatch, broken):
    staging, aside = tables
    book = scratch_path(spark, "ledger")
    whole = {"received": 100, "without_key": 10, "appended": 50, "table_rows": 50}

    def stop(*args, **kwargs):
        if broken == "after_append":
            sinks.append_table(*args, **kwargs)
        raise KeyboardInterrupt("killed")

    with monkeypatch.context() as patch:
        patch.setattr(loads, "append_table" if broken == "after_append" else broken, stop)
        with pytest.raises(KeyboardInterrupt):
            loads.keyed_append(batch(spark, 0, 100), staging, KEYS, ORDER, quarantine=aside, ledger=book, load="one")
    assert ledger.read_ledger(spark, book).count() == 0
    for _ in range(2):
        assert loads.keyed_append(batch(spark, 0, 100), staging, KEYS, ORDER, quarantine=aside, ledger=book, load="one") == whole
    assert sizes(spark, tables) == (50, 10)


def test_a_ledger_needs_a_name_and_a_quarantine_its_column(spark, tables):
    with pytest.raises(ValueError, match="ledger"):
        loads.keyed_append(batch(spark, 0, 10), tables[0], KEYS, ORDER, load="one")
    with pytest.raises(ValueError, match="load_id"):
        loads.keyed_append(batch(spark, 0, 100), tables[0], KEYS, ORDER, quarantine=tables[0])


RETRIED = """
import sys
sys.path.insert(0, {root!r})
import os, uuid
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType
from lodestead.plans import loads
from lodestead.session import local_session, scratch_path
from lodestead.sources import sinks
spark = local_session("retry", cores="4,3", shuffle_partitions=3)
name = "t_" + uuid.uuid4().hex
schema = StructType.fromDDL("slug string, ingestionDate date, id bigint")
sinks.create_table(spark, name, schema, scratch_path(spark, name))

def once(rows):
    context = TaskContext.get()
    for i, row in enumerate(rows):
        yield row
    if context.attemptNumber() == 0 and context.partitionId() == 1:
        os._exit(1)

rows = spark.range(0, 1000, 1, 4).select(
    F.when(F.col("id") % 10 != 0, F.concat(F.lit("s"), "id")).alias("slug"), F.lit("2025-05-02").cast("date").alias("ingestionDate"), "id")
flaky = rows.mapInPandas(once, schema)
print("COUNTS", sorted(loads.keyed_append(flaky, name, ["slug", "ingestionDate"], ["id"]).items()), spark.table(name).count())
"""


def test_counters_survive_a_task_that_fails_once():
    done = subprocess.run([sys.executable, "-c", RETRIED.format(root=ROOT)], capture_output=True, text=True, timeout=300)
    assert "COUNTS [('appended', 900), ('received', 1000), ('without_key', 100)] 900" in done.stdout, done.stdout + done.stderr[-3000:]


def test_many_dates_are_a_range(spark, tables, monkeypatch):
    monkeypatch.setattr(loads, "MAX_DATES", 3)
    days = spark.range(40).select(
        F.concat(F.lit("s"), "id").alias("slug"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("ingestionDate"), "id"
    )
    profile = loads.batch_profile(days, KEYS)
    assert profile == (40, 0, DateRange("2025-01-01", "2025-01-10"))
    for added in (40, 0):
        assert loads.keyed_append(days, tables[0], KEYS, ORDER)["appended"] == added
    fresh = new_rows(days, read_table(spark, tables[0]), KEYS, profile.dates)
    assert "PartitionFilters: [isnotnull(ingestionDate" in fresh._jdf.queryExecution().toString()


# --- versions --------------------------------------------------------------


def test_readers_keep_their_version(spark, tmp_path):
    name = f"v_{uuid.uuid4().hex}"
    versions = [sinks.replace_table(spark.range(5), name, str(tmp_path))]
    first = spark.table(name)
    versions.append(sinks.replace_table(spark.range(7), name, str(tmp_path)))
    assert (first.count(), read_table(spark, name).count()) == (5, 7)
    with pytest.raises(Exception, match="no more"):
        sinks.replace_table(spark.range(9).select(F.raise_error(F.lit("no more")).cast("bigint").alias("id")), name, str(tmp_path))
    assert (first.count(), read_table(spark, name).count()) == (5, 7)
    versions.append(sinks.replace_table(spark.range(9), name, str(tmp_path)))
    assert sinks.table_versions(spark, name) == versions[1:] and read_table(spark, name).count() == 9
    assert len([d for d in os.listdir(tmp_path) if os.path.isdir(tmp_path / d) and any(f.endswith(".parquet") for f in os.listdir(tmp_path / d))]) == 2


def test_version_keeps_column_types(spark, tmp_path):
    name = f"v_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([("001", 1), ("2025-01-01", 2)], "code string, n int")
    sinks.replace_table(rows, name, str(tmp_path), ["code"])
    assert sorted(map(tuple, spark.table(name).select("code", "n").collect())) == [("001", 1), ("2025-01-01", 2)]
    assert dict(spark.table(name).dtypes)["code"] == "string"


def test_a_plain_table_is_not_replaced(spark, tables):
    with pytest.raises(ValueError, match="is a table"):
        sinks.replace_table(spark.range(3), tables[0])


# --- buckets ---------------------------------------------------------------


def test_bucketed_target_is_read_without_an_exchange(spark):
    name = f"b_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, SCHEMA, scratch_path(spark, name), keys=KEYS, bucket_by=["slug"], buckets=6)
    rows = batch(spark, 0, 3000).filter("slug is not null")
    counts = [loads.keyed_append(rows, name, KEYS, ORDER)["appended"] for _ in range(2)]
    assert counts == [1500, 0] and read_table(spark, name).count() == 1500
    layout = sinks.table_layout(spark, name)
    assert layout == (("ingestionDate",), ("slug",), 6, ("slug", "ingestionDate"))
    # One file a bucket and load, whatever the number of tasks.
    assert len(read_table(spark, name).inputFiles()) <= 6
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"), setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        new = loads._new_of_batch(rows, read_table(spark, name), layout, KEYS, ORDER, ["2025-05-02"], "ingestionDate", True)
        plan = new._jdf.queryExecution().executedPlan().toString()
        new.collect()
    target_side = plan[plan.rindex("LeftAnti"):]
    assert "Bucketed: true" in target_side
    # Above the scan of the target there is no exchange: the only one deals out the batch.
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    above, at = [], depth(lines[scan])
    for x in reversed(lines[:scan]):
        if depth(x) < at:
            above.append(x)
            at = depth(x)
    assert any("SortMergeJoin" in x or "ShuffledHashJoin" in x for x in above)
    until_join = above[: next(i for i, x in enumerate(above) if "Join" in x)]
    assert not any("Exchange" in x for x in until_join), plan


def test_append_refuses_rows_without_a_key(spark, tables):
    with pytest.raises(Exception, match="slug is null"):
        sinks.append_table(batch(spark, 0, 100), tables[0])
    assert read_table(spark, tables[0]).count() == 0
    sinks.append_table(batch(spark, 0, 100).filter("slug is not null"), tables[0])
    assert read_table(spark, tables[0]).count() == 90


# --- one exchange for dedup and anti join ----------------------------------


def test_a_load_of_one_day_moves_its_rows_once(spark, tables):
    """The day is a literal in the batch, as it is in a staged snapshot, so the join may not lose it as a key."""
    loads.keyed_append(batch(spark, 0, 100), tables[0], KEYS, ORDER)
    rows = batch(spark, 50, 200)
    rows = rows.unionByName(rows)
    for held in (read_table(spark, tables[0]), read_table(spark, tables[0]).withColumn("ingestionDate", F.lit("2025-05-02").cast("date"))):
        for given in (rows, batch(spark, 50, 200)):
            with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
                new = loads._new_of_batch(given, held, sinks.table_layout(spark, tables[0]), KEYS, ORDER, ["2025-05-02"], "ingestionDate", True)
                plan = new._jdf.queryExecution().executedPlan().toString()
                got = new.collect()
            # One deals out the batch, one the keys of the target.
            assert plan.count("Exchange hashpartitioning") == 2, plan
            assert new.columns == ["slug", "ingestionDate", "id"]
            assert sorted(r.id for r in got) == list(range(101, 200, 2))


def test_new_of_batch_is_dedup_and_anti_join(spark):
    """Nulls in keys, copies, an order by a key column, a dotted column and a key of another type."""
    day = lambda d: F.lit(d).cast("date")
    rows = spark.createDataFrame(
        [("a", "2025-05-01", 1, "x"), ("a", "2025-05-01", 1, "x"), ("a", "2025-05-01", None, "y"), ("a", "2025-05-02", 3, "z"),
         ("b", "2025-05-01", 4, "u"), (None, "2025-05-01", 5, "v"), ("c", None, 6, "w"), ("d", "2025-05-03", 7, "t")],
        "slug string, ingestionDate string, id int, `a.b` string",
    )
    dated = rows.withColumn("ingestionDate", F.col("ingestionDate").cast("date"))
    held = spark.createDataFrame([("b",), ("b",), ("c",), (None,), ("d",)], "slug string").withColumn("ingestionDate", day("2025-05-01"))
    expected = {("a", "2025-05-01", 1, "x"), ("a", "2025-05-02", 3, "z"), ("d", "2025-05-03", 7, "t")}
    for given in (dated, rows):  # the second has the date as text, the target as a date
        for order in (["id"], ["slug", "id"]):
            for dates in (None, ["2025-05-01"], DateRange("2025-05-01", "2025-05-02")):
                new = loads.new_of_batch(given, held, KEYS, order, dates)
                assert new.columns == ["slug", "ingestionDate", "id", "a.b"] and new.schema["ingestionDate"] == given.schema["ingestionDate"]
                got = [(r[0], str(r[1]), r[2], r[3]) for r in new.collect()]
                assert len(got) == 3 and set(got) == expected
    # A target of other dates than the batch's holds nothing of it.
    assert loads.new_of_batch(dated, held, KEYS, ["id"], ["2025-05-09"]).count() == 4
