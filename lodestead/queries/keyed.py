"""Keys, dedup, anti joins and loads."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestead.operators import keys
from lodestead.operators.projections import union_all
from lodestead.plans.ledger import read_ledger
from lodestead.plans.loads import create_quarantine, keyed_append
from lodestead.queries.registry import query, table
from lodestead.session import scratch_path
from lodestead.sources.sinks import create_table, laid_out, replace_table
from lodestead.sources.snapshots import read_table
from lodestead.streaming.ingest import append_arrivals, arriving_files, load_arrivals


@query("""
    SELECT user_id, event_id, event_type, value FROM events WHERE user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return keys.latest_per_key(events, ["user_id"], "ts", ["event_id"]).select(
        "user_id", "event_id", "event_type", "value"
    )


@query("""
    SELECT 'first' AS kept, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
    UNION ALL
    SELECT 'last', CAST(o_custkey AS VARCHAR), o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def dedup_keep_first_last(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return union_all(
        [
            keys.one_per_key(orders, "o_custkey", "o_orderdate", keep, ["o_orderkey"]).select(
                F.lit(keep).alias("kept"), "o_custkey", "o_orderkey", "o_totalprice"
            )
            for keep in ("first", "last")
        ]
    )


def _user_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("day", F.to_date("ts"))


@query("SELECT DISTINCT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return keys.distinct_keys(_user_days(spark, sf), ["user_id", "day"]).select(
        "user_id", F.col("day").cast("string").alias("day")
    )


@query("""
    SELECT DISTINCT slug FROM (
        SELECT CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN NULL
               ELSE event_type || '-' || user_id END AS slug FROM events)
    WHERE slug IS NOT NULL AND slug <> ''
""")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    slug = F.when(F.col("event_type") == "error", "").when(
        F.col("event_type") != "view", F.concat_ws("-", "event_type", "user_id")
    )
    return keys.distinct_values(table(spark, sf, "events").select(slug.alias("slug")), "slug")


_TARGET = "event_type <> 'purchase'"


@query(f"""
    SELECT DISTINCT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE {_TARGET}
    INTERSECT
    SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events
""")
def existing_keys(spark: SparkSession, sf: str) -> DataFrame:
    events = _user_days(spark, sf)
    return keys.existing_keys(events.filter(_TARGET), events, ["user_id", "day"]).select(
        "user_id", F.col("day").cast("string").alias("day")
    )


@query("""
    SELECT doc_id, lang, source, n_chars FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def new_rows(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return keys.new_rows(documents, table(spark, sf, "labels"), ["doc_id"])


_FIRST_LOAD = f"""
    SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type FROM events WHERE {_TARGET}
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
"""
_LOADED = f"""
    WITH a AS ({_FIRST_LOAD}),
    b AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, CAST(day AS VARCHAR) AS day, event_id, event_type FROM a
    UNION ALL
    SELECT user_id, CAST(day AS VARCHAR), event_id, event_type FROM b
    WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = b.user_id AND a.day = b.day)
"""


@query(_LOADED)
def idempotent_load(spark: SparkSession, sf: str) -> DataFrame:
    """A first load, a larger one, and the larger one again: the last adds nothing."""
    events = _user_days(spark, sf).withColumn("ingestionDate", F.col("day"))
    name, path = f"staging_{uuid.uuid4().hex}", scratch_path(spark, "idempotent-load")
    create_table(spark, name, events.schema, path)
    for batch in (events.filter(_TARGET), events, events):
        keyed_append(batch, name, ["user_id", "ingestionDate"], ["ts", "event_id"])
    return read_table(spark, name).select("user_id", F.col("day").cast("string").alias("day"), "event_id", "event_type")


@query("""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS events,
           CAST(min(user_id) AS BIGINT) AS first_user, CAST(max(event_id) AS BIGINT) AS last_event
    FROM events GROUP BY 1
""")
def partitioned_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Full refresh twice into the same table, partitioned by day and sorted by user."""
    name, path = f"refreshed_{uuid.uuid4().hex}", scratch_path(spark, "refresh")
    rows = _user_days(spark, sf)
    for _ in range(2):
        replace_table(laid_out(rows, ["day"], ["user_id"]), name, path, ["day"])
    return read_table(spark, name).groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count("*").alias("events"), F.min("user_id").alias("first_user"), F.max("event_id").alias("last_event")
    )


@query("""
    SELECT key, CAST((row_number() OVER (ORDER BY md5(key), key) - 1) // 50 AS BIGINT) AS batch_no
    FROM (SELECT DISTINCT url AS key FROM pages WHERE url <> '')
""")
def batch_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return keys.batch_numbers(table(spark, sf, "pages").withColumnRenamed("url", "key"), "key", 50)


def _land_events(spark: SparkSession, sf: str, folder: str, part: int) -> StructType:
    """One of two rounds of event files; returns their schema."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.filter(F.pmod("event_id", F.lit(2)) == part).write.mode("append").parquet(folder)
    return events.schema


@query("SELECT event_id, user_id, event_type, CAST(value * 2 AS DOUBLE) AS doubled FROM events")
def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """Every landed file is appended once, also when more land and the stream is started again."""
    folder, out, checkpoint = (scratch_path(spark, f"stream-{x}") for x in ("landing", "out", "checkpoint"))
    for part in (0, 1):
        schema = _land_events(spark, sf, folder, part)
        append_arrivals(
            arriving_files(spark, folder, schema),
            lambda df: df.select("event_id", "user_id", "event_type", (F.col("value") * 2).alias("doubled")),
            out,
            checkpoint,
        ).awaitTermination()
    return spark.read.parquet(out)


@query("""
    SELECT DISTINCT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events
""")
def stream_keyed_load(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batches of two rounds through the keyed load: one row per user and day in the table."""
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream-checkpoint")
    name, path = f"streamed_{uuid.uuid4().hex}", scratch_path(spark, "stream-load")
    project = lambda df: df.select("user_id", "event_id", "ts", F.to_date("ts").alias("ingestionDate"))
    for part in (0, 1):
        schema = _land_events(spark, sf, folder, part)
        if part == 0:
            create_table(spark, name, project(spark.read.schema(schema).parquet(folder)).schema, path)
        load_arrivals(
            arriving_files(spark, folder, schema, files_per_batch=4), project, name,
            ["user_id", "ingestionDate"], ["ts", "event_id"], checkpoint,
        ).awaitTermination()
    return read_table(spark, name).select("user_id", F.col("ingestionDate").cast("string").alias("day"))


_NULL_KEYS = """
    SELECT 'loaded' AS state, count(DISTINCT (user_id, CAST(ts AS DATE))) AS rows FROM events WHERE event_type <> 'view'
    UNION ALL SELECT 'quarantined', count(*) FROM events WHERE event_type = 'view'
"""


def _without_some_users(spark: SparkSession, sf: str) -> DataFrame:
    """Views lose their user."""
    user = F.when(F.col("event_type") != "view", F.col("user_id"))
    return _user_days(spark, sf).withColumn("user_id", user).withColumnRenamed("day", "ingestionDate")


def _staging_and_quarantine(spark: SparkSession, schema: StructType) -> list[str]:
    names = [f"{kind}_{uuid.uuid4().hex}" for kind in ("staging", "aside")]
    create_table(spark, names[0], schema, scratch_path(spark, "staging"), keys=["user_id", "ingestionDate"])
    create_quarantine(spark, names[1], schema, scratch_path(spark, "quarantine"))
    return names


def _table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    return union_all([
        read_table(spark, n).agg(F.lit(s).alias("state"), F.count("*").alias("rows"))
        for n, s in zip(names, ("loaded", "quarantined"))
    ])


@query(_NULL_KEYS)
def null_key_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a user are set aside, and a second load of the same batch adds nothing to either table."""
    events = _without_some_users(spark, sf)
    staging, aside = _staging_and_quarantine(spark, events.schema)
    for _ in range(2):
        keyed_append(events, staging, ["user_id", "ingestionDate"], ["ts", "event_id"], quarantine=aside)
    return _table_counts(spark, [staging, aside])


@query(f"""
    WITH e AS (SELECT event_id % 3 AS part, CASE WHEN event_type <> 'view' THEN user_id END AS user_id, CAST(ts AS DATE) AS day FROM events),
    k AS (SELECT user_id, day, min(part) AS part FROM e WHERE user_id IS NOT NULL GROUP BY 1, 2),
    c AS (SELECT e.part, count(*) AS received, count(*) FILTER (user_id IS NULL) AS without_key,
                 (SELECT count(*) FROM k WHERE k.part = e.part) AS appended,
                 (SELECT count(*) FROM k WHERE k.part <= e.part) AS table_rows
          FROM e GROUP BY e.part)
    SELECT 'load ' || part AS state, received, without_key, appended, table_rows AS rows FROM c
    UNION ALL SELECT state, NULL, NULL, NULL, rows FROM ({_NULL_KEYS})
""")
def replayed_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches, each handed over twice under its name: both tables and the counters are as if once."""
    events = _without_some_users(spark, sf)
    staging, aside = _staging_and_quarantine(spark, events.schema)
    ledger = scratch_path(spark, "ledger")
    for part in (0, 0, 1, 1, 0, 2, 2):
        batch = events.filter(F.pmod("event_id", F.lit(3)) == part)
        keyed_append(
            batch, staging, ["user_id", "ingestionDate"], ["ts", "event_id"], quarantine=aside, ledger=ledger, load=f"load {part}"
        )
    loads = read_ledger(spark, ledger).select(
        F.col("load").alias("state"), "received", "without_key", "appended", F.col("table_rows").alias("rows")
    )
    counts = _table_counts(spark, [staging, aside])
    none = [F.lit(None).cast("bigint").alias(c) for c in ("received", "without_key", "appended")]
    return loads.unionByName(counts.select("state", *none, "rows"))


@query("""
    SELECT 'pinned' AS reader, event_type, count(*) AS events FROM events WHERE event_type <> 'purchase' GROUP BY 2
    UNION ALL SELECT 'after a failed write', event_type, count(*) FROM events WHERE event_type <> 'purchase' GROUP BY 2
    UNION ALL SELECT 'after the swap', event_type, count(*) FROM events GROUP BY 2
""")
def versioned_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A reader keeps its version over a failed refresh and a successful one."""
    name, path = f"versioned_{uuid.uuid4().hex}", scratch_path(spark, "versions")
    events = _user_days(spark, sf)
    counts = lambda reader: read_table(spark, name).groupBy(F.lit(reader).alias("reader"), "event_type").agg(F.count("*").alias("events"))
    replace_table(events.filter(_TARGET), name, path, ["day"])
    pinned = counts("pinned")
    broken = F.when(F.col("event_type") == "purchase", F.raise_error(F.lit("broken row")).cast("double")).otherwise(F.col("value"))
    try:
        replace_table(events.withColumn("value", broken), name, path, ["day"])
        raise AssertionError("the broken row was written")
    except PySparkException as error:
        if "broken row" not in str(error):
            raise
    failed = counts("after a failed write")
    replace_table(events, name, path, ["day"])
    return union_all([pinned, failed, counts("after the swap")])


@query(_LOADED)
def bucketed_load(spark: SparkSession, sf: str) -> DataFrame:
    """The idempotent load into a table bucketed by user, whose keys are found without an exchange of the table."""
    events = _user_days(spark, sf).withColumn("ingestionDate", F.col("day"))
    name, path = f"bucketed_{uuid.uuid4().hex}", scratch_path(spark, "bucketed-load")
    keys_ = ["user_id", "ingestionDate"]
    create_table(spark, name, events.schema, path, keys=keys_, bucket_by=["user_id"], buckets=8)
    for batch in (events.filter(_TARGET), events, events):
        keyed_append(batch, name, keys_, ["ts", "event_id"])
    return read_table(spark, name).select("user_id", F.col("day").cast("string").alias("day"), "event_id", "event_type")
