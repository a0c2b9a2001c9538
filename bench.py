"""Times the headline queries and the stages of the daily load; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores.  Every query is written to the no-op sink, so all rows
are computed and none is collected; the best of the timed runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lodestead.operators.keys import distinct_keys, new_rows  # noqa: E402
from lodestead.operators.projections import stage_listings  # noqa: E402
from lodestead.plans.loads import keyed_append, one_per_batch_key  # noqa: E402
from lodestead.queries import QUERIES  # noqa: E402
from lodestead.queries.nested import order_listings  # noqa: E402
from lodestead.schemas import staging_schema  # noqa: E402
from lodestead.session import local_session, scratch_path  # noqa: E402
from lodestead.sources import sinks, snapshots  # noqa: E402

HEADLINE = (
    "latest_per_key", "dedup_keep_first_last", "existing_keys", "new_rows", "batch_numbers", "staging_projection",
    "incremental_load", "detail_projection", "flat_training_row", "kv_pivot_last_wins", "location_tree", "json_tags",
    "poi_whitelist", "type_coercion", "required_filter", "name_join", "fallback_join", "point_in_polygon",
    "page_embedded_json", "page_text", "multi_hot", "column_profile", "median_fill", "text_flags", "date_features",
    "hash_split", "regression_metrics", "partitioned_refresh", "idempotent_load", "stream_keyed_load",
    "nearest_poi", "poi_counts_radius", "model_table", "json_doc_files", "null_key_quarantine",
    "replayed_loads", "versioned_refresh", "bucketed_load", "json_whole_documents", "multi_hot_sparse", "category_means",
    "boosted_trees",
)
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def load_stages(spark, sf_dir: str) -> dict[str, float]:
    """Newest snapshot -> projection -> dedup -> anti join -> append, each timed on the rows before it.

    The snapshot holds every order listing twice.  The table holds all listings
    of three days before and half of the same day's, so the anti join has both
    keys that it finds and keys that it does not.
    """
    folder, day = scratch_path(spark, "bench"), "2025-05-02"
    keys, order = ["slug", "ingestionDate"], ["dateCreated", "id"]
    listings = order_listings(spark, sf_dir)
    sinks.write_snapshot(listings.unionByName(listings), folder, "listings", day)
    name = f"bench_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, staging_schema(), scratch_path(spark, "bench-table"))
    for before in ("2025-04-29", "2025-04-30", "2025-05-01"):
        sinks.append_table(stage_listings(listings, before), name)
    sinks.append_table(stage_listings(listings.filter(F.pmod(F.xxhash64("slug"), F.lit(2)) == 0), day), name)
    out: dict[str, float] = {}
    found: dict[str, str] = {}
    out["load_discovery"] = timed(lambda: found.update(path=snapshots.newest_snapshot(spark, folder, "listings_*.parquet")))
    raw = snapshots.read_snapshot(spark, found["path"])
    out["load_read"] = timed(lambda: compute(raw))
    staged = stage_listings(raw, day)
    out["load_projection"] = timed(lambda: compute(staged))
    out["load_keys"] = timed(lambda: compute(distinct_keys(staged, keys)))
    unique = one_per_batch_key(staged, keys, order)
    out["load_dedup"] = timed(lambda: compute(unique))
    out["load_anti_join"] = timed(lambda: compute(new_rows(unique, spark.table(name), keys, [day])))
    out["load_append"] = timed(lambda: keyed_append(staged, name, keys, order, [day]))
    out["load_again"] = timed(lambda: keyed_append(staged, name, keys, order, [day]))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    compute(spark.range(1_000_000).groupBy((F.col("id") % 10).alias("k")).count())
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        seconds[name] = min(timed(lambda: compute(QUERIES[name](spark, sf_dir))) for _ in range(RUNS))
    stages = [load_stages(spark, sf_dir) for _ in range(RUNS)]
    seconds.update({k: min(s[k] for s in stages) for k in stages[0]})
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count() * 2
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "load_rows": rows,
        "projection_rows_per_second": round(rows / seconds["load_projection"]),
    }))


if __name__ == "__main__":
    main()
