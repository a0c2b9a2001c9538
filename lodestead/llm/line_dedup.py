"""Line dedup by spread over sites: lines that stand on many sites are boilerplate.

The number of distinct sites of each line is estimated by HyperLogLog sketches
that merge by aggregation, so that a very common line is combined in every map
task before the shuffle.  Lines whose estimate lies near the threshold are
counted exactly; only built-in functions are used.

Lines are known by two 64-bit hashes.  The lines to remove come back to a
document under a hash of its id and text; two documents that shared such a hash
would only look for each other's boilerplate as well, so this loses nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.llm.text import stored

MIN_SITES, MIN_CHARS, LOG_K = 10, 10, 12


def _near(log_k: int) -> float:
    """Six standard errors of a sketch's estimate."""
    return 6 * 1.04 / math.sqrt(2**log_k)


def _hashes(line: Column) -> Column:
    line = F.trim(line)
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(3), line).alias("b"))


def _site(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("?"))


def _line_hashes(text: Column, min_chars: int) -> Column:
    long_enough = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x)) >= min_chars)
    return F.array_distinct(F.transform(long_enough, _hashes))


def boilerplate_lines(
    df: DataFrame,
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
    log_k: int = LOG_K,
) -> DataFrame:
    """(a, b) hashes of lines that stand on ``min_sites`` sites or more; a null site is a site."""
    lines = df.select(_site(site).alias("site"), F.explode(_line_hashes(F.col(text), min_chars)).alias("line")).select(
        "line.a", "line.b", "site"
    )
    spread = lines.groupBy("a", "b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k))).alias("sites"))
    low, high = min_sites * (1 - _near(log_k)) - 1, min_sites * (1 + _near(log_k)) + 1
    # Both are written once: few rows, whose size Spark then knows when it joins them with all lines.
    spread = stored(df.sparkSession, spread.filter(F.col("sites") >= low), "line-spread")
    near = stored(df.sparkSession, spread.filter(F.col("sites") <= high).select("a", "b"), "line-near")
    exact = (
        # Only lines near the threshold are counted exactly; the others do not reach the distinct.
        lines.join(near, ["a", "b"], "left_semi").distinct()
        .groupBy("a", "b").agg(F.count("*").alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    return spread.filter(F.col("sites") > high).select("a", "b").unionByName(exact.select("a", "b"))


def remove_boilerplate(
    df: DataFrame,
    text: str = "text",
    site: str = "source",
    key: str = "doc_id",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
    log_k: int = LOG_K,
) -> DataFrame:
    """All rows, their texts without boilerplate lines, with ``n_lines`` and ``n_removed`` lines.

    Lines compare without spaces at their ends; shorter ones than ``min_chars``
    code points always stay.  A null text stays null and has no line; an empty
    one has one line, which stays.  Every occurrence of a boilerplate line goes.
    Repeated rows and rows without a key are treated like others; columns named
    ``n_lines`` or ``n_removed`` are replaced.
    """
    # Written once: few rows, whose size Spark then knows when it plans the join with all lines.
    bad = stored(df.sparkSession, boilerplate_lines(df, text, site, min_sites, min_chars, log_k), "boilerplate")
    own = F.xxhash64(F.col(key), F.col(text))
    found = (
        df.select(own.alias("__own"), F.explode(_line_hashes(F.col(text), min_chars)).alias("line"))
        .select("__own", "line.a", "line.b")
        .join(bad, ["a", "b"], "left_semi")
        .groupBy("__own")
        .agg(F.collect_set(F.struct("a", "b")).alias("__bad"))
    )
    kept = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], own.alias("__own")).join(found, "__own", "left")
    lines = F.split(F.col(text), "\n", -1)
    stays = F.when(
        F.col("__bad").isNotNull(),
        F.filter(lines, lambda x: ~F.array_contains("__bad", _hashes(x)) | (F.length(F.trim(x)) < min_chars)),
    )
    rows = rows.withColumn("__stays", stays)
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n_lines = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    n_removed = F.when(F.col("__bad").isNotNull(), n_lines - F.size("__stays")).otherwise(F.lit(0)).cast("long")
    new_text = F.when(F.col("__bad").isNotNull(), F.array_join("__stays", "\n")).otherwise(F.col(text))
    return rows.select(
        *[new_text.alias(text) if c == text else F.col(f"`{c}`") for c in kept],
        n_lines.alias("n_lines"), n_removed.alias("n_removed"),
    )
