"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is a share of all words by weight, at most ``cap`` times its
own words; what is above goes to the others until nothing is.  Every document
of a source then has the same fractional number of copies.  Rounding pairs
documents: a random one of two moves takes words from one and gives as many to
the other until one of them is integral, so the expected copies stay and the
words of a source do not change.  Each leaf of a reduction tree leaves at most
one document open; the open ones of many leaves meet in the next level.

A leaf is read as a sorted stream that carries one open row, so that memory
does not depend on the size of a source, and a source has as many leaves as its
rows need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestead.llm.text import mix as mixed
from lodestead.llm.text import give_back, small_batches, stored

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
LEAF_ROWS, FAN_IN, SEED = 4096, 64, 20_240_501


def numbered(sources: DataFrame, column: str = "source") -> DataFrame:
    """The rows with ``no``: 0, 1, ... by code point, null last; ranges are counted, not gathered."""
    spark = sources.sparkSession
    by = F.col(column).asc_nulls_last()
    ranged = sources.repartitionByRange(by).sortWithinPartitions(by)
    # The row's place in its range is kept with the range: both are written once.
    ranged = stored(spark, ranged.withColumn("place", F.monotonically_increasing_id()), "mix-sources")
    bits = 33  # of a place's rank inside its range
    split = ranged.withColumn("range", F.shiftright("place", bits)).withColumn("rank", F.col("place") - F.shiftleft("range", bits))
    counts = sorted((r["range"], r["n"]) for r in split.groupBy("range").agg((F.max("rank") + 1).alias("n")).collect())
    start, offsets = 0, [(-1, 0)]
    for k, n in counts:  # one entry for each shuffle partition
        offsets.append((k, start))
        start += n
    starts = spark.createDataFrame(offsets, "range long, start long")
    return split.join(F.broadcast(starts), "range").withColumn("no", F.col("start") + F.col("rank")).drop("range", "rank", "start", "place")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_size, n_rows, target) of (source, size) rows; null is a source of its own, the last.

    ``share`` below ``cap`` is needed, else all stop at their caps.
    """
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    table = stored(
        spark,
        numbered(per).withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap))).drop("no"),
        "mix-weights",
    )
    total, all_weights = table.agg(F.sum("source_size"), F.sum("weight")).first()
    rate = share * (total or 0) / all_weights if all_weights else 0.0
    stopped = -1
    while True:  # one round for each time that sources reach their caps
        above = F.col("most") < F.col("weight") * F.lit(rate)
        n, given, rest = table.agg(
            F.count_if(above), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == stopped or not rest:
            break
        stopped, rate = n, (share * total - (given or 0.0)) / rest
    return table.withColumn("target", F.least("most", F.col("weight") * F.lit(rate))).drop("weight", "most")


def _rounded(schema: T.StructType):
    """Streams rows sorted by (source, leaf): sets ``copies``, or leaves it null for the last open row of a leaf."""
    names = schema.fieldNames()
    at = {n: names.index(n) for n in ("__source", "__leaf", "__hash", "__chance", "size", "copies")}

    def filled(batch: pa.RecordBatch, rows: np.ndarray, up: np.ndarray, chance: np.ndarray, undecided: bool) -> pa.RecordBatch:
        part = batch.take(pa.array(rows))
        columns = list(part.columns)
        columns[at["__chance"]] = pa.array(chance, pa.float64())
        if not undecided:
            whole = columns[at["copies"]].to_numpy(zero_copy_only=False).astype("int64")
            columns[at["copies"]] = pa.array(whole + up, pa.int64())
            columns.append(pa.array(np.ones(len(rows), bool)))
        else:
            columns.append(pa.array(np.zeros(len(rows), bool)))
        return pa.RecordBatch.from_arrays(columns, names=[*names, "decided"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_p, held_size, group = None, 0.0, 0.0, None
        last, met = None, 0  # source, leaf and hash of the row before, and how many rows before had them in a row

        def release(up: int | None) -> pa.RecordBatch:
            one = np.zeros(1, np.int64)
            return filled(held, one, np.array([up or 0]), np.array([held_p]), up is None)

        for batch in batches:
            source, leaf, key, size = (batch.column(at[c]).to_numpy(zero_copy_only=False) for c in ("__source", "__leaf", "__hash", "size"))
            chance = batch.column(at["__chance"]).to_numpy(zero_copy_only=False).astype(float).tolist()
            # Rows of one hash are neighbours; each draws by its number among them, wherever a batch ends.
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (leaf[1:] == leaf[:-1]) & (source[1:] == source[:-1])
            same[:1] = [last == (source[0], leaf[0], key[0])] if len(key) else []
            starts = np.maximum.accumulate(np.where(same, -1, np.arange(len(key))))
            number = np.arange(len(key)) - np.maximum(starts, 0) + np.where(starts < 0, met, 0)
            if len(key):
                last, met = (source[-1], leaf[-1], key[-1]), int(number[-1]) + 1
            with np.errstate(over="ignore"):
                draw = mixed(mixed(key.astype(np.uint64)) + number.astype(np.uint64))
            draw = ((draw >> np.uint64(11)).astype(float) / 2.0**53).tolist()
            up = np.zeros(len(key), np.int64)
            here = -1  # index of the open row, if it lies in this batch
            ready = np.ones(len(key), bool)
            groups, sizes = list(zip(source.tolist(), leaf.tolist())), size.tolist()
            for i, g in enumerate(groups):
                if g != group:
                    if held is not None:
                        yield release(None)
                        held = None
                    elif here >= 0:
                        ready[here] = False
                        yield filled(batch, np.array([here]), np.zeros(1, np.int64), np.array([held_p]), True)
                    group, here = g, -1
                p, s = chance[i], float(sizes[i])
                if s <= 0 or p <= 0 or p >= 1:  # nothing to move
                    up[i] = int(p >= 1 or (s <= 0 and draw[i] < p))
                    continue
                if held is None and here < 0:
                    here, held_p, held_size = i, p, s
                    continue
                # Words that can move to the open row, and from it.
                to, fro = min((1 - held_p) * held_size, p * s), min(held_p * held_size, (1 - p) * s)
                if draw[i] * (to + fro) < fro:
                    a, b = held_p + to / held_size, p - to / s
                    first = (1 - held_p) * held_size <= p * s  # the open row is full, else the new one is empty
                    a, b = (1.0, b) if first else (a, 0.0)
                else:
                    a, b = held_p - fro / held_size, p + fro / s
                    first = held_p * held_size <= (1 - p) * s
                    a, b = (0.0, b) if first else (a, 1.0)
                if first:  # the open row is decided, the new one is open
                    if held is not None:
                        held_p = a
                        yield release(int(a))
                        held = None
                    else:
                        up[here] = int(a)
                    here, held_p, held_size = i, b, s
                else:
                    up[i], held_p = int(b), a
            if here >= 0:
                ready[here] = False
                held = batch.slice(here, 1)
            rows = np.flatnonzero(ready)
            if len(rows):
                yield filled(batch, rows, up[rows], np.zeros(len(rows)), False)
        if held is not None:
            yield release(None)
        held = None
        give_back()

    return work


def _level(rows: DataFrame) -> DataFrame:
    """One level of the tree.  Large rows go first, so that the one left open is small."""
    dealt = rows.repartition("__source", "__leaf").sortWithinPartitions(
        "__source", "__leaf", F.desc("size"), "__hash"
    )
    schema = T.StructType([*dealt.schema.fields, T.StructField("decided", T.BooleanType())])
    return dealt.mapInArrow(_rounded(dealt.schema), schema)


def mix(
    df: DataFrame,
    size,
    key: list[str],
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """The rows with ``size``, ``source_size``, ``target`` (their source's) and ``copies`` (0 to ``cap``).

    ``size`` is a column expression; ``key`` names the columns that tell rows
    apart and decide the draws: reruns over the same rows agree.  Rows that are
    the same in all of them are interchangeable.  Rows of size 0 move nothing;
    a null source is a source.  Columns named like a result are replaced.
    """
    spark = df.sparkSession
    small_batches(spark)
    results = ("size", "source_size", "target", "copies")
    base = df.withColumn("size", F.coalesce(size, F.lit(0)).cast("long")).drop("source_size", "target", "copies")
    targets = source_targets(base.select("source", "size"), weights, share, cap)
    leaves = F.greatest(F.ceil(F.col("n_rows") / LEAF_ROWS), F.lit(1)).cast("long")
    targets = targets.withColumn("__leaves", leaves).withColumnRenamed("source", "__of").drop("n_rows")
    most = targets.agg(F.max("__leaves")).first()[0] or 1
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        base.join(targets, F.col("source").eqNullSafe(F.col("__of")), "left")
        .withColumn("__hash", F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in key]))
        .withColumn("__source", F.xxhash64("source", F.lit(1)))
        .withColumn("__leaf", F.pmod("__hash", "__leaves"))
        .withColumn("copies", F.floor(ratio).cast("long"))
        .withColumn("__chance", ratio - F.floor(ratio))
        .drop("__of", "__leaves")
    )
    done = []
    while True:
        level = stored(spark, _level(rows), "mix-level")
        done.append(level.filter("decided"))
        rows = level.filter("not decided").drop("decided")
        if most == 1:
            break
        most = -(-most // FAN_IN)
        rows = rows.withColumn("__leaf", F.floor(F.col("__leaf") / FAN_IN))
    # One row of each source is still open: it is drawn alone.
    draw = F.pmod(F.xxhash64("__hash", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30)
    last = rows.withColumn("copies", F.col("copies") + (draw < F.col("__chance")).cast("long"))
    out = last
    for level in done:
        out = out.unionByName(level.drop("decided"))
    return out.select(*[f"`{c}`" for c in df.columns if c not in results], *results)
