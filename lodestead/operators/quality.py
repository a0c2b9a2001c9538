"""Run counters, value counts, profiles, exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from lodestead.session import written_once


def counted(df: DataFrame, name: str, counters: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Attach counters that are filled while the frame is written, without a second pass.

    Each counter is a condition; ``rows`` is always counted.
    """
    observation = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counters.items()]]
    return df.observe(observation, *metrics), observation


def run_counters(df: DataFrame, counters: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """The same counters as a table, optionally per group."""
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counters.items()]]
    return df.groupBy(*by).agg(*metrics)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Most frequent values; ties in value order."""
    return df.groupBy(column).count().orderBy(F.desc("count"), column).limit(n)


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-null rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("type"), F.col("_rows").alias("rows"),
            F.col(f"_n{i}").alias("non_null"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def column_summary(df: DataFrame, columns: Sequence[str], quartiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles, maximum per numeric column."""
    asks = {}
    for i, c in enumerate(columns):
        asks |= {
            f"count{i}": F.count(c), f"mean{i}": F.avg(c).cast("double"), f"std{i}": F.stddev_samp(c),
            f"min{i}": F.min(c).cast("double"), f"max{i}": F.max(c).cast("double"),
        }
    cuts, found = quantiles_and(df, columns, quartiles, [a.alias(n) for n, a in asks.items()])
    names = [f"q{round(q * 100)}" for q in quartiles]
    rows = [
        (c, found[f"count{i}"], found[f"mean{i}"], found[f"std{i}"], found[f"min{i}"],
         *[None if cuts[c][q] is None else float(cuts[c][q]) for q in quartiles], found[f"max{i}"])
        for i, c in enumerate(columns)
    ]
    schema = f"column string, count bigint, mean double, std double, min double, {''.join(f'{n} double, ' for n in names)}max double"
    return df.sparkSession.createDataFrame(rows, schema)


# --- exact quantiles -------------------------------------------------------

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


@dataclass
class _Wanted:
    """A quantile of a column: the two 0-based ranks it lies between, and a bracket of values that holds them."""

    column: str
    p: float
    whole: bool
    ranks: tuple[int, int]
    bracket: tuple | None = None
    below: int = 0

    def value(self) -> Column:
        if self.whole:
            return F.col(self.column).cast("bigint")
        return F.nanvl(F.col(self.column).cast("double"), F.lit(None).cast("double"))

    def within(self) -> Column:
        value = self.value()
        if self.bracket is None:
            return value.isNotNull()
        return value.between(*[F.lit(b) for b in self.bracket])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 2_000, max_values: int = 5_000
) -> dict[str, dict[float, float | int | None]]:
    """Exact interpolated quantiles of several columns without a sort, in three scans at most.

    A built-in exact percentile keeps every distinct value in one task.  Here
    mergeable sketches of all columns bracket each wanted rank in one scan, a
    second one counts what lies below the brackets, and a third one counts the
    values inside, about 4 / ``accuracy`` of the rows.  If these are more than
    ``max_values`` they are put in order by ranges, and only the range that
    holds a rank reaches the driver.  Null and NaN do not count.  Whole numbers
    stay whole, also above 2 ** 53; other numbers are taken as doubles.
    """
    return quantiles_and(df, columns, probabilities, [], accuracy, max_values)[0]


def quantiles_and(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], aggregates: Sequence[Column],
    accuracy: int = 2_000, max_values: int = 5_000,
) -> tuple[dict[str, dict[float, float | int | None]], Row]:
    """:func:`exact_quantiles`, and other aggregates that come with its first scan."""
    whole = {c: isinstance(df.schema[c].dataType, _WHOLE) for c in columns}
    slack = 2.0 / accuracy
    shares = [x for p in probabilities for x in (max(0.0, p - slack), min(1.0, p + slack))]
    # Rank error of a sketch of size k: about 2.3 / k ** 0.97.
    size = max(8, min(65_535, math.ceil((2.3 * accuracy) ** (1 / 0.97))))
    asks = []
    for i, c in enumerate(columns):
        value = _Wanted(c, 0.0, whole[c], (0, 0)).value()
        sketch, quantile = (
            (F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint) if whole[c]
            else (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double)
        )
        ranks = F.array(*[F.lit(x) for x in shares])
        asks += [F.count(value).alias(f"_n{i}"), F.when(F.count(value) > 0, quantile(sketch(value, size), ranks)).alias(f"_q{i}")]
    first = df.agg(*asks, *aggregates).first()
    counts = {c: first[f"_n{i}"] for i, c in enumerate(columns)}
    wanted = []
    for i, c in enumerate(columns):
        for j, p in enumerate(probabilities if counts[c] else []):
            at = p * (counts[c] - 1)
            bracket = tuple(first[f"_q{i}"][2 * j : 2 * j + 2]) if counts[c] > max_values else None
            wanted.append(_Wanted(c, p, whole[c], (math.floor(at), math.ceil(at)), bracket))
    out: dict[str, dict[float, float | int | None]] = {c: {p: None for p in probabilities} for c in columns}
    inside = _measure(df, wanted, counts)
    for w, (low, high) in zip(wanted, _at_ranks(df, wanted, inside, max_values)):
        weight = Fraction(w.p * (counts[w.column] - 1)) - w.ranks[0]
        between = low + (high - low) * (weight if w.whole else float(weight))
        out[w.column][w.p] = int(between) if w.whole and between == int(between) else float(between)
    return out, first


def _measure(df: DataFrame, wanted: list[_Wanted], counts: Mapping[str, int]) -> list[int]:
    """Count the values below and inside each bracket; a bracket that misses its ranks is given up."""
    cut = [w for w in wanted if w.bracket is not None]
    inside = {id(w): counts[w.column] for w in wanted}
    if cut:
        asks = []
        for i, w in enumerate(cut):
            asks += [F.count_if(w.value() < F.lit(w.bracket[0])).alias(f"b{i}"), F.count_if(w.within()).alias(f"i{i}")]
        row = df.agg(*asks).first()
        for i, w in enumerate(cut):
            if row[f"b{i}"] <= w.ranks[0] and w.ranks[1] < row[f"b{i}"] + row[f"i{i}"]:
                w.below, inside[id(w)] = row[f"b{i}"], row[f"i{i}"]
            else:
                w.bracket = None
    return [inside[id(w)] for w in wanted]


def _at_ranks(df: DataFrame, wanted: list[_Wanted], inside: list[int], max_values: int) -> list[tuple]:
    """The two values at each one's ranks, from the counts of the values inside its bracket."""
    if not wanted:
        return []
    none = {"whole": F.lit(None).cast("bigint"), "number": F.lit(None).cast("double")}
    hits = []
    for i, w in enumerate(wanted):
        fields = none | {"whole" if w.whole else "number": w.value()}
        hits.append(F.when(w.within(), F.struct(F.lit(i).alias("i"), *[v.alias(k) for k, v in fields.items()])))
    # Few rows fall into any bracket: drop the others before the list is built.
    rows = df.filter(reduce(or_, [w.within() for w in wanted])).select(F.explode(F.array(*hits)).alias("h")).filter("h is not null")
    values = rows.groupBy("h.i", "h.whole", "h.number").agg(F.count("*").alias("n"))
    if sum(inside) > max_values:
        values, before = _ranges_with_ranks(values, wanted, max_values)
    else:
        before = [w.below for w in wanted]
    found: list[list] = [[] for _ in wanted]
    for r in values.collect():
        found[r["i"]].append((r["whole"] if wanted[r["i"]].whole else r["number"], r["n"]))
    out = []
    for w, start, pairs in zip(wanted, before, found):
        picked = []
        for value, n in sorted(pairs):
            picked += [value for rank in dict.fromkeys(w.ranks) if start <= rank < start + n]
            start += n
        out.append((picked[0], picked[-1]))
    return out


def _ranges_with_ranks(values: DataFrame, wanted: list[_Wanted], max_values: int) -> tuple[DataFrame, list[int]]:
    """The values of the ranges that hold wanted ranks, and the rank at which the first of them begins."""
    values = written_once(values, "quantile-values")
    order = ["i", "whole", "number"]
    parts = values.count() // max_values + 1
    ranged = written_once(values.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "quantile-ranges")
    totals = sorted(map(tuple, ranged.groupBy("i", "part").agg(F.sum("n")).collect()))  # a row for each range and quantile
    keep, before = [], []
    for i, w in enumerate(wanted):
        start, begin = w.below, None
        for _, part, n in (t for t in totals if t[0] == i):
            if any(start <= rank < start + n for rank in w.ranks):
                keep.append((i, part))
                begin = start if begin is None else begin
            start += n
        before.append(begin)
    chosen = ranged.sparkSession.createDataFrame(keep, "i int, part int")
    return ranged.join(F.broadcast(chosen), ["i", "part"], "left_semi"), before  # two ranges for each quantile at most
