"""Hard-negative mining with segment summaries.

Vectors are scaled to integers, so scores are exact inner products.  A vector
is cut into segments, and for each the mean and the deviation from it are kept.
In a segment of l components the inner product is l times the means' product,
give or take the product of the deviations (Cauchy and Schwarz), and the sum
over segments bounds the score from both sides.  Bounds are refined from a
block's box of summaries to a row's few long segments, to its many short ones,
and what is left is scored exactly.

The index is sorted by label and by the sum of the components, and cut into
blocks of one label and groups of bounded size.  A task holds a group and
streams anchors past it: first those that have rows of their own label there,
to find positives; then all, to find negatives within their positives' ranges.
The best of each group are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.llm.text import even_keys, small_batches, stored

POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
SCALE = 256
#: Scaled components are held within this, so that sums stay in 64 bits.
MOST = 1 << 24
#: Rows of a block and of a group; segments of the two levels of summaries.
BLOCK, GROUP, LEVELS = 128, 262_144, (4, 16)

INDEX = "grp long, blk int, label long, n int, ids binary, keys binary, anchors binary, vectors binary, summaries binary, box binary"


def _cuts(dims: int, segments: int) -> np.ndarray:
    """The first component of each segment; at most one segment a component."""
    return np.unique(np.linspace(0, dims, min(segments, dims), endpoint=False).astype(int))


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means times the root of the segment's length, and deviations, of each row and segment."""
    cuts = _cuts(vectors.shape[1], segments)
    sizes = np.diff(np.r_[cuts, vectors.shape[1]])
    exact = vectors.astype(float)
    means = np.add.reduceat(exact, cuts, axis=1) / sizes
    apart = exact - np.repeat(means, sizes, axis=1)
    deviations = np.sqrt(np.add.reduceat(apart * apart, cuts, axis=1))
    return means * np.sqrt(sizes), deviations


def _packed(vectors: np.ndarray) -> np.ndarray:
    """The summaries of all levels in one matrix."""
    return np.hstack([x for k in LEVELS for x in summaries(vectors, k)]).astype(np.float32)


def _matrix(column, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int32)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def prepared(df: DataFrame, anchors: Column, vector: str, key: str, label: str, scale: int) -> DataFrame:
    """(label, sum, id, key, anchor, v) of the rows that take part; ``key`` tells rows of one id apart."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    near = lambda x: F.greatest(F.least(x * F.lit(float(scale)), F.lit(float(MOST))), F.lit(float(-MOST)))
    whole = F.transform(values, lambda x: F.floor(near(x)).cast("int"))
    taken = df.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = taken.select(
        F.col(label).cast("long").alias("label"), F.col(key).cast("long").alias("id"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), whole.alias("v"),
    )
    total = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select("label", total.alias("sum"), "id", F.xxhash64("v").alias("key"), "anchor", "v")


def build_index(rows: DataFrame, group: int = GROUP, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Blocks (``INDEX``) of ``prepared`` rows, written once, and the number of components."""
    spark = rows.sparkSession
    n, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    dims = max(dims, 1)
    parts = max(-(-n // group), 2 * spark.sparkContext.defaultParallelism)
    order = ["label", "sum", "id", "key"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def made(grp: int, no: int, run: pd.DataFrame) -> dict:
        vectors = _matrix(run["v"], dims)
        packed = _packed(vectors)
        return {
            "grp": grp, "blk": no, "label": int(run["label"].iloc[0]), "n": len(run), "ids": run["id"].to_numpy(np.int64).tobytes(),
            "keys": run["key"].to_numpy(np.int64).tobytes(), "anchors": run["anchor"].to_numpy(bool).tobytes(),
            "vectors": vectors.tobytes(), "summaries": packed.tobytes(),
            "box": np.vstack([packed.min(axis=0), packed.max(axis=0)]).tobytes(),
        }

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, last, no, count, part = None, None, 0, 0, 0

        def cut(rows: pd.DataFrame, end: bool) -> tuple[list[pd.DataFrame], pd.DataFrame]:
            """Blocks of one label; an unfinished last one is kept for the next batch."""
            edges = np.flatnonzero(np.diff(rows["label"].to_numpy())) + 1
            edges = np.r_[0, edges, len(rows)]
            blocks = [rows.iloc[i : min(i + block, b)] for a, b in zip(edges[:-1], edges[1:]) for i in range(a, b, block)]
            if not end and blocks and len(blocks[-1]) < block:
                return blocks[:-1], blocks[-1]
            return blocks, rows.iloc[:0]

        def numbered(blocks: list[pd.DataFrame]) -> list[dict]:
            nonlocal no, count
            out = []
            for b in blocks:
                # A partition of more rows than a group is cut into several.
                out.append(made((part << 20) + count // group, no, b))
                no, count = no + 1, count + len(b)
            return out

        for batch in batches:
            part = int(batch["part"].iloc[0])
            # Equal rows are neighbours, also across batches.
            own = batch[["label", "id", "key"]].to_numpy()
            before = np.vstack([own[:1] - 1 if last is None else last, own[:-1]])
            last = own[-1:]
            batch = batch[(own != before).any(axis=1)]
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            blocks, rest = cut(rest, False)
            if blocks:
                yield pd.DataFrame(numbered(blocks))
        if rest is not None and len(rest):
            yield pd.DataFrame(numbered(cut(rest, True)[0]))

    return stored(spark, dealt.mapInPandas(work, INDEX), "negatives-index"), dims


class _Group:
    """The blocks of a group, with bounds from coarse to fine."""

    def __init__(self, blocks: list, dims: int):
        self.dims = dims
        self.labels = np.array([b.label for b in blocks], np.int64)
        self.ends = np.cumsum([int(b.n) for b in blocks])
        self.starts = self.ends - [int(b.n) for b in blocks]
        self.ids = np.concatenate([np.frombuffer(b.ids, np.int64) for b in blocks])
        self.keys = np.concatenate([np.frombuffer(b.keys, np.int64) for b in blocks])
        self.vectors = np.concatenate([np.frombuffer(b.vectors, np.int32) for b in blocks]).reshape(-1, dims)
        width = sum(2 * len(_cuts(dims, k)) for k in LEVELS)
        self.packed = np.concatenate([np.frombuffer(b.summaries, np.float32) for b in blocks]).reshape(-1, width)
        self.boxes = np.stack([np.frombuffer(b.box, np.float32).reshape(2, width) for b in blocks])
        self.norm = float(np.sqrt((self.vectors.astype(np.float32) ** 2).sum(axis=1, dtype=np.float64).max(initial=0)))
        self.largest = int(np.abs(self.vectors).max(initial=0))
        at, self.levels = 0, []
        for k in LEVELS:
            m = len(_cuts(dims, k))
            self.levels.append((slice(at, at + m), slice(at + m, at + 2 * m)))
            at += 2 * m

    def exact(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.largest * int(np.abs(q).max(initial=0)) * self.dims < 1 << 52:
            return (self.vectors[rows].astype(float) @ q.astype(float)).astype(np.int64)
        return self.vectors[rows].astype(np.int64) @ q.astype(np.int64)

    def visit(self, q: np.ndarray, wanted: np.ndarray, may_count, found) -> None:
        """Give ``found`` rows and scores of the wanted blocks, the most promising first, where ``may_count(low, high)`` holds."""
        blocks = np.flatnonzero(wanted)
        own = _packed(q[None])[0]
        slack = 0.5 + 4e-6 * self.norm * float(np.sqrt((q.astype(float) ** 2).sum()))
        m, d = self.levels[0]
        products = np.stack([self.boxes[blocks, 0, m] * own[m], self.boxes[blocks, 1, m] * own[m]])
        spread = self.boxes[blocks, 1, d] @ own[d] + slack
        low, high = products.min(axis=0).sum(axis=1) - spread, products.max(axis=0).sum(axis=1) + spread
        order = np.argsort(-high, kind="stable")
        blocks, low, high = blocks[order], low[order], high[order]
        at, step = 0, 1
        while at < len(blocks):
            some = slice(at, at + step)
            good = blocks[some][may_count(low[some], high[some])]
            at, step = at + step, min(2 * step, 256)
            if not len(good):
                continue
            sizes = self.ends[good] - self.starts[good]
            rows = np.repeat(self.starts[good] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            for m, d in self.levels:
                middle, apart = self.packed[rows, m] @ own[m], self.packed[rows, d] @ own[d] + slack
                rows = rows[may_count(middle - apart, middle + apart)]
            if len(rows):
                found(rows, self.exact(rows, q))

    def positives(self, q: np.ndarray, label: int, own_id: int, own_key: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def may_count(low, high):
            return high >= (best[1][-1] if len(best[1]) == most else -np.inf)

        def found(rows, scores):
            nonlocal best
            other = (self.ids[rows] != own_id) | (self.keys[rows] != own_key)
            best = self.first(np.r_[best[0], rows[other]], np.r_[best[1], scores[other]], most)

        self.visit(q, self.labels == label, may_count, found)
        return best

    def negatives(self, q: np.ndarray, label: int, tops: np.ndarray, low_pct: int, high_pct: int, most: int) -> list:
        """The best rows for each positive's score."""
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in tops]

        def may_count(low, high):
            out = np.zeros(len(high), bool)
            for top, (_, scores) in zip(tops, best):
                least = scores[-1] if len(scores) == most else low_pct * top / 100
                out |= (high >= least) & (low <= high_pct * top / 100)
            return out

        def found(rows, scores):
            for k, top in enumerate(tops):
                fits = (low_pct * top <= 100 * scores) & (100 * scores <= high_pct * top)
                best[k] = self.first(np.r_[best[k][0], rows[fits]], np.r_[best[k][1], scores[fits]], most)

        self.visit(q, self.labels != label, may_count, found)
        return best

    def first(self, rows: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.keys[rows], self.ids[rows], -scores))[:most]
        return rows[order], scores[order]


_BLOCKS = ["blk", "n", "ids", "keys", "vectors", "summaries", "box"]
_ANCHORS = {"anchor_id": "long", "anchor_key": "long", "q": "binary", "tops": "array<long>"}


def _streamed(index: DataFrame, asked: DataFrame, groups: int, dims: int, answer, schema: str) -> DataFrame:
    """``answer(group, anchor)`` for each row of ``asked`` (with ``grp`` and ``deal``), past its group's blocks."""
    kinds = dict(index.dtypes)
    blocks = index.select(
        "deal", "grp", "label", *_BLOCKS, F.lit(0).alias("kind"),
        *[F.lit(0 if t == "long" else None).cast(t).alias(c) for c, t in _ANCHORS.items()],
    )
    anchors = asked.select(
        "deal", "grp", "label", *[F.lit(0 if kinds[c] == "int" else None).cast(kinds[c]).alias(c) for c in _BLOCKS],
        F.lit(1).alias("kind"), *_ANCHORS,
    )
    dealt = blocks.unionByName(anchors).repartition(groups, "deal").drop("deal").sortWithinPartitions("grp", "kind", "blk")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, group = None, [], None
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.grp != at:
                    at, held, group = r.grp, [], None
                if r.kind == 0:
                    held.append(r)
                    continue
                if group is None:
                    group, held = _Group(held, dims), []
                out += answer(group, r)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return dealt.mapInPandas(work, schema)


def _anchors(index: DataFrame, dims: int) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                vectors = np.frombuffer(r.vectors, np.int32).reshape(-1, dims)
                ids, keys = np.frombuffer(r.ids, np.int64), np.frombuffer(r.keys, np.int64)
                for i in np.flatnonzero(np.frombuffer(r.anchors, bool)):
                    out.append((r.label, ids[i], keys[i], vectors[i].tobytes()))
            yield pd.DataFrame(out, columns=["label", "anchor_id", "anchor_key", "q"])

    return index.select("label", "ids", "keys", "anchors", "vectors").mapInPandas(
        work, "label long, anchor_id long, anchor_key long, q binary"
    )


def mine(
    df: DataFrame,
    anchors: Column,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    group: int = GROUP,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), for rows where ``anchors`` holds.

    Scores are inner products of floor(``scale`` * component).  A positive is
    one of the anchor's first other rows of its label; its negatives are the
    first rows of other labels that score from ``low`` to ``high`` percent of
    it.  Higher scores come first, ties by smaller key.  Rows without key or
    label, and vectors that are null or hold null, infinite or NaN components,
    take no part.  Shorter vectors count as if zeros followed.  Rows that are
    equal in all of these count once; rows that share only the key are rows of
    their own.  Scaled components beyond +-2^24 count as that.  Labels are
    integers.  Other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    index, dims = build_index(prepared(df, anchors, vector, key, label, scale), group)
    asked = stored(spark, _anchors(index, dims), "negatives-anchors")
    groups = [r[0] for r in index.select("grp").distinct().collect()] or [0]  # one number for each group
    dealt = list(zip(groups, even_keys(spark, len(groups))))
    index = index.join(F.broadcast(spark.createDataFrame(dealt, "grp long, deal long")), "grp")
    every = F.array(*[F.struct(F.lit(g).cast("long").alias("grp"), F.lit(k).cast("long").alias("deal")) for g, k in dealt])
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "other_id", "other_key"))

    def nearest(group: _Group, r) -> list:
        rows, scores = group.positives(np.frombuffer(r.q, np.int32), r.label, r.anchor_id, r.anchor_key, positives)
        return [(r.anchor_id, r.anchor_key, i, k, s) for i, k, s in zip(group.ids[rows], group.keys[rows], scores)]

    near = _streamed(
        index, asked.join(index.select("deal", "grp", "label").distinct(), "label").withColumn("tops", F.lit(None).cast("array<long>")),
        len(groups), dims, nearest, "anchor_id long, anchor_key long, other_id long, other_key long, score long",
    )
    own = ["anchor_id", "anchor_key"]
    best = near.withColumn("no", place(*own)).filter(F.col("no") <= positives)
    best = stored(spark, best.select(*own, "no", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    tops = best.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("no", "positive_score"))).alias("t"))

    def hardest(group: _Group, r) -> list:
        found = group.negatives(np.frombuffer(r.q, np.int32), r.label, np.asarray(r.tops, np.int64), low, high, negatives)
        return [
            (r.anchor_id, r.anchor_key, no + 1, i, k, s)
            for no, (rows, scores) in enumerate(found) for i, k, s in zip(group.ids[rows], group.keys[rows], scores)
        ]

    far = _streamed(
        index,
        asked.join(tops, own).withColumn("tops", F.col("t.positive_score")).select("*", F.explode(every).alias("e")).select("*", "e.*"),
        len(groups), dims, hardest, "anchor_id long, anchor_key long, no int, other_id long, other_key long, score long",
    )
    ranked = far.withColumn("rank", place(*own, "no")).filter(F.col("rank") <= negatives)
    return ranked.join(best, [*own, "no"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
