"""Embedding near-dedup by an epsilon grid order join.

Unit vectors whose cosine is at least t lie within eps = sqrt(2 - 2t).  They are
projected on a few principal directions, which never lengthens a distance, and
sorted by their grid cells of side eps there.  The sorted sequence is cut into
blocks; intervals of blocks form a tree with the box of each interval.  The join
starts with each label's whole sequence and descends both sides, dropping pairs
of intervals whose boxes lie more than eps apart.  Block pairs that are left are
compared exactly in double precision.

Equal vectors are one vector with a count, so a group of copies costs nothing.
A block pair returns counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestead.llm.graph import connected_components
from lodestead.llm.text import stored

THRESHOLD = 0.93
DIRECTIONS, BLOCK, FAN_OUT_BITS = 8, 512, 3
#: The directions are fitted on at most so many vectors; they only steer what can be skipped.
SAMPLE = 20_000


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def principal_directions(vectors: DataFrame, sample: int = SAMPLE, k: int = DIRECTIONS) -> np.ndarray:
    """k orthonormal rows, fitted to a sample of ``embedding`` arrays; shorter vectors are padded with zeros."""
    chosen = vectors.orderBy("h1", "h2").limit(sample).select("embedding", F.lit(0).alias("one"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        size = max(map(len, pdf["embedding"]))
        units = np.zeros((len(pdf), size))
        for i, e in enumerate(pdf["embedding"]):
            units[i, : len(e)] = e
        units = _units(units)
        _, axes = np.linalg.eigh(units.T @ units - len(units) * np.outer(m := units.mean(axis=0), m))
        return pd.DataFrame({"axes": [np.ascontiguousarray(axes[:, ::-1][:, :k].T).tobytes()], "size": [size]})

    got = chosen.groupBy("one").applyInPandas(fit, "axes binary, size long").first()
    return np.frombuffer(got["axes"]).reshape(-1, got["size"]) if got else np.zeros((1, 1))


def _projected(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    n = min(units.shape[1], axes.shape[1])
    out = np.zeros((len(units), DIRECTIONS))
    out[:, : len(axes)] = units[:, :n] @ axes[:, :n].T
    return out


def _sorted_blocks(vectors: DataFrame, axes: np.ndarray, eps: float, block: int) -> DataFrame:
    """A row for each block of the sorted sequence: label, size, part and number, box, ids, counts and vectors."""
    cells = [f"c{i}" for i in range(DIRECTIONS)]

    def cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.assign(**{c: 0 for c in cells})
            for n in out["n"].unique():
                at = (out["n"] == n).to_numpy()
                grid = np.floor(_projected(_units(np.array(list(out.loc[at, "embedding"]), float)), axes) / eps)
                out.loc[at, cells] = grid.astype(int)
            yield out

    kept = "label long, n long, rep long, copies long, embedding array<double>"
    placed = vectors.select("label", "n", "rep", "copies", "embedding").mapInPandas(
        cell, kept + "".join(f", {c} long" for c in cells)
    )
    order = ["label", "n", *cells]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order, "rep")
    dealt = dealt.withColumn("part", F.spark_partition_id().cast("long")).select("part", *kept.replace(",", "").split()[::2])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, no = None, 0
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            runs = list(rest.groupby(["label", "n"], sort=False))
            blocks = []
            for k, (_, run) in enumerate(runs):
                whole = len(run) if k < len(runs) - 1 else len(run) - len(run) % block
                blocks += [run.iloc[i : min(i + block, whole)] for i in range(0, whole, block)]
                rest = run.iloc[whole:]
            made = [row(b, no + i) for i, b in enumerate(blocks)]
            no += len(blocks)
            if made:
                yield pd.DataFrame(made)
        if rest is not None and len(rest):
            yield pd.DataFrame([row(rest, no)])

    def row(run: pd.DataFrame, no: int) -> dict:
        vectors = np.array(list(run["embedding"]), float)
        places = _projected(_units(vectors), axes)
        box = {f"lo{i}": places[:, i].min() for i in range(DIRECTIONS)} | {f"hi{i}": places[:, i].max() for i in range(DIRECTIONS)}
        first = run.iloc[0]
        return {
            "label": int(first["label"]), "n": int(first["n"]), "part": int(first["part"]), "no": no,
            "ids": run["rep"].to_numpy(np.int64).tobytes(), "copies": run["copies"].to_numpy(np.int64).tobytes(),
            "vectors": vectors.tobytes(),
        } | box

    boxes = "".join(f", lo{i} double" for i in range(DIRECTIONS)) + "".join(f", hi{i} double" for i in range(DIRECTIONS))
    return dealt.mapInPandas(
        cut, "label long, n long, part long, no long, ids binary, copies binary, vectors binary" + boxes
    )


def _near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """(label, n, a, b) of block pairs, a <= b, whose boxes are within eps, found from the whole sequence down.

    The intervals of all levels are one small table, written once: a row for
    each block and the levels above it, without vectors.
    """
    names = [f"{e}{i}" for i in range(DIRECTIONS) for e in ("lo", "hi")]
    last = blocks.agg(F.max("seq")).first()[0] or 0
    levels = max(1, math.ceil(last.bit_length() / FAN_OUT_BITS))
    at = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    tree = (
        blocks.select("label", "n", "seq", *names, at)
        .groupBy("label", "n", "level", F.expr(f"shiftright(seq, {FAN_OUT_BITS} * level)").alias("node"))
        .agg(*[(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in names])
    )
    tree = stored(blocks.sparkSession, tree, "vector-tree")

    def nodes(level: int, side: str) -> DataFrame:
        own = tree.filter(F.col("level") == level)
        boxes = [F.col(c).alias(f"{side}_{c}") for c in names]
        return own.select(
            "label", "n", F.shiftright("node", FAN_OUT_BITS).alias(side), F.col("node").alias(f"{side}_node"), *boxes
        )

    pairs = nodes(levels, "a").select("label", "n", F.col("a_node").alias("a"), F.col("a_node").alias("b"))
    gap = lambda i: F.greatest(F.lit(0.0), F.col(f"b_lo{i}") - F.col(f"a_hi{i}"), F.col(f"a_lo{i}") - F.col(f"b_hi{i}"))
    apart = sum((gap(i) * gap(i) for i in range(DIRECTIONS)), F.lit(0.0))
    for level in reversed(range(levels)):
        pairs = (
            pairs.join(nodes(level, "a"), ["label", "n", "a"])
            .join(nodes(level, "b"), ["label", "n", "b"])
            .filter((F.col("a_node") <= F.col("b_node")) & (apart <= (eps * (1 + 1e-9) + 1e-12) ** 2))
            .select("label", "n", F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        )
    return pairs


def _compare(threshold: float):
    """Counts and a spanning forest of the links of block pairs."""

    def forest(links: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.iinfo(np.int64).max
        lx, ly = x.copy(), y.copy()
        while True:
            nx = np.minimum(lx, np.where(links, ly, far).min(axis=1, initial=far))
            ny = np.minimum(ly, np.where(links, nx[:, None], far).min(axis=0, initial=far))
            if (nx == lx).all() and (ny == ly).all():
                return lx, ly
            lx, ly = nx, ny

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                x, y = np.frombuffer(r.a_ids, np.int64), np.frombuffer(r.b_ids, np.int64)
                cx, cy = np.frombuffer(r.a_copies, np.int64), np.frombuffer(r.b_copies, np.int64)
                u = _units(np.frombuffer(r.a_vectors).reshape(len(x), -1))
                v = _units(np.frombuffer(r.b_vectors).reshape(len(y), -1))
                links = u @ v.T >= threshold
                if r.a == r.b:
                    np.fill_diagonal(links, False)
                if not links.any():
                    continue
                lx, ly = forest(links, x, y)
                out = [(x, links @ cy, lx)]
                if r.a != r.b:
                    out.append((y, cx @ links, ly))
                ids, counts, roots = (np.concatenate(z) for z in zip(*out))
                some = counts > 0
                yield pd.DataFrame({"id": ids[some], "links": counts[some], "root": roots[some]})

    return work


def near_duplicates(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Only vectors of equal label and length are compared.  Rows without key or
    label, and vectors that are null, empty, zero or hold null, infinite or NaN
    components, link with nothing: they have 0 links and are their own
    component (null without a key; such a row is kept).  Rows that share a key
    count as one node.  Every row that is linked counts, also copies.
    """
    spark = df.sparkSession
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = df.select(F.col(key).alias("vec_id"), F.col(label).cast("long").alias("label"), values.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    solid = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # Squares of very small or large numbers would vanish or overflow: the largest component is made 1.
    top = F.aggregate("embedding", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    rows = rows.withColumn("solid", solid)
    hashed = rows.withColumns({
        "h1": F.when(F.col("solid"), F.xxhash64("embedding")),
        "h2": F.when(F.col("solid"), F.xxhash64(F.lit(5), "embedding")),
    })
    classes = (
        hashed.filter("solid")
        .withColumn("top", top).withColumn("embedding", F.transform("embedding", lambda x: x / F.col("top")))
        .groupBy("label", "h1", "h2")
        .agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("n", F.size("embedding").cast("long"))
    )
    classes = stored(spark, classes, "vector-classes")
    axes = principal_directions(classes)
    blocks = stored(spark, _sorted_blocks(classes, axes, eps, block), "vector-blocks")
    # A place in the sequence: parts are ranges in order, each with room for the longest.
    room = ((blocks.agg(F.max("no")).first()[0] or 0) + 1).bit_length()
    blocks = blocks.withColumn("seq", F.shiftleft("part", room) + F.col("no"))
    pairs = _near_blocks(blocks, eps)
    for side in ("a", "b"):
        held = blocks.select(F.col("seq").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("ids", "copies", "vectors")])
        pairs = pairs.join(held, side)
    found = stored(spark, pairs.mapInPandas(_compare(threshold), "id long, links long, root long"), "vector-links")
    counts = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select(F.col("label").alias("l"), F.col("h1").alias("x1"), F.col("h2").alias("x2"), "rep", "copies")
        .join(counts, "rep", "left").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    )
    joined = hashed.select("vec_id", "label", "h1", "h2").join(
        known, (F.col("label") == F.col("l")) & (F.col("h1") == F.col("x1")) & (F.col("h2") == F.col("x2")), "left"
    )
    component = F.coalesce("component", "rep", "vec_id").cast("long")
    return joined.select(
        F.col("vec_id").alias(key),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
