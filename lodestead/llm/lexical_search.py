"""Ranked lexical search over a length-stratified index.

A score depends on a document only through its term frequencies and its length
normaliser m, an integer.  Documents of one m form a stratum, which is cut into
cells of bounded size.  A cell keeps, for each of its terms, the documents in
order of falling term frequency; the impact of a frequency is computed once for
each run of equal ones, since m is common to all.  A term's first impact in a
cell bounds what it can add there, so a query visits the cells by the sum of
its terms' bounds and ends where the next one lies below its last place.

Documents are dealt evenly over shards.  A task holds one shard's cells and
streams all queries past them, so memory does not depend on their number; the
best of each shard are merged by rank.  All arithmetic but the weights'
logarithm is in integers.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.llm.text import encoded, even_keys, small_batches, stored

TOP, K1, B = 20, 12, 25
#: Documents of a cell and of a shard; a query's terms that are known to every task at most.
CELL, SHARD, VOCABULARY = 512, 65_536, 200_000
#: A document without an id has this number among the others, which puts it last.
NO_ID = np.iinfo(np.int64).max

_ALNUM = (string.ascii_letters + string.digits).encode()
_TABLE = bytes(b if b >= 128 or b in _ALNUM else 32 for b in range(256)).lower()

INDEX = "shard long, m long, ids binary, terms array<string>, ends binary, docs binary, impacts binary"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all other than ASCII characters; A-Z in lower case."""
    return text.translate(_TABLE).split()


def term_counts(docs: DataFrame, vocabulary: frozenset[bytes] | None = None) -> DataFrame:
    """(doc_id, n, terms, tfs) of each row of (doc_id, text): all its terms counted, and the frequencies of known ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in encoded(batch.column(1).to_pylist()):
                found = terms_of(text)
                sizes.append(len(found))
                counts = Counter(found if vocabulary is None else filter(vocabulary.__contains__, found))
                terms += counts.keys()
                tfs += counts.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, n long, terms array<string>, tfs array<long>"
    )


def _cell(shard: int, m: int, ids: list, terms: list, tfs: list) -> dict:
    """One stratum's piece: postings of each term by falling frequency, as places among ``ids`` and their impacts."""
    sizes = [len(t) for t in terms]
    place = np.repeat(np.arange(len(ids)), sizes)
    names, code = np.unique(np.array([x for t in terms for x in t], object), return_inverse=True)
    tf = np.concatenate(tfs)
    order = np.lexsort((place, -tf, code))
    place, tf, code = place[order], tf[order], code[order]
    first = np.flatnonzero(np.r_[True, (tf[1:] != tf[:-1]) | (code[1:] != code[:-1])])
    run = tf[first]  # one impact for each run of equal frequencies
    impact = np.repeat((1_000_000_000 * run) // (1000 * run + K1 * m), np.diff(np.r_[first, len(tf)]))
    return {
        "shard": shard, "m": m, "ids": np.array(ids, np.int64).tobytes(), "terms": names.tolist(),
        "ends": np.r_[np.flatnonzero(code[1:] != code[:-1]) + 1, len(code)].astype(np.int32).tobytes(),
        "docs": place.astype(np.int32).tobytes(), "impacts": impact.astype(np.int64).tobytes(),
    }


def build_index(counts: DataFrame, documents: int, all_terms: int, shard_rows: int = SHARD) -> DataFrame:
    """Cells (``INDEX``) of the rows of ``term_counts`` that hold a known term."""
    spark = counts.sparkSession
    m = F.lit(100 - B) + F.expr(f"({B} * n * {documents}) div {max(all_terms, 1)}")
    shards = max(-(-documents // shard_rows), spark.sparkContext.defaultParallelism)
    rows = (
        counts.filter(F.size("terms") > 0).select(m.alias("m"), F.coalesce("doc_id", F.lit(int(NO_ID))).alias("doc_id"), "terms", "tfs")
        .repartition(shards).sortWithinPartitions("m", "doc_id").withColumn("shard", F.spark_partition_id().cast("long"))
        .select("shard", "m", "doc_id", "terms", "tfs")
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, ([], [], [])
        for batch in batches:
            out = []
            for shard, m, *row in batch.itertuples(index=False):
                if at and (at != (shard, m) or len(held[0]) == CELL):
                    out.append(_cell(*at, *held))
                    held = ([], [], [])
                at = shard, m
                for values, value in zip(held, row):
                    values.append(value)
            yield pd.DataFrame(out, columns=_names())
        if held[0]:
            yield pd.DataFrame([_cell(*at, *held)], columns=_names())

    return rows.mapInPandas(work, INDEX)


def _names() -> list[str]:
    return [c.split()[0] for c in INDEX.split(", ")]


def weight(documents: int, df: Column) -> Column:
    """A term's weight by the documents that hold it."""
    return F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2.0 * df + 1))).cast("long")


class _Shard:
    """The cells of a shard, and for each term its postings in them."""

    def __init__(self, cells: list):
        self.ids = [np.frombuffer(c.ids, np.int64) for c in cells]
        self.docs = [np.frombuffer(c.docs, np.int32) for c in cells]
        self.impacts = [np.frombuffer(c.impacts, np.int64) for c in cells]
        found: dict[str, list] = {}
        for i, c in enumerate(cells):
            ends = np.frombuffer(c.ends, np.int32).tolist()
            for term, a, b in zip(c.terms, [0, *ends], ends):
                found.setdefault(term, []).append((i, a, b, self.impacts[i][a]))
        self.found = {term: np.array(rows, np.int64) for term, rows in found.items()}

    def best(self, terms: list[str], weights: list[int], top: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``top`` best documents, best first; equal scores by id."""
        known = [(self.found[t], int(w)) for t, w in zip(terms, weights) if w > 0 and t in self.found]
        ids = scores = np.zeros(0, np.int64)
        bound = np.zeros(len(self.ids), np.int64)
        slot = np.full((len(known), len(self.ids)), -1, np.int32)
        for k, (rows, w) in enumerate(known):
            bound[rows[:, 0]] += w * rows[:, 3]
            slot[k, rows[:, 0]] = np.arange(len(rows))
        for c in np.argsort(-bound, kind="stable"):
            least = scores[-1] if len(scores) == top else 1
            if bound[c] < least:
                break
            got = np.zeros(len(self.ids[c]), np.int64)
            for k in np.flatnonzero(slot[:, c] >= 0):
                rows, w = known[k]
                _, a, b, _ = rows[slot[k, c]]
                got[self.docs[c][a:b]] += w * self.impacts[c][a:b]
            good = np.flatnonzero(got >= least)
            ids, scores = np.r_[ids, self.ids[c][good]], np.r_[scores, got[good]]
            order = np.lexsort((ids, -scores))[:top]
            ids, scores = ids[order], scores[order]
        return ids, scores


def rank(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, h, doc_id, score, rank) for each row (item_id, h, terms, weights) of ``queries``, against all cells."""
    shards = [r[0] for r in index.select("shard").distinct().collect()] or [0]  # one number for each task
    key = dict(zip(shards, even_keys(index.sparkSession, len(shards))))
    dealt_by = F.get(F.array(*[F.lit(key.get(s)) for s in range(max(shards) + 1)]), F.col("shard").cast("int"))
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
    cells = index.select("*", F.lit(0).alias("kind"), *none("string", "item_id", "h"), *none("array<long>", "weights"))
    asked = queries.select(
        F.explode(F.array(*[F.lit(s) for s in shards])).alias("shard"), *none("long", "m"),
        *none("binary", "ids", "ends", "docs", "impacts"), "terms", F.lit(1).alias("kind"),
        *[F.col(c).cast("string").alias(c) for c in ("item_id", "h")], "weights",  # text, since pandas has no null among integers
    )
    dealt = cells.unionByName(asked).withColumn("deal", dealt_by).repartition(len(shards), "deal").drop("deal")
    dealt = dealt.sortWithinPartitions("shard", "kind", "m")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, shard = None, [], None
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.shard != at:
                    at, held, shard = r.shard, [], None
                if r.kind == 0:
                    held.append(r)
                    continue
                if shard is None:
                    shard, held = _Shard(held), []
                ids, scores = shard.best(r.terms, r.weights, top)
                out.append(pd.DataFrame({"item_id": r.item_id, "h": r.h, "doc_id": ids, "score": scores}))
            if out:
                yield pd.concat(out, ignore_index=True)

    found = dealt.mapInPandas(work, "item_id string, h string, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item_id", "h").orderBy(F.desc("score"), "doc_id"))
    return (
        found.withColumn("rank", place).filter(F.col("rank") <= top)
        .withColumn("doc_id", F.when(F.col("doc_id") < int(NO_ID), F.col("doc_id")))
        .withColumns({"item_id": F.col("item_id").cast("long"), "h": F.col("h").cast("long")})
    )


def search(docs: DataFrame, items: DataFrame, top: int = TOP, vocabulary: int = VOCABULARY, shard_rows: int = SHARD) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of (doc_id, text) for each row of (item_id, text).

    Only documents with a score above 0; equal scores by ascending doc_id, and
    documents without one last.  Null, empty and blank texts have no term and
    no rank, and count nowhere; every other row is a document, also if it
    repeats another or has no id.  Items that are equal in id and text are one;
    items that share only the id are ranked apart.  Other columns are not read.

    If all items together have at most ``vocabulary`` different terms, only
    their postings are kept, else those of all terms.
    """
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("h"), "text").distinct()
    wanted = term_counts(asked.select(F.col("item_id").alias("doc_id"), "text")).select("doc_id", "terms", "tfs")
    words = wanted.select(F.explode("terms").alias("term")).distinct().limit(vocabulary + 1).collect()
    known = frozenset(r["term"].encode() for r in words) if len(words) <= vocabulary else None
    counts = stored(spark, term_counts(docs, known).filter("n > 0"), "search-counts")
    documents, all_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    spread = asked.transform(_item_terms).join(held, "term")
    queries = spread.groupBy("item_id", "h").agg(
        F.collect_list(F.struct("term", (F.col("tf") * weight(documents, F.col("df"))).alias("w"))).alias("t")
    )
    queries = queries.select("item_id", "h", F.col("t.term").alias("terms"), F.col("t.w").alias("weights"))
    index = stored(spark, build_index(counts, documents, all_terms, shard_rows), "search-index")
    return rank(index, queries, top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, h, term, tf) of items' texts."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (i, h, term.decode(), tf)
                for i, h, text in zip(batch["item_id"], batch["h"], encoded(batch["text"]))
                for term, tf in Counter(terms_of(text)).items()
            ]
            yield pd.DataFrame(rows, columns=["item_id", "h", "term", "tf"])

    named = items.withColumn("item_id", F.col("item_id").cast("string")).select("item_id", "h", "text")
    found = named.mapInPandas(work, "item_id string, h long, term string, tf long")
    return found.withColumn("item_id", F.col("item_id").cast("long"))
