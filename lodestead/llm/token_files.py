"""Token ids as ORC files: encoded, ordered by document, written in stripes and read back.

A file row is a document: its id, its place (``rng``, ``pos``) and its token
ids.  Rows ascend by document id through the files in order of their names.
ORC writes integers run-length encoded, keeps least and greatest ids for every
stripe and every ``ROW_STRIDE`` rows, and a Bloom filter over document ids for
the same rows.  Stripes are read in parallel, and a filter on ids skips stripes
and row groups by this metadata (``read_documents``).

Encoding equals the tokenizers library's.  The vocabulary drops white space and
no token of it crosses ASCII white space, so texts are cut there and each
different piece is encoded once in a worker, as long as it is remembered; ids
are then gathered for whole batches.  Texts that hold a special token's string
go to the library whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestead.llm.text import chunks, small_batches, stored

END_ID = 2
#: Rows between two index entries of a file, bytes of a stripe and share of false positives of its Bloom filters.
ROW_STRIDE, STRIPE_BYTES, FALSE_POSITIVES = 1000, 16 << 20, 0.01
#: A stripe is closed at one of so many rows: long documents must not pile up.
CHECKED_ROWS = 100
#: Different pieces that a worker remembers, and bytes of text that are gathered at once.
CACHED, CHUNK = 600_000, 4_000_000
#: Fixed value: the mark of a token that ends a word.
WORD_END = "</w>"

#: A piece of these bytes only is cut further where letters, digits and signs meet; apostrophes begin tokens of two letters.
_PLAIN = re.compile(rb"[!-&(-~]+")
_PARTS = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")

_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts as one array with an end for each text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        #: Place of each remembered piece; ``flat[starts[i] : starts[i + 1]]`` are its ids, ``uses`` how often it was met.
        self.known: dict[bytes, int] = {}
        self.starts, self.flat, self.uses = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def whole(self, texts: list[bytes]) -> list[list[int]]:
        found = self.library.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [e.ids for e in found]

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by place, and the end of each."""
        begin, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], ends

    def remember(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.starts = np.concatenate([self.starts, len(self.flat) + ends])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int64)])

    def forget(self) -> None:
        """Keep the pieces that were met most, at most half of them."""
        kept = self.uses > max(1, np.median(self.uses))
        pieces = [p for p, k in zip(self.known, kept.tolist()) if k]
        ids, ends = self.gather(np.flatnonzero(kept))
        self.known, self.starts, self.flat, self.uses = {}, self.starts[:1], ids[:0], self.uses[:0]
        self.remember(pieces, ids, ends)

    def learn_words(self, words: list[bytes]) -> None:
        """Pieces of letters, of signs or of one digit: each is one word of the library, so many are encoded as one text."""
        for a in range(0, len(words), 2000):
            part = words[a : a + 2000]
            ids = np.array(self.whole([b" ".join(part)])[0], np.int64)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(part):
                self.remember(part, ids, ends)
            else:
                self.learn_others(part)

    def learn_others(self, pieces: list[bytes]) -> None:
        ids = self.whole(pieces)
        self.remember(pieces, np.array([i for x in ids for i in x], np.int64), np.cumsum([len(x) for x in ids], dtype=np.int64))

    def learn(self, pieces: list[bytes]) -> None:
        words, others, compound, parts = [], [], [], []
        for p in pieces:
            if p.isalpha():
                words.append(p)
            elif _PLAIN.fullmatch(p):
                compound.append(p)
                parts.append(_PARTS.findall(p))
            elif p.decode("utf-8", "replace").isalpha():
                words.append(p)
            else:
                others.append(p)
        own = set(words)
        single = {x for found in parts for x in found if x not in self.known and x not in own}
        compound_of = [(p, found) for p, found in zip(compound, parts) if p not in single]
        self.learn_words([*words, *single])
        if others:
            self.learn_others(others)
        if compound_of:
            at = np.fromiter((self.known[x] for _, found in compound_of for x in found), np.int64)
            ids, ends = self.gather(at)
            last = np.cumsum([len(found) for _, found in compound_of]) - 1
            self.remember([p for p, _ in compound_of], ids, ends[last])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the end of each text's ids; a null text has none."""
        if len(self.known) > CACHED:
            self.forget()
        texts = texts.fill_null("")
        special = np.zeros(len(texts), bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            new = [words[i] for i in unknown]
            self.learn(new)
            at[unknown] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        codes = coded.indices.to_numpy()
        self.uses[at] += np.bincount(codes, minlength=len(at))
        ids, ends = self.gather(at[codes])
        text_ends = np.r_[0, ends][pieces.offsets.to_numpy()[1:] - pieces.offsets[0].as_py()]
        if not special.any():
            return ids, text_ends
        own = [
            np.array(self.whole([t.as_py().encode()])[0], np.int32) if whole else part
            for t, whole, part in zip(texts, special, np.split(ids, text_ends[:-1]))
        ]
        return np.concatenate(own), np.cumsum([len(x) for x in own])


def _encoder(path: str) -> Encoder:
    """One for each worker, kept between its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id behind each text's ids."""
    ends = ends + np.arange(1, len(ends) + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int32)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = ids
    return out, ends


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, rng, pos) of (doc_id, text), in ascending order of doc_id over the ranges ``rng`` and inside them.

    A range is a partition.  Ids that many rows share are cut by text and by
    the input's partition, so that they do not fall into one range.
    """
    small_batches(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_last(), "h", "part"]
    rows = docs.withColumn("h", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("rng"), "doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pos = _encoder(tokenizer), 0
        for batch in batches:
            texts = batch.column(2)
            for a, b in chunks(pc.binary_length(texts).fill_null(0).to_pylist(), CHUNK):
                ids, ends = _with_end(*encoder.encode(texts.slice(a, b - a)), end_id)
                ends = pa.array(np.concatenate([[0], ends]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32()))
                places = pa.array(np.arange(pos, pos + b - a), pa.int64())
                pos += b - a
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), places, part.column(1), lists], ["rng", "pos", "doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(work, f"rng int, pos long, doc_id {kind}, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of every text of (doc_id, text) as ORC files below ``path``.

    A null text is empty; it has the end id only.  Rows without a doc_id come
    last, rows that share one stand together, repeated rows stay repeated.
    Other columns are not read.  An empty table makes an empty set of files.
    """
    (
        encode(docs.select("doc_id", "text"), tokenizer, end_id)
        .write.option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.row.index.stride", str(ROW_STRIDE))
        .option("orc.rows.between.memory.checks", str(CHECKED_ROWS)).option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(FALSE_POSITIVES)).option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, key_type: str = "long") -> DataFrame:
    """(rng, pos, doc_id, ids) of files that ``write_tokens`` has written."""
    return spark.read.schema(f"rng int, pos long, doc_id {key_type}, ids array<int>").orc(path)


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; least and greatest ids and Bloom filters skip stripes and row groups."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def document_starts(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files' rows.

    ``start`` counts the ids of all documents before.  Sums run inside ranges,
    and the ranges' totals (one number each) are summed on the driver.
    """
    spark = tokens.sparkSession
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            data = lists.values.to_numpy().astype("<i4", copy=False).view(np.uint8)
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())],
                ["rng", "pos", "doc_id", "n_tokens", "ids_crc32"],
            )

    counted = tokens.select("rng", "pos", "doc_id", "ids").mapInArrow(
        work, f"rng int, pos long, doc_id {kind}, n_tokens long, ids_crc32 long"
    )
    counted = stored(spark, counted, "token-counts")
    offsets, total = [], 0
    for r in sorted(counted.groupBy("rng").agg(F.sum("n_tokens").alias("n")).collect()):
        offsets.append((r["rng"], total))
        total += r["n"]
    before = F.sum("n_tokens").over(Window.partitionBy("rng").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    bases = F.broadcast(spark.createDataFrame(offsets, "rng int, base long"))  # a row for each file
    return (
        counted.withColumn("before", F.coalesce(before, F.lit(0))).join(bases, "rng")
        .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_table(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files below ``path`` and return ``document_starts`` of what is read back."""
    write_tokens(docs, path, tokenizer, end_id)
    return document_starts(read_tokens(docs.sparkSession, path, docs.schema["doc_id"].dataType.simpleString()))
