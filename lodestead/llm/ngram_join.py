"""N-gram Jaccard join by parity sketches.

A document's set are its distinct word shingles.  The parity sketch of a set is
an array of 64-bit words: a shingle belongs to one word by its hash and flips
bits there.  A shingle that only one of two sets has changes at most one word,
so sets that differ in at most D shingles agree in all but D words.  With
more words than that, taken in an order that depends on their content only, the
first D + 1 of both sides have one in common (pigeonhole and prefix); fuller
words go first, because they are shared by chance least.  D follows from the
sizes: bands of sizes have one number of words each, and sets near a band's
lower end join the band below as well.

Sets that share a word meet in a bucket.  In the words that make them meet a
shingle flips the bits of a hash, so that unlike sets do not meet by chance; in
the sketches that are compared afterwards it flips one bit, so that their
Hamming distance is a lower bound of the difference.  First each member of a
bucket is paired with the one of the least id.  Pairs whose whole sketches are
nearer than the sizes allow are verified on their texts, and links make
components.  In buckets that still hold several components, the pairs across
components are compared by their sketches, block by block inside tasks.  Of two
components the nearest few pairs are verified first, and more only where these
have not linked them, so that a large group of near copies is never paired as a
whole.  In the end every pair that shares a bucket is verified, connected or
too far apart.  Equal sets are one class from the start, and a map task sends
one row for each word of its distinct texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestead.llm.graph import connected_components
from lodestead.llm.text import chunks, encoded, give_back, mix, small_batches, stored

WORDS, PERCENT = 4, 85
BAND = 1.2
SLACK = 1.25
CHUNK = 1_000_000
CACHED = 50_000
#: Members of a bucket that one task compares with each other; larger buckets are cut into pairs of blocks.
BLOCK = 1024
#: Bits of the sketch that is compared, for each shingle of the largest set of its band, and least words.
SKETCH_BITS, LEAST_WORDS = 1, 16
#: Pairs of two components that a block gives in the first round; eight times as many in each that follows.
NEAREST = 32
#: Bits of the filter that picks out the texts to verify.
FILTER_BITS = 23

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class _Hashes(dict):
    """64-bit hash of a word; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


class Shingler:
    """Distinct shingle hashes of texts: ASCII letters in lower case, runs of other than ASCII white space."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.hashes = _Hashes()
        steps = mix(np.arange(1, words + 1, dtype=np.uint64) * _FACTORS[0])
        self.factors = steps | np.uint64(1)

    def shingles(self, text: bytes) -> np.ndarray:
        found = text.lower().split()
        n, k = len(found), self.words
        if not n:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, found), np.uint64, n)
        with np.errstate(over="ignore"):
            if n < k:
                return mix((h * self.factors[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
            total = h[: n - k + 1] * self.factors[0]
            for i in range(1, k):
                total = total + h[i : n - k + 1 + i] * self.factors[i]
        return np.unique(mix(total))


class Bands:
    """Bands of set sizes for a least similarity in percent."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.low = [1]

    def of(self, n: int) -> int:
        while self.low[-1] <= n:  # wide enough that partners stand in neighbouring bands
            self.low.append(max(self.low[-1] + 1, math.ceil(self.low[-1] * max(BAND, 100 / self.percent))))
        return int(np.searchsorted(self.low, n, side="right")) - 1

    def joins(self, n: int) -> list[int]:
        """The bands a set of n shingles joins: its own, and the one below if a partner fits there."""
        band = self.of(n)
        least = -(-self.percent * n // 100)
        return [band, band - 1] if band and least < self.low[band] else [band]

    def differing(self, band: int) -> int:
        """The most shingles that two linked sets of a band's join can differ in."""
        top = self.low[band + 1] - 1
        both = top + top * 100 // self.percent
        return self.allowed(both)

    def allowed(self, both: int) -> int:
        """The most shingles that two linked sets of ``both`` shingles together can differ in."""
        return (100 - self.percent) * both // (100 + self.percent)

    def sketch_words(self, band: int) -> int:
        """64-bit words of the sketch that is compared in a band's join."""
        while len(self.low) < band + 2:
            self.of(self.low[-1])
        return max(LEAST_WORDS, -(-SKETCH_BITS * (self.low[band + 1] - 1) // 64))


def sketch(shingles: np.ndarray, band: int, words: int, all_bits: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, parity words and set sizes of the words that are not empty.

    A shingle flips one bit of its word, or with ``all_bits`` those of a hash:
    words are then equal by chance next to never, but say nothing of distance.
    """
    own = mix(shingles ^ mix(np.array([band * 2 + 1], np.uint64)))
    place = ((own >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    bits = mix(own[order]) if all_bits else np.uint64(1) << (own[order] & np.uint64(63))
    return place[first], np.bitwise_xor.reduceat(bits, first), np.diff(np.r_[first, len(place)])


def bucket_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the words by which a set looks for partners."""
    out = []
    for band in bands.joins(len(shingles)):
        needed = bands.differing(band) + 1
        words = needed if needed == 1 else int(np.ceil(needed * SLACK))
        place, parity, count = sketch(shingles, band, words, all_bits=True)
        seed = mix(np.array([band * 2], np.uint64))
        with np.errstate(over="ignore"):
            key = mix(parity ^ mix(place * _FACTORS[1] + count.astype(np.uint64) * _FACTORS[2] + seed))
        empty = words - len(place)
        if len(place) > needed:
            key = key[np.lexsort((key, -count))[:needed]]
        elif len(place) < needed and empty:  # only empty words are left: all of them are one key
            key = np.append(key, mix(seed ^ np.uint64(5)))
        out.append(key)
    return np.concatenate(out)


def whole_sketch(shingles: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """The parity sketch that is compared, of one length for a band's join."""
    words = bands.sketch_words(band)
    place, parity, _ = sketch(shingles, band + (1 << 40), words)
    out = np.zeros(words, np.uint64)
    out[place.astype(np.int64)] = parity
    return out


def record(shingles: np.ndarray, bands: Bands) -> bytes:
    """Size and whole sketches of a set, for its own band and the one below if it joins it."""
    parts = [whole_sketch(shingles, band, bands).tobytes() for band in bands.joins(len(shingles))]
    return len(shingles).to_bytes(8, "little") + b"".join(parts)


def read_record(data: bytes, bands: Bands) -> tuple[int, dict[int, np.ndarray]]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, {}
    for band in bands.joins(n):
        size = 8 * bands.sketch_words(band)
        out[band] = np.frombuffer(data[at : at + size], np.uint64)
        at += size
    return n, out


def may_link(data: bytes, other: bytes, bands: Bands) -> bool:
    """False if the sizes or the sketches prove that two sets are not linked."""
    (n, mine), (m, theirs) = read_record(data, bands), read_record(other, bands)
    common = mine.keys() & theirs.keys() & {min(bands.of(n), bands.of(m))}
    if not common or bands.percent * max(n, m) > 100 * min(n, m):
        return False
    band = common.pop()
    return int(np.bitwise_count(mine[band] ^ theirs[band]).sum()) <= bands.allowed(n + m)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits of each set, as two columns."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)


def bucket_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row with n_shingles for each row of (doc_id, text), and one for each bucket key of its set.

    Sets are known by the digests d1 and d2, those of a key by an id that has
    them, among others perhaps.  Rows of texts hold a hash of the text and the record of their sketches, unless the
    same set came before in the task's chunk of texts.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.xxhash64("text").cast("string").alias("hash"), "text")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, bands = Shingler(words), Bands(percent)
        for batch in batches:
            texts = encoded(t if isinstance(t, str) else None for t in batch["text"])
            ids = [int(i) if isinstance(i, str) else None for i in batch["id"]]
            hashes = [int(h) for h in batch["hash"]]
            for a, b in chunks([len(t) for t in texts], CHUNK):
                yield _chunk(ids[a:b], hashes[a:b], [shingler.shingles(t) for t in texts[a:b]], bands)
        del shingler
        give_back()

    return rows.mapInPandas(work, "key long, id long, hash long, n_shingles long, d1 long, d2 long, record binary")


def _chunk(ids: list[int | None], hashes: list[int], sets: list[np.ndarray], bands: Bands) -> pd.DataFrame:
    keys, owners, records, seen = [], [], [], set()
    two = _digests(sets)
    for i, s, digest in zip(ids, sets, map(tuple, two.tolist())):
        new = i is not None and len(s) > 0 and digest not in seen
        records.append(record(s, bands) if new else None)
        if new:
            seen.add(digest)
            keys.append(bucket_keys(s, bands))
            owners.append(np.full(len(keys[-1]), i, np.int64))
    spread = mix(two[:, 0].view(np.uint64) + np.arange(len(ids), dtype=np.uint64)).view(np.int64)
    own = pd.DataFrame({
        "key": spread, "id": pd.array(ids, dtype="Int64"), "hash": pd.array(hashes, dtype="Int64"),
        "n_shingles": pd.array([len(s) for s in sets], dtype="Int64"), "d1": pd.array(two[:, 0], dtype="Int64"), "d2": pd.array(two[:, 1], dtype="Int64"),
        "record": records,
    })
    if not keys:
        return own
    key = pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "id": pd.array(np.concatenate(owners), dtype="Int64")})
    for name in ("hash", "n_shingles", "d1", "d2"):
        key[name] = pd.array([pd.NA], dtype="Int64").repeat(len(key))
    key["record"] = None
    return pd.concat([own, key[own.columns]], ignore_index=True)


def _near(pairs: DataFrame, records: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that their records do not rule out."""
    for side in ("a", "b"):
        pairs = pairs.join(records.select(F.col("id").alias(side), F.col("record").alias(f"{side}_record")), side)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(percent)
        for batch in batches:
            keep = [may_link(x, y, bands) for x, y in zip(batch["a_record"], batch["b_record"])]
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    return pairs.mapInPandas(work, "a long, b long").distinct()


def _marked(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """Documents whose id's bit is set by a needed id, so that few other texts are moved.

    The filter has 2 ** ``FILTER_BITS`` bits in at most as many rows of 64, which bounds the broadcast.
    """
    bit = lambda: F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << FILTER_BITS))
    words = (
        needed.select(bit().alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    )
    asked = docs.withColumn("bit", bit()).withColumn("word", F.shiftright("bit", 6))
    found = asked.join(F.broadcast(words), "word").filter(F.expr("shiftrightunsigned(bits, cast(bit & 63 as int)) & 1 = 1"))
    return found.select(*docs.columns)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The (a, b) pairs of classes whose whole texts are linked."""
    spark = docs.sparkSession
    pairs = stored(spark, pairs, "ngram-pairs")
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    needed = needed.join(classes.select("id", "doc_id", "d1", "d2"), "id")
    texts = _marked(docs, needed.select("doc_id").distinct()).join(needed, "doc_id")
    for side in ("a", "b"):
        own = [F.col(c).alias(f"{side}_{c}") for c in ("text", "d1", "d2")]
        pairs = pairs.join(texts.select(F.col("id").alias(side), *own), side)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            keep = []
            wanted = batch[["a_d1", "a_d2", "b_d1", "b_d2"]].to_numpy()
            for x, y, digests in zip(batch["a_text"], batch["b_text"], wanted):
                sets = [shingler.shingles(t) for t in encoded([x, y])]
                # An id may have texts of other sets.
                keep.append((_digests(sets).ravel() == digests).all() and linked(*sets, percent))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]
        give_back()

    return stored(spark, pairs.mapInPandas(work, "a long, b long").distinct(), "ngram-links")


#: Stands for pairs that a round has left for the next one.
_MORE = -1


def _across(members: DataFrame, records: DataFrame, percent: int, most: int) -> DataFrame:
    """(a, b) pairs of different components in one bucket that sketches do not rule out.

    ``members`` has rows (bucket, id, component).  A bucket of many members is
    cut into blocks, and each pair of blocks is a group of its own.  Of a pair
    of components a group gives the ``most`` nearest pairs; where there are
    others, a pair (-1, -1) says so.
    """
    in_order = Window.partitionBy("bucket").orderBy("id")
    place = F.row_number().over(in_order) - 1
    last = F.count("*").over(Window.partitionBy("bucket")) - 1
    cut = members.withColumns({"x": F.floor(place / BLOCK).cast("long"), "last": F.floor(last / BLOCK).cast("long")})
    dealt = (
        cut.withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .select("bucket", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "id", "component")
        .join(records, "id")
    )
    dealt = dealt.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "id")

    def compare(group: list[tuple[int, int, bytes]], bands: Bands) -> list[tuple[int, int]]:
        by_band: dict[int, list] = {}
        for i, c, data in group:
            n, sketches = read_record(data, bands)
            for band, words in sketches.items():
                by_band.setdefault(band, []).append((i, c, n, words))
        out = [], [], [], [], []
        for rows in by_band.values():
            ids, parts, sizes = (np.array([r[k] for r in rows], np.int64) for k in range(3))
            if (parts == parts[0]).all():
                continue
            words = np.array([r[3] for r in rows])
            for k in range(len(rows) - 1):
                m = sizes[k + 1 :]
                fits = (parts[k + 1 :] != parts[k]) & (bands.percent * np.maximum(m, sizes[k]) <= 100 * np.minimum(m, sizes[k]))
                if not fits.any():
                    continue
                at = np.flatnonzero(fits) + k + 1
                far = np.bitwise_count(words[at] ^ words[k]).sum(axis=1)
                near = far <= (100 - bands.percent) * (sizes[at] + sizes[k]) // (100 + bands.percent)
                at, far = at[near], far[near]
                lower = np.minimum(ids[at], ids[k]), np.maximum(ids[at], ids[k])
                found = *lower, np.minimum(parts[at], parts[k]), np.maximum(parts[at], parts[k]), far
                for values, value in zip(out, found):
                    values.append(value)
        if not out[0]:
            return []
        a, b, x, y, far = (np.concatenate(values) for values in out)
        order = np.lexsort((b, a, far, y, x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        sizes = np.diff(np.r_[first, len(x)])
        taken = order[np.arange(len(x)) - np.repeat(first, sizes) < most]
        left = [(_MORE, _MORE)] if len(taken) < len(order) else []
        return list(zip(a[taken].tolist(), b[taken].tolist())) + left

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands, key, group = Bands(percent), None, []
        for batch in batches:
            found = []
            for row in zip(batch["bucket"], batch["x"], batch["y"], batch["id"], batch["component"], batch["record"]):
                if row[:3] != key:
                    found += compare(group, bands)
                    key, group = row[:3], []
                group.append(row[3:])
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(compare(group, bands), columns=["a", "b"], dtype="int64")
        del group
        give_back()

    return dealt.mapInPandas(work, "a long, b long").distinct()


def text_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, ids_link: bool = True) -> DataFrame:
    """(id, hash, n_shingles, d1, d2, group, least_id, least_hash) for each row of (doc_id, text).

    ``group`` is a number for all rows that are reached by links, ``least_id``
    its least id and ``least_hash`` the least text hash under that; they are
    null for rows that can link with nothing.  With ``ids_link`` the texts of
    one id are linked as well, however unlike they are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    in_bucket = Window.partitionBy("key", "is_text")  # one window, so that rows are dealt out once
    rows = (
        bucket_rows(docs, words, percent)
        .withColumn("is_text", F.col("n_shingles").isNotNull())
        .withColumns({
            "least": F.min("id").over(in_bucket),
            "members": F.count("id").over(in_bucket),
            "mark": F.bit_xor(F.xxhash64("id")).over(in_bucket),
        })
        .filter(F.col("is_text") | (F.col("members") > 1))
        .select("id", "hash", "n_shingles", "d1", "d2", "record", "least", "members", F.xxhash64("mark", "least", "members").alias("bucket"))
    )
    rows = stored(spark, rows, "ngram-buckets")
    texts = rows.filter("n_shingles is not null").select("id", "hash", "n_shingles", "d1", "d2", "record")
    met = rows.filter("n_shingles is null").select("id", "least", "members", "bucket")
    # Equal sets are a class, with a number of its own; one document that has a record stands for it.
    able = texts.filter("n_shingles > 0 and id is not null")
    classes = able.groupBy("d1", "d2").agg(
        F.min(F.struct("id", "hash")).alias("low"), F.min(F.when(F.col("record").isNotNull(), F.struct("id", "record"))).alias("own")
    )
    classes = stored(
        spark, classes.select("d1", "d2", "low", F.col("own.id").alias("doc_id"), "own.record", F.monotonically_increasing_id().alias("id")),
        "ngram-classes",
    )
    records = classes.select("id", "record")

    # An id with several texts stands for the classes of all: more pairs are asked, none is lost.
    class_of = able.filter("record is not null").select(F.col("id").alias("member"), "d1", "d2").distinct()
    class_of = stored(spark, class_of.join(classes.select("d1", "d2", "id"), ["d1", "d2"]).select("member", "id"), "ngram-members")

    def classed(df: DataFrame, column: str) -> DataFrame:
        own = class_of.select(F.col("member").alias(column), F.col("id").alias("__own"))
        return df.join(own, column).withColumn(column, F.col("__own")).drop("__own")

    pairs = met.filter("id <> least").groupBy(F.col("least").alias("a"), F.col("id").alias("b")).agg(F.lit(1).alias("one"))
    pairs = classed(classed(pairs.select("a", "b"), "a"), "b").filter("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = _verified(_near(pairs, records, percent), classes, docs, words, percent)
    # Buckets of three and more can hold pairs that no star has shown.
    members = met.filter("members > 2").groupBy("bucket", "id").agg(F.lit(1).alias("one")).select("bucket", "id")
    members = stored(spark, classed(members, "id").distinct(), "ngram-members")
    links, tested, most = first, pairs.limit(0), NEAREST
    while True:
        parts = connected_components(links)
        known = members.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = known.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
        known = known.join(mixed.select("bucket"), "bucket", "left_semi")
        found = stored(spark, _across(known, records, percent, most), "ngram-across")
        more = not found.filter(F.col("a") == _MORE).isEmpty()
        asked = found.filter(F.col("a") != _MORE).join(tested, ["a", "b"], "left_anti")
        links = links.unionByName(_verified(asked, classes, docs, words, percent))
        if not more:
            break
        # What is linked by now needs no further pairs; the others get more of them.
        tested, most = stored(spark, tested.unionByName(asked), "ngram-tested"), most * 8
    if ids_link:
        several = able.groupBy(F.col("id").alias("doc")).agg(F.min(F.struct("d1", "d2")).alias("x"), F.max(F.struct("d1", "d2")).alias("y"))
        several = several.filter("x <> y").select("doc")
        under = able.select(F.col("id").alias("doc"), "d1", "d2").join(several, "doc", "left_semi").distinct()
        under = under.join(classes.select("d1", "d2", "id"), ["d1", "d2"]).select("doc", "id")
        star = under.join(under.groupBy("doc").agg(F.min("id").alias("a")), "doc")
        links = links.unionByName(star.select("a", F.col("id").alias("b")))
    parts = stored(spark, connected_components(links), "ngram-components")
    grouped = classes.select("d1", "d2", "low", "id").join(parts, "id", "left").withColumn("group", F.coalesce("component", "id"))
    lowest = grouped.groupBy("group").agg(F.min("low").alias("least"))
    known = grouped.select("d1", "d2", "group").join(lowest, "group")
    return texts.drop("record").join(known, ["d1", "d2"], "left").select(
        "id", "hash", "n_shingles", "d1", "d2",
        *[F.when(F.col("id").isNotNull(), c).alias(n) for n, c in (
            ("group", F.col("group")), ("least_id", F.col("least.id")), ("least_hash", F.col("least.hash")))],
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of (doc_id, text); other columns are not read.

    The component is the smallest doc_id reachable by links of at least
    ``percent`` similarity, itself included.  Null, empty and blank texts have
    no shingle and link with nothing.  Rows without an id link with nothing and
    have a null component.  Rows that share an id are one document, linked if
    one of its texts is; repeated rows come back repeated.
    """
    groups = text_groups(docs, words, percent)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("least_id", "id").alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of (doc_id, text, ...) without near copies, with all columns: of linked rows the least id stays.

    Of several texts under that id the one with the least hash stays, and of
    rows that repeat id and text one.  Unlike texts that share an id all stay,
    and so do rows without an id and rows whose text has no shingle.  Columns
    may have any names beside these two.
    """
    key = {"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64("text")}
    groups = stored(docs.sparkSession, text_groups(docs, words, percent, ids_link=False).filter("group is not null"), "ngram-groups")
    stays = (F.col("id") == F.col("least_id")) & (F.col("hash") == F.col("least_hash"))
    gone = groups.filter(~stays).select(F.col("id").alias("__id"), F.col("hash").alias("__hash")).distinct()
    repeated = groups.filter(stays).groupBy(F.col("id").alias("__id"), F.col("hash").alias("__hash")).agg(F.count("*").alias("n"))
    repeated = repeated.filter("n > 1").select("__id", "__hash")
    # Written once: their sizes are then known, and few of them need no exchange of the texts.
    gone, repeated = (stored(docs.sparkSession, t, "ngram-rows") for t in (gone, repeated))
    rows = docs.withColumns(key).join(gone, ["__id", "__hash"], "left_anti")
    once = rows.join(repeated, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"])
    rows = rows.join(repeated, ["__id", "__hash"], "left_anti").unionByName(once)
    return rows.select(*[f"`{c}`" for c in docs.columns])
