"""Removal of long repeated passages by sorted hashes of strings in range-partitioned buckets.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else.
Every start is a suffix, of which the first ``length`` bytes matter.  Sorting all
of them would move each text hundreds of times, so two rounds sort few:

1. The starts of a text fall into runs with a common anchor: the place of the
   least hash among the ``GRAM``-byte strings in a start's window.  Equal strings
   have equal anchors, so only anchors are sorted, by their hashes.  A run whose anchor is unlike all others holds no repeat; a run that
   stands elsewhere with all its bytes is repeated as a whole.
2. Only starts of the runs between, and of one run for each of the classes that
   they may meet, are sorted by the hashes of their whole strings.

In both rounds splitters sampled from the data cut the order of leading bytes
into buckets; strings that are too common for a bucket are cut by what follows.
A task packs its suffixes for each bucket into one row, equal ones into one
suffix, so that a very common passage is combined before the shuffle.  Buckets
are sorted key by key: the first key, then the next one among equals.  Splitters
never part equal keys, so that nothing is left to compare across a boundary but
the anchors that are known to be common, which are marked as such.

Strings are known by 64-bit hashes with a second one beside them, which are what
is sorted: there is no multikey quicksort, and leading bytes only choose a bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestead.llm.text import encoded, mix, small_batches, stored

LENGTH, GRAM = 200, 100
PIECE = 2_000_000
#: One text in so many is sampled for splitters, and a bucket stands for so many bytes of text.
SAMPLED, BUCKET_BYTES, SAMPLES = 32, 32_000_000, 200_000

RUN = np.dtype([("gram", "<u8"), ("ctx", "<u8"), ("id", "<i8"), ("h", "<u4"), ("lo", "<u4"), ("n", "u1"), ("more", "u1")])
FLAGGED = np.dtype([("id", "<i8"), ("h", "<u4"), ("lo", "<u4"), ("n", "u1"), ("status", "u1")])
START = np.dtype([("hash", "<u8"), ("check", "<u4"), ("id", "<i8"), ("h", "<u4"), ("lo", "<u4"), ("more", "u1")])
WHOLE, SOME, SHOWN = 1, 2, 3  # all starts repeat; some may; all do, and they stand for their class
SILENT = 2  # a start that is only there to be met
_FACTOR = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Roller:
    """Hashes of any stretch of a buffer, from sums over its prefixes."""

    def __init__(self, kind: int = 0):
        self.table = mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * kind + 1))
        self.factor = np.uint64(_FACTOR[kind])
        self.inverse = np.uint64(pow(_FACTOR[kind], -1, 2**64))
        self.powers = self.unpowers = np.ones(1, np.uint64)

    def load(self, buf: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            if len(self.powers) <= len(buf):
                n = len(buf) + 1
                self.powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, self.factor))])
                self.unpowers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, self.inverse))])
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[buf] * self.powers[: len(buf)])])

    def hash(self, start: np.ndarray, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[start + length] - self.sums[start]) * self.unpowers[start])

    def all(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            n = len(self.sums) - length
            return mix((self.sums[length:] - self.sums[:n]) * self.unpowers[:n])


def leading(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first eight bytes at each place, in the order of bytes."""
    return np.ascontiguousarray(buf[at[:, None] + np.arange(8)]).view(">u8").ravel().astype(np.uint64)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: minima from block starts and from block ends."""
    n, blocks = len(values) - width + 1, -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Pieces:
    """Texts of one batch as buffers of bounded size; a long text is several pieces, which share length - 1 bytes."""

    def __init__(self, texts: list[bytes], length: int):
        self.parts = []
        group, size = [], 0
        for i, t in enumerate(texts):
            for at in range(0, max(1, len(t) - length + 1), PIECE):
                part = t[at : at + PIECE + length - 1]
                if group and size + len(part) > PIECE:
                    self.parts.append(group)
                    group, size = [], 0
                group.append((i, at, part))
                size += len(part)
        if group:
            self.parts.append(group)

    def __iter__(self):
        for group in self.parts:
            lens = np.array([len(p) for _, _, p in group])
            buf = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
            yield buf, np.array([i for i, _, _ in group]), np.array([a for _, a, _ in group]), lens


def runs(buf: np.ndarray, lens: np.ndarray, roller: Roller, length: int, gram: int):
    """Runs of starts with one anchor: owner piece, first and last start, anchor (places in the buffer)."""
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none, none
    grams = roller.all(gram)
    low = np.uint64(0xFFFFFFFF)
    least = window_minima((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    ends = np.cumsum(lens)
    owner = np.repeat(np.arange(len(lens)), lens)[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + length <= ends[owner])
    if not len(at):
        return none, none, none, none
    anchor, owner = (least[at] & low).astype(np.int64), owner[at]
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[first[1:] - 1, len(at) - 1]
    return owner[first], at[first], at[last], anchor[first]


def _repeated(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number and size of each sorted row."""
    new = np.r_[True, np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])] if len(order) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    return group, np.bincount(group)[group] if len(group) else group


class Splitters:
    """Ranges of (leading bytes, hash) from a sample; common hashes are told, to be cut by a further key."""

    def __init__(self, lead: np.ndarray, key: np.ndarray, further: np.ndarray, buckets: int):
        values, counts = np.unique(key, return_counts=True)
        self.common = values[counts > max(8, len(key) // (4 * max(1, buckets)))]
        tie = self.tie(key, further)
        order = np.lexsort((tie, lead))
        at = order[(np.arange(1, buckets) * len(order)) // max(1, buckets)] if len(order) else order
        self.lead, self.ties = lead[at], tie[at]
        self.many = np.unique(self.lead)

    def is_common(self, key: np.ndarray) -> np.ndarray:
        return np.isin(key, self.common)

    def tie(self, key: np.ndarray, further: np.ndarray) -> np.ndarray:
        return np.where(self.is_common(key), mix(key ^ further), key)

    def bucket(self, lead: np.ndarray, key: np.ndarray, further: np.ndarray) -> np.ndarray:
        out = np.searchsorted(self.lead, lead, "left")
        equal = np.flatnonzero(np.isin(lead, self.many))
        if len(equal):
            tie = self.tie(key[equal], further[equal])
            for value in np.unique(lead[equal]):
                a, b = np.searchsorted(self.lead, value, "left"), np.searchsorted(self.lead, value, "right")
                mine = lead[equal] == value
                out[equal[mine]] = a + np.searchsorted(self.ties[a:b], tie[mine], "right")
        return out


def _joined(items: np.ndarray) -> bytes:
    """Items field by field: ids that come again then compress well."""
    return b"".join(items[name].tobytes() for name in items.dtype.names)


def _parted(blobs: list[bytes], kind: np.dtype) -> np.ndarray:
    """The items of blobs that were joined field by field."""
    out = np.zeros(sum(len(b) for b in blobs) // kind.itemsize, kind)
    at = 0
    for blob in blobs:
        n, place = len(blob) // kind.itemsize, 0
        for name in kind.names:
            size = n * kind[name].itemsize
            out[name][at : at + n] = np.frombuffer(blob, kind[name], n, place)
            place += size
        at += n
    return out


def _packed(buckets: np.ndarray, items: np.ndarray, kind: int) -> pd.DataFrame:
    order = np.argsort(buckets, kind="stable")
    buckets, items = buckets[order], items[order]
    cuts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else np.zeros(0, int)
    blobs = [_joined(items[a:b]) for a, b in zip(cuts, np.r_[cuts[1:], len(items)])]
    return pd.DataFrame({"bucket": buckets[cuts].astype(np.int64), "kind": np.full(len(cuts), kind, np.int64), "items": blobs})


PACKED = "bucket long, kind long, items binary"


def _keys(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return batch["id"].to_numpy(np.int64), batch["h"].to_numpy(np.int64).astype(np.uint32)


def _run_items(ids, hs, texts, roller: Roller, length: int, gram: int):
    """Runs of all texts, the leading bytes of their anchors' suffixes and the buffer, piece group by piece group."""
    for buf, owners, offsets, lens in Pieces(texts, length):
        if len(buf) < length:
            continue
        roller.load(buf)
        piece, lo, hi, anchor = runs(buf, lens, roller, length, gram)
        if not len(lo):
            continue
        base = np.cumsum(lens) - lens
        items = np.zeros(len(lo), RUN)
        items["gram"] = roller.hash(anchor, gram)
        n = hi - lo + 1
        items["ctx"] = mix(roller.hash(lo, n + length - 1) ^ mix((n * 1024 + (anchor - lo)).astype(np.uint64)))
        items["id"], items["h"] = ids[owners[piece]], hs[owners[piece]]
        items["lo"], items["n"] = lo - base[piece] + offsets[piece], n
        yield items, leading(buf, anchor), buf


def _splitters(docs: DataFrame, length: int, gram: int, least: int) -> tuple[Splitters, Splitters, int]:
    """Splitters of both rounds and the number of buckets, from one text in ``SAMPLED`` and ``SAMPLES`` suffixes at most."""
    chosen = docs.filter(F.pmod(F.xxhash64("id", "h", F.lit(1)), F.lit(SAMPLED)) == 0)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roller = Roller()
        for batch in batches:
            for items, lead, buf in _run_items(*_keys(batch), encoded(batch["text"]), roller, length, gram):
                whole = roller.all(length)
                at = np.flatnonzero(whole % np.uint64(64) == 0)
                starts = np.stack([leading(buf, at), whole[at]]) if len(at) else np.zeros((2, 0), np.uint64)
                anchors = np.stack([lead, items["gram"], items["ctx"]])
                yield pd.DataFrame({"anchors": [anchors.tobytes()], "starts": [starts.tobytes()], "n": [len(buf)], "k": [len(lead)]})

    got = chosen.select("id", "h", "text").mapInPandas(work, "anchors binary, starts binary, n long, k long")
    got = stored(docs.sparkSession, got, "suffix-sample")
    total, k = got.agg(F.sum("n"), F.sum("k")).first()
    buckets = max(least, -(-(total or 0) * SAMPLED // BUCKET_BYTES))
    # Each of them is taken with a chance that leaves ``SAMPLES`` of all, however many there are, and copies one by one.
    share = min(1.0, SAMPLES / max(1, k or 0))

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in zip(batch["anchors"], batch["starts"]):
                parts = [np.frombuffer(data, np.uint64).reshape(n, -1) for data, n in zip(row, (3, 2))]
                draws = np.random.default_rng(zlib.crc32(row[0]))  # by content: a task that runs twice takes the same
                kept = [part[:, draws.random(part.shape[1]) < share] for part in parts]
                if any(part.size for part in kept):
                    out.append([part.tobytes() for part in kept])
            yield pd.DataFrame(out, columns=["anchors", "starts"])

    rows = got.select("anchors", "starts").mapInPandas(thin, "anchors binary, starts binary").collect()
    join = lambda name, n: np.concatenate([np.zeros((n, 0), np.uint64), *(np.frombuffer(r[name], np.uint64).reshape(n, -1) for r in rows)], axis=1)
    anchors, starts = join("anchors", 3), join("starts", 2)
    return Splitters(*anchors, buckets), Splitters(*starts, np.zeros_like(starts[0]), buckets), buckets


def _by_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[dict[int, list[bytes]]]:
    """The packed items of each bucket by kind, of rows sorted by bucket."""
    key, held = None, {}
    for batch in batches:
        for bucket, kind, items in zip(batch["bucket"], batch["kind"], batch["items"]):
            if bucket != key and key is not None:
                yield held
                held = {}
            key = bucket
            held.setdefault(kind, []).append(items)
    if held:
        yield held


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")


def _to_texts(items: np.ndarray, texts: int, kind: int = 0) -> pd.DataFrame:
    place = mix(items["id"].astype(np.int64).view(np.uint64)) % np.uint64(texts)
    return _packed(place.astype(np.int64), items, kind)


def _flagged_runs(docs: DataFrame, splitters: Splitters, buckets: int, length: int, gram: int) -> DataFrame:
    """Packed runs that are repeated or may be, addressed to their texts: the first round."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roller = Roller()
        for batch in batches:
            for items, lead, _ in _run_items(*_keys(batch), encoded(batch["text"]), roller, length, gram):
                order = np.lexsort((items["ctx"], items["gram"]))
                group, size = _repeated(order, items["gram"], items["ctx"])
                first = np.r_[True, group[1:] != group[:-1]]
                sent = order[first]
                items["more"][sent] = size[first] > 1
                yield _packed(splitters.bucket(lead[sent], items["gram"][sent], items["ctx"][sent]), items[sent], 0)
                rest = order[~first]
                if len(rest):
                    yield _packed(rest % buckets, _flag(items[rest], WHOLE), 1)

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in _by_bucket(batches):
            if 1 in held:
                yield _to_texts(_parted(held[1], FLAGGED), buckets)
            items = _parted(held.get(0, []), RUN)
            if not len(items):
                continue
            order = np.lexsort((items["ctx"], items["gram"]))
            items = items[order]
            same = np.arange(len(items))
            group, size = _repeated(same, items["gram"], items["ctx"])
            first = np.r_[True, group[1:] != group[:-1]]
            whole = (size > 1) | (np.bincount(group, items["more"])[group] > 0)
            anchor, anchors = _repeated(same, items["gram"])
            common = splitters.is_common(items["gram"])
            classes = np.bincount(anchor, first)[anchor]
            met = (anchors > 1) | common
            status = np.where(whole, WHOLE, np.where(met, SOME, 0))
            status[whole & first & ((classes > 1) | common)] = SHOWN
            at = status > 0
            yield _to_texts(_flag(items[at], status[at]), buckets)

    rows = docs.select("id", "h", "text").mapInPandas(emit, PACKED)
    return _dealt(rows, buckets).mapInPandas(sort, PACKED)


def _flag(items: np.ndarray, status) -> np.ndarray:
    out = np.zeros(len(items), FLAGGED)
    for name in ("id", "h", "lo", "n"):
        out[name] = items[name]
    out["status"] = status
    return out


def _per_text(rows: DataFrame, kind: np.dtype, buckets: int, name: str) -> DataFrame:
    """(id, h, name): the packed items of each text, sorted by place."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in _by_bucket(batches):
            items = _parted([b for blobs in held.values() for b in blobs], kind)
            items = items[np.lexsort((items["lo"], items["h"], items["id"]))]
            cuts = np.flatnonzero(np.r_[True, (items["id"][1:] != items["id"][:-1]) | (items["h"][1:] != items["h"][:-1])])
            blobs = [items[a:b].tobytes() for a, b in zip(cuts, np.r_[cuts[1:], len(items)])]
            yield pd.DataFrame({"id": items["id"][cuts], "h": items["h"][cuts].astype(np.int64), name: blobs})

    return _dealt(rows, buckets).mapInPandas(work, f"id long, h long, {name} binary")


def _repeated_starts(flagged: DataFrame, splitters: Splitters, buckets: int, length: int) -> DataFrame:
    """Packed starts in doubtful runs whose strings come again, addressed to their texts: the second round."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = Roller(0), Roller(1)
        for batch in batches:
            held, size = [], 0
            for i, h, text, packed in zip(*_keys(batch), encoded(batch["text"]), batch["runs"]):
                for r in np.frombuffer(packed, FLAGGED):
                    if r["status"] != WHOLE:
                        lo, n = int(r["lo"]), int(r["n"])
                        held.append((i, h, lo, n, r["status"] == SHOWN, text[lo : lo + n + length - 1]))
                        size += len(held[-1][-1])
                        if size >= PIECE:
                            yield from starts(held, one, two)
                            held, size = [], 0
            if held:
                yield from starts(held, one, two)

    def starts(held: list, one: Roller, two: Roller) -> Iterator[pd.DataFrame]:
        buf = np.frombuffer(b"".join(x[-1] for x in held), np.uint8)
        one.load(buf)
        two.load(buf)
        n = np.array([x[3] for x in held])
        base = np.cumsum(n + length - 1) - (n + length - 1)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(base, n) + inside
        items = np.zeros(len(at), START)
        items["hash"], items["check"] = one.hash(at, length), two.hash(at, length).astype(np.uint32)
        for k, name in enumerate(("id", "h", "lo")):
            items[name] = np.repeat(np.array([x[k] for x in held]), n)
        items["lo"] += inside.astype(np.uint32)
        items["more"] = np.repeat(np.array([SILENT if x[4] else 0 for x in held], np.uint8), n)
        order = np.lexsort((items["more"], items["check"], items["hash"]))
        group, size = _repeated(order, items["hash"], items["check"])
        first = np.r_[True, group[1:] != group[:-1]]
        sent, rest = order[first], order[~first]
        items["more"][sent] |= (size[first] > 1).astype(np.uint8)
        sent.sort()
        key = items["hash"][sent]
        yield _packed(splitters.bucket(leading(buf, at[sent]), key, np.zeros_like(key)), items[sent], 0)
        rest = rest[items["more"][rest] < SILENT]
        if len(rest):
            yield _packed(rest % buckets, items[rest], 1)

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in _by_bucket(batches):
            if 1 in held:
                yield _to_texts(_place(_parted(held[1], START)), buckets)
            items = _parted(held.get(0, []), START)
            if not len(items):
                continue
            order = np.lexsort((items["check"], items["hash"]))
            items = items[order]
            group, size = _repeated(np.arange(len(items)), items["hash"], items["check"])
            again = ((size > 1) | (items["more"] & 1 > 0)) & (items["more"] < SILENT)
            yield _to_texts(_place(items[again]), buckets)

    rows = flagged.select("id", "h", "text", "runs").mapInPandas(emit, PACKED)
    return _dealt(rows, buckets).mapInPandas(sort, PACKED)


PLACE = np.dtype([("id", "<i8"), ("h", "<u4"), ("lo", "<u4")])


def _place(items: np.ndarray) -> np.ndarray:
    out = np.zeros(len(items), PLACE)
    for name in PLACE.names:
        out[name] = items[name]
    return out


def spans_of(packed_runs: bytes | None, packed_starts: bytes | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed stretches of a text from its repeated runs and starts."""
    found = np.frombuffer(packed_runs or b"", FLAGGED)
    found = found[found["status"] != SOME]
    starts = np.frombuffer(packed_starts or b"", PLACE)["lo"].astype(np.int64)
    lo = np.concatenate([found["lo"].astype(np.int64), starts])
    hi = np.concatenate([found["lo"].astype(np.int64) + found["n"] + length - 1, starts + length])
    if not len(lo):
        return []
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
    return list(zip(lo[new].tolist(), hi[np.r_[new[1:] - 1, len(hi) - 1]].tolist()))


def remove_repeats(
    df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept) for each row: UTF-8 bytes, removed stretches and what is left.

    Strings never cross texts and are judged on the input.  Null texts are
    empty; texts shorter than ``length`` bytes stay whole.  Of repeated rows,
    with or without a key, each one is a text of its own, so their long strings
    repeat.  Other columns are not read.  ``kept`` is binary, since a cut may
    fall inside a character.
    """
    spark = df.sparkSession
    small_batches(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(
        F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text))).alias("id"),
        F.shiftrightunsigned(F.xxhash64(F.lit(9), F.col(text), F.col(key).isNull()), 32).alias("h"),
    )
    anchors, starts, buckets = _splitters(docs, length, gram, least)
    flagged = _per_text(_flagged_runs(docs, anchors, buckets, length, gram), FLAGGED, buckets, "runs")
    flagged = stored(spark, flagged, "suffix-runs")
    # Both joins deal the texts out in the same way: Spark moves them once.
    dealt = docs.repartition(max(least, buckets), "id", "h")
    doubtful = dealt.select("id", "h", "text").join(flagged, ["id", "h"])
    again = _per_text(_repeated_starts(doubtful, starts, buckets, length), PLACE, buckets, "starts")
    made = T.StructType.fromDDL("n_bytes long, n_removed long, spans array<struct<start:long, end:long>>, kept binary")

    def cut(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, run_blobs, start_blobs in columns:
            out = []
            for t, r, s in zip(encoded(texts), run_blobs, start_blobs):
                spans = spans_of(r, s, length)
                at, parts = 0, []
                for a, b in spans:
                    parts.append(t[at:a])
                    at = b
                kept = b"".join([*parts, t[at:]])
                out.append((len(t), len(t) - len(kept), [{"start": a, "end": b} for a, b in spans], kept))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "spans", "kept"])

    result = F.pandas_udf(cut, made)("text", "runs", "starts").alias("made")
    joined = dealt.join(flagged, ["id", "h"], "left").join(again, ["id", "h"], "left")
    return joined.select(F.col("key").alias(key), result).select(key, "made.*")
