"""Token files, lexical search and hard negatives against plain Python, with nulls, ties, repeated rows and clashing names."""

import glob
import math
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestead.llm import hard_negatives, lexical_search, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i * 7919 % 4001}," for i in range(12_000))
TEXTS = [
    None, "", " \n\t ", "The cat's hat, it's 12 o'clock!", "a\x1cb c\x0bd e f   g", "é ́x É", "<|endoftext|> and x<|startoftext|>y",
    "I'll WE'RE 'tis ''s '' don't,.;", "日本語 テキスト 😀😀 ½²", "İẞ Σσς", "tab\tnew\r\nline", "~!@#$%^&*()_+{}|:\"<>?[];',./`", LONG,
]


def docs_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("rng", "pos", "ids", "h", "part", "m", "n", "terms", "shard", "score", "rank", "item_id", "kind")
    return df.withColumns({n: F.lit("own") for n in names})


# token files


def token_rows(rows):
    library, start, out = Tokenizer.from_file(WORD_BPE), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("cached", [400_000, 3])
def test_token_encoder_equals_the_library(monkeypatch, cached):
    monkeypatch.setattr(token_files, "CACHED", cached)
    encoder, library = token_files.Encoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    for texts in (TEXTS, TEXTS[3:5], [], TEXTS[::-1], ["", None], [LONG] * 3):
        ids, ends = encoder.encode(pa.array(["skipped", *texts], pa.string())[1:])
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == want


def test_token_files(spark, tmp_path):
    rows = [(i * 7 % 101, t) for i, t in enumerate(TEXTS * 5)]
    got = token_files.token_table(docs_of(spark, rows), str(tmp_path / "a"), WORD_BPE)
    assert sorted(map(tuple, got.collect())) == sorted(token_rows(rows))
    # Files ascend by name, and rows ascend inside them.
    ids = [i for f in sorted(glob.glob(f"{tmp_path}/a/part-*")) for i in pyarrow.orc.read_table(f)["doc_id"].to_pylist()]
    assert ids == sorted(i for i, _ in rows)
    one = token_files.read_documents(spark, str(tmp_path / "a"), [7, 14])
    assert sorted(r.doc_id for r in one.collect()) == [7, 14]
    assert "PushedFilters: [In(doc_id, [14,7])]" in one._jdf.queryExecution().toString() or "In(doc_id" in one._jdf.queryExecution().toString()


def test_token_files_shared_and_missing_ids(spark, tmp_path):
    rows = [(None, t) for t in TEXTS[:6]] + [(5, t) for t in TEXTS[3:9]] + [(1, "x y")] * 4 + [(9, "one")]
    got = sorted(map(tuple, token_files.token_table(docs_of(spark, rows), str(tmp_path / "b"), WORD_BPE).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1] * 4 + [5] * 6 + [9] + [None] * 6
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter((r[0], r[2], r[3]) for r in token_rows(rows))


def test_token_files_of_nothing(spark, tmp_path):
    empty = docs_of(spark, [(1, "x")]).limit(0)
    assert token_files.token_table(empty, str(tmp_path / "c"), WORD_BPE).count() == 0


def test_stripes_and_blooms_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "STRIPE_BYTES", 1 << 18)
    rows = [(i, f"{LONG[i:]} {i}") for i in range(600)]
    token_files.write_tokens(docs_of(spark, rows), str(tmp_path / "d"), WORD_BPE)
    files = [pyarrow.orc.ORCFile(f) for f in glob.glob(f"{tmp_path}/d/part-*")]
    assert sum(f.nstripes for f in files) > len(files) and all(f.row_index_stride == token_files.ROW_STRIDE for f in files)
    plain = tmp_path / "e"
    token_files.read_tokens(spark, str(tmp_path / "d")).select("doc_id").coalesce(1).write.orc(str(plain / "none"))
    token_files.read_tokens(spark, str(tmp_path / "d")).select("doc_id").coalesce(1).write.option("orc.bloom.filter.columns", "doc_id").orc(str(plain / "bloom"))
    sizes = [sum(pyarrow.orc.ORCFile(f).file_length for f in glob.glob(f"{plain}/{k}/part-*")) for k in ("none", "bloom")]
    assert sizes[1] > sizes[0]  # the option that write_tokens sets makes filters


# lexical search


def ranked(docs, items, top):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x.group().lower(), t or ""))
    rows = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    rows = [r for r in rows if r[2]]
    n_docs, total = len(rows), sum(r[2] for r in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked = Counter(terms(text))
        found = []
        for i, counts, n in rows:
            m = 75 + 25 * n * n_docs // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t, k in asked.items() if t in counts
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, place, x[3], -x[0]) for place, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def search_rows():
    rng = np.random.default_rng(8)
    words = ["The", "of", "día", "x1", "zürich", "Ärger", "日本", *[f"t{i}" for i in range(60)]]
    chance = 1 / np.arange(1, len(words) + 1)
    made = [" ".join(rng.choice(words, rng.integers(1, 90), p=chance / chance.sum())) for _ in range(300)]
    docs = [(i if i % 29 else None, t) for i, t in enumerate(made)]
    docs += [(1000, None), (1001, ""), (1002, "... !!"), (1003, made[5]), (1003, made[5]), (1004, " ".join(made) * 3), (4, made[9])]
    items = [(i, made[i * 11]) for i in range(20)] + [(20, None), (21, "-"), (22, "nowhere found"), (3, made[33]), (3, "t1 t1 T1, t2"), (None, "zürich"), (2**60 + 1, "t5 of")]
    return docs, items


@pytest.mark.parametrize("cell, shard_rows, vocabulary", [(512, 65_536, 200_000), (3, 40, 2)])
def test_search(spark, monkeypatch, cell, shard_rows, vocabulary):
    monkeypatch.setattr(lexical_search, "CELL", cell)
    rows, asked = search_rows()
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("h", F.lit("own"))
    got = lexical_search.search(docs_of(spark, rows).drop("item_id"), items, 20, vocabulary, shard_rows)
    assert sorted(map(tuple, got.collect()), key=str) == ranked(rows, asked, 20)


def test_search_of_nothing(spark):
    rows, asked = search_rows()
    docs, items = docs_of(spark, rows), spark.createDataFrame(asked, "item_id long, text string")
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


def test_search_stops_at_the_bound():
    """Cells behind the last place are not scored."""
    ids, terms, tfs = [[1, 2], [3, 4]], [[["a"], ["a"]], [["a"], ["a"]]], [[[9], [8]], [[1], [1]]]
    cells = [lexical_search._cell(0, 75 + k, *x) for k, x in enumerate(zip(ids, terms, tfs))]
    shard = lexical_search._Shard([type("Cell", (), c) for c in cells])
    shard.docs[1] = None  # would fail if it were visited
    assert shard.best(["a", "b"], [10, 5], 2)[0].tolist() == [1, 2]


# hard negatives


def mined(rows, anchor, positives=5, negatives=5, low=80, high=100):
    ok = {(i, tuple(math.floor(256 * x) for x in e), y) for i, e, y in rows
          if i is not None and e is not None and y is not None and all(x is not None and math.isfinite(x) for x in e)}
    dot = lambda a, b: sum(x * z for x, z in zip(a, b))
    out = []
    for a in ok:
        if not anchor(a[0]):
            continue
        scored = [(-dot(a[1], b[1]), b[0], b) for b in ok if b != a]
        near = sorted(x for x in scored if x[2][2] == a[2])[:positives]
        for s, p, _ in near:
            far = sorted(x for x in scored if x[2][2] != a[2] and low * -s <= 100 * -x[0] <= high * -s)[:negatives]
            out += [(a[0], p, k, i, -s, -t) for k, (t, i, _) in enumerate(far, 1)]
    return sorted(out)


def vector_rows():
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(6, 10))
    rows = []
    for i in range(400):
        v = centres[i % 6] + rng.normal(scale=0.4, size=10)
        rows.append((i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(0, 4)) if i % 5 else 1))
    rows += [(500 + i, rows[8][1], i % 3) for i in range(30)]  # ties
    rows += [rows[10]] * 3 + [rows[20]]  # repeated rows, one of them an anchor
    rows += [(600, None, 1), (602, [1.0, None] * 5, 1), (603, [math.nan] * 10, 1), (604, [math.inf] * 10, 2), (605, rows[3][1], None), (None, rows[3][1], 2)]
    rows += [(700, [0.0] * 10, 1), (2**60, [50.0] * 10, 2), (701, [-x for x in rows[8][1]], 0)]
    return rows


@pytest.mark.parametrize("group, block", [(262_144, 128), (16, 3)])
def test_hard_negatives(spark, group, block, monkeypatch):
    monkeypatch.setattr(hard_negatives.build_index, "__defaults__", (group, block))
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.withColumns({n: F.lit("own") for n in ("id", "key", "sum", "v", "grp", "blk", "score")})
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, group=group)
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0


def test_rows_sharing_an_id_are_rows_of_their_own(spark):
    rows = [(1, [1.0, 0.5], 0), (1, [0.5, 1.0], 0), (2, [1.0, 1.0], 0), (3, [0.9, 0.7], 1), (4, [1.0], 1), (5, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") == 1, low=10).collect()))
    padded = [(i, [*e, 0.0, 0.0][:2], y) for i, e, y in rows]
    assert got == mined(padded, lambda i: i == 1, low=10)


@pytest.mark.parametrize("dims", [1, 7, 64])
def test_segment_bounds_hold(dims):
    rng = np.random.default_rng(dims)
    a, b = rng.integers(-300, 300, (50, dims)), rng.integers(-300, 300, (50, dims))
    exact = (a * b).sum(axis=1)
    widths = []
    for k in hard_negatives.LEVELS:
        (ma, da), (mb, db) = hard_negatives.summaries(a, k), hard_negatives.summaries(b, k)
        middle, apart = (ma * mb).sum(axis=1), (da * db).sum(axis=1)
        assert (np.abs(exact - middle) <= apart + 1e-6).all()
        widths.append(apart.mean())
    assert widths == sorted(widths, reverse=True)


def test_far_blocks_are_not_scored(monkeypatch):
    """Exact scores are computed only for rows that the bounds leave."""
    rng = np.random.default_rng(1)
    far, near = rng.integers(-20, 20, (500, 8)), rng.integers(200, 256, (10, 8))
    blocks = []
    for vectors, ids in ((far, 100), (near, 1)):
        vectors = vectors.astype(np.int32)
        packed = hard_negatives._packed(vectors)
        box = np.vstack([packed.min(axis=0), packed.max(axis=0)])
        blocks.append(type("Block", (), {
            "label": 1, "n": len(vectors), "ids": np.arange(ids, ids + len(vectors)).tobytes(), "keys": np.zeros(len(vectors), np.int64).tobytes(),
            "vectors": vectors.tobytes(), "summaries": packed.tobytes(), "box": box.tobytes(),
        }))
    group, scored = hard_negatives._Group(blocks, 8), []
    monkeypatch.setattr(group, "exact", lambda rows, q, f=group.exact: scored.append(len(rows)) or f(rows, q))
    rows, _ = group.positives(np.full(8, 255, np.int32), 1, -1, 0, 5)
    assert set(group.ids[rows]) <= set(range(1, 11)) and sum(scored) < 510
