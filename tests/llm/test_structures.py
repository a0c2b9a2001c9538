"""Conversations, links, vectors and the pipeline against brute force."""

import hashlib
import itertools
import math
import re
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from lodestead.llm import chat_format, graph, line_dedup, ngram_join, quality_rules, vector_dedup

SF_DIR = "/root/testdata/sf0.001"


# chats


def test_escape_is_reversible_and_leaves_no_control_string():
    pieces = ["<", "/", "s", ">", "\\", "</s>", "<s>", "[INST]", "[/INST]", "<|", "|>", "<|end|>", "x", "<<SYS>>", "[", "<"]
    for n in (1, 2, 3):
        for parts in itertools.product(pieces, repeat=n):
            text = "".join(parts)
            written = chat_format.escape(text)
            assert chat_format.unescape(written) == text
            assert not any(c in written for c in chat_format.CONTROL), written


def test_chats_read_back(spark):
    rows = [
        (1, 2, "assistant", "second <|end|> \\"), (1, 1, "user", None), (1, 1, "user", None), (2, None, None, "no number"),
        (None, 1, "assistant", "no conversation"), (2, 5, "assistant", ""), (2, 6, "assistant", "é😀</s>"), (3, 1, "a<|text|>b", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit(1))
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        learned = "".join(t or "" for _, _, r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


def test_parts_become_placeholders(spark):
    parts = [
        ("text", "see ", None, None, None, None, None), ("image", None, "a.png", 1024, 513, None, None), None,
        ("audio", None, "b.wav", None, None, 2.5, None), ("document", None, "c.pdf", None, None, None, 3),
        ("video", None, "d.mp4", None, None, None, None), (None, " end", None, None, None, None, None),
    ]
    schema = f"conv_id long, turn long, role string, content array<struct<{chat_format.PART_SCHEMA.replace(' ', ':').replace(',:', ',')}>>"
    df = spark.createDataFrame([(1, 1, "user", parts), (1, 2, "assistant", None), (1, 3, "assistant", [])], schema)
    got = chat_format.format_turns(df, "content").orderBy("turn").collect()
    body = got[0].formatted.split(chat_format.TEXT)[1].removesuffix(chat_format.END)
    assert body == "see <|image:1|><|audio:2|><|document:3|><|other:4|> end"
    assert [(a.kind, a.uri, a.tokens) for a in got[0].attachments] == [
        ("image", "a.png", 85 + 170 * 4), ("audio", "b.wav", 63), ("document", "c.pdf", 1800), ("other", "d.mp4", 0),
    ]
    for a in got[0].attachments:
        assert got[0].formatted[a.position :].startswith(f"<|{a.kind}")
    assert got[0].n_expanded == 85 + 170 * 4 + 63 + 1800 and got[0].loss_start is None
    assert got[1].loss_start == got[1].loss_end and got[1].n_chars == len(got[1].formatted)


# components


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2001 + i) for i in range(50)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    assert {r.id: r.component for r in graph.connected_components(df).collect()} == {x: find(x) for x in parent}
    assert graph.connected_components(df.limit(0)).count() == 0


# vectors


@pytest.mark.parametrize("block", [512, 7])
def test_vectors(spark, block):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        base = rng.normal(size=6) if i % 3 else np.ones(6) + rng.normal(scale=0.2, size=6)
        rows.append((i, base.tolist(), i % 4))
    rows += [(300 + i, rows[9][1], rows[9][2]) for i in range(20)]  # copies
    rows += [(400, (np.array(rows[9][1]) * 1e-200).tolist(), rows[9][2]), (401, (np.array(rows[9][1]) * 3).tolist(), rows[9][2])]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 6, 1), (503, [1.0, None, 2.0, 1.0, 1.0, 1.0], 1), (504, [float("nan")] * 6, 1)]
    rows += [(505, [float("inf")] * 6, 1), (506, [1.0] * 6, None), (507, [1.0] * 5, 1), (508, [1.0] * 5, 1), (None, [1.0] * 6, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("own"))

    def solid(e, label):
        return e and label is not None and all(x is not None and math.isfinite(x) for x in e) and any(e)

    ok = [(i, np.array(e) / max(map(abs, e)), y) for i, e, y in rows if i is not None and solid(e, y)]
    links = {i: set() for i, *_ in rows}
    for (a, u, x), (b, v, y) in itertools.combinations(ok, 2):
        if x == y and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.93:
            links[a].add(b)
            links[b].add(a)
    component = {}
    for i in sorted(x for x in links if x is not None):
        stack = [i]
        while stack:
            x = stack.pop()
            if x not in component:
                component[x] = i
                stack += links[x]
    got = vector_dedup.near_duplicates(df, block=block).collect()
    want = [(i, len(links[i]) if i is not None else 0, component.get(i), i == component.get(i)) for i, *_ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert vector_dedup.near_duplicates(df.limit(0)).count() == 0


# pipeline


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    judged = quality_rules.judge(docs)
    ruled = stage["quality rules"](spark, docs, SF_DIR)
    assert ruled.columns == docs.columns
    assert ruled.count() == judged.filter("kept").count() < docs.count()
    lined = stage["line dedup"](spark, ruled, SF_DIR).cache()
    assert lined.columns == docs.columns and lined.count() == ruled.count()
    assert lined.filter("n_chars <> length(text)").count() == 0
    assert line_dedup.remove_boilerplate(lined).count() == lined.count()
    single = stage["n-gram near duplicates"](spark, lined, SF_DIR).cache()
    groups = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(lined).collect()}
    assert sorted(r.doc_id for r in single.select("doc_id").collect()) == sorted(set(groups.values()))
    taken = stage["mixing"](spark, single, SF_DIR).cache()
    assert taken.columns == docs.columns
    per = taken.groupBy("doc_id").count().collect()
    assert all(r["count"] <= 2 for r in per) and {r.doc_id for r in per} <= {r.doc_id for r in single.collect()}
    out = stage["sentencepiece"](spark, taken, SF_DIR)
    assert out.count() == taken.count()


def test_stages_take_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "the cat of the house " * 30, "en", None, None), (None, None, None, None, None), (1, "", "en", "s", 0)]
    words = "the and of to in that is was for with on as at by from this be are not have"
    rows += [(2, words + " we will go there now", "en", "s", 1), (2, words + " we will go there now", "en", "s", 1), (3, words + " We will go there now", "en", "t", 1)]
    for docs, n in ((spark.createDataFrame([], schema), 0), (spark.createDataFrame(rows, schema), 2)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:3]:
            kept = stage(spark, kept, SF_DIR)
            assert kept.columns == docs.columns
        assert kept.filter("doc_id is not null").count() == (1 if n else 0)
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, SF_DIR)
        docs.count()


def test_near_copies_share_four_fifths_of_five_words(spark):
    base = [f"w{i}" for i in range(1000)]
    inserted = base[:500] + [f"i{i}" for i in range(200)] + base[500:]
    appended = base + [f"a{i}" for i in range(240)]
    scattered = [f"s{i}" if i % 45 == 22 and i < 990 else w for i, w in enumerate(base)]
    far = base + [f"f{i}" for i in range(260)]

    def jaccard(a, b, n):
        x, y = ({tuple(t[i : i + n]) for i in range(len(t) - n + 1)} for t in (a, b))
        return len(x & y) / len(x | y)

    for copy in (inserted, appended, scattered):
        assert jaccard(base, copy, 5) >= 0.8 and jaccard(base, copy, 4) < 0.85
    assert jaccard(base, far, 5) < 0.8
    rows = []
    for i, copy in enumerate((inserted, appended, scattered, far)):  # each pair in words of its own
        rows += [(10 * i + k, " ".join(f"{i}{w}" for w in text), "en", "s", 0) for k, text in enumerate((base, copy))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 10, 20, 30, 31]


def good(text):
    """The quality rules in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip()]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    n = len(words)
    return (
        n >= 20 and 100 * len(covered) <= 30 * n and 2 * n <= sum(map(len, words)) <= 15 * n
        and 4 * len(re.findall(r"[#*$%&|<>]", text)) <= n and 4 * text.count("!") <= n
        and (n < 50 or 100 * sum(w in quality_rules.STOP_WORDS for w in words) >= 2 * n)
        and 2 * (len(lines) - len(set(lines))) <= len(lines)
    )


def smallest_of_groups(texts):
    """Ids that stay: the smallest of each component of texts with 5-word Jaccard of 0.8 and more."""
    sets = {}
    for i, t in texts.items():
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    low = {i: i for i in texts}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if (x := len(sets[a] & sets[b])) and 10 * x >= 8 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return {i for i in texts if low[i] == i}


def test_stages_against_plain_python(spark):
    rng = np.random.default_rng(6)
    said = ["the", "of", "and", *(f"w{i}" for i in range(400))]
    texts = []
    for i in range(24):
        w = ["the", *rng.choice(said, 119), "end"]
        changed, far = list(w), list(w)
        changed[60] = "changed"
        for k in range(10, 110, 15):
            far[k] = "far"
        longer = w + [f"more{i}-{k}" for k in range(18)]  # 5-word Jaccard above 0.8, 4-word below 0.85
        texts += [" ".join(x) for x in (w, (changed, far, longer, w)[i % 4])]
    bad = ["too few", "the " + "ab cd " * 40, "the and of " + "w! " * 30, "# $ " * 20 + "the of", "x" * 700 + " the" * 21, " ".join(f"v{i}" for i in range(60))]
    bad += ["\n".join(["one line of the house"] * 6)]
    texts = [
        f"a line that stands on all sites\n{t}\n  on nine sites only  {'' if i % 12 < 9 else i}\nshort" for i, t in enumerate(texts)
    ] + bad
    rows = [(i, t, "en", f"site{i % 12}", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    stage = dict(corpus_pipeline.STAGES)

    ruled = stage["quality rules"](spark, docs, SF_DIR).cache()
    want = [r for r in rows if good(r[1])]
    assert sorted(map(tuple, ruled.collect())) == want and 40 < len(want) < len(rows)

    lined = stage["line dedup"](spark, ruled, SF_DIR).cache()
    sites = {}
    for _, t, _, site, _ in want:
        for line in t.split("\n"):
            sites.setdefault(line.strip(" "), set()).add(site)
    common = {x for x, on in sites.items() if len(x) >= 10 and len(on) >= 10}
    assert common == {"a line that stands on all sites"}
    kept = [(i, "\n".join(x for x in t.split("\n") if x.strip(" ") not in common), lang, site) for i, t, lang, site, _ in want]
    want = [(*r, len(r[1])) for r in kept]
    assert sorted(map(tuple, lined.collect())) == want

    single = stage["n-gram near duplicates"](spark, lined, SF_DIR).cache()
    stay = smallest_of_groups({r[0]: r[1] for r in want})
    want = [r for r in want if r[0] in stay]
    assert sorted(map(tuple, single.collect())) == want and len(want) < len(kept)

    taken = stage["mixing"](spark, single, SF_DIR).cache()
    copies = Counter(map(tuple, taken.collect()))
    assert copies and set(copies) <= set(want) and max(copies.values()) <= 2

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    told = []
    for r in copies.elements():
        ids = library.encode(r[1], add_bos=True, add_eos=True)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        told.append((r[0], len(ids), sha(array("I", ids).tobytes()), sha(library.decode(ids).encode())))
    assert sorted(map(tuple, stage["sentencepiece"](spark, taken, SF_DIR).collect())) == sorted(told)


def test_run_gives_token_digests(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 50


# ids with several texts


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_links_of_texts_that_share_an_id(spark, parts):
    """(3, X) (5, X) | (5, Y) | (9, near Y): 9 is linked to 3 by way of 5, however the rows are dealt."""
    x, y = " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(3, x), (5, x), (5, y), (9, y + " end"), (11, " ".join(f"z{i}" for i in range(60)))]
    for order in (rows, rows[::-1], [rows[i] for i in (2, 0, 3, 1, 4)]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1).repartition(parts)
        got = ngram_join.near_duplicates(df).collect()
        assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (5, 3), (9, 3), (11, 11)}


def test_unlike_texts_under_one_id_stay(spark):
    x, y = " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(3, x, 1), (5, x + " end", 2), (5, y, 3), (9, y, 4), (9, y, 4), (3, y + " end", 5), (None, x, 6), (7, "", 7), (7, "", 7), (8, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumn("hash", F.lit("own"))
    kept = ngram_join.one_of_each_group(df, 5, 80)
    assert kept.columns == df.columns
    assert sorted(r.n for r in kept.collect()) == [1, 5, 6, 7, 7, 8]
    repeated = ngram_join.one_of_each_group(df.filter("doc_id = 9"), 5, 80)
    assert [r.n for r in repeated.collect()] == [4] and ngram_join.one_of_each_group(df.limit(0), 5, 80).count() == 0
