"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's chance is logistic in its distinct words and their stems, which can
only raise it; the noisy-or of its sentences is the document's chance, and only
documents have labels.  The
gradient of the document's likelihood reaches each sentence through its share
in the noisy-or, so that training also finds which sentences offend.

Training takes at most ``max_docs`` labelled documents (a documented bound, the
ones with the smallest hash of their id) in one task; the weights are an array
of fixed size, which is broadcast.  Scoring is a map over all documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestead.llm.text import small_batches

BITS = 18
MAX_DOCS = 10_000
EPOCHS, RATE, DECAY, LEAST_DOCS, BATCH = 12, 1.0, 2e-5, 5, 256
BIAS = -8.0
CACHED = 200_000

_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def features(word: str) -> tuple[int, int, int]:
    """Hashed features of a word: itself and its first four and five letters."""
    w = word.lower()
    mask = (1 << BITS) - 1
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) & mask for x in ("w" + w, "4" + w[:4], "5" + w[:5]))


class _Words(dict):
    """Value of each word, computed at its first use; bounded."""

    def __init__(self, value):
        self.value = value

    def __missing__(self, word: str):
        if len(self) >= CACHED:
            self.clear()
        made = self[word] = self.value(word)
        return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _instances(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all sentences, the sentence of each feature and the document of each sentence."""
    known = _Words(features)
    feats, owner, docs, n = [], [], [], 0
    for d, text in enumerate(texts):
        words: set[str] = set()
        for token in [*_TOKEN.findall(text or ""), "\n"]:
            if token not in _ENDS:
                words.add(token)
            elif words:
                own = [f for w in sorted(words) for f in known[w]]
                feats.append(np.array(own, np.int32))
                owner.append(np.full(len(own), n, np.int32))
                docs.append(d)
                n, words = n + 1, set()
    empty = np.zeros(0, np.int32)
    return np.concatenate([empty, *feats]), np.concatenate([empty, *owner]), np.array(docs, np.int32)


def fit(texts: list[str | None], labels: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights of the features and the bias, by adaptive gradient steps on the noisy-or likelihood."""
    size = 1 << BITS
    weights, bias = np.zeros(size), BIAS
    feats, owner, docs = _instances(texts)
    if not len(docs) or not labels.any():
        return weights, bias
    # Features of few documents tell nothing about others.
    pairs = np.unique(docs[owner].astype(np.int64) << BITS | feats)
    seen = np.bincount(pairs & (size - 1), minlength=size) >= LEAST_DOCS
    keep = seen[feats]
    feats, owner = feats[keep], owner[keep]
    first = np.searchsorted(docs, np.arange(len(texts) + 1))  # sentences of each document
    start = np.searchsorted(owner, np.arange(len(docs) + 1))  # features of each sentence
    past, past_bias, random = np.full(size, 1e-8), 1e-8, np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for lot in range(0, len(order), BATCH):
            chosen = order[lot : lot + BATCH]
            sentences = np.concatenate([np.arange(first[d], first[d + 1]) for d in chosen])
            if not len(sentences):
                continue
            n = start[sentences + 1] - start[sentences]
            local = np.repeat(np.arange(len(sentences)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[sentences], n)
            f = feats[at]
            chance = _sigmoid(np.bincount(local, weights[f], len(sentences)) + bias)
            of = docs[sentences]
            none = np.zeros(len(texts))
            np.add.at(none, of, np.log1p(-np.minimum(chance, 1 - 1e-12)))
            clean = np.exp(none[of])
            y = labels[of]
            pull = chance * np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0) / len(chosen)
            touched, back = np.unique(f, return_inverse=True)
            grad = np.bincount(back, pull[local], len(touched)) - DECAY * weights[touched]
            past[touched] += grad**2
            weights[touched] = np.maximum(0.0, weights[touched] + RATE * grad / np.sqrt(past[touched]))
            g = pull.sum()
            past_bias += g * g
            bias += RATE * g / np.sqrt(past_bias)
    return weights, float(bias)


def train(labelled: DataFrame, max_docs: int = MAX_DOCS) -> tuple[np.ndarray, float]:
    """Weights and bias from (doc_id, text, label) rows; rows without a label are left out.

    Of more than ``max_docs`` rows the ones with the smallest hash of their id are taken.
    """
    rows = labelled.filter(F.col("label").isin(0, 1)).withColumn("h", F.xxhash64("doc_id", "text"))
    sample = rows.orderBy("h", "doc_id").limit(max_docs).select(
        "text", F.col("label").cast("int").alias("label"), "h", F.lit(0).alias("one")
    )

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h", kind="stable")
        weights, bias = fit(list(pdf["text"]), pdf["label"].to_numpy())
        return pd.DataFrame({"weights": [weights.astype("<f4").tobytes()], "bias": [bias]})

    got = sample.groupBy("one").applyInPandas(work, "weights binary, bias double").first()
    if got is None:
        return np.zeros(1 << BITS, "f4"), BIAS
    return np.frombuffer(got["weights"], "<f4"), got["bias"]


class _Scorer:
    """Scores texts with a logit for each word: the sum of its features' weights."""

    def __init__(self, weights: np.ndarray, bias: float, least: float):
        self.weights, self.bias, self.least = weights.astype(float).tolist(), bias, least
        self.logits = _Words(lambda w: np.nan if w in _ENDS else self._logit(w))

    def _logit(self, word: str) -> float:
        total = sum(self.weights[f] for f in features(word))
        return total if total >= 0.05 else 0.0

    def chances(self, text: str) -> np.ndarray:
        """The chance of each sentence with a word, in order."""
        tokens = _TOKEN.findall(text)
        values = np.fromiter(map(self.logits.__getitem__, tokens), float, len(tokens))
        word = np.flatnonzero(~np.isnan(values))
        if not len(word):
            return np.zeros(0)
        sentence = np.cumsum(np.r_[True, np.diff(word) > 1]) - 1  # an end lies between
        total = np.full(sentence[-1] + 1, self.bias)
        telling = np.flatnonzero(values[word] > 0)
        for s, w in {(s, tokens[i]) for s, i in zip(sentence[telling].tolist(), word[telling].tolist())}:
            total[s] += self.logits[w]
        # A sentence without a telling word has no chance, or a long clean text would add up to a toxic one.
        return np.where(total > self.bias, _sigmoid(total), 0.0)

    def score(self, text: str) -> tuple[float, list[dict]]:
        chances = self.chances(text)
        score = abs(float(np.expm1(np.log1p(-np.minimum(chances, 1 - 1e-12)).sum())))
        loud = np.flatnonzero(chances >= self.least)
        return score, self._spans(text, chances, set(loud.tolist())) if len(loud) else []

    def _spans(self, text: str, chances: np.ndarray, wanted: set[int]) -> list[dict]:
        out, k, start, end = [], 0, None, 0
        for m in _TOKEN.finditer(text + "\n"):
            if m[0] not in _ENDS:
                start, end = m.start() if start is None else start, m.end()
            elif start is not None:
                if k in wanted:
                    out.append({"start": start, "end": end, "chance": float(chances[k])})
                k, start = k + 1, None
        return out


def score(df: DataFrame, weights: np.ndarray, bias: float, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows with ``score`` and ``offending``: (start, end, chance) of sentences of chance ``least`` or more.

    Only the text is read.  Null and empty texts have no sentence and score 0.
    Offsets count code points.  Columns named like a result are replaced.
    """
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast((weights, bias))

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(*sent.value, least)
        for batch in batches:
            made = [scorer.score(value if isinstance(value, str) else "") for value in batch]
            yield pd.DataFrame(made, columns=["score", "offending"])

    schema = T.StructType.fromDDL("score double, offending array<struct<start:long, end:long, chance:double>>")
    made = F.pandas_udf(work, schema)(F.col(text)).alias("__made")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("score", "offending")]
    return df.select(*kept, made).select(*kept, "__made.score", "__made.offending")


def held_out(doc_id: str) -> Column:
    """True for ids whose documents never train; rows without an id never train nor test."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
