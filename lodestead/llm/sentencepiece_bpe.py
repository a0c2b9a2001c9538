"""Encoding and decoding with a merge-type (BPE) sentencepiece vocabulary by a prefix table.

For every prefix of a stretch of text the merges end in exactly one last token.
The table of these tokens is filled from left to right: an automaton gives the
pieces that end at a place, and a piece is the last token there if the merges
keep it whole and keep it apart from the last token of the prefix before it.
The ids are then read off backwards.  Work is linear in the text; stretches that
come again (words with their leading space) are looked up in a bounded cache.

The vocabulary is read once on the driver and broadcast: its size is fixed.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.llm.text import small_batches

SPACE = "▁"
#: Stretches and pairs of tokens that a worker remembers.
CACHED, PAIRS = 100_000, 250_000
#: Texts whose results a worker holds at a time.
SLICE = 256
_PROBE = " Á  ﬁ\t½　\n "


class Vocabulary:
    """Pieces, scores and special ids of a model; plain data, so that it can be sent to executors."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if model.normalize(_PROBE) != SPACE + _PROBE.replace(" ", SPACE):
            raise ValueError("only models that leave texts as they are, with a space in front, can be read")
        ids = range(model.get_piece_size())
        self.path = model_path
        self.pieces = model.id_to_piece(list(ids))
        self.control = [i for i in ids if model.is_control(i) or model.is_unknown(i)]
        self.bytes = [i for i in ids if model.is_byte(i)]
        special = {*self.control, *self.bytes, *(i for i in ids if model.is_unused(i))}
        self.scores = {self.pieces[i]: (model.get_score(i), i) for i in ids if i not in special}
        self.begin, self.end = model.bos_id(), model.eos_id()
        if len(self.bytes) != 256:
            raise ValueError("only models with a piece for every byte can be read")


class Encoder:
    """Encodes texts with one vocabulary; a worker process keeps one."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.ids = {p: i for p, (_, i) in vocabulary.scores.items()}
        self.byte_id = {int(vocabulary.pieces[i][3:5], 16): i for i in vocabulary.bytes}
        self.surface = [p.replace(SPACE, " ").encode() for p in vocabulary.pieces]
        for i in vocabulary.control:
            self.surface[i] = b""
        for byte, i in self.byte_id.items():
            self.surface[i] = bytes([byte])
        self.automaton = ahocorasick.Automaton()
        self.steps: dict[int, list[tuple[float, str, str]]] = {}
        for piece, i in self.ids.items():
            parts, steps = self.merges(piece)
            if len(parts) == 1:  # the others are never produced
                self.steps[i] = steps
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        known = {p for p in self.ids if len(p) == 1}
        self.foreign = re.compile("([^" + "".join(map(re.escape, sorted(known))) + "])")
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        line = "" if any("\n" in p for p in self.ids) else "\n"
        # No piece crosses from other characters to a space, or over a line's end.
        self.stretch = re.compile(f".+(?s:.)*" if inner else f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + (line and f"|{line}"))
        self.together: dict[int, bool] = {}
        self.known_stretches: dict[str, bytes] = {}

    def merges(self, piece: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """What the merges leave of a piece (the best score first, then the leftmost), and each one's score and outer parts."""
        parts, scores, steps = list(piece), self.v.scores, []
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = scores.get(parts[k] + parts[k + 1])
                if found and (best is None or found[0] > best):
                    best, at = found[0], k
            if at < 0:
                return parts, steps
            parts[at : at + 2] = [sys.intern(parts[at] + parts[at + 1])]
            steps.append((best, parts[0], parts[-1]))

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges keep two tokens that stand side by side apart.

        The steps of both run side by side; a merge across the border would
        come before the steps that it outscores, and the leftmost wins a tie.
        """
        ours, theirs = self.steps[left], self.steps[right]
        scores, i, k = self.v.scores, 0, 0
        a, b = self.v.pieces[left][-1], self.v.pieces[right][0]
        while True:
            one = ours[i][0] if i < len(ours) else None
            two = theirs[k][0] if k < len(theirs) else None
            across = scores.get(a + b)
            if across and (one is None or across[0] > one) and (two is None or across[0] >= two):
                return False
            if one is not None and (two is None or one >= two):
                a, i = ours[i][2], i + 1
            elif two is not None:
                b, k = theirs[k][1], k + 1
            else:
                return True

    def _table(self, text: str) -> list[int]:
        """Ids of a stretch of known characters."""
        last, size = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        together, n = self.together, len(self.v.pieces)
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if size[end]:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                pair = before * n + token
                fits = together.get(pair)
                if fits is None:
                    if len(together) >= PAIRS:
                        together.clear()
                    fits = together[pair] = self.compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        ids, end = [], len(text)
        while end:
            ids.append(last[end])
            end -= size[end]
        return ids[::-1]

    def _stretch(self, text: str) -> bytes:
        ids = array("I")
        for k, part in enumerate(self.foreign.split(text)):
            if k % 2:
                ids.extend(self.byte_id[b] for b in part.encode("utf-8"))
            elif part:
                ids.extend(self._table(part))
        return ids.tobytes()

    def encode(self, text: str | None) -> bytes:
        """Begin id, ids and end id as little-endian unsigned 32-bit integers; null is empty."""
        cache, out = self.known_stretches, [array("I", [self.v.begin]).tobytes()]
        for stretch in self.stretch.findall(SPACE + text.replace(" ", SPACE)) if text else ():
            ids = cache.get(stretch)
            if ids is None:
                ids = self._stretch(stretch)
                if len(stretch) <= 64:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[stretch] = ids
            out.append(ids)
        out.append(array("I", [self.v.end]).tobytes())
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids, without the space put in front; null is empty."""
        surface = self.surface
        text = b"".join([surface[i] for i in array("I", ids or b"")])
        return text.removeprefix(b" ").decode("utf-8", "replace")


def _slices(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.iloc[at : at + SLICE]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary.path] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.path]


class Tokenizer:
    """Columns of ids and texts for a model file that the driver can read."""

    def __init__(self, spark: SparkSession, model_path: str):
        small_batches(spark)
        sent = spark.sparkContext.broadcast(Vocabulary(model_path))

        def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = _encoder(sent.value)
            for part in _slices(texts):
                yield pd.Series([own.encode(t) for t in part], dtype=object)

        def decode(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = _encoder(sent.value)
            for part in _slices(ids):
                yield pd.Series([own.decode(x) for x in part], dtype=object)

        def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            own = _encoder(sent.value)
            for part in _slices(texts):
                ids = [own.encode(t) for t in part]
                yield pd.DataFrame({"ids": ids, "text": [own.decode(x) for x in ids]}, dtype=object)

        self._encode, self._decode = F.pandas_udf(encode, "binary"), F.pandas_udf(decode, "string")
        self._both = F.pandas_udf(both, "ids binary, text string")

    def encode(self, text: str | Column) -> Column:
        """Ids of a text with begin and end, as a binary of little-endian unsigned 32-bit integers."""
        return self._encode(text)

    def decode(self, ids: str | Column) -> Column:
        return self._decode(ids)

    def round_trip(self, text: str | Column) -> Column:
        """A struct of the ids and of the text decoded from them, in one pass through a worker."""
        return self._both(text)


def with_ids(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with their ids.  Null and empty texts have begin and end only; other columns pass through."""
    return df.withColumn(ids, Tokenizer(df.sparkSession, model_path).encode(F.col(text)))


def token_digests(df: DataFrame, model_path: str, *keys: str, text: str = "text") -> DataFrame:
    """Keys, number of ids, digest of the ids, digest of the text decoded from them; a row for each row."""
    coded = df.select(*keys, Tokenizer(df.sparkSession, model_path).round_trip(F.col(text)).alias("__coded"))
    return coded.select(
        *keys,
        (F.octet_length("__coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("__coded.ids", 256).alias("ids_sha256"),
        F.sha2("__coded.text", 256).alias("decoded_sha256"),
    )
