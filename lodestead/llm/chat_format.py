"""Chat formatting: typed content parts flattened into text with placeholders, a loss mask and attachments.

A turn is one row; its content is a text, or a list of typed parts.  A visitor
has one method for each type and writes the parts in order.  Control strings
that occur inside texts are broken by an escape character, so that only the
template's own marks remain and the text can be read back exactly.

Formatting is a map over rows.  Only the order of a conversation's turns needs
a shuffle: rows are dealt by conversation and sorted inside each task, and a
conversation is then read as a stream, so that its length is not bounded by
memory.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestead.llm.text import small_batches

#: The template's marks.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that other templates read as control; none may stand in a formatted text but the template's own marks.
CONTROL = ("<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|")
ESCAPE = "\\"

#: Tokens that placeholders stand for: image tiles of 512 x 512 and one overview, 25 a second of sound, 600 a page.
TILE, TILE_TOKENS, IMAGE_BASE, AUDIO_TOKENS, PAGE_TOKENS = 512, 170, 85, 25, 600

PART_SCHEMA = "type string, text string, uri string, width int, height int, seconds double, pages int"
TURN_SCHEMA = (
    "formatted string, n_chars long, loss_start long, loss_end long, n_expanded long, "
    "attachments array<struct<kind:string, uri:string, position:long, tokens:long>>"
)

_CONTROL = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROL))))
_ESCAPED = re.compile(re.escape(ESCAPE) + "(" + re.escape(ESCAPE) + "?)")


def escape(text: str) -> str:
    """Breaks control strings after their first character and doubles the escape character."""
    return _CONTROL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of one turn; unknown types are written as a placeholder of no tokens."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.length = self.expanded = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "uri": part.get("uri"), "position": self.length, "tokens": tokens})
        self.expanded += tokens
        self._write(f"<|{kind}:{len(self.attachments)}|>")

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        tiles = math.ceil(_number(part, "width") / TILE) * math.ceil(_number(part, "height") / TILE)
        self._attach("image", part, IMAGE_BASE + TILE_TOKENS * tiles)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(_number(part, "seconds") * AUDIO_TOKENS))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, int(_number(part, "pages")) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 0)


def _number(part: dict, name: str) -> float:
    value = part.get(name)
    return float(value) if value is not None and value == value and 0 <= value < 1e12 else 0.0


def format_turn(role: str | None, parts) -> dict:
    """One turn as text, where its loss lies in it, and its attachments."""
    flat = Flattener()
    for part in parts:
        if part is not None:
            flat.visit(part)
    head, body = f"{TURN}{escape(role or '')}{TEXT}", "".join(flat.out)
    start, learned = len(head), role == "assistant"
    for a in flat.attachments:
        a["position"] += start
    return {
        "formatted": f"{head}{body}{END}",
        "n_chars": start + len(body) + len(END),
        "loss_start": start if learned else None,
        "loss_end": start + len(body) if learned else None,
        "n_expanded": flat.expanded,
        "attachments": flat.attachments,
    }


def format_turns(df: DataFrame, content: str = "text") -> DataFrame:
    """(conv_id, turn, role) with the formatted turn, for each row.

    ``content`` is a string or an array of parts (``PART_SCHEMA``).  Null
    content is empty, null parts are skipped, a null role is written as an
    empty one; offsets count code points.  Repeated rows are turns of their own.
    """
    small_batches(df.sparkSession)
    plain = df.schema[content].dataType.simpleString() == "string"
    # Ids travel in a struct: in a column of their own nulls would turn them to floats.
    key = F.struct("conv_id", "turn", "role").alias("key")
    rows = df.select(key, F.col(content).alias("content"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = ([{"text": c}] if plain else list(c) if c is not None else [] for c in batch["content"])
            made = [format_turn(k["role"], c) for k, c in zip(batch["key"], texts)]
            out = pd.DataFrame(made, columns=["formatted", "n_chars", "loss_start", "loss_end", "n_expanded", "attachments"])
            for name in ("loss_start", "loss_end"):
                out[name] = out[name].astype("Int64")
            out.insert(0, "key", batch["key"].to_numpy())
            yield out

    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL(TURN_SCHEMA).fields])
    return rows.mapInPandas(work, schema).select("key.*", *[f.name for f in schema.fields[1:]])


def _text(value) -> str | None:
    return value if isinstance(value, str) else None


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, _, body = formatted.removeprefix(TURN).removesuffix(END).partition(TEXT)
    return unescape(role), unescape(body)


def read_back(turns: DataFrame) -> DataFrame:
    """A row for each conversation, read from its formatted turns in order.

    Turns with equal numbers go by role and text; rows without a conversation
    are one conversation of their own, rows without a number come first.
    Memory is bounded by one batch of turns, not by a conversation.
    """
    # The schemas' nullable integers would turn to floats in pandas: ids travel as text.
    rows = turns.select(
        F.col("conv_id").cast("string").alias("conv"), "turn", "role", "formatted", "loss_start", "loss_end"
    )
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "formatted")
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_conv, state = None, None

        def closed():
            conv, n, turns_digest, learned, loss_digest, chars = state
            return (conv, n, turns_digest.hexdigest(), learned, loss_digest.hexdigest(), chars)

        for batch in batches:
            done = []
            for conv, text, start, end in zip(batch["conv"], batch["formatted"], batch["loss_start"], batch["loss_end"]):
                conv = _text(conv)
                if state is None or conv != open_conv:
                    if state is not None:
                        done.append(closed())
                    open_conv, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if start == start and start is not None:
                    learned = unescape(text[int(start) : int(end)])
                    state[3] += len(learned)
                    state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield pd.DataFrame(done, columns=columns)
        if state is not None:
            yield pd.DataFrame([closed()], columns=columns)

    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    read = dealt.mapInPandas(work, schema)
    return read.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))
