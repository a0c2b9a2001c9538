"""JSON documents of any size, read item by item.

A document ``{key: [item, ...], ...}`` is one file.  It is decoded in pieces,
and a task holds a piece and an item at a time, so neither the file nor a list
need fit into memory.  Python because Spark's readers take a document as one
value, which ends at 2 GB.  Files lie in any store that Arrow can open.
"""

from __future__ import annotations

import codecs
import json
import sys
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PIECE, ROWS = 1 << 20, 1000
_SPACE = " \t\n\r"


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


class _Text:
    """The part of a document that is held, and a place in it."""

    def __init__(self, stream: BinaryIO, piece: int):
        self.stream, self.piece = stream, piece
        self.decode = codecs.getincrementaldecoder("utf-8-sig")().decode
        self.json = json.JSONDecoder(parse_constant=_no_constant)
        self.held, self.at, self.ended = "", 0, False

    def more(self, size: int) -> None:
        data = self.stream.read(size)
        self.ended = not data
        self.held, self.at = self.held[self.at :] + self.decode(data, self.ended), 0

    def next_sign(self) -> str:
        """The next character that is not white space, which stays; empty at the end."""
        while True:
            while self.at < len(self.held) and self.held[self.at] in _SPACE:
                self.at += 1
            if self.at < len(self.held):
                return self.held[self.at]
            if self.ended:
                return ""
            self.more(self.piece)

    def take(self, signs: str) -> str:
        found = self.next_sign()
        if not found or found not in signs:
            raise ValueError(f"expected one of {signs!r}, found {found!r}")
        self.at += 1
        return found

    def value(self) -> tuple[object, str]:
        """The next value and its text.  More is read, twice as much each time, until the value is whole."""
        self.next_sign()
        size = self.piece
        while True:
            try:
                found, end = self.json.raw_decode(self.held, self.at)
                if end < len(self.held) or self.ended:  # a number could go on
                    text, self.at = self.held[self.at : end], end
                    return found, text
            except json.JSONDecodeError:
                if self.ended:
                    raise
            self.more(size)
            size *= 2


def document_items(stream: BinaryIO, piece: int = PIECE) -> Iterator[tuple[str, str]]:
    """(key, text of an item) of a document; a key whose value is no list has none.  Raises where it is no such document."""
    text = _Text(stream, piece)
    text.take("{")
    if text.next_sign() == "}":
        text.take("}")
    else:
        while True:
            if text.next_sign() != '"':
                raise ValueError("a key is no text")
            key, _ = text.value()
            text.take(":")
            if text.next_sign() == "[":
                text.take("[")
                if text.next_sign() == "]":
                    text.take("]")
                else:
                    while True:
                        yield key, text.value()[1]
                        if text.take(",]") == "]":
                            break
            else:
                text.value()
            if text.take(",}") == "}":
                break
    if text.next_sign():
        raise ValueError("text behind the document")


def _open(uri: str) -> BinaryIO:
    """Paths come as Spark lists them, where a space is a space."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        path = rest or uri
        return fs.LocalFileSystem().open_input_stream("/" + path.lstrip("/"))
    place, _, path = rest.removeprefix("//").partition("/")
    store, root = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{place}/")
    return store.open_input_stream(f"{root.rstrip('/')}/{path}")


def is_document(uri: str, piece: int = PIECE) -> bool:
    try:
        with _open(uri) as stream:
            for _ in document_items(stream, piece):
                pass
        return True
    except ValueError:
        return False


class _File(InputPartition):
    def __init__(self, uri: str):
        self.uri = uri


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files = json.loads(options["files"])
        self.skip = options.get("on_bad", "fail") == "skip"
        self.piece = int(options.get("piece", PIECE))

    def partitions(self) -> list[_File]:
        return [_File(f) for f in self.files] or [_File("")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        names = ["path", "key", "item"]
        # What is left out as a whole is read to its end first.
        if not partition.uri or (self.skip and not is_document(partition.uri, self.piece)):
            return
        with _open(partition.uri) as stream:
            keys, items, size = [], [], 0

            def batch() -> pa.RecordBatch:
                texts = ([partition.uri] * len(keys), keys, items)
                return pa.RecordBatch.from_arrays([pa.array(t, pa.string()) for t in texts], names)

            try:
                for key, item in document_items(stream, self.piece):
                    keys.append(key)
                    items.append(item)
                    size += len(item)
                    if len(keys) == ROWS or size > 4 * PIECE:
                        yield batch()
                        keys, items, size = [], [], 0
            except ValueError as error:
                raise ValueError(f"{partition.uri}: a document is not valid JSON: {error}") from error
            if keys:
                yield batch()


class JsonDocuments(DataSource):
    """``spark.read.format("json_documents")``: one row (path, key, item) for each item, a task for each file.

    Options: ``files``, a JSON list of file URIs; ``on_bad``, ``fail`` or ``skip``; ``piece``, bytes read at once.
    """

    @classmethod
    def name(cls) -> str:
        return "json_documents"

    def schema(self) -> str:
        return "path string, key string, item string"

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


# Send the reader with the task, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
