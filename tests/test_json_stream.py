"""Documents read item by item: any cut, any size, and what is no document."""

import io
import json
import tracemalloc

import pytest

from lodestead.sources import json_files, json_stream

DOCUMENT = {
    "a/x": [{"id": "1", "t": "ünï 😀 \\ \" ]}", "n": [1, {"k": [2.5e3, -0, True, None]}]}, 12, "text", None, [], {}],
    "é": [], "none": None, "number": 3, "object": {"k": [1]}, "b": [{"id": "2"}],
}


def items(text, piece):
    return [(k, json.loads(v)) for k, v in json_stream.document_items(io.BytesIO(text.encode()), piece)]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 20])
def test_items_of_a_document(piece):
    want = [(k, v) for k, values in DOCUMENT.items() if isinstance(values, list) for v in values]
    for text in (json.dumps(DOCUMENT), json.dumps(DOCUMENT, ensure_ascii=False, indent=3), f"﻿ {json.dumps(DOCUMENT)}\r\n\t "):
        assert items(text, piece) == want
    assert items(" {} ", piece) == [] and items('{"a": [123456789]}', piece) == [("a", 123456789)]


@pytest.mark.parametrize("piece", [1, 5, 1 << 20])
@pytest.mark.parametrize("text", [
    "", "[]", "null", '{"a": [1, 2}', '{"a": [1, 2]', '{"a": [1 2]}', '{"a": [1,]}', '{"a": [1]} x', '{"a" [1]}', "{'a': [1]}",
    '{"a": [1],}', '{1: [2]}', '{"a": [NaN]}', '{"a": ["cut', '{"a": [{"b": 1]}',
])
def test_what_is_no_document_raises(text, piece):
    with pytest.raises(ValueError):
        items(text, piece)


def test_memory_does_not_grow_with_the_document():
    """200 MB of one list: a piece and an item are held."""
    item = json.dumps({"id": "x" * 900, "n": list(range(20))}).encode()

    class Long(io.RawIOBase):
        left, parts = 200_000, [b'{"a/x": [', b"0]}", b""]

        def read(self, size):
            if not self.left or len(self.parts) == 3:
                return self.parts.pop(0)
            n = min(self.left, max(size // len(item), 1))
            self.left -= n
            return (item + b",") * n

    tracemalloc.start()
    n = sum(1 for _ in json_stream.document_items(Long()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200_001 and peak < 20_000_000


def test_files_are_read_by_task(spark, tmp_path):
    for name, document in (("a", DOCUMENT), ("b", {"c": [{"id": str(i)} for i in range(3000)]}), ("empty", {})):
        (tmp_path / f"{name}.json").write_text(json.dumps(document))
    (tmp_path / "nothing.json").write_text("")
    found = json_files.read_document_items(spark, f"{tmp_path}/*.json", piece=64)
    rows = [(r.key, json.loads(r["item"])) for r in found.collect()]
    assert len(rows) == 3007 and rows.count(("a/x", None)) == 1 and ("c", {"id": "2999"}) in rows
    typed = json_files.read_documents(spark, f"{tmp_path}/[b]*.json", "map<string,array<struct<id:string>>>", key="place")
    assert typed.columns == ["place", "id"] and typed.filter("id = '17' and place = 'c'").count() == 1
    (tmp_path / "bad.json").write_text(json.dumps({"d": [{"id": "1"}] * 5000})[:-1])
    with pytest.raises(Exception, match="not valid JSON"):
        json_files.read_document_items(spark, f"{tmp_path}/*.json").count()
    assert json_files.read_document_items(spark, f"{tmp_path}/*.json", on_bad="skip").count() == 3007
