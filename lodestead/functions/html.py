"""HTML to text.  Spark has no HTML parser, so this is the one Python step."""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags whose text is not page text.
_HIDDEN = {"script", "style", "template", "rt", "rp"}
_KEEP_SPACE = {"pre", "textarea"}


class _TextNodes(HTMLParser):
    """Collects the text between tags, one entry per text node."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self._open: list[str] = []
        self._node: list[str] = []

    def _end_node(self) -> None:
        text = "".join(self._node)
        self._node = []
        if not text or any(t in _HIDDEN for t in self._open):
            return
        if not text.strip() and not any(t in _KEEP_SPACE for t in self._open):
            text = "\n" if "\n" in text else " "
        self.nodes.append(text)

    def handle_starttag(self, tag, attrs):
        self._end_node()
        if tag in _HIDDEN or tag in _KEEP_SPACE:
            self._open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._end_node()

    def handle_endtag(self, tag):
        self._end_node()
        if tag in self._open:
            while self._open.pop() != tag:
                pass

    def handle_data(self, data):
        self._node.append(data)

    def handle_comment(self, data):
        self._end_node()

    def handle_decl(self, decl):
        self._end_node()

    def unknown_decl(self, data):
        self._end_node()
        if data.upper().startswith("CDATA["):
            self._node.append(data[len("CDATA["):])
            self._end_node()

    def handle_pi(self, data):
        self._end_node()


def text_nodes(html: str) -> list[str]:
    parser = _TextNodes()
    parser.feed(html)
    parser.close()
    parser._end_node()
    return parser.nodes


def _one_line(html: str | None) -> str:
    if not html:
        return ""
    return " ".join(text_nodes(html)).replace("\n", " ").strip()


def _lines(html: str | None) -> str:
    if not html:
        return ""
    stripped = (n.strip() for n in text_nodes(html))
    return re.sub(r"\n{2,}", "\n", "\n".join(n for n in stripped if n))


def _one_line_batch(html: pd.Series) -> pd.Series:
    return html.map(_one_line, na_action=None)


def _lines_batch(html: pd.Series) -> pd.Series:
    return html.map(_lines, na_action=None)


def html_to_line(c: Column) -> Column:
    """All text on one line, nodes separated by a space; null gives empty text."""
    return F.pandas_udf(_one_line_batch, "string")(c)


def html_to_lines(c: Column) -> Column:
    """One line per text node; null gives empty text."""
    return F.pandas_udf(_lines_batch, "string")(c)


# Send the helpers with the task, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
