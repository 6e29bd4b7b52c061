"""Tables and links of HTML by one pass over its tags with a stack of open elements.

For markup that patterns cannot take apart: tables in cells, cells and rows without an end tag, links that hold other
elements of their kind. The scan is linear in the text, also where quotes or tags are never closed.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_RAW = frozenset(("script", "style"))


def tags(text: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, rest)``: kind ``text`` (rest is the text), ``open`` (rest are the attributes) or ``close``."""
    at, size = 0, len(text)
    last = {quote: text.rfind(quote) for quote in "\"'"}
    folded = None
    while at < size:
        start = text.find("<", at)
        if start < 0:
            yield "text", "", text[at:]
            return
        if start > at:
            yield "text", "", text[at:start]
        if text.startswith("<!--", start):
            end = text.find("-->", start + 4)
            if end < 0:
                return
            at = end + 3
            continue
        found = _NAME.match(text, start)
        if not found:
            if text[start + 1:start + 2] in ("!", "?"):
                end = text.find(">", start)
                at = size if end < 0 else end + 1
            else:
                yield "text", "", "<"
                at = start + 1
            continue
        end = found.end()
        while True:
            end = _PLAIN.match(text, end).end()
            if end >= size or text[end] == ">":
                break
            # a quote without a second one is a letter like others
            end = text.find(text[end], end + 1) + 1 if last[text[end]] > end else end + 1
        if end >= size:  # a tag that the end of the text cuts off is none
            return
        name, closing = found[1].lower(), text[start + 1] == "/"
        yield "close" if closing else "open", name, text[found.end():end]
        at = end + 1
        if name in _RAW and not closing:
            folded = text.lower() if folded is None and len(text.lower()) == size else folded
            end = (folded or text).find(f"</{name}", at)
            if end < 0:
                return
            at = end


def attributes(rest: str) -> dict[str, str]:
    """Attributes by lower-case name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(rest):
        out.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return out


class _Table:
    def __init__(self, number: int, parent: int):
        self.number, self.parent = number, parent
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def close_cell(self) -> None:
        if self.cell is not None:
            self.rows[-1].append(references.unescape("".join(self.cell)).strip())
            self.cell = None


def table_rows(text: str) -> list[tuple[int, int, int, list[str]]]:
    """``(table, parent, row, cells)`` of all tables, numbered as they begin; the parent of an outer table is -1.

    Cells are the texts of ``td``, without those of tables inside them; a line break of the markup is one of the text. A new
    cell, row or the end of the table closes what is open.
    """
    done: list[_Table] = []
    open_tables: list[_Table] = []
    for kind, name, rest in tags(text):
        if name == "table" and kind == "open":
            open_tables.append(_Table(len(done), open_tables[-1].number if open_tables else -1))
            done.append(open_tables[-1])
            continue
        if not open_tables:
            continue
        table = open_tables[-1]
        if kind == "text":
            if table.cell is not None:
                table.cell.append(rest)
        elif name == "br" and kind == "open":
            if table.cell is not None:
                table.cell.append("\n")
        elif name in ("tr", "td", "th", "tbody", "thead", "tfoot", "table", "caption"):
            table.close_cell()
            if name == "table":
                open_tables.pop()
            elif name == "tr" and kind == "open":
                table.rows.append([])
            elif name == "td" and kind == "open":
                if not table.rows:
                    table.rows.append([])
                table.cell = []
    for table in open_tables:
        table.close_cell()
    return [(t.number, t.parent, i, cells) for t in done for i, cells in enumerate(t.rows)]


def links(text: str) -> list[tuple[str, str, str, str]]:
    """``(source, raw, text, title)`` of each ``a`` with a ``href`` and each ``a`` or ``div`` with an ``onclick``, as they begin.

    The text of an element is all text up to its own end tag, also that of elements of its kind inside it; pieces between
    tags are stripped. A new ``a`` ends an open one, and an element without an end tag ends with the one around it.
    """
    pieces: list[str] = []
    found: list[list] = []
    stack: list[tuple[str, int, list[int]]] = []  # name, place of the first piece, links that it is

    opened = {"a": 0, "div": 0}

    def close() -> None:
        name, first, mine = stack.pop()
        opened[name] -= 1
        for i in mine:
            found[i][2] = references.unescape("".join(pieces[first:]))

    for kind, name, rest in tags(text):
        if kind == "text":
            pieces.append(rest.strip())
        elif name in ("a", "div"):
            if kind == "close" and opened[name]:  # ends the innermost one, and what is still open in it
                while stack[-1][0] != name:
                    close()
                close()
            if kind == "open" and name == "a" and stack and stack[-1][0] == "a":
                close()
            if kind == "open":
                given = attributes(rest)
                mine = []
                for source in ("href", "onclick"):
                    if source in given and (source == "onclick" or name == "a"):
                        mine.append(len(found))
                        found.append([source, references.unescape(given[source]), "", references.unescape(given.get("title", ""))])
                stack.append((name, len(pieces), mine))
                opened[name] += 1
    while stack:
        close()
    return [tuple(link) for link in found]


_TEXT, _INT = T.StringType(), T.IntegerType()
_ROWS = T.ArrayType(T.StructType([T.StructField("table", _INT), T.StructField("parent", _INT), T.StructField("row", _INT),
                                  T.StructField("cells", T.ArrayType(_TEXT))]))
_LINKS = T.ArrayType(T.StructType([T.StructField(n, _TEXT) for n in ("source", "raw", "text", "title")]))


@F.pandas_udf(_ROWS)
def table_rows_of(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [dict(zip(("table", "parent", "row", "cells"), r)) for r in table_rows(t or "")])


@F.pandas_udf(_LINKS)
def links_of(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [dict(zip(("source", "raw", "text", "title"), r)) for r in links(t or "")])
