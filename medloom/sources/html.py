"""Pages as DataFrames: one Arrow UDF turns HTML into tables, list items and links; all rules after that are Columns.

The tree is built as the standard parser reports it: an end tag closes the nearest open element of its name, nothing is
closed implicitly, so an unclosed <li> holds what follows. Text of scripts, styles and comments is no text.
"""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("script", "style", "template"))


class _Node:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict, parent: _Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def strings(self) -> list[str]:
        """Stripped texts in order, without empty ones."""
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                if x.strip():
                    out.append(x.strip())
            elif x.name not in _SILENT:
                stack.extend(reversed(x.children))
        return out

    def all(self, *names: str) -> list[_Node]:
        """Elements of these names below, in document order."""
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if not isinstance(x, str):
                if x.name in names:
                    out.append(x)
                stack.extend(reversed(x.children))
        return out

    def above(self, name: str) -> _Node | None:
        x = self.parent
        while x is not None and x.name != name:
            x = x.parent
        return x


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        x = self.at
        while x is not self.root and x.name != tag:
            x = x.parent
        if x is not self.root:
            self.at = x.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def read_page(page: str | None) -> dict[str, list]:
    """rows (table, row, cells), items (list, position, text) and links of a page; nothing for null."""
    tree = _Tree()
    tree.feed(page or "")
    tree.close()
    rows = [
        {"table": t, "row": r, "cells": ["".join(c.strings()) for c in row.all("td", "th")]}
        for t, table in enumerate(tree.root.all("table"))
        for r, row in enumerate(table.all("tr"))
    ]
    items = [
        {"list": n, "pos": p, "text": "".join(item.strings())} for n, each in enumerate(tree.root.all("ul", "ol")) for p, item in enumerate(each.all("li"))
    ]
    links = []
    for p, a in enumerate(x for x in tree.root.all("a") if "href" in x.attrs):
        row, item = a.above("tr"), a.above("li")
        near = lambda x: " | ".join(x.strings()) if x is not None else None
        links.append(
            {"pos": p, "href": a.attrs["href"], "text": "".join(a.strings()), "title": a.attrs.get("title", "").strip(), "row_text": near(row), "item_text": near(item), "parent_text": near(a.parent)}
        )
    return {"rows": rows, "items": items, "links": links}


_PAGE = (
    "struct<rows: array<struct<table: int, row: int, cells: array<string>>>, items: array<struct<list: int, pos: int, text: string>>, "
    "links: array<struct<pos: int, href: string, text: string, title: string, row_text: string, item_text: string, parent_text: string>>>"
)


def parsed_page(html: Column) -> Column:
    """The struct of read_page for a column of HTML."""
    # marked so that no filter on its result is pushed below it, which would read every page twice
    return F.pandas_udf(_read_pages, _PAGE).asNondeterministic()(html)


def _read_pages(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_page(p) for p in pages], columns=["rows", "items", "links"])


def absolute_url(base: Column, href: Column) -> Column:
    """A link as seen from the page it stands on; null if either is null or the link can't be read."""
    return F.pandas_udf(_absolute_urls, "string").asNondeterministic()(base, href)


def _absolute_urls(base: pd.Series, href: pd.Series) -> pd.Series:

    def join(b: str | None, h: str | None) -> str | None:
        try:
            return None if b is None or h is None else urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([join(b, h) for b, h in zip(base, href)], dtype=object)


def pages(df: DataFrame, html: Column) -> DataFrame:
    """Adds ``page``, the parsed struct."""
    return df.withColumn("page", parsed_page(html))
