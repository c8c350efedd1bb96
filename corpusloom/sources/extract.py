"""Text of web pages, filings and PDF files."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize
from . import pdf

_REFERENCE = re.compile("&(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);|&")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Body(HTMLParser):
    """Strings of the body outside tables, scripts and styles."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside = self.skip = 0
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "body"
        self.skip += tag in ("table", "script", "style")

    def handle_endtag(self, tag):
        self.inside -= tag == "body" and self.inside > 0
        self.skip -= tag in ("table", "script", "style") and self.skip > 0

    def handle_data(self, data):
        if self.inside and not self.skip and data.strip():
            self.found.append(data.strip())


def _closed(page: str) -> str:
    """page with every & that begins no known character reference with its semicolon as &amp;."""
    return _REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] + ";" in html5) else "&amp;" + m[0][1:], page)


def body_text(page: str | None, closed: bool = False) -> str | None:
    """closed: character references without their semicolon, as in a text that was cut, stay as they are written."""
    if page is None:
        return None
    parser = _Body()
    parser.feed(_closed(page) if closed else page)
    parser.close()
    return "\n".join(parser.found)


class _Filing(HTMLParser):
    """Elements as [tag, parent, children and strings], read leniently: an end tag closes up to its start, a stray one nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top: list = ["", None, []]
        self.at, self.titles = self.top, []

    def handle_starttag(self, tag, attrs):
        node = [tag, self.at, []]
        self.at[2].append(node)
        if tag == "title":
            self.titles.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at[2].append([tag, self.at, []])

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node[0] != tag:
            node = node[1]
        if node is not None and node is not self.top:
            self.at = node[1]

    def handle_data(self, data):
        self.at[2].append(data)


def _strings(node: list) -> list[str]:
    """All strings below a node but for its tables."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if x.strip():
                out.append(x.strip())
        elif x[0] != "table":
            todo += reversed(x[2])
    return out


def section_text(filing: str | None, title: str = "사업의 내용") -> str | None:
    """Text without tables of the nearest section-1 around the first title that has the words; null without such a section.

    The markup need not be well formed.
    """
    if filing is None:
        return None
    parser = _Filing()
    parser.feed(filing)
    parser.close()
    node = next((t for t in parser.titles if title in " ".join(_strings(t))), None)
    while node is not None and node[0] != "section-1":
        node = node[1]
    return None if node is None else "\n".join(_strings(node))


def extract_report(document: Column, kind: str, closed: bool = False) -> Column:
    """Text of an 'html' page (white space normalised) or of the business section of an 'xml' filing. closed: see `body_text`."""
    if kind not in ("html", "xml"):
        raise ValueError(f"kind is 'html' or 'xml', not {kind!r}")
    read = (lambda page: body_text(page, closed)) if kind == "html" else section_text

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(read)

    return normalize(run(document)) if kind == "html" else run(document)


def pdf_pages(spark: SparkSession, path: str, title: str = "", reader: Callable[[bytes], list[str]] = pdf.pages) -> DataFrame:
    """path, page (from 0), title, contents of the pages that have text; reader gives the pages of a file's bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, data in zip(f["path"], f["content"]):
                texts = reader(data)
                yield pd.DataFrame({"path": name, "page": range(len(texts)), "title": title, "contents": texts})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, page int, title string, contents string").filter("contents <> ''")


def pdf_full_text(pages: DataFrame) -> DataFrame:
    """path, contents: a file's pages joined by line breaks."""
    return pages.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "contents"))), lambda p: p["contents"]), "\n").alias("contents"))
