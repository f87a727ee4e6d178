"""Anchors of HTML pages as rows, read by the standard library's parser in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.href: str | None = None
        self.said: list[str] = []

    def close_anchor(self) -> None:
        if self.href is not None:
            self.found.append((self.href, " ".join("".join(self.said).split())))
        self.href, self.said = None, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.close_anchor()
            self.href = dict(attrs).get("href")

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.close_anchor()

    def handle_data(self, data: str) -> None:
        if self.href is not None:
            self.said.append(data)


def anchors(html: str | None) -> list[tuple[str, str]]:
    """(address, joined text) of the anchors with an address."""
    parser = _Anchors()
    parser.feed(html or "")
    parser.close()
    parser.close_anchor()
    return parser.found


def links(pages: DataFrame, base: str, pattern: str, html: str = "html") -> DataFrame:
    """The rows without their HTML, one for each anchor whose absolute address matches: n (from 1), url, title. Null pages have none."""
    kept = [f for f in pages.schema.fields if f.name not in (html, "n", "url", "title")]
    schema = T.StructType([*kept, T.StructField("n", T.LongType()), T.StructField("url", T.StringType()), T.StructField("title", T.StringType())])
    fits = re.compile(pattern, re.IGNORECASE)
    names = [f.name for f in kept]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row, page in zip(b[names].itertuples(index=False), b[html]):
                good = [(u, x) for u, x in ((urljoin(base, h), x) for h, x in anchors(page)) if fits.search(u)]
                out += [(*row, n, u, x) for n, (u, x) in enumerate(good, 1)]
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return pages.select(*names, html).mapInPandas(run, schema)
