"""The one Python step: HTML of a page to the texts the rules look at."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser
from unicodedata import normalize

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the step travels with the job, so workers need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
UNSEEN = {"script", "style", "template"}
# text wanted from the first matching tag: name -> (tag, class or None)
SPOTS = {
    "detail_title": ("h1", "detail-title"),
    "any_title": ("h1", None),
    "shown_date": ("div", "detail-time"),
    "summary": ("h2", "detail-sapo"),
    "detail_body": ("div", "detail-content"),
    "any_body": ("div", "content"),
}
TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in SPOTS])
TEXT_SCHEMA.add("meta_date", "string").add("has_meta", "boolean")
TEXT_SCHEMA.add("tables", T.ArrayType(T.StringType())).add("page_text", "string")


class _PageText(HTMLParser):
    """Collects the texts of one page while its tags stream by."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str]]] = []  # open tags and the spots they started
        self.spots: dict[str, list[str]] = {}
        self.tables: list[list[str]] = []
        self.running_tables: list[list[str]] = []
        self.words: list[str] = []
        self.metas: dict[str, str] = {}

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        if tag == "meta":
            for kind, name in (("property", "article:published_time"), ("itemprop", "datePublished")):
                if found.get(kind) == name:
                    self.metas.setdefault(kind, found.get("content") or "")
        if tag in VOID:
            return
        classes = (found.get("class") or "").split()
        started = [
            name for name, (t, css) in SPOTS.items()
            if t == tag and name not in self.spots and (css is None or css in classes)
        ]
        for name in started:
            self.spots[name] = []
        if tag == "table":
            self.running_tables.append([])
            self.tables.append(self.running_tables[-1])
        self.open.append((tag, started))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not any(name == tag for name, _ in self.open):
            return
        while self.open:
            name, _ = self.open.pop()
            if name == "table":
                self.running_tables.pop()
            if name == tag:
                return

    def handle_data(self, data):
        if any(tag in UNSEEN for tag, _ in self.open):
            return
        self.words.append(data)
        for _, started in self.open:
            for name in started:
                self.spots[name].append(data.strip())
        for table in self.running_tables:
            table.append(data)

    def row(self) -> tuple:
        meta = self.metas.get("property", self.metas.get("itemprop"))
        return (
            *("".join(self.spots.get(name, [])) for name in SPOTS),
            meta, bool(self.metas), [" ".join(t) for t in self.tables], " ".join(self.words),
        )


def _texts(html: str | None) -> tuple:
    page = _PageText()
    page.feed(normalize("NFC", html or ""))
    page.close()
    return page.row()


def _read_pages(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    columns = [*SPOTS, "meta_date", "has_meta", "tables", "page_text"]
    for html in batches:
        yield pd.DataFrame([_texts(h) for h in html], columns=columns)


page_texts_udf = F.pandas_udf(_read_pages, TEXT_SCHEMA)
