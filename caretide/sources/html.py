"""Fields from raw HTML pages. Pages are spread over Spark tasks as Arrow batches.

The parser is the standard library's; a page is reduced to its text runs and the
elements they lie in, and everything else is selection on that.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.functions.dates import parse_iso_timestamp
from caretide.functions.text import absolute_url, collapse_spaces, truncate
from caretide.operators.schema import col

# Where an article's text is looked for, in order, and the fallbacks.
ARTICLE_SELECTORS = ("div.syndicate", "div.content", "article", "div.col-md-12")
NOT_FOUND = "Content not found"
FAILED = "Error retrieving content"

# Elements without content, and elements whose text is no page text.
_VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr"
    " basefont bgsound command frame image isindex nextid spacer".split()
)
_NO_TEXT = frozenset(("script", "style", "template"))
#: Cards, and characters in them, that are handed back at once.
_CARDS, _CHARS = 4_096, 4 << 20


class _Element:
    """An element, the text runs below it and where its descendants end."""

    __slots__ = ("attrs", "end", "start", "tag", "texts")

    def __init__(self, tag: str, attrs: dict, position: int):
        self.tag, self.attrs = tag, attrs
        self.start = self.end = position + 1
        self.texts: list[str] = []

    def is_a(self, selector: str) -> bool:
        tag, _, css = selector.partition(".")
        return self.tag == tag and (not css or css in (self.attrs.get("class") or "").split())


class _Page(HTMLParser):
    """Elements of a page in document order, so descendants follow their ancestor."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[_Element] = []
        self._open: list[_Element] = []
        self._run: list[str] = []
        self.feed(html)
        self.close()
        self._end_run()
        self._shut(0)

    def _end_run(self, *_):
        """Text between two pieces of markup is one run."""
        run = "".join(self._run).strip()
        self._run.clear()
        if run and not any(node.tag in _NO_TEXT for node in self._open):
            for node in self._open:
                node.texts.append(run)

    handle_comment = handle_decl = handle_pi = unknown_decl = _end_run

    def handle_data(self, data):
        self._run.append(data)

    def _shut(self, depth):
        for node in self._open[depth:]:
            node.end = len(self.elements)
        del self._open[depth:]

    def handle_starttag(self, tag, attrs):
        self._end_run()
        node = _Element(tag, dict(attrs), len(self.elements))
        self.elements.append(node)
        if tag not in _VOID:
            self._open.append(node)

    def handle_endtag(self, tag):
        self._end_run()
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth].tag == tag:
                self._shut(depth)
                return


def _article_text(html: str | None, selectors: Sequence[str]) -> str:
    if html is None:
        return FAILED
    elements = _Page(html).elements
    for selector in selectors:
        for node in elements:
            if node.is_a(selector):
                return " ".join(node.texts)
    return NOT_FOUND


def _cards(html: str | None, limit: int) -> Iterator[tuple[int, str, str, str | None]]:
    """(position, title, link, time) of the first ``limit`` cards that have title and link."""
    elements = _Page(html or "").elements
    cards = [e for e in elements if e.is_a("div.card-body")][:limit]
    for position, card in enumerate(cards, 1):
        inner = elements[card.start : card.end]
        title = next((e for e in inner if e.tag == "h3"), None)
        link = next((e for e in inner if e.tag == "a" and "href" in e.attrs), None)
        if title is None or link is None:
            continue
        time = next((e for e in inner if e.tag == "time"), None)
        yield (
            position,
            "".join(title.texts),
            link.attrs["href"] or "",
            (time.attrs.get("datetime") or None) if time is not None else None,
        )


def _listed(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The cards of ``page_url, html`` rows; one page and a bounded number of cards are held at a time."""
    kinds = {"page_url": pa.string(), "position": pa.int32(), "title": pa.string(), "link": pa.string(), "published": pa.string()}

    def packed() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    rows, chars = [], 0
    for batch in batches:
        for page_url, page in zip(*batch.columns, strict=True):
            name = page_url.as_py()
            for card in _cards(page.as_py(), limit):
                rows.append((name, *card))
                chars += sum(len(v) for v in rows[-1] if isinstance(v, str))
                if len(rows) == _CARDS or chars > _CHARS:
                    yield packed()
                    rows, chars = [], 0
    if rows:
        yield packed()


def extract_article(
    pages: DataFrame,
    html: str = "html",
    into: str = "content",
    selectors: Sequence[str] = ARTICLE_SELECTORS,
    max_chars: int = 5000,
) -> DataFrame:
    """Add the article text: the first selector with a match decides.

    Whitespace is collapsed and the text cut to ``max_chars``; a page without a
    match gives ``Content not found``, a missing page ``Error retrieving content``.
    """

    @F.pandas_udf("string")
    def text_of(batch: pd.Series) -> pd.Series:
        return batch.map(lambda page: _article_text(page, selectors))

    return pages.withColumn(into, truncate(collapse_spaces(text_of(col(html))), max_chars))


def extract_listing(
    pages: DataFrame,
    default_ts: str,
    base_url: str,
    url: str = "url",
    html: str = "html",
    limit: int = 100,
) -> DataFrame:
    """Listing pages to ``(page_url, position, title, url, date)``, one row per card.

    At most ``limit`` cards of a page are looked at; a card without ``h3`` or link,
    or with a time that is no timestamp, is skipped. A card without a time gets
    ``default_ts``.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _listed(batches, limit)

    named = pages.select(col(url).cast("string").alias("page_url"), col(html).cast("string").alias("html"))
    cards = named.mapInArrow(parse, "page_url string, position int, title string, link string, published string")
    stamp = parse_iso_timestamp(F.col("published"))
    return cards.filter(F.col("published").isNull() | stamp.isNotNull()).select(
        "page_url",
        "position",
        "title",
        absolute_url("link", base_url).alias("url"),
        F.coalesce(stamp, F.to_timestamp(F.lit(default_ts))).alias("date"),
    )
