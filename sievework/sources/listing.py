"""Listing pages to raw notices."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import reduce
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import schemas
from sievework.functions.clean import WHITE_SPACE, build_url

# The table column (from 1) of each field in the two layouts of the listing. The
# title is the plain text of its cell, the others are the cell's inner markup.
LAYOUTS: dict[str, dict[str, int]] = {
    "v1": {"title": 2, "resource_id": 3, "ca": 4, "published": 5, "deadline": 6, "procedure": 7,
           "status": 8, "document": 9, "awarddate": 11, "value": 12},
    "v2": {"title": 2, "resource_id": 3, "ca": 4, "published": 6, "deadline": 7, "procedure": 8,
           "status": 9, "document": 10, "awarddate": 11, "value": 12},
}
VOID_TAGS = frozenset(("br", "hr", "img", "input", "link", "meta", "col", "wbr", "area", "base", "embed", "source"))
# Tags in plain form, and text without references. Pages of these alone need no tolerant parser.
PLAIN = (
    r"</([a-z][a-z0-9]*)>"
    r"|(<(?!(?:script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|plaintext|svg|math)[ >])"
    r"""([a-z][a-z0-9]*)(?: [a-z]+(?:='[^'<>&\0]*'|="[^"<>&\0]*"))*>)|([^<&\0]+)"""
)
PLAIN_TOKENS, PLAIN_PAGE = re.compile(PLAIN), re.compile("(?:" + re.sub(r"\((?!\?)", "(?:", PLAIN) + ")*+")


class _RowReader(HTMLParser):
    """Collects, per body row of any table, the (text, inner markup) of its cells."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, str]]] = []
        self._head = 0
        self._row: list[tuple[str, str]] | None = None
        self._text: list[str] | None = None
        self._markup: list[str] = []
        self._tag: str | None = None

    def _close_cell(self):
        if self._text is not None:
            self._row.append(("".join(self._text).strip(WHITE_SPACE), "".join(self._markup).strip(WHITE_SPACE)))
            self._text = None

    def _close_row(self):
        if self._row is not None:
            self._close_cell()
            self.rows.append(self._row)
            self._row = None

    def handle_starttag(self, tag, attrs):
        if tag in ("thead", "tfoot"):
            self._close_row()
            self._head += 1
        elif tag == "tr" and not self._head:
            self._close_row()
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._close_cell()
            self._text, self._markup = [], []
        elif self._text is not None:
            self._markup.append(self.get_starttag_text())

    def handle_startendtag(self, tag, attrs):
        if self._text is not None:
            self._markup.append(self.get_starttag_text())

    def handle_endtag(self, tag):
        if tag in ("thead", "tfoot"):
            self._head = max(0, self._head - 1)
        elif tag in ("td", "th"):
            self._close_cell()
        elif tag in ("tr", "tbody", "table"):
            self._close_row()
        elif self._text is not None and tag not in VOID_TAGS:
            self._markup.append(f"</{tag}>")

    def handle_data(self, data):
        if self._text is not None:
            self._text.append(data)
            self._markup.append(escape(data, quote=False).replace("\xa0", "&nbsp;"))

    def get_starttag_text(self):
        return super().get_starttag_text() if self._tag is None else self._tag

    def read(self, source: str) -> list[list[tuple[str, str]]]:
        """The rows of a page. Plain markup goes to the handlers as it is, the parser reads any other."""
        if not PLAIN_PAGE.fullmatch(source):
            self.feed(source)
            return self.finish()
        for end, self._tag, start, text in PLAIN_TOKENS.findall(source):
            if end:
                self.handle_endtag(end)
            elif start:
                self.handle_starttag(start, ())
            else:
                self.handle_data(text)
        return self.finish()

    def finish(self) -> list[list[tuple[str, str]]]:
        self.close()
        self._close_row()
        return self.rows


def _read_rows(layout: Mapping[str, int], page: str, html: str):
    fields = list(layout)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_no, source in zip(batch[page], batch[html]):
                for row_no, cells in enumerate(_RowReader().read(source or "")):
                    cell = lambda f: cells[layout[f] - 1] if layout[f] <= len(cells) else ("", "")  # noqa: B023, E731
                    out.append((page_no, row_no, *[cell(f)[0 if f == "title" else 1] for f in fields]))
            yield pd.DataFrame(out, columns=[page, "row_no", *fields])

    return run


def extract_listing_rows(
    pages: DataFrame, url_base: str, layout: str = "v1", page: str = "page_no", html: str = "html"
) -> DataFrame:
    """One raw record per table row, with its page and place on it.

    Layout v1 builds a document URL for every key, v2 only where the document cell is filled.
    """
    places = LAYOUTS[layout]
    kind = dict(pages.dtypes)[page]
    schema = f"{page} {kind}, row_no int, " + ", ".join(f"{f} string" for f in places)
    cells = pages.select(page, html).mapInPandas(_read_rows(places, page, html), schema)
    shown = F.col("document") if layout == "v2" else None
    blank = F.lit("")
    return cells.select(
        page, "row_no",
        *[
            (build_url("resource_id", url_base, shown) if n == "pdf_url" else F.col(n) if n in places else blank).alias(n)
            for n in schemas.RAW_NOTICES.names
        ],
    )


def split_bad_keys(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a numeric key, the others): what layout v2 does not accept."""
    numeric = F.col("resource_id").try_cast("bigint").isNotNull()
    return rows.where(numeric), rows.where(~numeric)


def page_window(start_page: int = 1, max_pages: int = 10, offset: int = 0, test_mode: bool = False) -> tuple[int, int]:
    """First page and the page after the last one (S06); an offset means pages 1 to offset."""
    if offset > 0:
        start_page, max_pages = 1, offset
    return start_page, start_page + (1 if test_mode else max_pages)


def select_pages(pages: DataFrame, page: str = "page_no", **request) -> DataFrame:
    low, high = page_window(**request)
    return pages.where((F.col(page) >= low) & (F.col(page) < high))


def backfill_chunks(pages: DataFrame, chunk: int, page: str = "page_no") -> DataFrame:
    """The pages present, cut into runs of ``chunk`` pages."""
    chunk_id = F.floor((F.col(page) - 1) / chunk).cast("int")
    return pages.groupBy(chunk_id.alias("chunk_id")).agg(
        F.min(page).alias("start_page"), F.count_distinct(page).alias("max_pages"), F.count(F.lit(1)).alias("n_rows")
    )


def union_pages(*frames: DataFrame) -> DataFrame:
    """Page results as one collection, nothing merged."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def page_number(key: Column, per_page: int = 10) -> Column:
    return F.floor(key / per_page).cast("bigint") + 1
