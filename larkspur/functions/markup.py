"""Pull regions, attributes and text blocks out of HTML."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import strip_text

# The marker comment around the article part of a law page, the class of an
# article block and the class its text carries, and the shape of an inline background image.
ARTICLE_MARKER = "조문정보"
BLOCK_CLASS = "pgroup"
TEXT_CLASS = "lawcon"
BACKGROUND_URL = r"background-image:\s*url\(['\"]?([^'\")]+)['\"]?\)"

# HTML elements that have no closing tag.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def region_between(html: Column, opening: str, closing: str) -> Column:
    """First, shortest region from ``opening`` to ``closing`` (patterns), across lines; else NULL."""
    return empty_to_null(F.regexp_extract(html, f"(?s){opening}.*?{closing}", 0))


def marked_region(html: Column, marker: str = ARTICLE_MARKER) -> Column:
    """Region between two comments that both hold ``marker``; NULL without a pair of them."""
    comment = rf"<!--\s*{re.escape(marker)}\s*-->"
    return region_between(html, comment, comment)


def first_attribute(html: Column, tag: str, attribute: str, css_class: str | None = None) -> Column:
    """Value of ``attribute`` on the first ``tag`` (carrying ``css_class`` if given); NULL if none.

    The opening tag is cut out first and the attribute read inside it, so attribute order is free.
    """
    if css_class is None:
        opening = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*\s{attribute}\s*=\s*[^>]*>", 0)
    else:
        name = rf"""class\s*=\s*["'][^"'>]*(?<![^\s"']){re.escape(css_class)}(?![^\s"'])"""
        opening = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*{name}[^>]*>", 0)
    quoted = rf"""(?is)\s{attribute}\s*=\s*(["'])(.*?)\1"""
    bare = rf"""(?is)\s{attribute}\s*=\s*([^\s"'>]+)"""
    return F.coalesce(
        empty_to_null(F.regexp_extract(opening, quoted, 2)),
        empty_to_null(F.regexp_extract(opening, bare, 1)),
    )


def background_url(style: Column) -> Column:
    """URL of a CSS ``background-image``, quotes optional; NULL if there is none."""
    return empty_to_null(F.regexp_extract(style, BACKGROUND_URL, 1))


def flat_blocks(html: Column, tag: str) -> Column:
    """Inner HTML of every ``tag`` block that does not nest, as an array."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))


def inner_text(html: Column) -> Column:
    """Text of an HTML fragment with the tags taken out and the ends stripped."""
    return strip_text(F.regexp_replace(html, "<[^>]*>", ""))


class _BlockReader(HTMLParser):
    """Collects the stripped text nodes of every element of one class, nested ones included."""

    def __init__(self, tag: str, block_class: str, child_class: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.block_class, self.child_class = tag, block_class, child_class
        self.open_tags: list[str] = []
        self.open_blocks: list[dict] = []
        self.blocks: list[dict] = []
        self.node: list[str] = []

    def end_node(self):
        """What lies between two tags or comments is one node; only its ends are stripped."""
        text = "".join(self.node).strip()
        self.node = []
        if text and not (self.open_tags and self.open_tags[-1] in ("script", "style")):
            for block in self.open_blocks:
                block["text"].append(text)

    def close(self):
        super().close()
        self.end_node()

    def handle_comment(self, data):
        self.end_node()

    def handle_starttag(self, tag, attrs):
        self.end_node()
        classes = (dict(attrs).get("class") or "").split()
        if self.child_class in classes and tag == self.tag:
            for block in self.open_blocks:
                block["kept"] = True
        if tag in VOID_TAGS:
            return
        self.open_tags.append(tag)
        if tag == self.tag and self.block_class in classes:
            block = {"depth": len(self.open_tags), "text": [], "kept": self.child_class is None}
            self.open_blocks.append(block)
            self.blocks.append(block)

    def handle_endtag(self, tag):
        self.end_node()
        if tag not in self.open_tags:
            return
        while self.open_tags.pop() != tag:
            pass
        depth = len(self.open_tags)
        self.open_blocks = [b for b in self.open_blocks if b["depth"] <= depth]

    def handle_data(self, data):
        self.node.append(data)


def _read_blocks(html: str | None, tag: str, block_class: str, child_class: str | None):
    if html is None:
        return None
    reader = _BlockReader(tag, block_class, child_class)
    reader.feed(html)
    reader.close()
    return ["".join(b["text"]) for b in reader.blocks if b["kept"]]


def class_blocks(
    html: Column, block_class: str = BLOCK_CLASS, child_class: str | None = TEXT_CLASS, tag: str = "div"
) -> Column:
    """Texts of the elements of ``block_class`` that hold one of ``child_class``.

    Each text node is stripped and the nodes are joined without a separator. Elements nest, which
    regular expressions cannot follow, so this one runs as an Arrow-batched function.
    """

    @F.pandas_udf("array<string>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: _read_blocks(page, tag, block_class, child_class))

    return read(html)
