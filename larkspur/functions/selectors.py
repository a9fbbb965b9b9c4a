"""CSS selectors over HTML columns.

A selector list is compiled once. A page is then read in one pass: each element that opens is compared with the
compound at which every selector stands among its ancestors, so no tree is built and nothing is searched twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.markup import VOID_TAGS

NAME = r"[\w-]+"
PART = re.compile(
    rf"""(?P<tag>\*|{NAME})|\.(?P<cls>{NAME})|\#(?P<id>{NAME})"""
    rf"""|\[\s*(?P<attr>{NAME})\s*(?:(?P<op>[~^$*|]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]"""
)
STEP = re.compile(r"\s*([>,])\s*|\s+")


@dataclass
class Compound:
    """What one element must be. ``child``: its parent must be the compound before, not just some ancestor."""

    tag: str | None = None
    classes: set[str] = field(default_factory=set)
    attributes: list[tuple[str, str | None, str]] = field(default_factory=list)
    child: bool = False

    def fits(self, tag: str, attributes: dict[str, str], classes: set[str]) -> bool:
        if self.tag not in (None, "*", tag) or not self.classes <= classes:
            return False
        return all(name in attributes and _compares(attributes[name], op, value) for name, op, value in self.attributes)


def _compares(found: str, op: str | None, value: str) -> bool:
    match op:
        case None:
            return True
        case "=":
            return found == value
        case "~=":
            return value in found.split()
        case "|=":
            return found == value or found.startswith(value + "-")
        case "^=":
            return value != "" and found.startswith(value)
        case "$=":
            return value != "" and found.endswith(value)
        case _:
            return value != "" and value in found


def compile_selector(selector: str) -> list[list[Compound]]:
    """Compounds of every selector of a list: tags, classes, ids and attributes, by descent or child steps."""
    found: list[list[Compound]] = [[]]
    at, text, child, fresh = 0, selector.strip(), False, True
    while at < len(text):
        if part := PART.match(text, at):
            if fresh:
                found[-1].append(Compound(child=child))
                child, fresh = False, False
            elif part["tag"]:
                raise ValueError(f"unexpected {part[0]!r} in selector {selector!r}")
            one = found[-1][-1]
            if part["tag"]:
                one.tag = part["tag"].lower()
            elif part["cls"]:
                one.classes.add(part["cls"])
            elif part["id"]:
                one.attributes.append(("id", "=", part["id"]))
            else:
                value = part["dq"] or part["sq"] or part["bare"] or ""
                one.attributes.append((part["attr"].lower(), part["op"], value))
        elif not fresh and (part := STEP.match(text, at)):
            fresh, child = True, part[1] == ">"
            if part[1] == ",":
                found.append([])
        else:
            raise ValueError(f"cannot read selector {selector!r} at {text[at:]!r}")
        at = part.end()
    if fresh:
        raise ValueError(f"selector {selector!r} ends too early")
    return found


class _Reader(HTMLParser):
    """Elements that match, in page order: their attributes and the texts inside."""

    def __init__(self, selectors: list[list[Compound]]):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.matches: list[tuple[dict[str, str], list[str]]] = []
        # For each open element: tag, and for each selector the numbers of compounds fitted by it and by its ancestors.
        self.open: list[tuple[str, list[set[int]], list[set[int]], list[str] | None]] = []
        self.counts: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        attributes = {name: value or "" for name, value in reversed(attrs)}  # of repeated ones the first counts
        classes = set(attributes.get("class", "").split())
        own, reached, hit = [], [], False
        for i, selector in enumerate(self.selectors):
            parent, above = (self.open[-1][1][i], self.open[-1][2][i]) if self.open else (set(), set())
            fitted = set()
            for k, one in enumerate(selector):
                before = k == 0 or k in (parent if one.child else above)
                if before and one.fits(tag, attributes, classes):
                    fitted.add(k + 1)
            hit = hit or len(selector) in fitted
            own.append(fitted)
            reached.append(above | fitted if fitted else above)
        texts: list[str] | None = None
        if hit:
            texts = []
            self.matches.append((attributes, texts))
        if tag not in VOID_TAGS:
            self.open.append((tag, own, reached, texts))
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_endtag(self, tag):
        if not self.counts.get(tag):
            return
        while True:
            closed = self.open.pop()[0]
            self.counts[closed] -= 1
            if closed == tag:
                return

    def handle_data(self, data):
        if data.strip() and not (self.open and self.open[-1][0] in ("script", "style")):
            for _, _, _, texts in self.open:
                if texts is not None:
                    texts.append(data.strip())


def _matches(html: str, selectors: list[list[Compound]]) -> list[tuple[dict[str, str], list[str]]]:
    reader = _Reader(selectors)
    reader.feed(html)
    reader.close()
    return reader.matches


def _selected(html: Column, selector: str, pick) -> Column:
    selectors = compile_selector(selector)

    @F.pandas_udf("array<string>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: None if page is None else [pick(m) for m in _matches(page, selectors)])

    return read(html)


def select_attribute(html: Column, selector: str, attribute: str) -> Column:
    """The attribute's value on each matching element, in page order; NULL on elements without it."""
    name = attribute.lower()
    return _selected(html, selector, lambda match: match[0].get(name))


def select_text(html: Column, selector: str) -> Column:
    """The text in each matching element: stripped text nodes, joined by one space."""
    return _selected(html, selector, lambda match: " ".join(match[1]))


def first_selected(html: Column, selector: str, attribute: str) -> Column:
    """The attribute's value on the first matching element; NULL if there is none or it lacks the attribute."""
    return F.get(select_attribute(html, selector, attribute), F.lit(0))
