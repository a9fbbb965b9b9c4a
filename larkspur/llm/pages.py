"""Main text of web pages by tree scoring.

A page is read into a tree. Menus, headers, footers, sidebars, notices, adverts, forms, scripts and
comments are taken out by tag, role and class. Each paragraph then has points for its length and
commas, and passes them to its ancestors, less the further away they are. A container's points are
discounted by its link density. The best container is kept, with those of its siblings that have enough
points of their own; where it lies in an article element, the whole article is kept. A form, or an element
whose class only hints at a frame of the page, stays if it holds the page's prose; comments, sidebars, notices
and the like never do, whatever they hold, so a page of nothing else is empty.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import slices

#: Fixed names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "thead", "tbody"},
    "option": {"option"},
}
#: Elements that an implied end does not reach beyond.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}} | {t: {"table"} for t in ("tr", "td", "th", "tbody", "tfoot")}

#: What never belongs to the article: by tag, role, and words of class and id.
DROPPED = RAW | set("nav footer aside button select input svg object canvas dialog menu head datalist audio video map math".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NEVER = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored comment comments discussion disqus reply replies respond "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer cookie cookies consent gdpr notice notices "
    "notification alert popup modal newsletter subscribe subscription related recommended recommendations".split()
)
#: Words that frames of whole pages have too.
DOUBTFUL = set("promo promotion side aside header masthead banner overlay signup login share sharing social widget toolbar skip legal copyright".split())
#: In one name with these, a word says what else the page has or hasn't (has-sidebar).
ABOUT = set("has no with without not".split())
#: Characters of prose from which a page without article element has some.
LEAST_PROSE = 200
POSITIVE = set("article content main post entry story body text hentry".split())
PARAGRAPHS = set("p pre blockquote td dd li".split())
HEADINGS = {"h1", "h2", "h3"}
#: Shares of a paragraph's points for its parent, grandparent and so on.
SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)

OPEN = re.compile(r"</?([a-zA-Z][^\s/>]*)|<!--|<[!?]")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""", re.IGNORECASE)
WORDS = re.compile(r"[A-Za-z]+")


class Page:
    """Elements in page order, and the texts and breaks between them."""

    def __init__(self, source: str):
        self.tags = ["#root"]
        self.parents = [-1]
        self.attributes: list[str] = [""]
        self.events: list[tuple[int, str | None]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack = [0]
        where: dict[str, list[int]] = {}  # places in the stack by tag
        block_at = [0]  # places of blocks in the stack
        tags, parents, events = self.tags, self.parents, self.events
        last = {q: source.rfind(q) for q in "\"'>"}
        gone: set[str] = set()
        at, size = 0, len(source)

        def top(names: Iterable[str]) -> int:
            """The highest place of any of these tags, 0 for none."""
            return max((where[name][-1] for name in names if where.get(name)), default=0)

        def close(to: int) -> None:
            while len(stack) > to:
                node = stack.pop()
                where[tags[node]].pop()
                if tags[node] in BLOCKS:
                    block_at.pop()
                    events.append((stack[-1], None))

        def text(value: str) -> None:
            if value:
                events.append((stack[-1], html.unescape(value) if "&" in value else value))

        while at < size:
            begin = source.find("<", at)
            if begin < 0:
                text(source[at:])
                break
            mark = OPEN.match(source, begin)
            if not mark:
                text(source[at : begin + 1])
                at = begin + 1
                continue
            text(source[at:begin])
            if mark[0] == "<!--":
                end = -1 if "-->" in gone else source.find("-->", begin + 4)
                if end < 0:
                    gone.add("-->")
                    end = source.find(">", begin)  # an unclosed comment ends with its tag
                    at = size if end < 0 else end + 1
                else:
                    at = end + 3
                continue
            # The tag ends at the first '>' outside of quotes.
            end = mark.end()
            while True:
                if end > last[">"]:
                    end = -1
                    break
                close_at = source.find(">", end)
                quotes = [(p, q) for q in "\"'" if end <= last[q] and 0 <= (p := source.find(q, end, close_at))]
                if not quotes:
                    end = close_at
                    break
                p, q = min(quotes)
                after = source.find(q, p + 1) if p + 1 <= last[q] else -1
                if after < 0:
                    end = close_at
                    break
                end = after + 1
            if end < 0:  # a tag that never ends is left out, with what follows
                break
            at = end + 1
            if not mark[1]:
                continue
            tag = mark[1].lower()
            if source[begin + 1] == "/":
                k = top((tag,))
                # An inline element does not end beyond the block that it is closed in.
                if k and (tag in BLOCKS or block_at[-1] < k):
                    close(k)
                continue
            if tag in BLOCKS:
                if tag not in ("html", "body", "head", "option", "optgroup"):
                    k = top(("p",))
                    if k > top(("td", "th", "table", "button", "caption")):
                        close(k)
                if ends := CLOSED_BY.get(tag):
                    scope = top(SCOPES[tag])
                    found = [held[i] for t in ends if (held := where.get(t)) and (i := bisect_right(held, scope)) < len(held)]
                    if found:
                        close(min(found))
                events.append((stack[-1], None))
            elif tag == "br":
                text(" ")
            node = len(tags)
            tags.append(tag)
            parents.append(stack[-1])
            self.attributes.append(source[mark.end() : end])
            if tag in VOID or (source[end - 1] == "/" and tag not in BLOCKS and tag not in RAW):
                continue
            if tag in RAW:
                found = None if tag in gone else re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(source, at)
                if found:
                    at = found.end()
                elif tag in ("script", "style"):
                    break
                else:
                    gone.add(tag)
                continue
            where.setdefault(tag, []).append(len(stack))
            if tag in BLOCKS:
                block_at.append(len(stack))
            stack.append(node)

    def named(self, node: int) -> str | None:
        """``never`` or ``doubtful`` where an element's class, id or role says that it is no part of an article."""
        tag, source = self.tags[node], self.attributes[node]
        if len(source) < 3 or tag in ("html", "body", "main", "#root"):
            return None
        found, positive = None, False
        for name, *values in ATTRIBUTE.findall(source):
            value, name = "".join(values).lower(), name.lower()
            if name == "role" and value in ROLES:
                if value != "form":
                    return "never"
                found = found or "doubtful"
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return "never"
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "never"
            elif name in ("class", "id"):
                for one in value.split():
                    words = set(WORDS.findall(one))
                    positive = positive or bool(words & POSITIVE)
                    if words & ABOUT:
                        continue
                    if words & NEVER:
                        return "never"
                    if words & DOUBTFUL:
                        found = "doubtful"
        return None if positive or tag == "article" else found

    def dropped(self) -> list[bool]:
        """Which elements are taken out, with all they hold.

        Doubtful ones and forms stay where they hold most of the prose and no article lies outside of them. What
        holds the main element stays whatever it is called.
        """
        tags, parents = self.tags, self.parents
        count = len(tags)
        holds_main, never, inside, prose, doubtful = ([False] * count for _ in range(5))
        for n in range(count - 1, 0, -1):
            holds_main[parents[n]] = holds_main[parents[n]] or holds_main[n] or tags[n] == "main"
        for n in range(1, count):
            up = parents[n]
            inside[n] = inside[up] or tags[up] in ("article", "main")
            prose[n] = prose[up] or tags[n] in PARAGRAPHS
            found = None if holds_main[n] else self.named(n)
            never[n] = never[up] or found == "never" or tags[n] in DROPPED or (tags[n] == "header" and not inside[n])
            doubtful[n] = found == "doubtful" or tags[n] == "form" and not holds_main[n]
        framed, linked = doubtful[:], [False] * count
        for n in range(1, count):
            framed[n] = framed[n] or framed[parents[n]]
            linked[n] = linked[parents[n]] or tags[n] == "a"
        held, outside, in_article = [0] * count, False, [0] * count
        for node, value in self.events:
            if value and not never[node] and not linked[node]:
                size = len(value.strip())
                article = inside[node] or tags[node] in ("article", "main")
                held[node] += size * prose[node]
                in_article[node] += size * article
                outside = outside or bool(size and article and not framed[node])
        for n in range(count - 1, 0, -1):
            held[parents[n]] += held[n]
            in_article[parents[n]] += in_article[n]
        out = never
        for n in range(1, count):
            stays = not outside and 2 * held[n] > held[0] and (in_article[n] > 0 or held[n] >= LEAST_PROSE)
            out[n] = out[n] or out[parents[n]] or doubtful[n] and not stays
        return out

    def main_text(self) -> str:
        tags, parents = self.tags, self.parents
        count = len(tags)
        dropped = self.dropped()
        linked = [False] * count
        for n in range(1, count):
            linked[n] = linked[parents[n]] or tags[n] == "a"
        own, commas, links, anchors = [0] * count, [0] * count, [0] * count, [0] * count
        for node, value in self.events:
            if value and not dropped[node]:
                size = len(value.strip())
                own[node] += size
                commas[node] += value.count(",")
                if linked[node]:
                    links[node] += size
        whole, all_links, all_commas = own[:], links[:], commas[:]
        for n in range(count - 1, 0, -1):
            up = parents[n]
            whole[up] += whole[n]
            all_links[up] += all_links[n]
            all_commas[up] += all_commas[n]
            anchors[up] += anchors[n] + (tags[n] == "a" and not dropped[n])
        density = [all_links[n] / whole[n] if whole[n] else 0.0 for n in range(count)]
        points = [0.0] * count
        for n in range(1, count):
            paragraph = tags[n] in PARAGRAPHS
            if dropped[n] or not (whole[n] if paragraph else own[n] and tags[n] in BLOCKS):
                continue
            size, marks = (whole[n], all_commas[n]) if paragraph else (own[n], commas[n])
            value = (1 + marks + min(size / 100, 3)) * (1 - density[n])
            up = parents[n] if paragraph else n
            for share in SHARES:
                if up < 0:
                    break
                points[up] += value * share
                up = parents[up]
        for n in range(1, count):
            if tags[n] in ("article", "main") and whole[n] and not dropped[n]:
                points[n] += 25
        score = [0.0 if dropped[n] else points[n] * (1 - density[n]) for n in range(count)]
        best = max(range(count), key=lambda n: (score[n], -n))
        kept = {best}
        up = best
        while up > 0:
            if tags[up] == "article" or tags[up] == "main" and tags[best] not in ("article", "main"):
                best = up
                kept = {up}
            up = parents[up]
        if score[best] > 0 and best:
            least = max(10.0, 0.2 * score[best])
            for n in range(1, count):
                if parents[n] != parents[best] or dropped[n] or not whole[n] or n == best:
                    continue
                prose = tags[n] in PARAGRAPHS and (whole[n] > 80 and density[n] < 0.25 or density[n] == 0)
                if score[n] >= least or prose or tags[n] in HEADINGS:
                    kept.add(n)
        else:
            kept = {0}
        # Lists of links inside the article lead elsewhere.
        for n in range(1, count):
            if tags[n] in ("ul", "ol", "div", "section", "table") and anchors[n] > 2 and density[n] > 0.8:
                dropped[n] = True
        keep = [False] * count
        for n in range(count):
            keep[n] = (n in kept or n > 0 and keep[parents[n]]) and not dropped[n]
        blocks, held = [], []
        for node, value in self.events:
            if value is None:
                if held:
                    if joined := " ".join("".join(held).split()):
                        blocks.append(joined)
                    held = []
            elif keep[node]:
                held.append(value)
        if joined := " ".join("".join(held).split()):
            blocks.append(joined)
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(v.as_py()) for v in batch.column(2)]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, main text and its length in code points, a row for each row of ``pages``.

    The blocks of the article are joined in page order by a newline; white space inside a block is one
    space; character references are decoded. NULL or empty html, and pages without text, give an empty
    text. Tags may be unclosed or badly nested; a tag or comment that never ends takes nothing before
    it away. Repeated rows stay; other columns are not read; no rows give no rows.
    """
    chosen = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(source).cast("string").alias("html"))
    return chosen.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
