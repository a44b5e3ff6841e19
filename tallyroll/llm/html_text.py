"""Main text of web pages by line-block distribution.

Markup is stripped and the page becomes lines, one for each block. A line counts with the
characters of its text outside links; lines of menus, headers, footers, sidebars, notices,
adverts, forms and comments count nothing. The counts are summed over windows of lines.
Text surges where a window's sum rises above a threshold and dives where it falls to
nothing; the lines between are the main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a window; characters of a window from which it is a surge.
WINDOW, SURGE = 3, 20
#: Elements whose content is no text of the page.
DROPPED = set("script style noscript template head title svg math iframe object canvas select option textarea button".split())
#: Elements that hold something other than the article.
BOILERPLATE = set("nav header footer aside form menu dialog".split())
#: Words in a class, id or role that say the same of any element.
BOILERPLATE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side aside header masthead footer cookie cookies consent notice notices alert popup "
    "modal comment comments disqus reply replies respond discussion share sharing social related newsletter subscribe "
    "signup login search toolbar pagination pager widget contentinfo complementary".split()
)
#: Elements that start and end a line.
BLOCKS = set(
    "address article aside blockquote body br center caption dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements without an end tag.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
MAIN = {"article", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?=[a-zA-Z/])[^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_WORDS = re.compile(r"[a-z]+")
#: First parts of class names that tell of a page's layout, and last parts that name a box for the first.
_LAYOUT = set("has no with without is not hide show".split())
_BOX = set("slot box block container wrapper wrap list links bar section buttons unit item items form inner".split())
#: Elements of a head, and elements that end an open one of the same kind.
_HEAD = set("base link meta noscript script style template title".split())
_ENDS = {"li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = set("ul ol dl table select".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _is_boilerplate(name: str, attributes: str) -> bool:
    """Whether the element's tag, or a whole class, id or role of it, or the last part of one, names boilerplate."""
    if name in BOILERPLATE:
        return True
    if name in ("html", "body") or name in MAIN:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id", "role"):
            for token in (m[2] or m[3] or m[4] or "").lower().split():
                parts = _WORDS.findall(token)
                if not parts or parts[0] in _LAYOUT:
                    continue
                if parts[-1] in BOILERPLATE_WORDS or parts[0] in BOILERPLATE_WORDS and all(w in _BOX for w in parts[1:]):
                    return True
    return False


class _Element:
    """An element: what it is, how much text it holds, and where in the page it lies."""

    __slots__ = ("name", "parent", "boilerplate", "size", "main", "closed", "left_out", "block", "inside", "linked")

    def __init__(self, name: str, parent: _Element | None, boilerplate: bool):
        self.name, self.parent, self.boilerplate = name, parent, boilerplate
        self.size, self.main, self.closed, self.left_out = 0, False, False, False
        own = parent is None or name in BLOCKS and name not in ("br", "hr")
        self.block = self if own else parent.block
        self.inside = name in MAIN or parent is not None and parent.inside
        self.linked = name == "a" or not own and parent.linked


def _parsed(page: str) -> tuple[list[tuple[_Element, str | None]], list[_Element]]:
    """Texts in order with the element that holds each (None: the element starts or ends there), and all elements."""
    root = _Element("", None, False)
    stack, events, elements = [root], [], []
    opened = Counter()
    at = 0

    def text(upto: int) -> None:
        if upto > at:
            if stack[-1].name == "head" and page[at:upto].strip():
                end(len(stack) - 1)
            events.append((stack[-1], page[at:upto]))
            stack[-1].size += len("".join(page[at:upto].split()))

    def end(n: int) -> None:
        """Ends all elements from place ``n`` of the stack on."""
        while len(stack) > n:
            opened[stack[-1].name] -= 1
            events.append((stack.pop(), None))

    # Each token is looked for behind the one before: a "<" in raw text starts none.
    while m := _TOKEN.search(page, at):
        text(m.start())
        at = m.end()
        name, closing = (m[2] or "").lower(), bool(m[1])
        if not name:
            continue
        if closing:
            for n in range(len(stack) - 1 if opened[name] else 0, 0, -1):
                if stack[n].name == name:
                    stack[n].closed = True
                    end(n)
                    break
                if name not in BLOCKS and name not in DROPPED and stack[n].name in BLOCKS:
                    break
            else:
                if name in BLOCKS:
                    events.append((_Element(name, stack[-1], False), None))
            continue
        if name in ("script", "style", "textarea", "title"):  # raw text up to the end tag
            found = re.compile(f"</{name}[^>]*>?", re.I).search(page, at)
            at = found.end() if found else len(page)
            continue
        if stack[-1].name == "head" and name not in _HEAD:
            end(len(stack) - 1)
        if opened["p"] and name in BLOCKS and name != "br":  # an open paragraph ends with the next block, which is no part of it
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].name == "p":
                    end(n)
                    break
                if stack[n].name in BLOCKS:
                    break
        if name in _ENDS:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].name in _ENDS[name]:
                    end(n)
                    break
                if stack[n].name in _SCOPE:
                    break
        if name == "a" and opened["a"]:  # a link ends the one that is open
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].name == "a":
                    end(n)
                    break
                if stack[n].name in BLOCKS:
                    break
        one = _Element(name, stack[-1], name not in VOID and _is_boilerplate(name, m[3]))
        elements.append(one)
        events.append((one, None))
        if name in VOID or name in DROPPED and m[3].endswith("/"):
            one.closed = True
        else:
            stack.append(one)
            opened[name] += 1
    text(len(page))
    end(1)
    return events, elements


def _marked(elements: list[_Element]) -> None:
    """Decides which elements are left out: never one that holds an article.

    On a page without article, one that holds most of the text stays too, unless its tag says what it is and it is closed.
    """
    for e in reversed(elements):  # children come after their parents
        e.main |= e.name in MAIN and e.size > 0
        if e.name in DROPPED and e.closed:
            continue
        e.parent.size += e.size
        e.parent.main |= e.main
    marked = any(e.main for e in elements)
    whole = elements[0].parent.size if elements else 0
    for e in elements:
        most = 2 * e.size > whole and whole > 0
        if e.parent.left_out:
            e.left_out = True
        elif e.name in DROPPED:
            e.left_out = e.closed or not (e.main or most)
        elif e.boilerplate:
            e.left_out = not e.main and (marked or not most or e.closed and e.name in BOILERPLATE)


class _Line:
    """A line: its text, characters outside links, its block, that block's parent, and whether it lies in an article."""

    __slots__ = ("text", "plain", "block", "parent", "inside")

    def __init__(self, text: str, plain: int, block: _Element, inside: bool):
        self.text, self.plain, self.block, self.inside = text, plain, block, inside
        self.parent = block.parent if block.name in BLOCKS else block


def _stripped(page: str) -> list[_Line]:
    events, elements = _parsed(page)
    _marked(elements)
    lines: list[_Line] = []
    text: list[str] = []
    plain: list[str] = []
    block = None

    def end() -> None:
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            lines.append(_Line(joined, len("".join("".join(plain).split())), block, block.inside))
        text.clear()
        plain.clear()

    for e, part in events:
        if part is None:
            if e.name in BLOCKS or e.left_out and e.boilerplate:
                end()
                block = None
        elif not e.left_out:
            if block is None and part.strip():
                block = e.block
            text.append(part)
            if not e.linked:
                plain.append(part)
    end()
    return lines


def main_text(page: str | None) -> str:
    """Main text of a page: white space is one space, lines are joined by one space; empty if there is none.

    Regions of lines end where a window's sum falls to nothing, and where an article or
    main element starts or ends. One is kept if a window of it reaches SURGE characters,
    or the largest sum of the page if that is less. Inside an article or main element
    every line counts, so that all of its regions are kept; regions outside are chosen by
    the same sums, twice SURGE if the page has such an element. Headings and paragraphs
    that are only links stay beside kept text of the same parent.
    """
    lines = _stripped(page or "")
    marked = any(x.inside for x in lines)
    # Inside an article, text in links belongs to it.
    counts = [max(x.plain, 1) if x.inside else x.plain for x in lines]
    sums = [0] * len(lines)
    for i, x in enumerate(lines):
        for j in range(i, min(i + WINDOW, len(lines))):
            if lines[j].inside != x.inside:
                break
            sums[i] += counts[j]
    least = min(SURGE * (2 if marked else 1), max(sums, default=0))
    kept = [False] * len(lines)
    i = 0
    while i < len(lines):
        if counts[i] == 0:
            i += 1
            continue
        dive = i
        while dive < len(lines) and sums[dive] > 0 and lines[dive].inside == lines[i].inside:
            dive += 1
        if lines[i].inside or max(sums[i:dive]) >= least:
            kept[i:dive] = [True] * (dive - i)
        i = dive
    for order in (range(1, len(lines)), range(len(lines) - 2, -1, -1)):
        step = 1 if order.step > 0 else -1
        for i in order:
            beside, x = lines[i - step], lines[i]
            if not kept[i] and kept[i - step] and (x.block.name in HEADINGS or x.block.name == "p" and x.parent is beside.parent):
                kept[i] = True
    return " ".join(x.text for x, k in zip(lines, kept, strict=True) if k)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    Null and empty pages have an empty text. Repeated rows stay; other columns are
    ignored; an empty table gives no rows. Pages that end inside a tag lose that tag only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, rows.drop("html").schema.add("text", "string").add("n_chars", "long"))
