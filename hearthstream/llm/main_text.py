"""Main text of web pages by line-block distribution.

The markup is stripped into lines, one per block element.  A line counts the
text outside links; lines of menus, headers, footers, side bars, notices,
adverts, forms, comments and scripts count nothing.  Sums over a sliding window
of lines give the distribution: it surges where the article starts and dives to
nothing where it ends.  Text between a surge and its dive is kept, in page
order, lines that are one link too.  Lines that count nothing between two surges
do not part them, and a linked heading right before a surge belongs to it.

Which elements stand beside the article is decided over the whole page first.  Elements
such as ``nav`` do, and elements whose class, id or role says so: a whole name of the
list below, or one that ends in it (``site-footer``, ``sidebar-left``); ``has-sidebar`` and
the like describe a page and say nothing.  Names never count on ``html``, ``body`` or an
element that holds an article, nor, unless it is mostly links or reader comments, on one
that holds half of the text around it; inside an article a composed name counts
only on a small or link-dense block.  A form around most of a page is not a form
to skip.  The scanner reads the page once, whatever is broken in it.

There are two regimes.  Where the page names its article (``article``, ``main``),
any text in it surges.  Elsewhere a window needs ``SURGE`` characters; as it reaches
ahead, short lines that are no paragraphs, before the first sentence or heading it
reaches, are not kept.  If nothing surges, the densest block of the page is its text.

Defined results: null, empty or text-free html gives the empty text; unclosed
tags end with their parent; an unterminated comment or script swallows the rest
of the page, as in a browser, and a tag without an end is text; repeated pages give repeated
rows; page columns other than the requested ones are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from hearthstream.llm.common import batch_of, map_batches

WINDOW = 3
SURGE = 40

# Elements whose text is never shown or never part of an article.
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas".split())
SKIPPED = frozenset(
    "head nav header footer aside form menu dialog button select fieldset datalist".split()
)
# Of these, the ones that pages wrap around their article.
WRAPPERS = frozenset(["form", "header", "fieldset"])
CONTAINERS = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements that end an open one of their kind.
SIBLINGS = frozenset("p li tr td th dt dd option".split())
# Names of classes, ids and roles of what stands beside an article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar topbar toolbar breadcrumb breadcrumbs pagination pager "
    "header masthead footer contentinfo copyright sidebar aside complementary widget widgets rail "
    "notice notices cookie cookies consent gdpr alert popup modal overlay dialog "
    "comment comments commentlist disqus replies reply respond "
    "form search login signup subscribe subscription newsletter "
    "share sharing social related recommended recommendations toc skip".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
# Composed names that begin with one of these mean the same.
BEGINNINGS = frozenset(
    "ad ads advert sponsor sponsored promo cookie cookies consent gdpr newsletter breadcrumb breadcrumbs "
    "comment comments popup modal".split()
)
# Composed names of link lists, if they are mostly links.
LINK_LISTS = frozenset("share sharing social related recommended toc nav menu search skip".split())
# Words that describe a page or a wrapper, and words of place that add nothing.
ABOUT = frozenset("has with no without single page is js not".split())
PLACES = frozenset(
    "left right top bottom main primary secondary inner outer wrapper wrap container box area block list items item".split()
)

# What follows a "<" that begins a tag; quoted parts may hold ">".
_OPEN = re.compile(r"(/?)([a-z][a-z0-9:-]*)", re.I)
_QUOTED_END = re.compile(r"(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def name_kind(attributes: str) -> tuple[bool, bool, bool, bool]:
    """What class, id and role say: beside by a whole name, by a composed one, a link list, comments."""
    whole = composed = links = comments = False
    for m in _NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            lower = name.lower()
            if lower in BESIDE:
                whole = True
                comments |= lower in COMMENTS
                continue
            words = [w.lower() for w in _WORD.findall(name)]
            while words and words[-1] in PLACES:
                words.pop()
            if not words or words[0] in ABOUT:
                continue
            composed |= words[-1] in BESIDE or words[0] in BEGINNINGS
            links |= words[0] in LINK_LISTS
            comments |= words[-1] in COMMENTS or words[0] in COMMENTS
    return whole, composed, links, comments


@dataclass(slots=True)
class Element:
    """An open or closed element that may stand beside the article."""

    name: str
    attributes: str
    parent: int
    block: int  # the nearest element that is not inline: itself or one around it
    ink: int = 0  # characters that are not white space, of the element and all in it
    linked: int = 0  # those of them inside links
    holds_article: bool = False
    holds_heading: bool = False
    comment: bool = False


@dataclass(slots=True)
class Line:
    """The text of one block, and the element it stands in."""

    text: str
    ink: int
    linked: int
    element: int
    heading: bool


def scan(page: str) -> tuple[list[Element], list[Line]]:
    """Elements and lines of a page, in one pass over it.  Element 0 is the page itself."""
    elements = [Element("", "", -1, 0)]
    lines: list[Line] = []
    parts: list[str] = []
    links: list[str] = []
    stack = [0]
    open_names: Counter = Counter()
    anchors = 0
    loose = False  # a quote without an end was found: from then on a tag ends at its first ">"

    def end_line() -> None:
        if parts:
            words = entities.unescape("".join(parts)).split()
            if words:
                linked = len("".join(entities.unescape("".join(links)).split())) if links else 0
                top = elements[stack[-1]]
                lines.append(Line(" ".join(words), sum(map(len, words)), linked, stack[-1], top.name in HEADINGS))
            parts.clear()
            links.clear()

    def push(name: str, attributes: str, inline: bool) -> None:
        top = stack[-1]
        index = len(elements)
        elements.append(Element(name, attributes, top, elements[top].block if inline else index))
        stack.append(index)
        open_names[name] += 1

    def close(name: str) -> None:
        """Close the innermost open element of a name and all in it."""
        while True:
            found = elements[stack.pop()].name
            open_names[found] -= 1
            if found == name:
                return

    def add(text: str) -> None:
        parts.append(text)
        if anchors:
            links.append(text)

    at, size = 0, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            break
        if begin > at:
            add(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else size
            continue
        tag = _OPEN.match(page, begin + 1)
        if tag is None and page[begin + 1 : begin + 2] not in ("!", "?"):
            add("<")
            at = begin + 1
            continue
        last = page.find(">", begin)
        if last < 0:  # no tag ends any more
            at = begin
            break
        if tag is not None and not loose:
            whole = _QUOTED_END.match(page, tag.end())
            loose = whole is None
            last = whole.end() - 1 if whole else last
        at = last + 1
        if tag is None:
            continue
        name, attributes = tag[2].lower(), page[tag.end() : last]
        if name in RAW and not tag[1]:
            if not attributes.endswith("/"):
                closing = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = closing.end() if closing else size
            continue
        if tag[1]:
            if name == "a":
                anchors = max(0, anchors - 1)
            if name not in INLINE:
                end_line()
                if open_names[name]:
                    close(name)
            elif name in ("span", "label") and open_names[name]:
                k = stack[-1]
                while elements[k].name in ("span", "label") and elements[k].name != name:
                    k = elements[k].parent
                if elements[k].name == name:  # of this block
                    if elements[k].attributes:
                        end_line()
                    close(name)
        elif name in VOID:
            if name not in INLINE:
                end_line()
        elif name in INLINE:
            if name == "a":
                anchors += 1
            elif name in ("span", "label"):
                # Only one with a name or a style can stand beside the article.
                kept = attributes if any(name_kind(attributes)) or _HIDDEN.search(attributes) else ""
                if kept:
                    end_line()
                push(name, kept, True)
        else:
            end_line()
            anchors = 0
            if name in SIBLINGS and open_names[name]:
                k = elements[stack[-1]].block
                while elements[k].name == "p" and name != "p":
                    k = elements[elements[k].parent].block
                if elements[k].name == name:
                    close(name)
            push(name, attributes, False)
    add(page[at:])
    end_line()
    return elements, lines


def beside_article(elements: list[Element], lines: list[Line]) -> tuple[list[bool], list[bool]]:
    """Per element whether it stands beside the article, and whether it stands in a named one."""
    for line in lines:
        own = elements[line.element]
        own.ink += line.ink
        own.linked += line.linked
        own.holds_heading |= line.heading
    kinds = [name_kind(e.attributes) if e.attributes else (False,) * 4 for e in elements]
    # Children come after their parents.
    for k in range(len(elements) - 1, 0, -1):
        e = elements[k]
        e.comment = kinds[k][3]
        above = elements[e.parent]
        above.ink += e.ink
        above.linked += e.linked
        above.holds_heading |= e.holds_heading
        above.holds_article |= e.holds_article or (e.name in CONTAINERS and not e.comment)
    beside, inside = [False] * len(elements), [False] * len(elements)
    around = [0] * len(elements)  # the article or page that an element is part of
    for k in range(1, len(elements)):
        e = elements[k]
        up = e.parent
        beside[k], inside[k], around[k] = beside[up], inside[up], around[up]
        if e.name in CONTAINERS and not e.comment:
            inside[k], around[k] = True, k
            continue
        if beside[k] or e.name in ("html", "body"):
            continue
        whole, composed, link_list, comments = kinds[k]
        text = elements[around[k]].ink
        dense = 2 * e.linked >= e.ink
        most = 2 * e.ink >= text and not dense and not comments
        if e.attributes and _HIDDEN.search(e.attributes):
            beside[k] = not e.holds_article
        elif e.name in SKIPPED:
            # A header inside an article holds its title.
            titled = e.name == "header" and inside[k]
            beside[k] = not e.holds_article and not titled and not (e.name in WRAPPERS and most)
        elif whole:
            beside[k] = not e.holds_article and not most and not (inside[k] and e.holds_heading and not dense and not comments)
        elif composed:
            small = not inside[k] or 5 * e.ink <= text
            beside[k] = not e.holds_article and not most and (small or dense or comments)
        elif link_list:
            beside[k] = not e.holds_article and dense
    return beside, inside


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The article of one page."""
    if not page:
        return ""
    elements, lines = scan(page)
    beside, inside = beside_article(elements, lines)
    contained = any(n.ink > n.linked and inside[n.element] and not beside[n.element] for n in lines)

    def of_article(line: Line) -> bool:
        return not beside[line.element] and (inside[line.element] or not contained)

    belongs = [of_article(n) for n in lines]
    lengths = [n.ink - n.linked if b else 0 for n, b in zip(lines, belongs, strict=True)]
    # Where the page names its article, any text there is a surge.
    threshold = 1 if contained else surge
    total = len(lines)
    sums = [0] * (total + 1)
    for k, n in enumerate(lengths):
        sums[k + 1] = sums[k] + n

    def dive(k: int) -> int:
        while k < total and sums[min(total, k + window)] - sums[k] > 0:
            k += 1
        return k

    def label(line: Line) -> bool:
        """A short line that is neither a paragraph nor a heading nor a sentence."""
        return (
            line.ink - line.linked < surge and not line.heading and elements[line.element].name != "p"
            and line.text[-1] not in ".!?\"'”’»。！？"
        )

    best: list[tuple[int, int]] = []
    densest = (0, 0)
    k = 0
    while k < total:
        block = sums[min(total, k + window)] - sums[k]
        if lengths[k]:
            densest = max(densest, (block, -k))
        if lengths[k] and block >= threshold:
            first, last = k, dive(k)
            # The first window reaches ahead: labels before the prose are not part of it.
            ahead = min(last, k + window) - 1
            while not contained and first < ahead and label(lines[first]):
                first += 1
            while first and lines[first - 1].heading and not lengths[first - 1] and belongs[first - 1]:
                first -= 1
            if best and sums[first] == sums[best[-1][1]]:
                first = best.pop()[0]
            best.append((first, last))
            k = last
        else:
            k += 1
    if not best and densest[0]:
        first = -densest[1]
        while first and lengths[first - 1]:
            first -= 1
        best.append((first, dive(first)))
    return " ".join(lines[i].text for a, b in best for i in range(a, b) if belongs[i])


def extract_main_text(
    pages: DataFrame, keys: list[str], html: str = "html", window: int = WINDOW, surge: int = SURGE
) -> DataFrame:
    """``keys`` of every page with ``text`` and its length ``n_chars`` in code points."""
    chosen = pages.select(*keys, html)
    fields = [f for f in chosen.schema.fields if f.name in keys]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def work(batches):
        for batch in batches:
            texts = [main_text(h, window, surge) for h in batch.column(len(keys)).to_pylist()]
            schema = pa.schema(
                [batch.schema.field(i) for i in range(len(keys))]
                + [pa.field("text", pa.string()), pa.field("n_chars", pa.int64())]
            )
            yield batch_of(
                schema,
                [batch.column(i) for i in range(len(keys))] + [texts, [len(t) for t in texts]],
            )

    return map_batches(chosen, work, f"{ddl}, text string, n_chars bigint")
