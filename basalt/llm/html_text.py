"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut into blocks at block-level tags, in time linear in its length. A block is described
by its number of words and link density, those of its neighbours, and what encloses it: page
furniture (1 by element, 0.5 by a hint: a form, or a class, id or role that names furniture as
a whole), article markup, a heading, and how its article compares with the page's longest one. Hints on elements that are or hold article markup do not count. A decision tree
grown from the labelled blocks below tells content from the rest; words and neighbours can
overrule a hint there. The content blocks make the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = re.compile(r"</?[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"""[^'">]*""")
_HUGE_REFERENCE = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9a-fA-F]{9,});?")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Fixed values of HTML: elements that end a text block, that have no content, whose content is not text
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style template noscript svg math iframe object textarea title head".split())
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Page furniture by element, and by a name in class, id or role
_FURNITURE = set("nav footer aside menu dialog button select".split())
_SOFT_FURNITURE = {"form", "fieldset"}
_FURNITURE_HINTS = set(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs carousel comment comments consent cookie cookies copyright dialog "
    "disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup "
    "privacy promo promotion related replies reply search share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
# Words that leave the meaning of the furniture word before them, and words that take it away
_PARTS = set(
    "area bar block body bottom box button buttons column container content footer form group header holder icons inner item items left link links list main "
    "modal news outer panel popup post posts primary region right row secondary section slot text title top unit widget widgets wrap wrapper".split()
)
_NOT_ITSELF = set("no non not without has have with hide hides hidden is can before after under below above".split())
_ARTICLE = {"article", "main"}
_ARTICLE_HINTS = set("article content entry main post story text".split())
_ARTICLE_NAMES = set("article entry post story".split())


def names_furniture(name: str, in_article: bool) -> bool:
    """Whether a whole class, id or role names page furniture: by itself (``sidebar``), by its last
    word (``cookie-notice``) or by its first before words for parts (``comments-area``).

    ``no-sidebar``, ``comments-open`` and ``content-sidebar-wrap`` say something else; a header
    inside an article or of one (``entry-header``) belongs to it.
    """
    words = [w.lower() for w in _HINT_WORD.findall(name) if len(w) > 1 and not w.isdigit()]
    if not words or words[0] in _NOT_ITSELF:
        return False
    if words[-1] in _FURNITURE_HINTS:
        head = words[-1]
    elif words[0] in _FURNITURE_HINTS and all(w in _PARTS for w in words[1:]):
        head = words[0]
    else:
        return False
    return head != "header" or not (in_article or words[0] in _ARTICLE_HINTS)


class _Element:
    """An open element with what it takes over from those around it; ``hint`` is its own only."""

    __slots__ = ("tag", "around", "furniture", "hint", "holds_article", "article", "heading", "link", "in_article", "hinted", "paragraph", "outermost")

    def __init__(self, tag: str, around: _Element | None, furniture: bool = False, hint: bool = False, article: bool = False, heading: bool = False, link: bool = False, paragraph: int = -1):
        self.tag, self.around, self.furniture, self.hint, self.article, self.heading, self.link = tag, around, furniture, hint, article, heading, link
        self.in_article = tag == "article" or (around is not None and around.in_article)
        self.holds_article, self.hinted = False, None
        self.paragraph = paragraph  # place of the open paragraph that a new one would end, or -1
        self.outermost = around.outermost if around is not None and around.outermost is not None else self if tag == "article" else None


def _hinted(element: _Element) -> bool:
    """Whether an element or one around it has a hint and holds no article; known ones are kept."""
    path = []
    while element.hinted is None and element.around is not None:
        path.append(element)
        element = element.around
    known = bool(element.hinted)
    for e in reversed(path):
        known = e.hinted = known or (e.hint and not e.holds_article)
    return known


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    furniture: float
    article: bool
    heading: bool
    share: float = 1.0  # words of its article element over those of the page's longest one


def decoded(text: str) -> str:
    """Text with its character references decoded; numbers beyond Unicode, however long, give U+FFFD."""
    if "&" not in text:
        return text
    return html.unescape(_HUGE_REFERENCE.sub("\ufffd", text))


class _Tokens:
    """Tags and texts of a page in order, in time linear in its length.

    Positions never go back: where something has no end in the rest of the page, that is found out
    once. A tag whose quotes do not close before the page ends stops at its first ``>``, and from
    there on quotes mean nothing. A ``<`` that begins no tag is text.
    """

    def __init__(self, page: str):
        self.page, self.at, self.size = page, 0, len(page)
        self.quoting, self.missing = True, set()  # end tags that the rest of the page does not have

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        """(kind, name, rest): kind is ``text``, ``open`` or ``close``; rest the text or the attributes."""
        page, text_from, look, gt = self.page, 0, 0, -1
        while True:
            lt = page.find("<", look)
            if gt < lt < self.size and gt < self.size:
                gt = page.find(">", lt)
                gt = self.size if gt < 0 else gt
            if lt < 0 or gt == self.size:  # no tag can end any more, but a comment may begin
                lt = page.find("<!--", look)
                if lt < 0:
                    break
            if page.startswith("<!--", lt):
                end, found = page.find("-->", lt + 4), None
                end = self.size if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), lt):
                end, found = gt + 1, None
            else:
                found = _NAME.match(page, lt)
                if not found:
                    look = lt + 1
                    continue
                end = self._tag_end(found.end(), gt) + 1
            if lt > text_from:
                yield "text", "", page[text_from:lt]
            self.at = end
            if found:
                closing = page[lt + 1] == "/"
                yield "close" if closing else "open", found.group()[2 if closing else 1 :].lower(), page[found.end() : end - 1]
            text_from = look = self.at
        if text_from < self.size:
            yield "text", "", page[text_from:]

    def _tag_end(self, at: int, gt: int) -> int:
        """The ``>`` that ends a tag, outside quotes; ``gt`` is the next one whatever it stands in."""
        while self.quoting:
            at = _PLAIN.match(self.page, at).end()
            if at < self.size and self.page[at] == ">":
                return at
            close = self.page.find(self.page[at], at + 1) if at < self.size else -1
            if close < 0:
                self.quoting = False
            at = close + 1
        return gt

    def skip_to_end_of(self, tag: str, open_ended: bool) -> None:
        """Go behind the end tag, or to the end of the page if it is ``open_ended`` and has none."""
        end = None if tag in self.missing else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(self.page, self.at)
        if end:
            self.at = end.end()
        else:
            self.missing.add(tag)
            if open_ended:
                self.at = self.size


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Character references are decoded, white space inside
    a block is one space; an unclosed comment or raw element runs to the end of the page."""
    out: list[Block] = []
    inside: list[_Element] = []
    stack: list[_Element] = []
    parts: list[str] = []
    linked: list[str] = []
    outside = state = _Element("", None)
    depth: Counter = Counter()  # open elements by tag
    articles: Counter = Counter()  # words by outermost article element

    def close():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, text.count(" ") + 1, len("".join(linked).split()), float(state.furniture), state.article, state.heading))
                inside.append(state)
                articles[state.outermost] += out[-1].words
            parts, linked = [], []

    def leave(i: int):
        nonlocal state
        depth.subtract(e.tag for e in stack[i:])
        del stack[i:]
        state = stack[-1] if stack else outside

    tokens = _Tokens(page)
    for kind, tag, rest in tokens:
        if kind == "text":
            parts.append(decoded(rest))
            if state.link:
                linked.append(parts[-1] + " ")
            continue
        if kind == "close":
            if tag in _BLOCK:
                close()
            if depth[tag]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if tag in _RAW and not rest.endswith("/"):
            tokens.skip_to_end_of(tag, tag not in ("head", "title"))
            continue
        if tag == "br":
            parts.append(" ")
        if tag in _BLOCK:
            close()
        if tag in _VOID or rest.endswith("/"):
            continue
        names = [n for a in _ATTRIBUTE.findall(rest) for n in "".join(a).split()] if rest else []
        hints = {w.lower() for n in names for w in _HINT_WORD.findall(n)}
        if tag == "p" and state.paragraph >= 0:  # a paragraph ends the one before it
            leave(state.paragraph)
        is_article = tag in _ARTICLE
        if is_article and not state.in_article:  # one inside an article is a reader's comment
            around = state
            while around is not None and not around.holds_article:
                around.holds_article = True
                around = around.around
        inside_article = state.article or is_article or (bool(hints & _ARTICLE_HINTS) and tag in _BLOCK)
        furniture = state.furniture or tag in _FURNITURE or (tag == "header" and not state.article and not hints & _ARTICLE_NAMES)
        named = not is_article and tag not in ("body", "html") and not any(n.lower() in _ARTICLE_NAMES or n.lower() == "main" for n in names)
        hint = tag in _SOFT_FURNITURE or (named and any(names_furniture(n, state.article) for n in names))
        paragraph = len(stack) if tag == "p" else -1 if tag in _BLOCK else state.paragraph
        state = _Element(tag, state, furniture, hint, inside_article, state.heading or tag in _HEADING, state.link or tag == "a", paragraph)
        stack.append(state)
        depth[tag] += 1
    close()
    largest = max((n for e, n in articles.items() if e is not None), default=0)
    for b, e in zip(out, inside):
        if not b.furniture and _hinted(e):
            b.furniture = 0.5
        if e.outermost is not None:
            b.share = articles[e.outermost] / largest
    return out


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "heading", "share")


def describe(found: list[Block]) -> np.ndarray:
    """One row of FEATURES per block; neighbours beyond the page have no words and no links."""
    words = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([0, *(min(1.0, b.link_words / b.words) for b in found), 0], float)
    flags = np.array([(b.furniture, b.article, b.heading, b.share) for b in found], float).reshape(len(found), 4)
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], flags])


# Labelled blocks: FEATURES as above up to heading, then 1 for content.
_ALONE = [
    # article markup: paragraphs, short paragraphs, headings, a quote with a link
    (9, 0.0, 6, 0.0, 80, 0.0, 0, 1, 1, 1), (12, 0.0, 0, 0.0, 60, 0.0, 0, 1, 1, 1), (120, 0.0, 10, 0.0, 90, 0.0, 0, 1, 0, 1), (1, 0.0, 40, 0.0, 12, 0.0, 0, 1, 0, 1),
    (3, 0.0, 30, 0.0, 8, 0.0, 0, 1, 0, 1), (45, 0.1, 50, 0.0, 40, 0.0, 0, 1, 0, 1), (20, 0.3, 60, 0.0, 70, 0.0, 0, 1, 0, 1), (2, 0.0, 9, 0.0, 10, 0.0, 0, 1, 0, 1),
    (400, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1), (7, 0.0, 25, 0.0, 9, 0.3, 0, 1, 0, 1), (60, 0.0, 1, 1.0, 50, 0.0, 0, 1, 0, 1), (15, 0.0, 8, 0.0, 14, 0.0, 0, 1, 0, 1),
    # article markup: short text among short text
    (6, 0.0, 0, 0.0, 6, 0.0, 0, 1, 1, 1), (6, 0.0, 6, 0.0, 0, 0.0, 0, 1, 0, 1), (1, 0.0, 0, 0.0, 1, 0.0, 0, 1, 0, 1), (2, 0.0, 3, 0.0, 1, 0.0, 0, 1, 0, 1),
    (4, 0.0, 1, 1.0, 2, 0.0, 0, 1, 0, 1), (5, 0.0, 0, 0.0, 2, 1.0, 0, 1, 0, 1), (3, 0.0, 2, 1.0, 2, 1.0, 0, 1, 0, 1), (10, 0.0, 5, 0.0, 1, 0.0, 0, 1, 1, 1),
    (4, 0.0, 3, 0.0, 5, 1.0, 0, 1, 1, 1), (12, 0.4, 4, 0.0, 3, 0.0, 0, 1, 0, 1), (18, 0.0, 2, 0.0, 6, 0.0, 0, 1, 0, 1), (1, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (10, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 3, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 0, 0.0, 4, 0.0, 0, 1, 0, 1),
    # article markup: lists of links such as further reading
    (4, 1.0, 5, 1.0, 4, 1.0, 0, 1, 0, 0), (6, 1.0, 40, 0.0, 5, 1.0, 0, 1, 0, 0), (3, 1.0, 4, 1.0, 9, 0.0, 0, 1, 0, 0), (8, 0.9, 6, 1.0, 0, 0.0, 0, 1, 0, 0),
    # furniture: menus, adverts, notices, footers, comments, whatever their size
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 2, 1.0, 8, 0.0, 1, 0, 0, 0), (8, 0.0, 1, 1.0, 10, 0.0, 1, 0, 0, 0),
    (14, 0.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0), (16, 0.0, 50, 0.0, 0, 0.0, 1, 0, 0, 0), (40, 0.1, 30, 0.0, 0, 0.0, 1, 0, 0, 0), (90, 0.0, 12, 0.0, 70, 0.0, 1, 0, 0, 0),
    (35, 0.0, 6, 0.0, 25, 0.0, 1, 1, 0, 0), (120, 0.0, 80, 0.0, 60, 0.0, 1, 1, 0, 0), (5, 0.0, 90, 0.0, 100, 0.0, 1, 1, 0, 0), (10, 0.5, 100, 0.0, 30, 0.0, 1, 1, 0, 0),
    (4, 0.0, 20, 0.0, 15, 0.0, 1, 0, 1, 0), (6, 0.0, 40, 0.0, 30, 0.0, 1, 1, 1, 0), (200, 0.0, 4, 0.0, 90, 0.0, 1, 0, 0, 0), (2, 0.0, 3, 0.0, 3, 0.0, 1, 0, 0, 0),
    # hints: adverts, notices, comments, headings of such, lists of links
    (1, 1.0, 1, 1.0, 1, 1.0, 0.5, 0, 0, 0), (2, 1.0, 2, 1.0, 8, 0.0, 0.5, 0, 0, 0), (11, 0.0, 1, 1.0, 8, 0.0, 0.5, 0, 0, 0), (6, 0.0, 11, 0.0, 5, 0.0, 0.5, 0, 0, 0),
    (13, 0.0, 2, 0.0, 1, 0.0, 0.5, 1, 0, 0), (16, 0.0, 50, 0.0, 0, 0.0, 0.5, 0, 0, 0), (40, 0.1, 30, 0.0, 0, 0.0, 0.5, 0, 0, 0), (35, 0.0, 6, 0.0, 25, 0.0, 0.5, 1, 0, 0),
    (45, 0.0, 20, 0.0, 15, 0.0, 0.5, 0, 0, 0), (30, 0.0, 90, 0.0, 110, 0.0, 0.5, 1, 0, 0), (50, 0.0, 30, 0.0, 80, 0.0, 0.5, 1, 0, 0), (25, 0.0, 120, 0.0, 150, 0.0, 0.5, 0, 0, 0),
    (90, 0.0, 2, 1.0, 6, 0.0, 0.5, 0, 0, 0), (150, 0.0, 3, 0.0, 2, 1.0, 0.5, 0, 0, 0), (120, 0.6, 90, 0.5, 80, 0.5, 0.5, 0, 0, 0), (300, 0.8, 90, 0.0, 80, 0.0, 0.5, 0, 0, 0),
    (4, 0.0, 20, 0.0, 15, 0.0, 0.5, 0, 1, 0), (6, 0.0, 40, 0.0, 30, 0.0, 0.5, 1, 1, 0), (5, 1.0, 30, 0.0, 90, 0.0, 0.5, 0, 1, 0), (3, 0.0, 90, 0.0, 40, 0.0, 0.5, 0, 1, 0),
    (8, 0.0, 1, 1.0, 150, 0.0, 0.5, 0, 0, 0), (11, 0.0, 0, 0.0, 200, 0.0, 0.5, 0, 0, 0), (6, 0.0, 60, 0.0, 120, 0.0, 0.5, 1, 0, 0), (15, 0.0, 2, 0.0, 300, 0.0, 0.5, 0, 0, 0),
    # hints overruled: long text beside long text, very long text, headings before long text
    (80, 0.0, 70, 0.0, 90, 0.0, 0.5, 0, 0, 1), (120, 0.0, 80, 0.0, 60, 0.0, 0.5, 1, 0, 1), (150, 0.0, 10, 0.0, 120, 0.0, 0.5, 0, 0, 1), (100, 0.0, 140, 0.0, 5, 0.0, 0.5, 0, 0, 1),
    (200, 0.0, 4, 0.0, 90, 0.0, 0.5, 0, 0, 1), (400, 0.0, 5, 0.0, 3, 0.0, 0.5, 0, 0, 1), (250, 0.0, 2, 1.0, 2, 1.0, 0.5, 1, 0, 1), (90, 0.1, 60, 0.0, 80, 0.0, 0.5, 1, 0, 1),
    (8, 0.0, 2, 0.0, 150, 0.0, 0.5, 0, 1, 1), (6, 0.0, 100, 0.0, 120, 0.0, 0.5, 1, 1, 1), (3, 0.0, 90, 0.0, 95, 0.0, 0.5, 0, 1, 1), (10, 0.0, 2, 1.0, 300, 0.0, 0.5, 0, 1, 1),
    (120, 0.0, 1, 0.0, 90, 0.0, 0.5, 0, 0, 1), (110, 0.0, 0, 0.0, 95, 0.0, 0.5, 1, 0, 1), (75, 0.0, 2, 0.0, 75, 0.0, 0.5, 0, 0, 1), (130, 0.0, 3, 0.0, 70, 0.0, 0.5, 1, 0, 1),
    # furniture by element stays so at any size
    (80, 0.0, 70, 0.0, 90, 0.0, 1, 0, 0, 0), (120, 0.0, 80, 0.0, 60, 0.0, 1, 1, 0, 0), (400, 0.0, 5, 0.0, 3, 0.0, 1, 0, 0, 0), (250, 0.0, 2, 1.0, 2, 1.0, 1, 1, 0, 0),
    (100, 0.0, 140, 0.0, 5, 0.0, 1, 0, 0, 0), (90, 0.1, 60, 0.0, 80, 0.0, 1, 1, 0, 0), (8, 0.0, 2, 0.0, 150, 0.0, 1, 0, 1, 0), (6, 0.0, 100, 0.0, 120, 0.0, 1, 1, 1, 0),
    # no markup to go by: long text is content, short text only beside long text
    (80, 0.0, 5, 0.0, 70, 0.0, 0, 0, 0, 1), (40, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (25, 0.05, 30, 0.0, 45, 0.0, 0, 0, 0, 1), (150, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (12, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (6, 0.0, 50, 0.0, 70, 0.0, 0, 0, 0, 1), (8, 0.0, 3, 0.5, 80, 0.0, 0, 0, 1, 1), (5, 0.0, 90, 0.0, 60, 0.0, 0, 0, 1, 1),
    (30, 0.2, 40, 0.0, 2, 1.0, 0, 0, 0, 1), (3, 0.0, 80, 0.0, 40, 0.0, 0, 0, 0, 1), (18, 0.0, 2, 1.0, 90, 0.0, 0, 0, 0, 1), (60, 0.1, 2, 1.0, 2, 1.0, 0, 0, 0, 1),
    # no markup: link lists, short text among short text
    (2, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0, 0), (10, 0.8, 4, 1.0, 5, 1.0, 0, 0, 0, 0), (30, 0.9, 3, 1.0, 3, 1.0, 0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 1, 1.0, 4, 0.5, 0, 0, 0, 0), (4, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (6, 0.0, 5, 0.0, 0, 0.0, 0, 0, 0, 0),
    (25, 0.7, 50, 0.0, 20, 0.8, 0, 0, 0, 0), (7, 0.6, 40, 0.0, 3, 1.0, 0, 0, 0, 0), (2, 0.5, 4, 0.5, 3, 0.5, 0, 0, 0, 0), (4, 0.0, 3, 0.0, 5, 1.0, 0, 0, 1, 0),
]
# The same with the share of the page's longest article: teasers and related articles beside a longer one.
_BESIDE = [
    (6, 1.0, 80, 0.0, 14, 0.0, 0, 1, 1, 0.1, 0), (14, 0.0, 6, 1.0, 6, 1.0, 0, 1, 0, 0.1, 0), (5, 0.0, 12, 0.0, 18, 0.0, 0, 1, 1, 0.05, 0), (18, 0.0, 5, 0.0, 2, 1.0, 0, 1, 0, 0.05, 0),
    (2, 1.0, 18, 0.0, 5, 0.0, 0, 1, 0, 0.05, 0), (30, 0.0, 7, 1.0, 2, 1.0, 0, 1, 0, 0.2, 0), (25, 0.0, 40, 0.0, 6, 0.0, 0, 1, 0, 0.15, 0), (8, 0.0, 60, 0.0, 25, 0.0, 0, 1, 1, 0.2, 0),
    (120, 0.0, 8, 0.0, 90, 0.0, 0, 1, 0, 0.5, 1), (8, 0.0, 60, 0.0, 120, 0.0, 0, 1, 1, 0.5, 1), (15, 0.0, 80, 0.0, 60, 0.0, 0, 1, 0, 0.6, 1), (60, 0.0, 15, 0.0, 0, 0.0, 0, 1, 0, 0.7, 1),
    (5, 0.0, 0, 0.0, 30, 0.0, 0, 1, 1, 0.8, 1), (30, 0.0, 5, 0.0, 12, 0.0, 0, 1, 0, 0.8, 1), (12, 0.0, 30, 0.0, 5, 0.0, 0, 1, 0, 0.9, 1), (40, 0.1, 6, 0.0, 7, 0.0, 0, 1, 0, 0.5, 1),
]
LABELLED = [(*row[:-1], 1.0, row[-1]) for row in _ALONE] + _BESIDE


def grow(x: np.ndarray, y: np.ndarray) -> tuple:
    """A decision tree by Gini impurity, grown until its leaves are pure: (feature, threshold,
    tree up to the threshold, tree above it), or (label,)."""
    if len(set(y.tolist())) == 1:
        return (bool(y[0]),)
    best = None
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for t in (values[:-1] + values[1:]) / 2:
            left = x[:, j] <= t
            cost = sum(s.sum() * (m := y[s].mean()) * (1 - m) for s in (left, ~left))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, j, float(t))
    if best is None:  # equal blocks with different labels
        return (bool(y.mean() >= 0.5),)
    left = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[left], y[left]), grow(x[~left], y[~left]))


def default_tree() -> tuple:
    """Grown from LABELLED, each grade of furniture for itself."""
    table = np.array(LABELLED, float)
    j = FEATURES.index("furniture")
    none, hint, element = (grow(rows[:, :-1], rows[:, -1]) for rows in (table[table[:, j] == grade] for grade in (0, 0.5, 1)))
    return (j, 0.25, none, (j, 0.75, hint, element))


def is_content(tree: tuple, x: np.ndarray) -> bool:
    while len(tree) > 1:
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def main_text(page: str | None, tree: tuple) -> str:
    """The content blocks of a page joined by an empty line; null, empty and blockless: empty."""
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b.text for b, x in zip(found, describe(found)) if is_content(tree, x))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), tree: tuple | None = None) -> DataFrame:
    """Per page: the ``keep`` columns as they are, ``text`` and ``n_chars`` (its code points).

    Every row is read whole, repeated rows too; null html counts as empty; other columns are not
    read; an empty table gives an empty result. ``tree`` replaces the default classifier.
    """
    tree = tree or default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                rows = batch.slice(a, 256)
                texts = [main_text(p, tree) for p in rows.column(len(keep)).to_pylist()]
                yield pa.record_batch([*rows.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    fields = [T.StructField(c, pages.schema[c].dataType) for c in keep]
    out = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*keep, F.col(html_col).cast("string").alias("__html")).mapInArrow(run, out)
