"""Blocks of a web page: runs of text between block-level tags, with what the markup says of them.

Tokens are found by one regular expression of possessive parts, so its work is in proportion
to the page. Comments, scripts, styles, titles and the like are no text; an unclosed one runs
to the end, as browsers have it. Character references are decoded and white space, as Python's
``str.split`` knows it, becomes one space. Inline tags and line breaks do not end a block.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?-->|.*)"
    rf"|<(script|style|title|textarea|xmp|noembed|noframes)(?=[\s/>]){_ATTRIBUTES}>(?:.*?</\1(?=[\s/>])[^>]*+>|.*)"
    rf"|<(/?)([a-z][^\s/>]*+)({_ATTRIBUTES})>"
    r"|<[!?/][^>]*+>"
    r"|<[a-z!?/][^>]*+\Z",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden|itemprop)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
    re.IGNORECASE,
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ITEMS = frozenset("li dt dd option".split())
_CELLS = frozenset("td th caption".split())
#: Elements whose text is a block of its own.
_LEAVES = _HEADINGS | _ITEMS | _CELLS | frozenset("p pre figcaption summary legend address".split())
#: Elements that hold blocks.
_CONTAINERS = frozenset(
    "html body div section article main nav header footer aside form fieldset ul ol dl menu table thead "
    "tbody tfoot tr blockquote figure details dialog center hgroup search head noscript template svg "
    "select button iframe object canvas video audio map label".split()
)
_BLOCKS = _LEAVES | _CONTAINERS | {"hr"}
_VOID = frozenset("hr br img input meta link area base col embed source track wbr param".split())
#: Elements that another one of the same kind closes, up to the nearest element that holds them.
_CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
}

#: What an element says of the text in it.
CONTENT, UNKNOWN, SOFT, FIRM = 1, 0, -1, -2
_FIRM_TAGS = frozenset(
    "nav footer aside dialog menu search button select noscript template svg iframe object canvas video "
    "audio fieldset label head map".split()
)
_FIRM_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu toolbar".split())
_FIRM_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice popup modal overlay newsletter subscribe signup login sidebar widget related recommended share "
    "sharing social breadcrumb breadcrumbs pagination pager menu navbar nav navigation footer masthead toolbar topbar "
    "copyright comment comments commentlist disqus respond reply replies".split()
)
_CONTENT_WORDS = frozenset("article content main post entry story body text prose".split())
#: Words of layout: a class name with one of them does not tell of the element's own text.
_LAYOUT_WORDS = frozenset("has with no without layout wrapper page site".split())


class Block(NamedTuple):
    """One block: its text, its kind, link share in it, what the markup says, and its container."""

    text: str
    kind: str
    link_share: float
    verdict: int
    container: int


def _named(value: str, inherited: int) -> int:
    """What class names and ids say."""
    content = False
    for name in value.lower().split():
        words = set(re.split(r"[^a-z0-9]+", name))
        if words & _LAYOUT_WORDS:
            continue
        if words & _FIRM_WORDS:
            return FIRM
        if words & _CONTENT_WORDS:
            content = True
        elif "header" in words and inherited != CONTENT:
            return FIRM
    return CONTENT if content else UNKNOWN


def _verdict(tag: str, attributes: str, inherited: int) -> int:
    """What an element says of its text, given what the ones around it say.

    Firm boilerplate holds for all that is inside, but for a ``main`` element. A form's text is
    boilerplate unless an article or content is marked in it.
    """
    if tag in ("html", "body"):
        return inherited
    said, role = UNKNOWN, ""
    if attributes:
        for match in _ATTRIBUTE.finditer(attributes):
            name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
            if name in ("class", "id"):
                found = _named(value, inherited)
                said = found if said == UNKNOWN or found == FIRM else said
            elif name == "role":
                role = value.strip().lower()
            elif name == "itemprop" and value.lower() == "articlebody":
                said = CONTENT if said == UNKNOWN else said
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or _HIDDEN.search(value):
                return FIRM
    if tag == "main" or role == "main":
        return FIRM if said == FIRM else CONTENT
    if inherited == FIRM or said == FIRM or tag in _FIRM_TAGS or role in _FIRM_ROLES:
        return FIRM
    if tag == "article" or role == "article" or said == CONTENT:
        return CONTENT
    if tag == "header":
        return CONTENT if inherited == CONTENT else FIRM
    if tag == "form":
        return SOFT
    return inherited


def page_blocks(html: str) -> tuple[list[Block], list[int]]:
    """The blocks of a page in order, and for each container the one around it (the first has -1)."""
    blocks: list[Block] = []
    around = [-1]
    # Open elements: tag, container of its blocks, verdict, kind of its blocks.
    stack = [("", 0, UNKNOWN, "text")]
    parts: list[str] = []
    linked, in_link, last = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join(raw.split())
            if text:
                _, container, verdict, kind = stack[-1]
                blocks.append(Block(text, kind, min(1.0, linked / len(text)), verdict, container))
            parts.clear()
            linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if "&" in piece:
            piece = unescape(piece)
        parts.append(piece)
        if in_link:
            linked += len(piece.strip())

    for token in _TOKEN.finditer(html):
        start = token.start()
        if start > last:
            add(html[last:start])
        last = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag, closing = tag.lower(), token[2]
        if tag not in _BLOCKS:
            if tag == "a":
                in_link = not closing and "href" in token[4].lower()
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        if closing:
            in_link = False
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == tag:
                    del stack[at:]
                    break
                # A leaf's end does not reach beyond its container.
                if tag in _LEAVES and stack[at][0] in _CONTAINERS:
                    break
            continue
        if stack[-1][0] == "p" or (tag in _HEADINGS and stack[-1][0] in _HEADINGS):
            stack.pop()
        if tag in _CLOSED_BY:
            same, holders = _CLOSED_BY[tag]
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in holders:
                    break
                if stack[at][0] in same:
                    del stack[at:]
                    break
        if tag in _VOID:
            continue
        _, container, inherited, kind = stack[-1]
        verdict = _verdict(tag, token[4], inherited)
        if tag in _CONTAINERS:
            around.append(container)
            container = len(around) - 1
        kind = "heading" if tag in _HEADINGS else "item" if tag in _ITEMS or kind == "item" else "text"
        stack.append((tag, container, verdict, kind))
    if last < len(html):
        add(html[last:])
    flush()
    return blocks, around
