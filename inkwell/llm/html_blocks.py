"""HTML to text blocks: a small tag scanner that marks where each block stands.

``blocks(html)`` returns ``(level, side, text)`` per block in page order.
``level`` says how strongly the markup names the block as article text (3: in
an <article>, 2: in <main> or its roles, 1: in an element named like content,
0: nothing says so); ``side`` is true inside menus, page headers and footers,
sidebars, notices, adverts, forms and reader comments.  Scripts, styles,
comments, hidden elements and the head yield nothing.  ``placed_blocks`` adds
the levels of all elements around the block.

A class or id is read as a whole token: its last part that is no mere container
word names the thing ("cookie-banner", "sidebar-left"), and tokens that tell a
state ("no-sidebar", "comments-open") name nothing.  <html> and <body> are never
side.  Names may err on a wrapper, so an <article> or <main> inside is not side
for them; it stays so inside tags and roles that say it (<nav>, <aside>).
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.DOTALL)
ATTR = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
NAME = re.compile(r"[a-z]+|[0-9]+")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas video audio head title select textarea button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
SIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
SIDE_NAMES = frozenset("ad ads adv advert advertisement adverts adsense sponsor sponsored promo promotion banner cookie cookies "
                       "consent gdpr notice notices newsletter subscribe subscription signup paywall menu nav navbar "
                       "navigation breadcrumb breadcrumbs sidebar widget widgets footer masthead comment comments "
                       "respond replies disqus share sharing social related recommended recommendations popup modal "
                       "overlay toolbar pagination pager login skip topbar".split())
MAIN_NAMES = frozenset("article content post entry story main articlebody".split())
# Parts of a name that say where or in what a thing is, and those that say whether it is there.
CONTAINER_WORDS = MAIN_NAMES | frozenset(
    "area articles bar block body bottom box button buttons card column container content entries form group inner item items "
    "left link links list module outer panel posts primary region right row secondary section slot text title top unit "
    "wrap wrapper".split())
STATE_WORDS = frozenset("no non not with without has have is hide hidden show shown enable enabled disable disabled".split())
# Kinds of side: what a name or a form around the page says, and what stands whatever is inside.
NAMED_SIDE, FIRM_SIDE = 1, 2
# Tags and their places that are remembered per worker, those of few characters only.
KEPT_PLACES, KEPT_CHARS = 4096, 200


def _tokens(attrs: dict[str, str]) -> list[list[str]]:
    """The classes and the id, each as its parts."""
    return [parts for t in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split() if (parts := NAME.findall(t))]


def _thing(parts: list[str]) -> str:
    """What a class or id names: its last part that is no container word; '' for a state."""
    if STATE_WORDS.intersection(parts):
        return ""
    named = [p for p in parts if not p.isdigit()] or parts
    while len(named) > 1 and named[-1] in CONTAINER_WORDS:
        named = named[:-1]
    return named[-1]


def _side_of_names(tokens: list[list[str]]) -> bool:
    whole = {t[0] for t in tokens if len(t) == 1}
    # "content right-sidebar" is content with a sidebar beside it
    return any(_thing(t) in SIDE_NAMES for t in tokens if len(t) == 1 or not whole & MAIN_NAMES)


def _place(name: str, raw: str, level: int, side: int) -> tuple[int, int, bool]:
    """(level, side, hidden) inside an element that opens within (level, side)."""
    attrs = {k.lower(): v.strip("\"'") for k, v in ATTR.findall(raw)} if raw.strip() else {}
    role = attrs.get("role", "").lower()
    tokens = _tokens(attrs) if attrs else []
    names = {p for t in tokens for p in t}
    bare = raw.lower().split()
    hidden = "hidden" in bare or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()
    own_article = name == "article" or role == "article" or "articlebody" in attrs.get("itemprop", "").lower()
    own_main = name == "main" or role == "main"
    if side == NAMED_SIDE and (own_article or own_main):
        side = 0
    if name not in ("html", "body"):
        if (name in SIDE_TAGS and name != "form") or role in SIDE_ROLES:
            side = FIRM_SIDE
        elif (name == "form" or _side_of_names(tokens)
                or ((name == "header" or any(_thing(t) == "header" for t in tokens)) and level < 2)):
            side = side or NAMED_SIDE
    if own_article:
        level = 3
    elif own_main:
        level = max(level, 2)
    elif names & MAIN_NAMES and name not in ("body", "html"):
        level = max(level, 1)
    return level, side, hidden


_kept_place = lru_cache(KEPT_PLACES)(_place)


def blocks(html: str) -> list[tuple[int, bool, str]]:
    return [(level, side, text) for level, side, _, text in placed_blocks(html)]


def placed_blocks(html: str) -> list[tuple[int, bool, frozenset[int], str]]:
    """``(level, side, levels, text)``: ``levels`` are those of all open elements."""
    out: list[tuple[int, bool, frozenset[int], str]] = []
    stack: list[tuple[str, int, int]] = []       # open elements: name, level, side
    level, side, at, text = 0, 0, 0, []

    def flush() -> None:
        words = unescape("".join(text)).split()
        if words:
            out.append((level, bool(side), frozenset(s[1] for s in stack) | {level}, " ".join(words)))
        text.clear()

    while (m := TAG.search(html, at)) is not None:
        text.append(html[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m.group().startswith("<![CDATA["):
                text.append(m.group()[9:].removesuffix("]]>"))
            continue
        raw, closing = m["attrs"] or m["attrs2"] or "", bool(m["end"] or m["end2"])
        if name in RAW:
            if not closing and not raw.endswith("/"):
                shut = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(html, at)
                if shut:
                    at = shut.end()
                elif name in ("script", "style", "title", "textarea"):
                    at = len(html)
            continue
        if name in VOID:
            if name in ("br", "hr"):
                text.append(" ")
            continue
        if name in INLINE:
            if closing:
                if any(s[0] == name for s in stack[-3:]):
                    flush()
                    while stack.pop()[0] != name:
                        pass
                    level, side = stack[-1][1:] if stack else (0, 0)
            elif raw.strip():
                inner = (_kept_place if len(raw) <= KEPT_CHARS else _place)(name, raw, level, side)
                if inner[2] or inner[1] != side:          # an inline advert or hidden text
                    flush()
                    stack.append((name, inner[0], FIRM_SIDE if inner[2] else inner[1]))
                    level, side = inner[0], FIRM_SIDE if inner[2] else inner[1]
            continue
        flush()
        if closing:
            if any(s[0] == name for s in stack):
                while stack.pop()[0] != name:
                    pass
        else:
            if stack and stack[-1][0] == "p":              # a block ends an open paragraph
                stack.pop()
            level, side = stack[-1][1:] if stack else (0, 0)
            inner = (_kept_place if len(raw) <= KEPT_CHARS else _place)(name, raw, level, side)
            if not raw.endswith("/"):
                stack.append((name, inner[0], FIRM_SIDE if inner[2] else inner[1]))
        level, side = stack[-1][1:] if stack else (0, 0)
    text.append(html[at:])
    flush()
    return out
