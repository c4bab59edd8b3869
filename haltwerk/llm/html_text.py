"""Blocks of an HTML page and what their place in the markup says about them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

CHROME, OPEN, MAIN = 0, 1, 2

#: Elements whose content is never text of the page, or never of its article.
UNSEEN = set("script style head noscript template iframe object embed svg math canvas audio video textarea select option button".split())
ASIDE = set("nav footer aside menu dialog form".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words of class and id that mark what is not the article, and what is.
NOT_ARTICLE = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside ad ads adv advert adverts advertisement "
    "advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert newsletter subscribe subscription "
    "popup modal overlay share sharing social related recommended comment comments commentlist disqus reply replies respond discussion widget "
    "toolbar pagination pager skip login signup search copyright legal disclaimer form".split()
)
#: Of these, words that also name parts of an article: inside one they count only in class tokens made of such words alone.
STRUCTURAL = set(
    "header footer side aside banner notice notices alert legal copyright disclaimer form search share sharing social related menu overlay login signup skip "
    "subscription comment discussion reply respond ad".split()
)
ARTICLE = set("article content post entry story".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content holds no tags.
RAW = set("script style textarea title iframe noembed noframes xmp".split())

# A tag with whole quoted values; or, where a quote never ends, up to the next >.
_NAME = r"<(/?)([a-zA-Z][^\s/>]*)"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|{_NAME}((?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*))>|{_NAME}([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    text: str
    role: int


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(text)}


def _marks(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool, bool, bool]:
    """(unseen, not article, article element, main element, marked as content) that the element starts; ``inside``: it is in an article.

    The classes of an article or main element do not make it something else, only its role and what is around it.
    """
    unseen, aside = tag in UNSEEN, tag in ASIDE or (tag == "header" and not inside)
    article, main, content = tag == "article", tag == "main", False
    if attributes and ("=" in attributes or "hidden" in attributes):
        a = _attributes(attributes)
        tokens = [set(_PARTS.split(t)) - {""} for k in ("class", "id") for t in a.get(k, "").lower().split()]
        words = set().union(*tokens)
        role = a.get("role", "").lower()
        style = a.get("style", "").replace(" ", "").lower()
        unseen |= "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in style
        if tag not in ("html", "body"):
            article |= role == "article"
            main |= role == "main"
            aside |= role in ROLES
            if inside:
                aside |= any(t and (t <= NOT_ARTICLE or t & NOT_ARTICLE - STRUCTURAL) for t in tokens) and not (article or main)
            elif not (article or main):
                aside |= bool(words & NOT_ARTICLE)
            content = bool(words & ARTICLE)
    return unseen, aside, article and not aside, main, content and not aside


def blocks_of(page: str) -> list[Block]:
    """The visible blocks of a page in order, white space inside each turned into one space.

    A block's role: CHROME in menus, headers, footers, side bars, notices, adverts, forms and comments; MAIN in
    an article element, else, if the page has none, in its main element, else in what is marked as content; OPEN if the page has
    nothing of these. Unclosed and misplaced tags are taken as browsers take them, broken ones as text.
    """
    found: list[tuple[str, bool, bool, bool, bool]] = []
    stack: list[tuple] = []  # (tag, unseen, aside, article, main, content), each with what is around it
    counts: dict[str, int] = {}
    pieces: list[str] = []
    top = (None, False, False, False, False, False)

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                found.append((text, *top[2:]))

    def pop() -> None:
        """Leave an element; one that is not seen inside a block does not end the block."""
        nonlocal top
        around = stack[-2] if len(stack) > 1 else (None, False, False, False, False, False)
        if top[0] in BLOCKS or top[2:] != around[2:]:
            flush()
        counts[stack.pop()[0]] -= 1
        top = around

    at, last = 0, page.rfind(">")
    while True:
        m = _TAG.search(page, at) if at <= last else None
        if m is None:
            if not top[1]:
                pieces.append(page[at:].partition("<!--")[0])
            break
        if m.start() > at and not top[1]:
            pieces.append(page[at : m.start()])
        at, closing, tag = m.end(), m.group(1) or m.group(4), (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue
        block = tag in BLOCKS
        if block:
            flush()
        elif tag == "br" and not top[1]:
            pieces.append(" ")
        if closing:
            if counts.get(tag, 0):
                if block or tag in UNSEEN:
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                else:  # an inline element ends inside its block only
                    k = len(stack) - 1
                    while k >= 0 and stack[k][0] != tag and stack[k][0] not in BLOCKS:
                        k -= 1
                    if k >= 0 and stack[k][0] == tag:
                        while len(stack) > k:
                            pop()
            continue
        if tag in VOID:
            continue
        if block and top[0] == tag and tag in ("p", "li", "dt", "dd", "td", "th", "tr", "option"):
            pop()
        unseen, aside, article, main, content = _marks(tag, m.group(3) or m.group(6), top[3] or top[4])
        if block or unseen or aside or article or main or content:
            if aside or article or main or content:
                flush()
            top = (tag, top[1] or unseen, top[2] or aside, top[3] or article, top[4] or main, top[5] or content)
            stack.append(top)
            counts[tag] = counts.get(tag, 0) + 1
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if not top[1]:
                pieces.append(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
    flush()
    level = next((k for k in (2, 3, 4) if any(b[k] and not b[1] for b in found)), None)
    return [Block(b[0], CHROME if b[1] else OPEN if level is None else MAIN if b[level] else CHROME) for b in found]
