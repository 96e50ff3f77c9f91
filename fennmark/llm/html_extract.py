"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass, each block by itself: blocks that are mostly link text are bad; so are
those in menus, headers, footers, sidebars, notices, adverts, forms, comments and the like, also where these hold an article
element of their own. For other blocks length and stop-word density decide, and short ones stay open, as do long ones of few
stop words without links (tables, code, other languages). The page's article element is a prior: inside it a lower density is
enough, and names that a text may have itself (a section `discussion`, a `post-header`) do not count. Inside it a short link that
stands alone (a linked title) is open too. Second pass: an open block takes the label that its nearest decided neighbours share, the nearer one's where they
differ, good where they are equally near. Blocks dropped by their place are no neighbours, as what surrounds a text says nothing of
it. Open blocks inside an article look at its other blocks only and are good where none is decided; those outside do not look
into the article. A page with neither an article nor a good block has its long open blocks as good ones.

Defined results: a null or empty html, or one without good blocks, gives the empty text; a very long page is one row like any
other; repeated rows and ties are each extracted alike; an empty table gives an empty table; blocks keep page order and repeats;
unclosed and stray tags are tolerated (an article opens afresh what was opened before it and is never closed); further columns are ignored.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tag and name lists.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
DROPPED_TAGS = frozenset("nav footer aside form menu button select textarea label fieldset dialog iframe object canvas audio video title head".split())
NAMES = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion disqus dialog footer form header login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget".split()
)
#: Of these, the names that parts of an article bear too.
OWN_NAMES = frozenset("discussion form header reply response respond search share sharing skip social".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
STOP_WORDS = frozenset(
    "a an and are as at be been but by for from had has have he her his i if in is it its not of on or she so that the their there they this to was we were which who will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "aber als auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich ihr im ist mit nach nicht oder sich sie sind so und von vor war wie wir zu zum zur "
    "al como con del el ella ellos era esta este lo los las más muy no para pero por sin su sus también una y ya".split()
)
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|title)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^<>\"']|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPLIT_NAME = re.compile(r"[^a-z0-9]+")
#: Lengths in characters; shares of link text and of stop words; STOPS_INSIDE: what is enough in an article.
SHORT, LONG, LINKS, STOPS_LOW, STOPS_HIGH, STOPS_INSIDE = 70, 200, 0.5, 0.15, 0.3, 0.1
GOOD, BAD, OPEN = 1, 0, -1


def _dropped(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in DROPPED_TAGS or tag == "header" and not in_article:
        return True
    if attrs and tag not in ("html", "body", "article", "main"):
        for name, value in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name in ("class", "id") and not (NAMES - OWN_NAMES if in_article else NAMES).isdisjoint(SPLIT_NAME.split(value)):
                return True
    elif attrs and tag == "article":  # readers' comments are often marked up as articles
        return any(name.lower() in ("class", "id") and not {"comment", "comments", "reply"}.isdisjoint(SPLIT_NAME.split(value.lower())) for name, value in ATTRIBUTE.findall(attrs))
    return False


def _closed(marks: list[re.Match[str]]) -> set[int]:
    """Which marks open containers that are closed by a tag of their own."""
    out, stack = set(), []
    for k, m in enumerate(marks):
        tag = (m["tag"] or "").lower()
        if tag and (tag in BLOCK_TAGS or tag in DROPPED_TAGS) and tag not in VOID_TAGS:
            if not m["close"]:
                stack.append((tag, k))
            elif any(s[0] == tag for s in stack):
                while stack[-1][0] != tag:
                    stack.pop()
                out.add(stack.pop()[1])
    return out


def blocks(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters of link text, dropped by its place, inside an article) of each block that has text."""
    out: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # open containers: tag, dropped, article, closed later
    marks = list(MARKUP.finditer(page))
    closed = _closed(marks)
    parts: list[str] = []
    links, linked, own_drop, at = 0, 0, False, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, linked, own_drop or any(s[1] for s in stack), any(s[2] for s in stack)))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw)
        parts.append(text)
        if links:
            linked += len(text.strip())

    for k, m in enumerate(marks):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 0 if m["close"] else 1
        elif tag in BLOCK_TAGS or tag in DROPPED_TAGS:
            flush()
            if m["close"]:
                own_drop = False
                if any(s[0] == tag for s in stack):
                    while stack.pop()[0] != tag:
                        pass
                links = 0
            else:
                in_article = any(s[2] for s in stack)
                drop = _dropped(tag, m["attrs"], in_article)
                own_drop = False
                if tag in ("article", "main") and not drop and not in_article:
                    stack = [s for s in stack if not s[1] or s[3]]
                    stack.append((tag, False, True, k in closed))
                elif tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6"):
                    own_drop = drop
                elif tag not in VOID_TAGS:
                    stack.append((tag, drop, False, k in closed))
    if at < len(page):
        add(page[at:])
    flush()
    return out


def stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(text: str, linked: int, dropped: bool, in_article: bool) -> int:
    if linked > LINKS * len(text) or dropped:
        return BAD
    if len(text) < SHORT:
        return OPEN
    stops = stop_share(text)
    if in_article:
        return GOOD if stops >= STOPS_INSIDE else OPEN
    if stops >= STOPS_HIGH or len(text) >= LONG and stops >= STOPS_LOW:
        return GOOD
    return OPEN if stops >= STOPS_LOW or not linked else BAD


def second_pass(labels: list[int]) -> list[int]:
    """Open labels take over from the nearest decided neighbours."""
    n, far = len(labels), 1 << 60
    before, after = [(far, BAD)] * n, [(far, BAD)] * n
    last = (far, BAD)
    for k, label in enumerate(labels):
        last = (0, label) if label != OPEN else (last[0] + 1, last[1])
        before[k] = last
    last = (far, BAD)
    for k in range(n - 1, -1, -1):
        last = (0, labels[k]) if labels[k] != OPEN else (last[0] + 1, last[1])
        after[k] = last
    return [min(a, b, key=lambda x: (x[0], -x[1]))[1] for a, b in zip(before, after, strict=True)]


def article_labels(found: list[tuple[str, int, bool, bool]]) -> list[int]:
    """Labels of the blocks inside articles, none of them dropped by its place."""
    labels = [first_pass(*b) for b in found]
    dense = [b[1] > LINKS * len(b[0]) for b in found]
    for k, (text, *_) in enumerate(found):
        if dense[k] and len(text) < SHORT and not any(dense[max(0, k - 1) : k]) and not any(dense[k + 1 : k + 2]):
            labels[k] = OPEN
    return second_pass(labels) if any(x != OPEN for x in labels) else [GOOD] * len(labels)


def outside_labels(found: list[tuple[str, int, bool, bool]], alone: bool) -> list[int]:
    """Labels of the blocks outside articles, none of them dropped by its place; alone: the page has no article."""
    labels = [first_pass(*b) for b in found]
    if alone and GOOD not in labels:  # a page without any prose: its long blocks are what it has to say
        labels = [GOOD if x == OPEN and len(b[0]) >= LONG else x for x, b in zip(labels, found, strict=True)]
    return second_pass(labels)


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    inside = [k for k, b in enumerate(found) if b[3] and not b[2]]
    outside = [k for k, b in enumerate(found) if not b[3] and not b[2]]
    labels = dict(zip(inside, article_labels([found[k] for k in inside]), strict=True))
    labels |= dict(zip(outside, outside_labels([found[k] for k in outside], not inside), strict=True))
    return "\n\n".join(b[0] for k, b in enumerate(found) if labels.get(k) == GOOD)


def extract(page: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(main_text, na_action=None) if len(pages) else pages.astype(str)

    return run(F.coalesce(page, F.lit("")))


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of each page, empty if it has none."""
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), extract(F.col(page)).alias("text"))
