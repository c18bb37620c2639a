"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  The first pass looks at each block by itself:
what stands in a region that the markup declares as navigation, advert, form, comments and the
like is bad; else length, share of stop words and share of linked text make it good, bad,
nearly good, poor or short.  The second pass gives the undecided blocks the label of their nearest
decided neighbours.  Where a page marks its article and good text stands in the mark (or nowhere),
undecided blocks are decided by whether they stand inside it; good and bad ones keep their label.
Linked blocks inside the mark stay where they stand between good ones, such as a list of links in the text.
A page whose long blocks hold next to none of the known stop words is in another language: there length and
share of linked text decide alone.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import type_of

#: Blocks shorter than this are short; those longer than the second are good if they have enough stop words.
SHORT, LONG = 70, 200
#: Shares of stop words from which a block is nearly good and good; share of linked text from which it is bad.
SOME_STOP_WORDS, MANY_STOP_WORDS, MOST_LINKED = 0.10, 0.18, 0.4
#: Below this share of stop words in all its blocks that are not short, a page is in none of the known languages.
NO_STOP_WORDS = 0.10

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their
    they this to was we were which will with would you
    aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es fuer für hat ich im
    ist mit nach nicht oder sich sie sind so und uns unter vom von vor war wie wir wird zu zum zur über
    au aux avec ce cette ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas
    pour qu que qui sa se ses son sont sur un une vous été être
    al con como cuando del desde donde el ella ellos era es esta este fue ha hay la las lo los más me mi muy no nos
    o para pero por porque que se ser si sin sobre su sus también tiene un una uno y ya
    """.split()
)
# Tags that end a block, tags whose content is no text, tags of regions that are no article.
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead tr ul
    """.split()
)
OPAQUE = "script style noscript template svg math iframe object textarea select button title canvas audio video"
REGIONS = frozenset("nav header footer aside form menu dialog fieldset".split())
ARTICLES = frozenset(["article", "main"])
# Words of class, id and role that declare a region that is no article.
DECLARED = frozenset(
    """
    ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr
    notice notices alert warning popup modal overlay newsletter subscribe subscription signup login
    nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager toolbar topbar tabs
    header masthead footer foot copyright sidebar aside widget widgets related recommended recommendations
    share sharing social comment comments commentlist disqus respond reply replies reader-comments
    search searchbox form skip skip-link contentinfo complementary banner-top
    """.split()
)
# What may stand beside declared words in a name of several parts ("site-header", not "no-sidebar").
BESIDE = frozenset(
    """
    site main page global top bottom left right primary secondary first last inner outer wrapper wrap container box
    block area section region zone list links link bar item items text form inline col column row mobile desktop fixed
    body content author meta thread
    """.split()
)
# Words that make reader comments of any name that ends in them ("post-comments"), unless it denies them.
COMMENTS = frozenset(["comment", "comments"])
DENIES = frozenset("no not non without has with hide hidden disable disabled allow".split())
#: Regions in one another that are told apart; deeper ones belong to the last of these.
DEEP = 64
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<opaque>{'|'.join(OPAQUE.split())})(?=[\s/>])(?P<own>[^>]*)>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_CLOSES = {name: re.compile(rf"</{name}\s*>", re.I) for name in OPAQUE.split()}
# Tags that may close themselves, and tags whose content is code even if nothing closes them.
SELF_CLOSED, CODE = frozenset(["svg", "math"]), frozenset(["script", "style"])
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_RIGHTS = re.compile(r"©|\ball rights reserved\b|\balle rechte vorbehalten\b|\btous droits r", re.I)
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    tag: str
    barred: bool  # in a region that is no article
    inside: bool  # in an article region
    label: str = ""
    region: int = -1  # number of the innermost region that is no article


def _names(value: str) -> bool:
    """Whether a class, id or role is a declared name, or made of declared words and what may stand beside them."""
    for name in value.lower().split():
        if name in DECLARED:
            return True
        words = [x for x in re.split(r"[-_]+", name) if x and not x.isdigit()]
        if not DECLARED.isdisjoint(words) and all(x in DECLARED or x in BESIDE for x in words):
            return True
        last = max((i for i, x in enumerate(words) if x in COMMENTS), default=None)
        if last is not None and DENIES.isdisjoint(words) and all(x in BESIDE for x in words[last + 1 :]):
            return True
    return False


def _after(html: str, name: str, own: str, at: int, open_ended: set[str]) -> int:
    """Where the content of an opaque tag ends.  A tag that nothing closes hides itself only, unless it holds code.

    `open_ended` keeps the names without an end further on, so that a page is searched for it once.
    """
    if name in SELF_CLOSED and own.rstrip().endswith("/"):
        return at
    found = None if name in open_ended else _CLOSES[name].search(html, at)
    if found:
        return found.end()
    open_ended.add(name)
    return len(html) if name in CODE else at


def _declared(rest: str) -> bool:
    if not rest:
        return False
    for found in _ATTRIBUTE.finditer(rest):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name in ("class", "id", "role"):
            if _names(value):
                return True
        elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            return True
        elif name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


def blocks(html: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = links = 0
    tag = "body"
    barred: list[list] = []  # open regions that are no article: tag, how many of that tag are open in it, number
    parents: list[int] = []  # the region around each region
    articles: list[int] = []  # the region around each outermost article
    inside: list[str] = []
    breaks = 0

    def close() -> None:
        nonlocal linked, parts
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append(Block(text, linked, tag, bool(barred), bool(inside), region=barred[-1][2] if barred else -1))
        parts, linked = [], 0

    def add(piece: str) -> None:
        nonlocal linked, breaks
        if piece:
            parts.append(piece)
            if not piece.isspace():
                breaks = 0
            if links:
                linked += len(piece)

    at = 0
    open_ended: set[str] = set()
    while token := _TOKEN.search(html, at):
        add(html[at : token.start()])
        at = token.end()
        name = (token["tag"] or "").lower()
        if not name:
            if token["opaque"]:
                parts.append(" ")
                at = _after(html, token["opaque"].lower(), token["own"], at, open_ended)
            continue
        ends = bool(token["end"])
        if name == "a":
            links = max(0, links + (-1 if ends else 1))
        elif name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:  # an empty line ends a block
                close()
        elif name in BLOCKS:
            close()
            breaks = links = 0
            if not ends and barred and barred[-1][0] == "p":
                barred.pop()  # a paragraph ends where the next block begins
            tag = "body" if ends else name
        if name in VOID:
            continue
        own = next((k for k in range(len(barred) - 1, -1, -1) if barred[k][0] == name), None)
        if ends:
            if own is not None:
                barred[own][1] -= 1
                if not barred[own][1]:
                    del barred[own:]
            elif name in ARTICLES and name in inside:
                while inside.pop() != name:
                    pass
            continue
        declared = (name in BLOCKS or name == "span") and name not in ("body", "html") and _declared(token["rest"])
        if name in ARTICLES and not declared:
            if not inside:
                articles.append(barred[-1][2] if barred else -1)
            inside.append(name)
        elif len(barred) < DEEP and (declared or (name in REGIONS and not (name == "header" and inside))):
            if name not in BLOCKS:
                close()
            parents.append(barred[-1][2] if barred else -1)
            barred.append([name, 1, len(parents) - 1])
            continue
        if own is not None:
            barred[own][1] += 1
    add(html[at:])
    close()
    _unbar(out, parents, articles)
    return out


def _unbar(page: list[Block], parents: list[int], articles: list[int]) -> None:
    """Opens regions that hold the page's only article, with good text in it, or most of the good text of a page without one."""
    if not parents or all(block.region < 0 for block in page):
        return
    known = _known(page)
    good = [len(block.text) if _alone(block, known, False) == "good" else 0 for block in page]
    within, marked = [0] * len(parents), 0
    for block, size in zip(page, good):
        marked += size * block.inside
        if block.region >= 0:
            within[block.region] += size
    for region in range(len(parents) - 1, -1, -1):  # regions follow the regions around them
        if parents[region] >= 0:
            within[parents[region]] += within[region]
    closed = [True] * len(parents)
    if marked and len(articles) == 1:
        region = articles[0]
        while region >= 0:
            closed[region], region = False, parents[region]
    elif not any(size and block.inside and block.region < 0 for block, size in zip(page, good)):
        closed = [2 * size <= sum(good) for size in within]
    for region, parent in enumerate(parents):
        closed[region] = closed[region] or (parent >= 0 and closed[parent])
    for block in page:
        block.barred = block.region >= 0 and closed[block.region]


def classify(page: list[Block]) -> list[bool]:
    """Whether each block is main text."""
    known = _known(page)
    for block in page:
        block.label = _alone(block, known)
    # An article mark counts if good text stands in it, or nowhere: articles may be teasers beside the text.
    good = [block.inside for block in page if block.label == "good"]
    marked = any(good) or (not good and any(block.inside and not block.barred for block in page))
    for block in page:
        if marked and block.label in ("near", "poor", "short"):  # in a marked article, few stop words are no fault
            block.label = "good" if block.inside else "bad"
        elif block.label == "linked" and not (marked and block.inside):
            block.label = "bad"
    # What stands in a declared region is no part of the text's flow: such blocks are no neighbours.
    flow = [i for i, block in enumerate(page) if block.label in ("good", "bad") and not block.barred]
    keep = []
    for i, block in enumerate(page):
        if block.label in ("good", "bad"):
            keep.append(block.label == "good")
            continue
        at = bisect(flow, i)
        before = page[flow[at - 1]].label if at else "bad"  # above the first decided block stand headers
        after = page[flow[at]].label if at < len(flow) else before
        heading = block.tag[:1] == "h" and block.tag[1:].isdigit()
        if block.label == "linked":
            keep.append(before == after == "good" and page[flow[at - 1]].inside and page[flow[at]].inside)
        elif block.label == "near" or heading:
            keep.append("good" in (before, after) or not flow)
        else:
            keep.append(before == after == "good")
    return keep


def _stop_words(text: str) -> tuple[int, int]:
    words = _WORDS.findall(text.lower())
    return sum(word in STOP_WORDS for word in words), len(words)


def _known(page: list[Block]) -> bool:
    """Whether the page's text, all blocks that are neither short nor linked, is in a language of the stop words."""
    counts = [_stop_words(x.text) for x in page if len(x.text) >= SHORT and x.linked <= MOST_LINKED * len(x.text)]
    return sum(stop for stop, _ in counts) >= NO_STOP_WORDS * sum(words for _, words in counts)


def _alone(block: Block, known: bool, barring: bool = True) -> str:
    """good, bad, linked, near (nearly good), poor in stop words or short.

    By the block itself and, if barring, its region; of a page in no known language stop words say nothing.
    """
    size = len(block.text)
    if barring and block.barred:
        return "bad"
    if block.linked > MOST_LINKED * size:
        return "linked"
    if size < LONG and not block.inside and _RIGHTS.search(block.text):
        return "bad"
    if size < SHORT:
        return "linked" if block.linked else "short"
    if not known:
        return "good" if size > LONG else "near"
    stop, words = _stop_words(block.text)
    share = stop / max(1, words)
    if share >= MANY_STOP_WORDS:
        return "good" if size > LONG else "near"
    return "near" if share >= SOME_STOP_WORDS else "poor"


def main_text(html: str | None) -> str:
    """The good blocks, joined by an empty line; nothing of a null or empty page."""
    page = blocks(html or "")
    return "\n\n".join(block.text for block, good in zip(page, classify(page)) if good)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages, from its whole html.

    Repeated rows stay repeated; pages without main text have an empty one; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
                names=["page_id", "url", "text", "n_chars"],
            )

    read = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return read.mapInArrow(run, f"page_id {type_of(pages, id_col)}, url string, text string, n_chars long")
