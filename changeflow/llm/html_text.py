"""Main text of web pages by block rules in two passes.

A page is cut into blocks at the tags that begin or end one. The first pass decides each block by its
markup, the share of its characters in links, its length and the share of its words that are
stop words (of any of the languages below):

- *bad* in a part of the page that is never article (menus, page headers and footers, sidebars,
  forms, notices, adverts, comments: by tag, role or by the name in its id or class), with links over
  ``MOST_LINKS`` of its characters, or as a copyright line outside an article: a sign of copyright before a year, or
  at the beginning of a short block;
- *good* when long enough, with at least ``STOP_WORDS`` of its words stop words, and few links; where no block of the
  page has so many, as in a language without a list below, length and few links suffice;
- else *ambiguous*, as short blocks are.

The second pass gives an ambiguous block the label of the nearest decided block of the same section,
counted in blocks, and of the one before it on equal distance. An article is a section, and so is each part
of the page outside of articles. A section without a decided block is good if it is an article, or
if the page has none; else bad. Where the page has no good block at all, bad ones decide nothing about others. The
texts of good blocks are joined in page order.

An id or a class names such a part with its last word, when words for a place or kind of box behind it are left
away: ``sidebar``, ``main-nav`` and ``ad-container-2`` do, ``ad-free``, ``has-sidebar`` and ``news-widget-page`` do not. Some
words (``DOUBTFUL_WORDS``) also name content, as in ``market-share`` or a chapter ``related``: without a word for a box behind
them such a part is a section that needs a second sign, that nothing in it is good; its blocks with links are bad anyhow. An article or main inside lifts what names of elements around it say, but not what their tags and roles say. An article
inside another one (a comment or a teaser), or with such a name itself, lifts nothing. An inline element
that is named so is left out of its block, which goes on behind it.

Cases: a null or empty html has an empty text. Scripts, styles and comments in the markup are no text,
also when they never end. Unclosed tags end with what is around them. Character references are
decoded after cutting, so they never make tags. Blocks of white space alone do not count. Nothing else is
dropped or shortened. Repeated rows are extracted alike. Other columns pass through; those named like
the added ones are replaced. Rows stay in their partition.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, map_batches, row_of, with_row

#: Share of a block's characters in links above which it is bad, and up to which it may be good.
MOST_LINKS, FEW_LINKS = 0.5, 0.2
#: Characters and share of stop words that make a block good.
LONG, STOP_WORDS = 70, 0.25

# Tags that begin a new block.
BLOCK_TAGS = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td
    template textarea tfoot th thead title tr ul""".split()
)
# Tags without content, tags whose content is no text, tags that are no part of an article.
EMPTY_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = ("script", "style", "noscript", "template", "svg", "iframe", "object", "title", "textarea", "select")
OUTSIDE_TAGS = frozenset("aside button dialog footer form head menu nav".split())
ARTICLE_TAGS = frozenset(("article", "main"))
OUTSIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# Words of ids and classes that name a part outside of the article.
OUTSIDE_WORDS = frozenset(
    """ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr masthead
    menu modal nav navbar navigation newsletter notice outbrain paywall popup promo promoted promotion recommended related respond share
    sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar widget""".split()
)
# Those of them that name content as well.
DOUBTFUL_WORDS = frozenset("promo related respond share skip social".split())
# Words behind the name of a part that leave it that part, and words that say that a part is not there or only beside.
PART_WORDS = frozenset(
    """area bar block blocks body bottom box button buttons col column container content entry footer form group header inner item items left
    link links list outer panel post posts right section slot text title top unit wrap wrapper zone""".split()
)
BESIDE_WORDS = frozenset("has have hide is no non not with without".split())
# Stop words of English, French, German and Spanish.
STOP = frozenset(
    """a an and are as at be by for from has have he in is it its not of on or she that the their they this to was were which will with you
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qui que se son sur un une vous
    als auch auf aus bei das dem den der die ein eine einer er es für hat ich im ist mit nicht oder sich sie sind so und vom von war wie wir
    zu zum zur al como con del el ella ellos en entre era es esta este ha las lo los más muy no o para pero por se sin sobre su sus y ya""".split()
)

# Attributes up to the end of the tag. A quote opens a value only behind an equals sign; elsewhere it is a character like others.
_ATTRIBUTES = r"(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*"
# A hidden element or comment up to its end or that of the page, or a tag.
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<hidden>{'|'.join(HIDDEN_TAGS)})(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</(?P=hidden)\s*>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>{_ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*>?",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s]+)))?")
# A sign of copyright before a year, or at the beginning; the letter in brackets alone may be an item of a list.
_COPYRIGHT = re.compile(r"(?:©|\(c\))\s*(?:19|20)\d\d|\A(?:©|copyright\s+(?:©|\(c\)|by\b|\d{4}))", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")


#: How surely a name says that an element is no part of the article.
NO, DOUBTFUL, SURE = range(3)


class Block(NamedTuple):
    text: str
    linked: int  # characters in links
    section: int
    in_article: bool
    outside: bool
    doubtful: bool


def part_name(name: str, inline: bool = False) -> int:
    """Whether one id or class is the name of a part outside of the article. Inside a block a doubtful word alone is sure."""
    words = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    if not words or not BESIDE_WORDS.isdisjoint(words):
        return NO
    if words[-1] in DOUBTFUL_WORDS:
        return DOUBTFUL if not inline else SURE if len(words) == 1 else NO
    if words[-1] in OUTSIDE_WORDS:
        return SURE
    while words and words[-1] in PART_WORDS and words[-1] not in OUTSIDE_WORDS:
        words.pop()
    # A box around content and a part is neither.
    return SURE if words and words[-1] in OUTSIDE_WORDS and words[0] not in ("content", "main", "page") else NO


def signs_outside(attributes: str, inline: bool) -> tuple[int, bool]:
    """What an element's id and class, and whether its role, say about its being no part of the article."""
    by_name, by_role = NO, False
    for name, *quoted in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("id", "class"):
            by_name = max([by_name, *(part_name(x, inline) for x in "".join(quoted).split())])
        elif name == "role":
            by_role = by_role or "".join(quoted).strip().lower() in OUTSIDE_ROLES
    return by_name, by_role


class Opened(NamedTuple):
    name: str
    outside: bool  # by tag or role
    named: bool  # outside by id or class
    inline: bool  # one of both, but inside a block
    doubted: bool  # by a doubtful id or class
    article: bool
    lifts: bool  # the names around it


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order."""
    out: list[Block] = []
    text: list[str] = []
    opened: list[Opened] = []
    outside = articles = inner = links = linked = section = at = 0
    # Open elements that are named as outside since the last one that lifts names; likewise those inside a block; and such by role.
    named, inline, doubted, hushed = [0], [0], [0], 0

    def end_block() -> None:
        nonlocal linked
        if text:
            joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                out.append(Block(joined, min(linked, len(joined)), section, articles > 0, outside > 0 or named[-1] > 0, doubted[-1] > 0))
            text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not inline[-1] and not hushed:
            text.append(piece)
            if links:
                linked += len(piece.strip())

    def close(gone: list[Opened]) -> None:
        nonlocal outside, hushed, articles, inner, links, section
        for x in reversed(gone):
            if x.lifts:
                named.pop()
                inline.pop()
                doubted.pop()
            else:
                doubted[-1] -= x.doubted
                named[-1] -= x.named and not x.inline
                inline[-1] -= x.named and x.inline
            outside -= x.outside and not x.inline
            hushed -= x.outside and x.inline
            articles -= x.article
            inner -= x.name == "article"
            links -= x.name == "a"
            section += ((x.outside or x.named) and not x.inline) or x.doubted or x.article

    for found in _MARKUP.finditer(page):
        add(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            if found["hidden"]:
                text.append(" ")
            continue
        name = name.lower()
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK_TAGS:
            end_block()
        if found["close"]:
            place = next((i for i in range(len(opened) - 1, -1, -1) if opened[i].name == name), None)
            if place is None or (name not in BLOCK_TAGS and any(x.name in BLOCK_TAGS and x.name != "p" for x in opened[place + 1 :])):
                continue
            close(opened[place:])
            del opened[place:]
        elif name in EMPTY_TAGS:
            continue
        else:
            if name in ("p", "li") and opened and opened[-1].name == name:
                close([opened.pop()])  # these end by themselves
            is_article = name in ARTICLE_TAGS
            # A header inside an article has its title; elsewhere it is the page's.
            root = name in ("html", "body")
            by_name, by_role = signs_outside(found["rest"], name not in BLOCK_TAGS)
            is_outside = not root and not is_article and (name in OUTSIDE_TAGS or (name == "header" and not articles) or by_role)
            is_named = not root and not is_article and by_name == SURE
            lifts = name == "main" or (name == "article" and not inner and by_name != SURE)
            is_inline = (is_outside or is_named) and name not in BLOCK_TAGS
            is_doubted = not root and not is_article and by_name == DOUBTFUL
            opened.append(Opened(name, is_outside, is_named, is_inline, is_doubted, is_article, lifts))
            if lifts:
                named.append(0)
                inline.append(0)
                doubted.append(0)
            doubted[-1] += is_doubted
            outside += is_outside and not is_inline
            hushed += is_outside and is_inline
            named[-1] += is_named and not is_inline
            inline[-1] += is_named and is_inline
            articles += is_article
            inner += name == "article"
            links += name == "a"
            section += ((is_outside or is_named) and not is_inline) or is_doubted or is_article
    add(page[at:])
    end_block()
    return out


def long_enough(block: Block) -> bool:
    return len(block.text) >= LONG and block.linked <= FEW_LINKS * len(block.text)


def has_stop_words(block: Block) -> bool:
    words = _WORD.findall(block.text.lower())
    return bool(words) and sum(w in STOP for w in words) >= STOP_WORDS * len(words)


def is_bad(block: Block) -> bool:
    if block.outside or block.linked > MOST_LINKS * len(block.text):
        return True
    if block.doubtful and block.linked > FEW_LINKS * len(block.text):
        return True
    sign = None if block.in_article else _COPYRIGHT.search(block.text)
    return sign is not None and (sign.start() > 0 or sign.group()[-1].isdigit() or len(block.text) < LONG)


def first_pass(blocks: list[Block]) -> list[bool | None]:
    """Good, bad, or None for an ambiguous block."""
    out: list[bool | None] = [False if is_bad(b) else None for b in blocks]
    long = [i for i, b in enumerate(blocks) if out[i] is None and long_enough(b)]
    for i in [i for i in long if has_stop_words(blocks[i])] or long:
        out[i] = True
    return out


def labels(blocks: list[Block]) -> list[bool]:
    """The labels after the second pass."""
    decided = first_pass(blocks)
    has_article, has_good = any(b.in_article for b in blocks), True in decided
    out: list[bool] = []
    first = 0
    while first < len(blocks):
        last = first
        while last < len(blocks) and blocks[last].section == blocks[first].section:
            last += 1
        known = [i for i in range(first, last) if decided[i] is not None]
        at = 0
        for i in range(first, last):
            while at + 1 < len(known) and abs(known[at + 1] - i) < abs(known[at] - i):
                at += 1
            if blocks[first].doubtful and True not in decided[first:last]:
                out.append(False)  # nothing long in it: short blocks and links are the second sign
            elif decided[i] is not None or (known and has_good):
                out.append(decided[known[at]])
            else:
                out.append(blocks[i].in_article or not has_article)
        first = last
    return out


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, good in zip(blocks, labels(blocks)) if good)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """All rows with text and n_chars (its code points), without the html."""
    others = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    rows = pages.select(row_of(others), F.col(f"`{html_column}`").cast("string").alias("_html"))

    def work(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x) for x in batch.column(1).to_pylist()]
        return {"_row": batch.column(0), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}

    return map_batches(rows, work, with_row(rows, "text string, n_chars bigint")).select(*columns_of(others), "text", "n_chars")
