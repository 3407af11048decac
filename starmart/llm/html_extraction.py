"""Main text of web pages by classifying flat text blocks.

A page is cut into text blocks at its block-level tags. A block is described by its words and link density, those
of its neighbours, whether it is a heading, whether it lies in an article or main element (or outside while the page
has one), and whether an element around it is named as something else: navigation, page header or footer, sidebar,
form, advert, notice, comments. A decision tree, trained on the small labelled table below, tells which blocks are
main text.

Character references are decoded, white space within a block becomes one space, blocks are joined by line breaks in
the order of the page. Scripts, styles, comments of the markup and hidden elements are no text, neither is what stands
between the tags of drawings, lists of options and embedded media; formulas are. A null or empty page has an empty
text and 0 characters; broken, unclosed or cut off markup is read as far as it goes: only raw text
(such as scripts) reaches to the end of the page where it is not closed, all other skipped elements hide text only if
they are closed. A page of any length is read whole. Repeated rows give equal rows. Columns other than those named are never read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose content is no markup, up to their end tag or the end of the page; not shown as text.
_RAW = frozenset("script style noscript textarea iframe title".split())
#: Elements of markup without text of the page, if they are closed, and those of them and others that "/>" ends.
_SKIPPED = frozenset("template svg object select canvas audio video annotation annotation-xml".split())
_FOREIGN = frozenset(("svg", "math"))
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*+\Z",
    re.S | re.I,
)
_RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in _RAW}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")

#: Elements that end a text block where they start and end, and those of them that have no end.
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_EMPTY = frozenset(("br", "hr"))
#: Elements that the start of a block ends.
_ENDED = frozenset(("p", "option"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

#: Names of elements and words of their class, id and role that say what they hold.
_OTHER_TAGS = frozenset("nav header footer aside form menu button dialog fieldset head option".split())
_MAIN_TAGS = frozenset(("article", "main"))
#: What they hold is no main part, articles inside included, if they are closed.
_ASIDE_TAGS = frozenset(("aside", "footer", "nav"))
_OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial alert banner breadcrumb breadcrumbs captcha comment "
    "comments consent contentinfo complementary cookie cookies dialog disclaimer discussion disqus form gdpr login "
    "modal navigation newsletter notice notices overlay pagination pager popup promo promoted promotion recommended "
    "related replies reply respond search share sharing signup skip social sponsor sponsored subscribe subscription "
    "tags toolbar widget widgets".split()
)
#: These say it only where no word for the main part stands beside them.
_PLACE_WORDS = frozenset("footer foot header masthead nav navbar menu sidebar side aside rail topbar copyright legal".split())
_MAIN_WORDS = frozenset("article content entry main post story text body page container wrapper layout hentry".split())
_TEXT_WORDS = frozenset("article entry main post story hentry".split())
_WITHOUT = frozenset(("has", "with", "no", "without"))
#: Of the words above, those that also name what articles are about. They say it only in a name made of such words and
#: of words for parts of a page, and not as the id of a section, heading or paragraph of the main part.
_AMBIGUOUS = frozenset(
    "alert complementary dialog discussion form notice notices overlay promotion recommended related replies reply "
    "respond search share sharing skip social tags".split()
)
_NEUTRAL = frozenset(
    "area bar block blog box btn button buttons col column container content entry group holder icon icons inner item "
    "items js link links list main module news outer panel post posts article articles row section site story text title "
    "top bottom left right unit user view wrap wrapper zone".split()
)
_SECTIONS = frozenset("section p h1 h2 h3 h4 h5 h6 li dt dd table figure blockquote pre".split())
#: A form that holds at least this share of the page's characters is no form, but what the page is written in.
WIDE_FORM = 0.5

INSIDE, OUTSIDE, NO_MAIN = 1, -1, 0


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    main: bool
    other: bool


def _says_other(parts: set[str], ambiguous_counts: bool) -> bool:
    """Whether the words of a name say that an element is something else than main text."""
    said = parts & _OTHER_WORDS
    if said - _AMBIGUOUS:
        return True
    return bool(said) and ambiguous_counts and parts <= _OTHER_WORDS | _PLACE_WORDS | _NEUTRAL


def _kind(tag: str, attributes: str, in_main: bool = False) -> tuple[bool, bool, bool]:
    """Whether an element is named as main, as something else for its place, and as something else at all events."""
    main, place, other = tag in _MAIN_TAGS, tag in _OTHER_TAGS, False
    if attributes and tag not in ("html", "body"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                other = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                other = True
            elif name in ("class", "id", "role"):
                for one in value.split():
                    parts = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", one)}
                    if parts & _WITHOUT:
                        continue
                    other |= _says_other(parts, not (in_main and name == "id" and tag in _SECTIONS))
                    place |= bool(parts & _PLACE_WORDS) and not parts & _MAIN_WORDS
                    main |= bool(parts & _TEXT_WORDS) and not parts & (_PLACE_WORDS | _OTHER_WORDS)
    return main, place, other


@dataclass
class Tag:
    name: str
    closing: bool
    attributes: str
    start: int
    end: int


def _tags(page: str) -> list[Tag]:
    """What is no text: tags in order, other markup as tags without a name, raw text as part of its tags."""
    tags: list[Tag] = []
    foreign = 0
    tokens = _TOKEN.finditer(page)
    while (found := next(tokens, None)) is not None:
        name = (found[2] or found[5] or "").lower()
        tag = Tag(name, bool(found[1] or found[4]), found[3] or found[6] or "", found.start(), found.end())
        tags.append(tag)
        ended = tag.attributes.endswith("/")
        if name in _FOREIGN and not ended:
            foreign = max(0, foreign + (-1 if tag.closing else 1))
        elif name in _RAW and not tag.closing and not (ended and foreign):
            end = _RAW_END[name].search(page, tag.end)
            tag.name, tag.end = "", end.end() if end else len(page)
            tokens = _TOKEN.finditer(page, tag.end)
    return tags


def _closed(tags: list[Tag]) -> dict[int, int]:
    """The place of the end tag for each start tag of a block or a skipped element that has one."""
    ends: dict[int, int] = {}
    opened: list[int] = []
    counts: dict[str, int] = {}

    def leave() -> int:
        last = opened.pop()
        counts[tags[last].name] -= 1
        return last

    for i, tag in enumerate(tags):
        block = tag.name in _BLOCKS and tag.name not in _EMPTY
        if not block and tag.name not in _SKIPPED:
            continue
        if not tag.closing:
            if block and opened and tags[opened[-1]].name in _ENDED:
                leave()
            if tag.name not in _FOREIGN or not tag.attributes.endswith("/"):
                opened.append(i)
                counts[tag.name] = counts.get(tag.name, 0) + 1
        elif counts.get(tag.name):
            while tags[last := leave()].name != tag.name:
                pass
            ends[last] = i
    return ends


def _wide_forms(tags: list[Tag], ends: dict[int, int], page: str) -> set[int]:
    """The start tags of forms that hold most of the page."""
    if not any(t.name == "form" for t in tags):
        return set()
    before, total, at = [], 0, 0
    for tag in tags:
        total += len(page[at : tag.start].strip())
        before.append(total)
        at = tag.end
    total += len(page[at:].strip())
    starts = [i for i, t in enumerate(tags) if t.name == "form" and not t.closing]
    return {i for i in starts if total and (before[ends[i]] if i in ends else total) - before[i] >= WIDE_FORM * total}


def cut(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    blocks: list[Block] = []
    parts: list[str] = []
    linked = 0
    in_link = False
    heading = False
    #: Open elements: name, whether main, whether something else for its place, whether at all events, whether aside.
    opened: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text)
            parts.append(text)
            if in_link:
                linked += len(text.split())

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            _, main, place, other, _ = opened[-1]
            words = text.count(" ") + 1
            blocks.append(Block(text, words, min(linked, words), heading, main, place or other))
        parts.clear()
        linked = 0

    at = 0
    tags = _tags(page)
    ends = _closed(tags)
    wide = _wide_forms(tags, ends, page)
    for i, tag in enumerate(tags):
        if tag.start < at:  # in an element that is skipped
            continue
        add(page[at : tag.start])
        at = tag.end
        name, closing = tag.name, tag.closing
        if name in _SKIPPED and i in ends:
            at = tags[ends[i]].end
            continue
        if name == "a":
            in_link = not closing
        if name not in _BLOCKS:
            continue
        flush()
        if name in _HEADINGS:
            heading = not closing
        if name in _EMPTY:
            continue
        if closing:
            for k in range(len(opened) - 1, 0, -1):
                if opened[k][0] == name:
                    del opened[k:]
                    break
            continue
        heading = heading and name in _HEADINGS
        if opened[-1][0] in _ENDED:
            opened.pop()
        _, was_main, was_place, was_other, was_aside = opened[-1]
        main, place, other = _kind("div", "") if i in wide else _kind(name, tag.attributes, was_main)
        if name in _MAIN_TAGS:
            was_place = was_aside  # not what was left open before it
        if was_main and (name == "header" or place and not other and name not in _OTHER_TAGS):
            place = False  # the article's own header
        aside = was_aside or name in _ASIDE_TAGS and place and i in ends
        opened.append((name, was_main or main, was_place or place, was_other or other, aside))
    add(page[at:])
    flush()
    return blocks


def describe(blocks: list[Block]) -> np.ndarray:
    """One row for each block: words, link density, both of the block before and after, place, other, heading."""
    words = np.array([0, *[b.words for b in blocks], 0], float)
    links = np.array([0, *[b.linked / b.words for b in blocks], 0], float)
    main = np.array([b.main for b in blocks], bool)
    other = np.array([b.other for b in blocks], float)
    has_main = (main & (other == 0)).any()  # a named part inside a sidebar or comments is not the page's
    place = np.where(main, INSIDE, OUTSIDE) if has_main else np.full(len(blocks), NO_MAIN)
    heading = np.array([b.heading for b in blocks], float)
    return np.stack(
        [words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], place, other, heading], axis=1
    )


#: The labelled table: words, link density, words and link density before, after, place, other, heading; main text.
LABELLED = [
    # navigation, headers, footers, sidebars and so on, named as such
    (1, 1.0, 0, 0.0, 1, 1.0, OUTSIDE, 1, 0, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, OUTSIDE, 1, 0, 0),
    (2, 1.0, 1, 1.0, 9, 0.0, OUTSIDE, 1, 0, 0),
    (9, 0.0, 1, 1.0, 11, 0.0, OUTSIDE, 1, 0, 0),
    (40, 0.0, 1, 1.0, 12, 0.0, OUTSIDE, 1, 0, 0),
    (6, 0.0, 60, 0.0, 0, 0.0, OUTSIDE, 1, 0, 0),
    (25, 0.0, 60, 0.0, 5, 0.4, OUTSIDE, 1, 0, 0),
    (4, 0.0, 60, 0.0, 30, 0.0, OUTSIDE, 1, 1, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, NO_MAIN, 1, 0, 0),
    (12, 0.1, 0, 0.0, 30, 0.0, NO_MAIN, 1, 0, 0),
    (50, 0.0, 30, 0.0, 30, 0.0, NO_MAIN, 1, 0, 0),
    (5, 0.0, 40, 0.0, 0, 0.0, NO_MAIN, 1, 0, 0),
    (3, 0.0, 2, 1.0, 40, 0.0, NO_MAIN, 1, 1, 0),
    (8, 0.0, 70, 0.0, 70, 0.0, INSIDE, 1, 0, 0),
    (30, 0.0, 70, 0.0, 20, 0.0, INSIDE, 1, 0, 0),
    (60, 0.0, 30, 0.0, 90, 0.0, INSIDE, 1, 0, 0),
    (2, 0.0, 70, 0.0, 25, 0.0, INSIDE, 1, 1, 0),
    (3, 1.0, 70, 0.0, 3, 1.0, INSIDE, 1, 0, 0),
    # text of an article
    (10, 0.0, 9, 0.0, 80, 0.0, INSIDE, 0, 1, 1),
    (3, 0.0, 0, 0.0, 60, 0.0, INSIDE, 0, 1, 1),
    (80, 0.0, 10, 0.0, 2, 0.0, INSIDE, 0, 0, 1),
    (2, 0.0, 80, 0.0, 1, 0.0, INSIDE, 0, 0, 1),
    (1, 0.0, 2, 0.0, 90, 0.0, INSIDE, 0, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, INSIDE, 0, 0, 1),
    (90, 0.05, 1, 0.0, 70, 0.1, INSIDE, 0, 0, 1),
    (40, 0.3, 90, 0.0, 40, 0.0, INSIDE, 0, 0, 1),
    (12, 0.5, 40, 0.0, 40, 0.0, INSIDE, 0, 0, 1),
    (4, 0.0, 90, 0.0, 7, 0.0, INSIDE, 0, 0, 1),
    (6, 0.0, 90, 0.0, 9, 0.0, INSIDE, 0, 0, 1),
    (3, 0.0, 90, 0.0, 0, 0.0, INSIDE, 0, 0, 1),
    (10, 0.0, 1, 1.0, 2, 0.0, INSIDE, 0, 1, 1),
    (2, 0.0, 3, 1.0, 1, 0.0, INSIDE, 0, 1, 1),
    (5, 0.0, 2, 1.0, 4, 0.0, INSIDE, 0, 0, 1),
    (1, 0.0, 1, 1.0, 1, 1.0, INSIDE, 0, 0, 1),
    (30, 0.0, 1, 1.0, 2, 1.0, INSIDE, 0, 0, 1),
    (4, 0.0, 60, 0.0, 2, 1.0, INSIDE, 0, 0, 1),
    (1, 0.0, 2, 0.0, 1, 1.0, INSIDE, 0, 0, 1),
    (2, 0.0, 5, 0.0, 0, 0.0, INSIDE, 0, 0, 1),
    (6, 0.0, 40, 0.0, 0, 0.0, INSIDE, 0, 0, 1),
    (1, 0.0, 1, 0.0, 0, 0.0, INSIDE, 0, 0, 1),
    (9, 0.0, 20, 0.0, 0, 0.0, INSIDE, 0, 0, 1),
    (11, 0.0, 60, 0.0, 0, 0.0, INSIDE, 0, 0, 1),
    (5, 0.0, 0, 0.0, 0, 0.0, INSIDE, 0, 1, 1),
    (3, 0.0, 0, 0.0, 0, 0.0, INSIDE, 0, 0, 1),
    (4, 0.0, 2, 1.0, 0, 0.0, INSIDE, 0, 0, 1),
    # lists of links in an article
    (3, 1.0, 90, 0.0, 4, 1.0, INSIDE, 0, 0, 0),
    (4, 1.0, 3, 1.0, 3, 1.0, INSIDE, 0, 0, 0),
    (3, 0.9, 4, 1.0, 6, 0.0, INSIDE, 0, 0, 0),
    # outside of the article, not named
    (9, 0.0, 1, 1.0, 10, 0.0, OUTSIDE, 0, 0, 0),
    (40, 0.0, 60, 0.0, 5, 0.0, OUTSIDE, 0, 0, 0),
    (4, 0.0, 0, 0.0, 1, 1.0, OUTSIDE, 0, 1, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, OUTSIDE, 0, 0, 0),
    # pages without any element for the main part
    (40, 0.0, 2, 1.0, 60, 0.0, NO_MAIN, 0, 0, 1),
    (60, 0.1, 40, 0.0, 3, 0.0, NO_MAIN, 0, 0, 1),
    (30, 0.2, 5, 0.0, 2, 1.0, NO_MAIN, 0, 0, 1),
    (18, 0.0, 0, 0.0, 2, 1.0, NO_MAIN, 0, 0, 1),
    (14, 0.0, 3, 0.0, 0, 0.0, NO_MAIN, 0, 0, 1),
    (3, 0.0, 60, 0.0, 40, 0.0, NO_MAIN, 0, 0, 1),
    (1, 0.0, 30, 0.0, 30, 0.0, NO_MAIN, 0, 0, 1),
    (6, 0.0, 1, 1.0, 60, 0.0, NO_MAIN, 0, 1, 1),
    (4, 0.0, 0, 0.0, 45, 0.0, NO_MAIN, 0, 1, 1),
    (5, 0.0, 50, 0.0, 35, 0.1, NO_MAIN, 0, 1, 1),
    (5, 0.0, 50, 0.0, 2, 0.0, NO_MAIN, 0, 0, 1),
    (2, 0.0, 2, 1.0, 30, 0.0, NO_MAIN, 0, 1, 1),
    (5, 0.0, 0, 0.0, 0, 0.0, NO_MAIN, 0, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, NO_MAIN, 0, 0, 1),
    (40, 0.0, 0, 0.0, 0, 0.0, NO_MAIN, 0, 0, 1),
    (7, 0.0, 3, 1.0, 14, 0.0, NO_MAIN, 0, 1, 1),
    (25, 0.0, 3, 1.0, 14, 0.0, NO_MAIN, 0, 0, 1),
    (4, 0.0, 2, 0.0, 60, 0.0, NO_MAIN, 0, 0, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, NO_MAIN, 0, 0, 0),
    (2, 1.0, 1, 1.0, 1, 1.0, NO_MAIN, 0, 0, 0),
    (2, 1.0, 1, 1.0, 40, 0.0, NO_MAIN, 0, 0, 0),
    (3, 0.7, 50, 0.0, 2, 1.0, NO_MAIN, 0, 0, 0),
    (20, 0.9, 50, 0.0, 2, 1.0, NO_MAIN, 0, 0, 0),
    (15, 0.6, 2, 1.0, 3, 1.0, NO_MAIN, 0, 0, 0),
    (4, 0.0, 0, 0.0, 2, 1.0, NO_MAIN, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, NO_MAIN, 0, 0, 0),
    (6, 0.0, 3, 1.0, 0, 0.0, NO_MAIN, 0, 0, 0),
    (6, 0.0, 60, 0.0, 0, 0.0, NO_MAIN, 0, 0, 0),
    (2, 0.0, 35, 0.0, 0, 0.0, NO_MAIN, 0, 0, 0),
    (8, 0.0, 5, 0.0, 0, 0.0, NO_MAIN, 0, 0, 0),
    (2, 0.0, 1, 1.0, 1, 0.0, NO_MAIN, 0, 0, 0),
]


@dataclass(frozen=True)
class Node:
    """A split (feature <= limit goes left) or, without feature, a leaf."""

    answer: bool
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None


def _gini(y: np.ndarray) -> float:
    share = y.mean()
    return 2 * share * (1 - share) * len(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """A decision tree: each split is the one that leaves the least Gini impurity, the first of equals."""
    answer = bool(y.mean() >= 0.5)
    if depth == 0 or y.all() or not y.any():
        return Node(answer)
    best = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, feature] <= limit
            left = _gini(y[low]) + _gini(y[~low])
            if best is None or left < best[0] - 1e-9:
                best = (left, feature, float(limit), low)
    if best is None:
        return Node(answer)
    _, feature, limit, low = best
    return Node(answer, feature, limit, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def decide(node: Node, x: np.ndarray) -> np.ndarray:
    if node.left is None or node.right is None:
        return np.full(len(x), node.answer)
    low = x[:, node.feature] <= node.limit
    out = np.zeros(len(x), bool)
    out[low], out[~low] = decide(node.left, x[low]), decide(node.right, x[~low])
    return out


def train(labelled=LABELLED) -> Node:
    table = np.array(labelled, float)
    return grow(table[:, :-1], table[:, -1] > 0)


def extract_page(page: str, tree: Node) -> str:
    """The main text of a page."""
    blocks = cut(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, main in zip(blocks, decide(tree, describe(blocks))) if main)


def extract(labelled=LABELLED) -> Callable[[Column], Column]:
    """A function from a column of HTML to the main text."""
    tree = train(labelled)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract_page(p or "", tree) for p in batch], dtype=object)

    return run
