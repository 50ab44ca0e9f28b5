"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks where elements other than inline ones begin or end. A block is
described by its words and link density, by those of the blocks before and after it, and by
what encloses it. A tree, grown on the table of labelled blocks below, says which blocks are
the article's.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ship

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math meter nobr output picture progress q ruby rb rt rp s samp small source span strike strong sub sup time track tt u var wbr".split())
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
#: Elements whose content is no markup: it ends at their own end tag.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")}
#: Elements that an opening of the first kind ends, up to the enclosing one.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
#: Elements and roles that never hold an article's text; those that hold nothing else.
OUTSIDE = frozenset("nav header footer aside form dialog noscript template svg button select fieldset menu object audio video canvas map head".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar status".split())
INSIDE, INSIDE_ROLES = frozenset({"article", "main"}), frozenset({"article", "main"})
#: Words of class names and ids.
AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "signin register paywall comment comments disqus reply replies respond sidebar widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead topbar toolbar footer copyright legal "
    "disclaimer share sharing social related recommended recommendations popular trending teaser teasers search form hidden aside rail".split()
)
FOR = frozenset("article content main post entry story body text prose hentry".split())
#: A name with one of these tells of the layout, not of what it encloses.
LAYOUT = frozenset("with without has have no not".split())
#: Elements nested deeper than this count as their enclosing one does.
DEEPEST = 512
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>|<!\[CDATA\[", re.S
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNFINISHED = re.compile(r"<(?:[a-zA-Z/!?][^>]*)?\Z")
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Place(NamedTuple):
    """What encloses a block: counts of elements that speak against and for an article."""

    outside: int = 0
    against: int = 0
    inside: int = 0
    heading: int = 0
    listed: int = 0


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    place: Place


@functools.lru_cache(maxsize=4096)
def speaks(name: str) -> int:
    """-1, 0 or 1: does a class name or id speak against or for an article's text?"""
    parts = {p.lower() for p in NAME_PARTS.findall(name)}
    if parts & LAYOUT:
        return 0
    against, good = parts & AGAINST, parts & FOR
    if against and not (good and against <= {"header"}):  # an article's own header has its title
        return -1
    return 1 if good else 0


def enter(place: Place, name: str, attributes: str = "") -> Place:
    """The place within an element opened at ``place``."""
    outside, against, inside, heading, listed = place
    role, names = "", []
    if "=" in attributes or "hidden" in attributes:
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key == "role":
                role = value.strip().lower()
            elif key in ("class", "id"):
                names += html.unescape(value).split()
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                outside += 1
    if name in OUTSIDE and not (name == "header" and inside) or role in OUTSIDE_ROLES:
        outside += 1
    said = [speaks(n) for n in names] if name not in ("html", "body") else []
    if -1 in said:
        against += 1
    elif 1 in said or name in INSIDE or role in INSIDE_ROLES:
        inside += 1
    return Place(outside, against, inside, heading + (name in HEADINGS), listed + (name in ("ul", "ol", "menu", "dl", "table")))


def page_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, in time linear in its length. Unfinished tags and
    comments reach to the end of the page."""
    page = UNFINISHED.sub("", page) if page.rfind("<") > page.rfind(">") else page
    blocks: list[Block] = []
    stack: list[tuple[str, Place]] = []
    pieces: list[tuple[str, bool]] = []
    link, at, end = False, 0, len(page)

    def place() -> Place:
        return stack[-1][1] if stack else Place()

    def flush() -> None:
        if pieces:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                blocks.append(Block(text, text.count(" ") + 1, sum(len(p.split()) for p, linked in pieces if linked), place()))
            pieces.clear()

    def close(names: set[str], within: set[str] = frozenset()) -> bool:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                flush()
                del stack[k:]
                return True
            if stack[k][0] in within:
                break
        return False

    def say(text: str) -> None:
        if text:
            pieces.append((html.unescape(text), link))

    while at < end:
        found = TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        slash, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if name == "a":
            link = not slash and "href" in attributes.lower()
        elif name == "br":
            pieces.append((" ", False))
        elif name in INLINE:
            continue
        elif slash:
            flush()
            if close({name}) and name != "p":
                link = False
        else:
            flush()
            if stack and stack[-1][0] == "p":
                stack.pop()
            if name in ENDS:
                close(*ENDS[name])
            if name in RAW:
                tail = RAW[name].search(page, at)
                at = tail.end() if tail else end
            elif name not in VOID and len(stack) < DEEPEST:
                stack.append((name, enter(place(), name, attributes)))
    flush()
    return blocks


#: Labelled blocks: pages of (enclosing elements, words, words in links, article?).
LABELLED = (
    (
        ("nav ul li", 1, 1, 0), ("nav ul li", 2, 2, 0), ("div.ad", 9, 0, 0), ("article h1", 8, 0, 1), ("article p", 60, 0, 1), ("article p", 1, 0, 1),
        ("article p", 5, 0, 1), ("article p", 120, 4, 1), ("footer", 14, 0, 0),
    ),
    (
        ("header h1", 3, 3, 0), ("header p", 12, 0, 0), ("header nav", 5, 5, 0), ("div.cookie-notice p", 25, 1, 0), ("main h1", 6, 0, 1),
        ("main p", 45, 2, 1), ("main h2", 2, 0, 1), ("main ul li", 7, 0, 1), ("main ul li", 4, 0, 1), ("main aside p", 30, 0, 0), ("main p", 80, 0, 1),
        ("footer p", 40, 6, 0),
    ),
    (
        ("div.menu a", 4, 4, 0), ("div.content h1", 5, 0, 1), ("div.content p", 33, 0, 1), ("div.content div.ad", 11, 0, 0),
        ("div.content p", 28, 8, 1), ("div.content blockquote p", 19, 0, 1), ("div.content div.share", 3, 3, 0), ("div.sidebar p", 35, 4, 0),
        ("div.sidebar ul li", 3, 3, 0), ("div.footer", 22, 3, 0),
    ),
    (
        ("body", 3, 3, 0), ("body", 2, 2, 0), ("h1", 6, 0, 1), ("p", 52, 0, 1), ("p", 9, 0, 1), ("p", 64, 3, 1), ("p", 31, 0, 1), ("ul li", 2, 2, 0),
        ("ul li", 3, 3, 0), ("p", 5, 2, 0),
    ),
    (
        ("ul li", 1, 1, 0), ("ul li", 1, 1, 0), ("h2", 7, 0, 1), ("div", 90, 2, 1), ("div", 41, 0, 1), ("h3", 2, 0, 1), ("div", 70, 0, 1),
        ("div", 4, 4, 0), ("div", 6, 3, 0), ("div", 8, 1, 0),
    ),
    (
        ("nav", 6, 6, 0), ("article header h1", 9, 0, 1), ("article header p", 4, 1, 1), ("article p", 75, 1, 1), ("article p", 3, 3, 1),
        ("article figure figcaption", 10, 0, 1), ("article table tr td", 2, 0, 1), ("article table tr td", 1, 0, 1), ("article footer p", 12, 2, 0),
        ("section.comments h2", 2, 0, 0), ("section.comments div.comment p", 48, 0, 0), ("section.comments article p", 21, 0, 0),
        ("section.comments form", 5, 0, 0),
    ),
    (
        ("div.post h2", 4, 0, 1), ("div.post p", 40, 0, 1), ("div.post ul li", 3, 3, 0), ("div.post ul li", 4, 4, 0), ("div.post ul li", 3, 3, 0),
        ("div.post p", 37, 0, 1), ("div.post form", 9, 0, 0), ("div.related ul li", 6, 6, 0), ("div.related p", 26, 0, 0),
        ("div.newsletter p", 18, 0, 0),
    ),
    (
        ("article p", 2, 0, 1), ("footer", 6, 0, 0),
    ),
    (("article p", 3, 0, 1),),
    (("p", 40, 0, 1),),
    (("body", 1, 0, 0),),
    (("p", 3, 0, 0),),
    (
        ("h1", 4, 0, 1), ("p", 25, 1, 1),
    ),
    (
        ("nav ul li", 2, 2, 0), ("article h1", 5, 0, 1), ("article p", 12, 0, 1),
    ),
    (
        ("div", 22, 0, 0), ("div", 3, 0, 0), ("article h1", 7, 0, 1), ("article p", 50, 0, 1), ("article p", 4, 4, 1), ("article p", 16, 0, 1),
        ("div", 35, 0, 0), ("p", 70, 0, 0),
    ),
    (
        ("p", 3, 0, 0), ("main p", 9, 0, 1), ("main p", 2, 0, 1), ("main pre", 30, 0, 1), ("p", 12, 0, 0), ("div", 2, 2, 0),
    ),
    (
        ("div", 5, 5, 0), ("article p", 6, 6, 1), ("article ul li", 9, 2, 1), ("article ul li", 1, 0, 1), ("article dl dd", 20, 0, 1),
        ("article div.ad", 40, 0, 0), ("article p", 15, 6, 1), ("article nav ul li", 4, 4, 0), ("article nav ul li", 2, 0, 0),
    ),
    (
        ("div.banner", 7, 0, 0), ("article h1", 3, 0, 1), ("footer", 5, 1, 0),
    ),
    (
        ("table tr td", 2, 2, 0), ("table tr td", 2, 2, 0), ("table tr td", 110, 3, 1), ("table tr td p", 66, 0, 1), ("table tr td", 4, 3, 0),
        ("p", 7, 1, 0),
    ),
    (
        ("nav ul li", 2, 2, 0), ("div.banner p", 44, 6, 0), ("h1", 5, 0, 1), ("p", 60, 8, 1), ("p", 35, 4, 1), ("p", 3, 0, 1), ("p", 42, 0, 1),
        ("aside p", 50, 7, 0), ("footer p", 60, 9, 0), ("div.comments p", 45, 5, 0), ("form", 40, 4, 0),
    ),
    (
        ("header p", 40, 5, 0), ("div.notice", 35, 4, 0), ("p", 50, 0, 1), ("p", 38, 5, 1), ("p", 12, 0, 1), ("p", 47, 2, 1),
        ("div.sidebar p", 41, 6, 0), ("div.newsletter", 36, 0, 0), ("footer", 70, 8, 0),
    ),
    (
        ("article h1", 3, 0, 1), ("article p", 30, 6, 1), ("article h2", 2, 0, 1), ("article p", 20, 3, 1), ("article p", 2, 1, 1),
        ("article p", 12, 2, 1), ("article aside p", 20, 3, 0), ("article div.related p", 14, 6, 0), ("article form", 9, 1, 0),
    ),
    (
        ("article p", 25, 5, 1), ("article p", 8, 2, 1), ("article p", 1, 1, 1), ("article p", 14, 4, 1), ("article div.ad", 20, 4, 0),
        ("article p", 6, 1, 1), ("article footer", 10, 5, 0),
    ),
    (
        ("div.nav", 8, 8, 0), ("main h1", 2, 1, 1), ("main p", 18, 3, 1), ("main nav ul li", 5, 3, 0), ("main div.sponsored", 24, 4, 0),
        ("main p", 9, 5, 1), ("main p", 40, 20, 1), ("main section.comments p", 30, 6, 0), ("main dl dd", 4, 1, 1), ("footer", 9, 4, 0),
    ),
    (
        ("noscript", 8, 0, 0), ("div.modal p", 24, 1, 0), ("p", 85, 0, 1), ("p", 14, 0, 1), ("p", 58, 9, 1), ("p", 10, 0, 0),
    ),
)


def features(blocks: list[Block]) -> np.ndarray:
    """A row a block: words and link density of it, the one before and the one after; is it
    within elements of other uses, of names against or for an article, a heading, a list;
    and does the page have any block in a place for articles?"""
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.linked / b.words for b in blocks], float)
    before, after = (lambda x: np.concatenate([[0.0], x[:-1]])), (lambda x: np.concatenate([x[1:], [0.0]]))
    place = np.array([b.place for b in blocks], float).reshape(len(blocks), len(Place._fields)) > 0
    told = (place[:, 2] & ~place[:, 0] & ~place[:, 1]).any()
    return np.column_stack([words, density, before(words), before(density), after(words), after(density), place, np.full(len(blocks), told)])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 9) -> tuple | float:
    """A tree of (feature, threshold, left, right) by Gini impurity; a leaf is the share of
    ones. Of equal splits the first feature's, at the lowest threshold, counts."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = (len(y) * share * (1 - share) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            n, ones = np.array([low.sum(), (~low).sum()]), np.array([y[low].sum(), y[~low].sum()])
            impurity = float((ones * (n - ones) / n).sum())
            if impurity < best[0] - 1e-9:
                best = (impurity, f, float(cut))
    _, f, cut = best
    if f < 0:
        return share
    low = x[:, f] <= cut
    return f, cut, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def labelled_blocks(pages=LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of labelled pages, and of the pages that a rule makes of them: cut
    off after any block, and with the longer blocks longer still where their place tells what
    they are."""
    rows, labels = [], []
    for page in pages:
        places = []
        for path, *_ in page:
            place = Place()
            for step in path.split():
                name, _, kind = step.partition(".")
                place = enter(place, name, f'class="{kind}"' if kind else "")
            places.append(place)
        for times in (1, 2, 6):
            grown = [times if words > 8 and (p.outside or p.against or p.inside) else 1 for (_, words, _, _), p in zip(page, places, strict=True)]
            blocks = [Block("", words * g, linked * g, p) for (_, words, linked, _), g, p in zip(page, grown, places, strict=True)]
            for end in range(1, len(page) + 1):
                rows.append(features(blocks[:end]))
                labels += [label for *_, label in page[:end]]
    return np.concatenate(rows), np.array(labels, float)


def article_tree() -> tuple | float:
    """The tree grown on the labelled blocks; the same in every run."""
    return grow(*labelled_blocks())


def predict(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    feature, cut, left, right = tree
    low = x[:, feature] <= cut
    out = np.empty(len(x))
    out[low], out[~low] = predict(left, x[low]), predict(right, x[~low])
    return out


def main_text(page: str, tree: tuple | float) -> str:
    blocks = page_blocks(page)
    if not blocks:
        return ""
    article = predict(tree, features(blocks)) >= 0.5
    return "\n".join(b.text for b, keep in zip(blocks, article, strict=True) if keep)


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``df``: page_id, url, text (the article's blocks, in page order,
    one line each) and n_chars (its code points).

    Within a block, character references are decoded and white space becomes one space; a
    line break in a block is white space. A null or empty page, or one without an article,
    has the text ''; null ids and urls stay null. Nothing is cut, at any length; repeated
    rows give rows each; an empty table gives none. Other columns are ignored.
    """
    tree = article_tree()
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", tree) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


PAGES_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(body, '</?(?:p|h1)>'), lambda x: regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')) AS parts FROM a),
c AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM b),
t AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM c)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""
