"""HTML extraction: flat text blocks, classified by a decision tree.

A page is cut at its block elements into flat blocks of text. A block is described by its number of words, its link
density, and the same two of the blocks before and after it. Two hints follow: whether it stands in an element that by its
name, role, class or id holds no article, and whether inside or outside the page's article element, if it has one.
A decision tree says which blocks are text. It is grown, when the operator starts, on the small table of labelled pages
below, each taken twice: with its hints, and without any. So pages that name nothing are read by their words and links alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, batch_of, limit_frames, table

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "apart", "article")

# Labelled pages as sequences of their blocks: words, words within links, 1 inside an element whose name or class is one
# that holds no article, 1 inside the page's article element, 1 for text.
PAGES = (
    # a report with menu, advert, article, a box and reader comments within it, and a footer
    (
        (1, 1, 1, 0, 0), (1, 1, 1, 0, 0), (2, 2, 1, 0, 0), (1, 1, 1, 0, 0), (7, 0, 1, 0, 0), (9, 0, 0, 1, 1), (12, 0, 0, 1, 1), (54, 2, 0, 1, 1),
        (88, 0, 0, 1, 1), (6, 0, 0, 1, 1), (73, 5, 0, 1, 1), (22, 0, 1, 1, 0), (41, 0, 0, 1, 1), (3, 0, 0, 1, 1), (64, 0, 0, 1, 1), (35, 0, 1, 1, 0),
        (10, 0, 1, 0, 0),
    ),
    # short notes below one heading, some of a word or two
    (
        (1, 1, 1, 0, 0), (1, 1, 1, 0, 0), (1, 1, 1, 0, 0), (5, 0, 1, 0, 0), (6, 0, 0, 1, 1), (6, 0, 0, 1, 1), (14, 0, 0, 1, 1), (1, 0, 0, 1, 1), (1, 0, 0, 1, 1),
        (23, 0, 0, 1, 1), (8, 0, 0, 1, 1), (2, 0, 0, 1, 1), (5, 0, 0, 1, 1), (11, 0, 0, 1, 1), (3, 0, 0, 1, 1), (7, 0, 0, 1, 1), (11, 0, 1, 0, 0),
    ),
    # a long article with links, and a list of links within it
    (
        (2, 2, 1, 0, 0), (3, 3, 1, 0, 0), (2, 2, 1, 0, 0), (7, 0, 0, 1, 1), (30, 18, 0, 1, 1), (120, 12, 0, 1, 1), (4, 0, 0, 1, 1), (210, 20, 0, 1, 1),
        (4, 4, 0, 1, 0), (3, 3, 0, 1, 0), (6, 6, 0, 1, 0), (5, 5, 0, 1, 0), (96, 3, 0, 1, 1), (9, 0, 0, 1, 1), (150, 0, 0, 1, 1), (8, 1, 1, 0, 0),
    ),
    # a page without an article element: header line, menu, text, footer with links
    (
        (4, 0, 1, 0, 0), (1, 1, 1, 0, 0), (2, 2, 1, 0, 0), (1, 1, 1, 0, 0), (1, 1, 1, 0, 0), (8, 0, 0, 0, 1), (45, 0, 0, 0, 1), (60, 4, 0, 0, 1),
        (5, 0, 0, 0, 1), (38, 0, 0, 0, 1), (16, 0, 0, 0, 1), (70, 6, 0, 0, 1), (2, 2, 1, 0, 0), (1, 1, 1, 0, 0), (6, 0, 1, 0, 0),
    ),
    # blocks without any telling name: link, link, text, link
    ((1, 1, 0, 0, 0), (1, 1, 0, 0, 0), (40, 0, 0, 0, 1), (1, 1, 0, 0, 0)),
    ((2, 2, 0, 0, 0), (3, 3, 0, 0, 0), (2, 2, 0, 0, 0), (65, 2, 0, 0, 1), (28, 3, 0, 0, 1), (3, 3, 0, 0, 0), (2, 2, 0, 0, 0)),
    (
        (1, 1, 0, 0, 0), (3, 3, 0, 0, 0), (1, 1, 0, 0, 0), (5, 0, 0, 0, 1), (34, 0, 0, 0, 1), (80, 5, 0, 0, 1), (13, 0, 0, 0, 1), (48, 0, 0, 0, 1),
        (1, 1, 0, 0, 0), (2, 2, 0, 0, 0),
    ),
    # an article alone on its page, long and short, cut off, or with a single line
    ((9, 0, 0, 1, 1), (40, 0, 0, 1, 1), (55, 5, 0, 1, 1), (12, 3, 0, 1, 1)),
    ((2, 0, 0, 1, 1), (4, 0, 0, 1, 1), (3, 0, 0, 1, 1), (4, 0, 0, 1, 1)),
    ((1, 0, 0, 1, 1),),
    ((6, 0, 0, 1, 1),),
    ((1, 0, 0, 1, 1), (1, 0, 0, 1, 1)),
    ((2, 0, 0, 1, 1), (1, 0, 0, 1, 1)),
    ((1, 0, 0, 1, 1), (5, 0, 0, 1, 1), (1, 0, 0, 1, 1)),
    ((1, 0, 0, 1, 1), (1, 0, 0, 1, 1), (2, 0, 0, 1, 1), (1, 0, 0, 1, 1)),
    ((3, 0, 0, 1, 1), (1, 0, 0, 1, 1), (15, 0, 0, 1, 1), (1, 0, 0, 1, 1), (9, 0, 0, 1, 1), (1, 0, 0, 1, 1)),
    # menu, one short article, a short footer; an advert before, a notice after
    ((1, 1, 1, 0, 0), (1, 0, 0, 1, 1), (2, 0, 1, 0, 0)),
    ((2, 0, 1, 0, 0), (1, 0, 0, 1, 1), (4, 0, 1, 0, 0)),
    ((2, 0, 1, 1, 0), (1, 0, 0, 1, 1), (1, 0, 1, 1, 0), (1, 0, 1, 1, 0)),
    ((2, 0, 0, 1, 1), (9, 0, 0, 1, 1), (3, 0, 1, 1, 0)),
    # unnamed blocks around an article: an advert, a line below
    ((2, 2, 0, 0, 0), (5, 0, 0, 0, 0), (1, 0, 0, 1, 1), (12, 0, 0, 1, 1), (30, 0, 0, 1, 1), (9, 0, 0, 0, 0)),
    ((1, 1, 0, 0, 0), (1, 1, 0, 0, 0), (6, 0, 0, 0, 0), (1, 0, 0, 1, 1), (1, 0, 0, 1, 1), (4, 0, 0, 0, 0)),
    # text and a side box beside it, then words of a form
    ((1, 0, 0, 1, 1), (2, 0, 1, 1, 0), (1, 0, 0, 1, 1), (3, 0, 1, 1, 0)),
    ((6, 0, 0, 1, 1), (52, 0, 0, 1, 1), (60, 0, 0, 1, 1), (90, 3, 1, 1, 0), (47, 0, 0, 1, 1), (2, 0, 1, 1, 0), (1, 0, 1, 1, 0), (14, 0, 1, 0, 0)),
)

# Features from here on are hints of tags and names; share of a page's words beyond which a hint is the page's own.
HINTS = 6
WHOLE_PAGE = 0.9

# Elements by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template textarea title iframe object svg math canvas audio video".split())
APART = frozenset("nav header footer aside form menu dialog button select search head".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
APART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget".split()
)
ARTICLE = frozenset(("article", "main"))
# An open paragraph ends where a block begins; these end others of their kind.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("article aside body div dl fieldset footer form header main nav ol section table td th ul".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^'\"<>]|\"[^\"]*\"|'[^']*')*|[^<>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


# --- blocks ---


@dataclass
class Block:
    text: str
    words: int
    linked: int
    apart: bool
    inside: bool


@dataclass
class _Element:
    name: str
    apart: bool
    inside: bool
    link: bool


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)  # text, whether within a link
    open: list[_Element] = field(default_factory=lambda: [_Element("", False, False, False)])

    def close_block(self) -> None:
        text = " ".join("".join(p for p, _ in self.parts).split())
        if text:
            linked = sum(len(p.split()) for p, link in self.parts if link)
            top = self.open[-1]
            words = text.count(" ") + 1
            self.blocks.append(Block(text, words, min(words, linked), top.apart, top.inside))
        self.parts = []

    def end(self, names: tuple[str, ...], bounds: frozenset[str]) -> None:
        """Close the innermost open element of one of the names, if no bound lies between."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name in names:
                del self.open[i:]
                return
            if self.open[i].name in bounds:
                return


def _is_apart(name: str, rest: str) -> bool:
    if name in APART:
        return True
    if not rest or rest.isspace():
        return False
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id") and name not in ("html", "body") and any(p.lower() in APART_NAMES for p in _NAME_PARTS.findall(value)):
            return True
        if key == "role" and value.lower() in APART_ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def blocks_of(page: str) -> list[Block]:
    """Flat blocks in page order. Unread elements, comments and markup are left out; broken markup is read on."""
    state, at = _Page(), 0
    while True:
        found = _MARKUP.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            state.parts.append((html.unescape(text) if "&" in text else text, state.open[-1].link))
        if not found:
            break
        at = found.end()
        if found["data"] is not None:
            state.parts.append((found["data"], state.open[-1].link))
        if found["name"] is None:
            continue
        name = found["name"].lower()
        if found["end"]:
            if name in BLOCKS:
                state.close_block()
            state.end((name,), frozenset() if name in BOUNDS or name in BLOCKS and name != "p" else BOUNDS)
            continue
        if name in UNREAD:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(page, at)
            if not found["rest"].rstrip().endswith("/") or name in ("script", "style", "textarea", "title"):
                at = close.end()
            continue
        if name == "br":
            state.parts.append((" ", False))
            continue
        if name in BLOCKS:
            state.close_block()
            state.end(("p",), BOUNDS)
            if name in SIBLINGS:
                state.end(SIBLINGS[name], frozenset(("ul", "ol", "dl", "table", "select")))
        if name in VOID:
            continue
        top = state.open[-1]
        state.open.append(
            _Element(name, top.apart or _is_apart(name, found["rest"]), top.inside or name in ARTICLE, top.link or name == "a")
        )
    state.close_block()
    return state.blocks


def features_of(blocks: list[Block]) -> np.ndarray:
    """The blocks' features. A hint that holds for nearly all words of a page, like a form around everything, says nothing."""
    words = np.array([b.words for b in blocks], float)
    links = 100 * np.array([b.linked for b in blocks], float) / np.maximum(words, 1)
    inside = np.array([b.inside for b in blocks])
    article = np.where(inside, 1.0, -1.0) if inside.any() else np.zeros(len(blocks))
    before = lambda x: np.concatenate(([0.0], x[:-1]))
    after = lambda x: np.concatenate((x[1:], [0.0]))
    apart = np.array([b.apart for b in blocks], float)
    if (apart * words).sum() > WHOLE_PAGE * words.sum():
        apart = np.zeros(len(blocks))
    return np.stack((words, links, before(words), before(links), after(words), after(links), apart, article), 1)


def neutral(x: np.ndarray) -> np.ndarray:
    """Features without the hints of tags and names."""
    return np.concatenate((x[:, :HINTS], np.zeros((len(x), x.shape[1] - HINTS))), 1)


# --- tree ---


@dataclass
class Tree:
    """A leaf has a share of text blocks; an inner node sends values up to ``cut`` of a feature to the left."""

    share: float
    feature: int = -1
    cut: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.left is None or self.right is None:
            return np.full(len(x), self.share >= 0.5)
        low = x[:, self.feature] <= self.cut
        out = np.empty(len(x), bool)
        out[low], out[~low] = self.left.predict(x[low]), self.right.predict(x[~low])
        return out


def _impurity(y: np.ndarray) -> float:
    p = y.mean()
    return 2 * p * (1 - p) * len(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Tree:
    """The split that lowers Gini impurity most, of several the first feature and lowest cut, until leaves are pure."""
    if depth == 0 or y.min() == y.max():
        return Tree(float(y.mean()))
    best = (_impurity(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            cost = _impurity(y[low]) + _impurity(y[~low])
            if cost < best[0] - 1e-9:
                best = (cost, f, float(cut))
    if best[1] < 0:
        return Tree(float(y.mean()))
    low = x[:, best[1]] <= best[2]
    return Tree(float(y.mean()), best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def labelled_blocks(pages: tuple = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the pages' blocks: each page as its tags tell it, and once more without hints.

    A box within an article is told from it by its element only: without hints its blocks are neighbours, but no examples.
    """
    x, y = [], []
    for page in pages:
        features = features_of([Block("", words, linked, bool(apart), bool(inside)) for words, linked, apart, inside, _ in page])
        label = np.array([b[-1] for b in page], float)
        told = np.array([not (apart and inside) for _, _, apart, inside, _ in page])
        x += [features, neutral(features)[told]]
        y += [label, label[told]]
    return np.concatenate(x), np.concatenate(y)


def trained(pages: tuple = PAGES) -> Tree:
    return grow(*labelled_blocks(pages))


# --- operator ---


def main_text(page: str, tree: Tree) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n\n".join(b.text for b, keep in zip(blocks, tree.predict(features_of(blocks)).tolist()) if keep)


def extract(pages: DataFrame, tree: Tree) -> DataFrame:
    """page_id, url, text, n_chars of every row: a null or empty page has an empty text.

    Repeated rows and null ids are kept as they are; pages of any length are read whole; an empty table gives no rows.
    """
    limit_frames(pages.sparkSession)
    source = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    wanted = source.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    added = arrow_schema(pages.sparkSession, "text string, n_chars long")

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [main_text(p, tree) for p in frame.column(2).to_pylist()]
            new = batch_of({"text": texts, "n_chars": [len(t) for t in texts]}, added)
            yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), *new.columns], names=["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, wanted)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), trained())
