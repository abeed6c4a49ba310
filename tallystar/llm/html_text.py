"""Main text of web pages: flat text blocks, judged by a small decision tree.

A page is cut at block-level tags into text blocks. Each has its number of words and its link
density (the share of words in links), the same of the blocks before and after it, and three
signs of its place: inside an article, inside an element whose name or class marks menus,
notices, adverts, comments and the like, and being a heading. Class names that tell the layout
(has-sidebar, menu-open) mark nothing; an article or main element ends the mark of what wraps it,
but for an article among comments, related pages, or in nav, aside and footer. A mark has a
degree: what only may be boilerplate (sidebar, widget, header) is marked less surely. A decision
tree grown on a small labelled table of blocks tells main text from the rest. Scripts, styles, comments and
forms have no text blocks.

Character references are decoded, white space in a block becomes one space, and the blocks
kept are joined by an empty line. Null and empty pages give an empty text, unclosed elements
end with the page, and a tag cut off by the page's end is dropped. Texts are never cut.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import in_batches

# Elements that begin a block, and elements whose content is no text of the page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
RAW = ("script", "style", "noscript", "template", "textarea", "select", "svg", "iframe", "object",
       "title", "button", "math", "canvas")
MARKED = frozenset("nav footer aside form menu dialog head fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())

#: Elements and parts of names by how surely they mark boilerplate: 3 also what has articles of
#: its own, 1 only what may as well wrap the page, so that the tree looks at its texts.
SURENESS = {"nav": 3, "footer": 3, "aside": 3, "form": 1, "header": 1}
_MARKS = (
    (3, re.compile(r"comments?|disqus|related|replies|sponsor\w*")),
    (2, re.compile(r"ads?|advert\w*|breadcrumbs?|consent|cookies?|copyright|footer|gdpr|login|"
                   r"nav\w*|newsletter|notices?|pagination|popup|signup|subscribe")),
    (1, re.compile(r"banner|header|masthead|menu|promo\w*|search|share|sharing|sidebar|social|"
                   r"tags|toolbar|widget\w*")))
#: A name with one of these tells how a page is laid out or what state it is in.
_LAYOUT = frozenset("has have with without no not is layout open opened closed enabled disabled "
                    "free hidden visible active collapsed expanded".split())
_TITLES = frozenset("article content entry page post section story title".split())
_PARTS = re.compile(r"[_-]+")
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_ARTICLE = re.compile(r"(?:^|\s)(?:article|main)(?:$|\s)", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW)})\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)", re.S | re.I)


@lru_cache(20_000)
def _mark(values: str) -> int:
    """How surely the class names, id and role mark boilerplate; 0 if they do not."""
    found = 0
    for name in values.lower().split():
        parts = [p for p in _PARTS.split(name) if p]
        if not parts or not _LAYOUT.isdisjoint(parts) or parts[0] == "content":
            continue
        if "header" in parts and not _TITLES.isdisjoint(parts):
            parts.remove("header")
        found = max(found, *(level for level, words in _MARKS
                             if any(map(words.fullmatch, parts))), 0)
    return found


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    mark: int
    heading: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


class _Page:
    """Reads a page from left to right, with a stack of the open block elements."""

    def __init__(self):
        self.blocks: list[Block] = []
        self._open: list[tuple[str, bool, int]] = []         # name, in article, how surely marked
        self._count: Counter[str] = Counter()                # open elements by name
        self._parts: list[str] = []
        self._linked, self._in_link = 0, False

    def text(self, part: str) -> None:
        if part:
            self._parts.append(part)
            if self._in_link:
                self._linked += len(part.split())

    def flush(self) -> None:
        text = " ".join(references.unescape("".join(self._parts)).split())
        if text:
            _, article, mark = self._open[-1] if self._open else ("", False, 0)
            heading = any(name in HEADINGS for name, _, _ in self._open[-2:])
            words = text.count(" ") + 1
            self.blocks.append(Block(text, words, min(words, self._linked), article, mark, heading))
        self._parts, self._linked = [], 0

    def begin(self, name: str, attributes: str) -> None:
        if name == "br":
            self._parts.append(" ")
        elif name == "a":
            self._in_link = True
        if name not in BLOCKS:
            return
        self.flush()
        if name in VOID:
            return
        self._in_link = False
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or name in HEADINGS:
            self._close_like(name)
        _, article, mark = self._open[-1] if self._open else ("", False, 0)
        values = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(attributes)) if attributes else ""
        own = _mark(values) if values else 0
        if name == "main" or name == "article" and not article and max(mark, own) < 3:
            mark = 0                              # the page's own text, whatever wraps it
        elif name in MARKED or name == "header" and not article:
            mark = max(mark, own, SURENESS.get(name, 2))
        elif name not in ("html", "body", "article"):
            mark = max(mark, own)
        article = article or name in ("article", "main") or bool(values and _ARTICLE.search(values))
        self._open.append((name, article, mark))
        self._count[name] += 1

    def _close_like(self, name: str) -> None:
        """A paragraph, item or heading ends an open one of the same kind beside it."""
        kind = HEADINGS if name in HEADINGS else {name}
        if self._open and self._open[-1][0] in kind | {"p"}:
            self._count[self._open.pop()[0]] -= 1

    def end(self, name: str) -> None:
        if name == "a":
            self._in_link = False
        if name in BLOCKS:
            self.flush()
            closed = "" if self._count[name] else name       # without an open one, nothing closes
            while closed != name:
                closed = self._open.pop()[0]
                self._count[closed] -= 1


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    found, at = _Page(), 0
    for token in _TOKEN.finditer(page):
        found.text(page[at:token.start()])
        at = token.end()
        if token[3]:
            name = token[3].lower()
            if token[2]:
                found.end(name)
            else:
                found.begin(name, token[4])
        elif token[1]:
            found.text(" ")
    found.text(page[at:])
    found.flush()
    return found.blocks


# The labelled table: words and link density of a block, of the one before and the one after,
# whether in an article, how surely marked as boilerplate, a heading; then whether it is main text.
LABELLED = (
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (2, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0),
    (1, 1.0, 2, 1.0, 9, 0.0, 0, 1, 0, 0), (12, 0.0, 1, 1.0, 10, 0.0, 0, 1, 0, 0),
    (30, 0.0, 3, 1.0, 8, 0.0, 0, 1, 0, 0), (85, 0.0, 60, 0.0, 40, 0.0, 0, 1, 0, 0),
    (14, 0.0, 120, 0.0, 0, 0.0, 0, 1, 0, 0), (6, 0.5, 90, 0.0, 0, 0.0, 0, 1, 0, 0),
    (40, 0.1, 70, 0.0, 35, 0.0, 1, 1, 0, 0), (9, 0.0, 55, 0.0, 12, 0.0, 1, 1, 0, 0),
    (3, 0.0, 200, 0.0, 25, 0.0, 1, 1, 1, 0), (25, 0.0, 3, 0.0, 30, 0.0, 1, 1, 0, 0),
    (5, 0.0, 2, 1.0, 60, 0.0, 0, 1, 1, 0), (2, 0.0, 0, 0.0, 4, 1.0, 0, 1, 1, 0),
    (1, 0.0, 8, 0.0, 1, 0.0, 1, 0, 0, 1), (2, 0.0, 45, 0.0, 30, 0.0, 1, 0, 0, 1),
    (7, 0.0, 10, 0.0, 60, 0.0, 1, 0, 1, 1), (10, 0.0, 0, 0.0, 80, 0.0, 1, 0, 1, 1),
    (60, 0.0, 9, 0.0, 45, 0.0, 1, 0, 0, 1), (120, 0.05, 60, 0.0, 20, 0.0, 1, 0, 0, 1),
    (25, 0.2, 80, 0.0, 3, 0.0, 1, 0, 0, 1), (4, 0.25, 60, 0.0, 50, 0.0, 1, 0, 0, 1),
    (250, 0.0, 1, 0.0, 14, 0.0, 1, 0, 0, 1), (15, 0.3, 30, 0.0, 0, 0.0, 1, 0, 0, 1),
    (3, 1.0, 90, 0.0, 3, 1.0, 1, 0, 0, 0), (2, 1.0, 3, 1.0, 2, 1.0, 1, 0, 0, 0),
    (5, 1.0, 2, 1.0, 60, 0.0, 1, 0, 0, 0), (4, 0.9, 70, 0.0, 1, 1.0, 1, 0, 0, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0),
    (4, 0.75, 2, 1.0, 60, 0.0, 0, 0, 0, 0), (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (6, 0.0, 2, 0.0, 3, 0.0, 0, 0, 0, 1), (2, 0.0, 5, 0.0, 4, 0.0, 0, 0, 0, 1),
    (8, 0.0, 6, 0.0, 1, 1.0, 0, 0, 0, 0), (12, 0.6, 4, 0.5, 10, 0.8, 0, 0, 0, 0),
    (20, 0.5, 3, 1.0, 15, 0.6, 0, 0, 0, 0), (7, 0.0, 3, 1.0, 70, 0.0, 0, 0, 1, 1),
    (9, 0.0, 0, 0.0, 55, 0.0, 0, 0, 1, 1), (5, 0.0, 80, 0.0, 90, 0.0, 0, 0, 1, 1),
    (3, 0.0, 40, 0.0, 65, 0.0, 0, 0, 1, 1), (55, 0.0, 7, 0.0, 60, 0.0, 0, 0, 0, 1),
    (80, 0.05, 55, 0.0, 45, 0.0, 0, 0, 0, 1), (24, 0.0, 60, 0.0, 75, 0.0, 0, 0, 0, 1),
    (18, 0.1, 90, 0.0, 40, 0.0, 0, 0, 0, 1), (45, 0.2, 50, 0.1, 8, 0.9, 0, 0, 0, 1),
    (9, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (4, 0.0, 70, 0.0, 65, 0.0, 0, 0, 0, 1),
    (33, 0.0, 2, 1.0, 38, 0.0, 0, 0, 0, 1), (28, 0.0, 45, 0.0, 3, 0.0, 0, 0, 0, 1),
    (140, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (3, 0.0, 2, 1.0, 5, 0.8, 0, 0, 1, 0),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (3, 0.0, 1, 0.0, 2, 0.0, 1, 0, 0, 1),
    (2, 0.0, 4, 0.0, 9, 0.0, 1, 0, 0, 1), (6, 0.0, 2, 0.0, 1, 0.0, 1, 0, 0, 1),
    (9, 0.0, 14, 0.0, 5, 0.0, 1, 0, 0, 1), (1, 0.0, 2, 0.0, 40, 0.0, 1, 0, 0, 1),
    (4, 0.0, 3, 0.0, 0, 0.0, 1, 0, 0, 1), (12, 0.0, 30, 0.0, 2, 0.0, 1, 0, 0, 1),
    (5, 0.0, 12, 0.0, 15, 0.0, 1, 0, 1, 1), (2, 0.0, 25, 0.0, 11, 0.0, 1, 0, 1, 1),
    (8, 0.0, 2, 1.0, 3, 0.0, 1, 0, 1, 1), (1, 0.0, 9, 0.0, 1, 0.0, 1, 0, 1, 1),
    (16, 0.0, 5, 0.0, 4, 0.0, 1, 0, 0, 1), (3, 0.0, 60, 0.0, 16, 0.0, 1, 0, 0, 1),
    (7, 0.0, 11, 0.0, 8, 0.0, 0, 0, 0, 1), (10, 0.0, 3, 0.0, 9, 0.0, 0, 0, 0, 1),
    (5, 0.0, 9, 0.0, 2, 0.0, 0, 0, 0, 1), (4, 0.0, 1, 1.0, 12, 0.0, 0, 0, 0, 0),
    (9, 0.0, 16, 0.0, 30, 0.0, 0, 1, 0, 0), (11, 0.0, 4, 0.0, 6, 0.0, 0, 1, 0, 0),
    (15, 0.0, 25, 0.0, 18, 0.0, 0, 1, 0, 0), (70, 0.0, 20, 0.0, 90, 0.0, 1, 1, 0, 0),
    (180, 0.0, 90, 0.0, 60, 0.0, 0, 2, 0, 0), (240, 0.0, 3, 0.0, 150, 0.0, 1, 3, 0, 0),
    (150, 0.05, 90, 0.0, 60, 0.0, 0, 1, 0, 1), (110, 0.0, 5, 0.0, 140, 0.0, 0, 1, 0, 1),
    (125, 0.1, 30, 0.0, 3, 1.0, 1, 1, 0, 1), (130, 0.6, 4, 1.0, 20, 0.7, 0, 1, 0, 0),
    (160, 0.4, 2, 1.0, 5, 1.0, 0, 1, 0, 0), (90, 0.0, 12, 0.0, 8, 0.0, 0, 1, 0, 0),
    (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (4, 0.0, 0, 0.0, 6, 0.0, 0, 0, 1, 1), (12, 0.0, 14, 0.0, 10, 0.0, 0, 0, 0, 1),
    (15, 0.1, 8, 0.2, 12, 0.0, 0, 0, 0, 1), (6, 0.0, 4, 1.0, 5, 0.9, 0, 0, 0, 0),
    (14, 0.0, 3, 1.0, 6, 0.0, 0, 0, 0, 0), (11, 0.1, 9, 0.0, 2, 1.0, 0, 0, 0, 0),
    (9, 0.2, 2, 0.8, 7, 0.6, 0, 0, 0, 0), (17, 0.0, 12, 0.5, 9, 0.0, 0, 0, 0, 0),
    (2, 0.0, 3, 1.0, 4, 0.0, 0, 0, 1, 0), (22, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 1),
    (3, 1.0, 40, 0.0, 50, 0.0, 1, 0, 0, 0), (8, 0.8, 30, 0.0, 20, 0.0, 0, 0, 0, 0),
    (5, 1.0, 12, 0.0, 8, 0.0, 0, 0, 0, 0), (2, 1.0, 60, 0.0, 25, 0.0, 1, 0, 0, 0),
    (30, 0.9, 50, 0.0, 45, 0.0, 1, 0, 0, 0), (45, 0.7, 70, 0.0, 0, 0.0, 0, 0, 0, 0),
    (12, 0.9, 0, 0.0, 30, 0.0, 1, 0, 1, 0), (160, 1.0, 10, 0.0, 12, 0.0, 1, 0, 0, 0),
    (12, 0.0, 3, 1.0, 2, 1.0, 1, 0, 0, 1), (5, 0.0, 4, 1.0, 9, 0.0, 1, 0, 0, 1),
    (3, 0.0, 2, 0.9, 7, 1.0, 1, 0, 0, 1), (8, 0.0, 20, 0.0, 3, 1.0, 1, 0, 0, 1),
    (2, 0.0, 2, 1.0, 1, 1.0, 1, 0, 1, 1), (16, 0.1, 9, 0.8, 4, 1.0, 1, 0, 0, 1),
    (1, 0.0, 1, 1.0, 6, 0.0, 1, 0, 0, 1), (6, 0.2, 5, 0.0, 2, 1.0, 1, 0, 0, 1),
    (300, 0.0, 200, 0.0, 90, 0.0, 0, 1, 0, 1), (600, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (170, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (200, 0.1, 4, 0.0, 250, 0.0, 0, 1, 0, 1),
    (400, 0.0, 0, 0.0, 30, 0.0, 0, 2, 0, 0), (700, 0.0, 300, 0.0, 100, 0.0, 1, 3, 0, 0),
    (120, 0.0, 40, 0.0, 60, 0.0, 1, 2, 0, 0), (130, 0.0, 0, 0.0, 9, 0.0, 0, 3, 0, 0),
    (180, 0.9, 20, 0.0, 6, 0.0, 0, 1, 0, 0), (220, 0.7, 0, 0.0, 0, 0.0, 0, 1, 0, 0),
)

Tree = tuple | int


def grow(rows: Sequence[Sequence[float]], depth: int = 7) -> Tree:
    """A decision tree by Gini impurity: (feature, bound, at most, above), or a label."""
    ones = sum(r[-1] for r in rows)
    label = int(2 * ones >= len(rows))
    if ones in (0, len(rows)) or depth == 0:
        return label
    impurity = lambda part: 2 * (n := sum(r[-1] for r in part)) * (len(part) - n) / len(part)
    best = None
    for feature in range(len(rows[0]) - 1):
        values = sorted({r[feature] for r in rows})
        for low, high in zip(values, values[1:]):
            bound = (low + high) / 2
            left = [r for r in rows if r[feature] <= bound]
            right = [r for r in rows if r[feature] > bound]
            cost = impurity(left) + impurity(right)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, feature, bound, left, right)
    if best is None:
        return label
    return (best[1], best[2], grow(best[3], depth - 1), grow(best[4], depth - 1))


def judge(tree: Tree, features: Sequence[float]) -> int:
    while not isinstance(tree, int):
        feature, bound, low, high = tree
        tree = low if features[feature] <= bound else high
    return tree


def main_text(page: str | None, tree: Tree) -> str:
    """The kept blocks of the page, joined by an empty line."""
    found = blocks(page) if page else []
    nothing = Block("", 0, 0, False, 0, False)
    around = [nothing, *found, nothing]
    return "\n\n".join(b.text for before, b, after in zip(around, found, around[2:])
                       if judge(tree, (b.words, b.density, before.words, before.density, after.words,
                                       after.density, b.article, b.mark, b.heading)))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", labelled: Sequence[Sequence[float]] = LABELLED) -> DataFrame:
    """(id, url, text) per row; the tree is grown on the labelled rows, which are few."""
    tree = grow(labelled)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string())], ["id", "url", "text"])

    fields = {c: pages.schema[n].dataType.simpleString() for c, n in (("id", id_col), ("url", url_col))}
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    return (in_batches(rows, extracted, f"id {fields['id']}, url {fields['url']}, text string")
            .toDF(id_col, url_col, "text"))
