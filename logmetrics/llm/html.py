"""Main text of web pages: flat blocks, judged by a decision tree.

A page is read once, tag by tag, into a flat list of text blocks; inline markup
leaves no trace, block markup ends a block, and scripts, styles and comments are
skipped. A block's features are its own words and link density, those of the blocks
before and after it, and what it stands in: an element that is a menu, header,
footer, sidebar, form and the like by its name or by a word of its class, id or
role, an article, a heading, a list. Words of a class may mislead, so a mark by words
alone is told from one by name, and each block knows how much of the page's text
stands outside such parts: where there is none, density outvotes the mark. Blocks
between two that are mostly links make a stretch, whose share of the page's words out
of links is a feature of each. A decision tree over these, grown on the labelled pages, says which blocks are main text.
"""

import html
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logmetrics.llm.labelled_pages import PAGES

PAGES_AT_ONCE = 200

# Elements of HTML.
BREAKING = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol "
    "optgroup option p pre section select summary table tbody td tfoot th thead title tr ul video audio object".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())  # hold text only: left open, they go on to the end of the page
SKIPPED = frozenset("template svg iframe object video audio select".split())
STARTING = BREAKING - SKIPPED - frozenset("caption hr legend optgroup option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("li dt dd option".split())
AROUND = frozenset("nav footer aside form menu dialog button fieldset".split())
MAIN = frozenset("article main".split())
# Words of class, id and role that name parts around a main text, and main texts.
AROUND_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle adbox banner promo promotion sponsor sponsored sponsors "
    "sidebar sidenav side rail aside complementary menu menubar nav navbar navigation topnav breadcrumb breadcrumbs crumbs "
    "footer foot footnav contentinfo header masthead topbar toolbar cookie cookies consent gdpr privacy notice notices "
    "notification alert alertdialog popup modal overlay dialog newsletter subscribe subscription signup login signin "
    "paywall share sharing social socials follow related recommended recommendations trending popular "
    "comment comments commentlist reply replies respond disqus discussion feedback reviews widget widgets search "
    "pager pagination paging tags taglist copyright legal disclaimer form".split()
)
MAIN_WORDS = frozenset("article post entry story content main body text prose".split())

# Words that mark an element as the frame of a page, whatever else its class says.
FRAME_WORDS = frozenset("has with no without wrapper container layout page site".split())
HEADER_WORDS = frozenset("header masthead".split())
# First and last words of a class that tells a topic or a state, not a place in the page.
TOPIC_WORDS = frozenset("category cat tag type status format topic term is js".split())
STATE_WORDS = frozenset("open closed enabled disabled on off active allowed".split())
REMARK_WORDS = frozenset("comment reply".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^\"'<>]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>|<[!?/][^<>]*>",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_CLOSE = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}
_OWN = {name: re.compile(rf"<!--.*?(?:-->|\Z)|<(/?){name}(?![a-zA-Z0-9:-])", re.I | re.S) for name in SKIPPED}

FEATURES = ("links", "around", "main", "hinted", "outside", "links_before", "links_after", "stretch", "heading", "list", "words", "words_before", "words_after")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    around: bool
    main: bool
    heading: bool
    listed: bool
    hinted: bool  # around by words of class, id or role alone


def _hints(name: str, attributes: str, inside_main: bool) -> tuple[bool, bool, bool]:
    """Does the element stand around a main text by its name, or by its words, and does it hold a main text?

    A class counts by its own: one with a word of either kind is around (``main-nav``),
    but for topics and states (``tag-social``, ``comments-open``). Next to a class that
    names a main text, and on an article or main element, it marks nothing around; on
    these only a remark's name does.
    """
    around = name in AROUND or (name in ("header", "noscript") and not inside_main)
    main, hinted = name in MAIN, False
    if attributes and "=" in attributes:
        for _, a, b, c in _NAMED.findall(attributes):
            classes = [[w for w in re.split(r"[^a-z]+", x) if w] for x in (a or b or c).lower().split()]
            frame = any(w in FRAME_WORDS for x in classes for w in x)
            named = AROUND_WORDS - HEADER_WORDS if inside_main else AROUND_WORDS
            places = [x for x in classes if x and not (len(x) > 1 and (x[0] in TOPIC_WORDS or x[-1] in STATE_WORDS))]
            outer = [x for x in places if not named.isdisjoint(x)]
            inner = [x for x in places if named.isdisjoint(x) and not MAIN_WORDS.isdisjoint(x)]
            if outer and not frame and name not in ("body", "html"):
                hinted |= not inner and (name not in MAIN or any(x[0] in REMARK_WORDS for x in outer))
            main |= bool(inner) and (frame or not outer) and name not in ("body", "html", "a", "span")
        if re.search(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", attributes, re.I):
            around = True
    return around, hinted, main


def _with_end(page: str, name: str) -> set[int]:
    """Where those elements of a name start that have an end tag; it belongs to the last one open."""
    begun, out = [], set()
    for m in _OWN[name].finditer(page):
        if m[1] == "":
            begun.append(m.start())
        elif m[1] and begun:
            out.add(begun.pop())
    return out


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order, none of them empty.

    What a skipped element holds is passed over up to its end tag or the end of the
    element it stands in. One without end tag of its own ends at the next text block
    too, so it cannot take the text behind it along.
    """
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, around by name, around by words, main: of this element and all it stands in
    skips: list[bool | None] = []  # of each element of the stack: None, or whether the skipped one it stands in has an end
    with_end: dict[str, set[int]] = {}
    opened: Counter[str] = Counter()
    n_links = 0

    def end() -> None:
        nonlocal parts, linked
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                _, around, hinted, main = stack[-1] if stack else ("", False, False, False)
                n = sum(len(html.unescape(x).split()) for x in linked)
                out.append(Block(" ".join(words), len(words), min(n, len(words)), around or hinted, main, any(opened[x] > 0 for x in HEADINGS), any(opened[x] > 0 for x in LISTS), hinted and not around))
            parts, linked = [], []

    def take(text: str) -> None:
        if text and not (skips and skips[-1] is not None):
            parts.append(text)
            if n_links:
                linked.append(text + " ")

    def leave() -> str:
        nonlocal n_links
        name = stack.pop()[0]
        skips.pop()
        opened[name] -= 1
        n_links -= name == "a"
        return name

    at = 0
    while found := _TAG.search(page, at):
        take(page[at : found.start()])
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        breaking = name in BREAKING
        if breaking:
            end()
        if name == "br":
            parts.append(" ")
        if closing:
            while opened[name]:
                if leave() == name:
                    break
            continue
        if name in STARTING:
            while skips and skips[-1] is False:
                leave()
        if name in SKIPPED and attributes.rstrip().endswith("/"):
            continue
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                close = _CLOSE[name].search(page, at)
                at = close.end() if close else len(page)
            continue
        if name in EMPTY:
            continue
        if (breaking and name not in SKIPPED and stack and stack[-1][0] == "p") or (name in LISTS and stack and stack[-1][0] == name):
            leave()
        if name == "a":
            n_links += 1
        elif not breaking and not attributes and name not in SKIPPED and name != "noscript":
            continue  # plain inline markup says nothing
        _, around, hinted, main = stack[-1] if stack else ("", False, False, False)
        by_name, by_words, here = _hints(name, attributes, main)
        skip = skips[-1] if skips else None
        if name in SKIPPED and not skip:
            if name not in with_end:
                with_end[name] = _with_end(page, name)
            skip = found.start() in with_end[name]
        skips.append(skip)
        opened[name] += 1
        stack.append((name, around or by_name, hinted or by_words, main or here))
    take(page[at:])
    end()
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row per block, columns as in ``FEATURES``. Beyond the page's ends there are no words.

    ``outside`` is the share of the page's words out of links that stand in no part
    marked as around, and 1 if such words stand in a main text. ``stretch`` is the share
    of the page's words out of links that stand in the block's stretch: the neighbours up
    to the next block of more than half links, or to the border of a part marked as around or as main text. A text
    lies in a large one, a notice among menus in a small one, however short its blocks.
    """
    n = len(found)
    words = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([0, *(b.linked / b.words for b in found), 0], float)
    flags = np.array([(b.around, b.main, b.heading, b.listed) for b in found], float).reshape(n, 4)
    plain = np.array([b.words - b.linked for b in found], float)
    clear = flags[:, 0] == 0
    outside = 1.0 if (plain[clear & (flags[:, 1] == 1)] > 0).any() else plain[clear].sum() / max(plain.sum(), 1.0)
    hinted = [float(b.hinted) for b in found]
    dense = links[1:-1] > 0.5
    border = np.ones(n, bool)
    border[1:] = dense[1:] | dense[:-1] | (flags[1:, :2] != flags[:-1, :2]).any(axis=1)
    number = np.cumsum(border) - 1
    stretch = np.where(dense, 0.0, np.bincount(number, weights=plain)[number] / max(plain.sum(), 1.0)) if n else plain
    around, main, heading, listed = flags.T
    return np.column_stack([
        links[1:-1], around, main, hinted, np.full(n, outside), links[:-2], links[2:], stretch, heading, listed, words[1:-1], words[:-2], words[2:],
    ])


@dataclass
class Tree:
    """Nodes in order; a node with feature -1 is a leaf."""

    feature: list[int]
    split: list[float]
    below: list[int]
    above: list[int]
    share: list[float]

    def keeps(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        feature, split = np.array(self.feature), np.array(self.split)
        below, above = np.array(self.below), np.array(self.above)
        while len(rows) and (inner := feature[node] >= 0).any():
            value = rows[np.arange(len(rows)), np.maximum(feature[node], 0)]
            node = np.where(inner, np.where(value <= split[node], below[node], above[node]), node)
        return np.array(self.share)[node] >= 0.5


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 1) -> Tree:
    """A tree by Gini impurity. Of equal splits the first feature and the lowest value win."""
    tree = Tree([], [], [], [], [])

    def impurity(y: np.ndarray) -> float:
        p = y.mean() if len(y) else 0.0
        return 2 * p * (1 - p) * len(y)

    def add(x: np.ndarray, y: np.ndarray, left: int) -> int:
        me = len(tree.feature)
        for column, value in zip((tree.feature, tree.split, tree.below, tree.above, tree.share), (-1, 0.0, -1, -1, float(y.mean()))):
            column.append(value)
        best = (impurity(y) - 1e-9, -1, 0.0)
        if left and 0 < y.mean() < 1:
            for j in range(x.shape[1]):
                values = np.unique(x[:, j])
                for v in (values[:-1] + values[1:]) / 2:
                    low = x[:, j] <= v
                    if least <= low.sum() <= len(y) - least:
                        total = impurity(y[low]) + impurity(y[~low])
                        if total < best[0] - 1e-9:
                            best = (total, j, float(v))
        if best[1] >= 0:
            low = x[:, best[1]] <= best[2]
            tree.feature[me], tree.split[me] = best[1], best[2]
            tree.below[me] = add(x[low], y[low], left - 1)
            tree.above[me] = add(x[~low], y[~low], left - 1)
        return me

    add(rows, labels.astype(float), depth)
    return tree


def learn(pages: list[list[tuple[str, int]]] = PAGES) -> Tree:
    """The tree of labelled pages. Each piece of a page must hold one block."""
    rows, labels = [], []
    for page in pages:
        found = blocks("".join(piece for piece, _ in page))
        kept = [y for _, y in page if y >= 0]
        if len(found) != len(kept):
            raise ValueError(f"a labelled page has {len(found)} blocks and {len(kept)} labels: {page[0][0][:80]}")
        rows.append(features(found))
        labels += kept
    return grow(np.concatenate(rows), np.array(labels))


@lru_cache(maxsize=1)
def default_tree() -> Tree:
    return learn()


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, tree.keeps(features(found))) if keep)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", content: str = "html", tree: Tree | None = None) -> DataFrame:
    """Key, url, ``text`` and ``n_chars`` (its code points) per page.

    One row per input row, repeated and null keys included. A null or empty page,
    or one without main text, has an empty text. Broken markup never fails: what
    is not a tag is text, an element left open ends with the one it stands in.
    Other columns do not pass. No shuffle.
    """
    tree = tree or default_tree()
    shared = pages.sparkSession.sparkContext.broadcast(tree)
    kind = lambda c: pages.schema[c].dataType.simpleString()
    schema = f"`{key}` {kind(key)}, `{url}` {kind(url)}, text string, n_chars bigint"

    def each(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(lo, PAGES_AT_ONCE)
                texts = [main_text(p, shared.value) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [key, url, "text", "n_chars"],
                )

    return pages.select(key, url, content).mapInArrow(each, schema)
