"""HTML main text: flat text blocks classified by a small decision tree.

A page is cut into blocks at block-level tags.  Each block has shallow features: its words, its link
density, those of the blocks before and after it, whether it lies in an article element or beside one,
whether it is a heading, and how far its containers look like boilerplate (0 to 2, see ``_names``).  A
decision tree says which blocks are main text.  It is trained on the blocks of ``PAGES`` labelled pages,
which are made by rule (``htmlpages``): with and without article elements and telling names, with
articles in containers of misleading names, and with menus, sidebars and teasers that only words and
links tell from text.

What is no text is skipped up to its own end tag, whatever markup its content looks like; a button or
a select box that is not closed ends where a block begins.  A head needs no end tag: its elements hold
no text, and text in it belongs to the body, as in a browser.

Edge cases: null or empty html gives an empty text.  Very long pages are read whole, in linear time.
Cut-off pages and unclosed tags are read as far as they go.  Blocks keep the order of the page, so
there are no ties.  Repeated pages get equal results, a null page_id stays null.  Columns of any other
name are not read.  An empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import htmlpages

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[|\]\]>|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>""",
    re.DOTALL,
)
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)

#: Elements whose content is no text.
RAW = frozenset("script style noscript noframes template iframe svg select textarea button title".split())
#: Those of them whose content is no markup: it ends at the first end tag of their name.
PLAIN = frozenset("script style noscript noframes iframe textarea title".split())
#: Void elements have no end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start a new block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements kept on the stack of containers.
CONTAINER = frozenset("article aside body details dialog div dl fieldset figure footer form header html li main menu nav ol section span table td tr ul".split())
OUTSIDE = frozenset("nav footer aside form menu dialog fieldset".split())
#: Names of what is no article, and names that may be either.
STRONG = frozenset(
    "ad ads adsense sponsor sponsored sidebar menu nav navbar navigation masthead footer foot cookie cookies consent gdpr notice notices popup modal"
    " newsletter subscribe subscription signup login search form comment comments reply replies respond discussion disqus recommended tags pagination"
    " pager copyright contentinfo complementary".split()
)
STEMS = ("advert", "comment", "breadcrumb", "sidebar", "newsletter")
WEAK = frozenset("promo promotion side alert banner overlay related share sharing social widget legal teaser more header".split())
#: What is put behind such names, and what before them says that they are of something else.
PLACES = frozenset("box wrapper wrap container block section area list inner outer bar panel item items link links group row column left right top bottom".split())
OTHERS = frozenset("has with no without hide show".split())


def _strength(name: str) -> int:
    """2 where the last word of a name, places aside, is of no article, 1 where another is or may be, else 0."""
    words = re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())
    if not words or words[0] in OTHERS:
        return 0
    while len(words) > 1 and words[-1] in PLACES:
        words.pop()
    strong = [w in STRONG or w.startswith(STEMS) for w in words]
    return 2 if strong[-1] else int(any(strong) or any(w in WEAK for w in words))


def _names(attributes: str) -> list[str]:
    return [name for x in _HINT.findall(attributes) for name in "".join(x).split()]


_SCRIPT = re.compile(r"<!--|-->|<(/?)script(?=[\s/>])", re.IGNORECASE)


@lru_cache(maxsize=64)
def _end_tag(tag: str) -> re.Pattern:
    """The end tag of an element without text; in one that holds markup, what may only look like it is passed over."""
    own = rf"</{tag}(?=[\s/>])"
    passed = "" if tag in PLAIN else r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style)(?=[\s/>]).*?(?:</(?P=raw)(?=[\s/>])|\Z)|<[a-z](?:[^<>=]|=\s*(?:"[^"]*"|'[^']*')?)*+>|"""
    return re.compile(f"{passed}(?P<own>{own})", re.DOTALL | re.IGNORECASE)


#: No button or select box holds these, so it ends there if not before; a div may stand in one.
_NEXT = re.compile(rf"<(?:/?(?:{'|'.join(sorted(BLOCK - {'div', 'option', 'hr', 'legend', 'label'}))})|button|select)(?=[\s/>])", re.IGNORECASE)


def _skipped(html: str, tag: str, at: int) -> int:
    """Where the end tag of an element without text starts, or the end of the page."""
    if tag in ("button", "select"):
        end = _end_tag(tag).search(html, at)
        while end and not end["own"]:
            end = _end_tag(tag).search(html, end.end())
        block = _NEXT.search(html, at, end.start() if end else len(html))
        return block.start() if block else end.start() if end else len(html)
    if tag == "script":
        state = 0  # 1: after <!--, 2: in a script element written there, whose end tag doesn't count
        while m := _SCRIPT.search(html, at):
            at, what = m.end(), m[0]
            if what == "<!--":
                state, at = max(state, 1), at - 2  # its dashes may close it: <!-->
            elif what == "-->":
                state = 0
            elif not m[1]:
                state = 2 if state else 0
            elif state == 2:
                state = 1
            else:
                return m.start()
        return len(html)
    return next((m.start() for m in _end_tag(tag).finditer(html, at) if m["own"]), len(html))


@dataclass
class Block:
    text: str
    n_words: int
    link_words: int
    inside: bool
    boiler: int
    heading: bool

    @property
    def link_density(self) -> float:
        return self.link_words / self.n_words if self.n_words else 0.0


def blocks_of(html: str | None) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # tag, is article, looks like boilerplate
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    inside = heading = False
    boiler = 0
    html = html or ""
    at = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = "".join(parts)
            words = (unescape(text) if "&" in text else text).split()
            if words:
                out.append(Block(" ".join(words), len(words), min(len(words), sum(len(x.split()) for x in linked)), inside, boiler, heading))
        parts, linked = [], []

    def stand() -> None:
        nonlocal inside, boiler
        inside, boiler = any(x[1] for x in stack), max((x[2] for x in stack), default=0)

    while m := _MARKUP.search(html, at):
        if m.start() > at:
            piece = html[at : m.start()]
            parts.append(piece)
            if in_link:
                linked.append(piece)
        at = m.end()
        close, tag, attributes = m[1], m[2], m[3]
        if tag is None:
            close, tag, attributes = m[4], m[5], m[6]
            if tag is None:
                continue
        tag = tag.lower()
        if tag == "head":
            flush()
            continue
        if tag in RAW:
            if not close and not attributes.endswith("/"):
                at = _skipped(html, tag, at)
                flush() if tag == "title" else parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if close else 1
        if tag in BLOCK:
            flush()
            in_link = 0 if tag in CONTAINER and tag != "li" else in_link
            if tag[0] == "h" and len(tag) == 2 and tag[1] in "123456":
                heading = not close
            elif tag in BLOCK:
                heading = False
        if tag in CONTAINER and tag not in VOID:
            if close:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        flush()
                        del stack[k:]
                        stand()
                        break
            elif not attributes.endswith("/"):
                article = tag in ("article", "main")
                bad = 2 if tag in OUTSIDE or tag == "header" and not inside else 0
                if attributes and tag not in ("body", "html"):
                    names = _names(attributes)
                    if not article:
                        bad = max([bad, *map(_strength, names)])
                    if _HIDDEN.search(attributes) or "header" in names and not inside and not article:
                        bad = 2
                    article = article or not bad and tag in ("div", "section") and bool({"article", "main"} & {n.lower() for n in names})
                if article or bad or tag != "span":
                    if bad or article:
                        flush()
                    stack.append((tag, article, bad))
                    stand()
    if at < len(html):
        rest = html[at:]
        cut = rest.rfind("<")
        parts.append(rest[:cut] if cut >= 0 and re.match(r"</?[a-zA-Z!]?[^>]*\Z", rest[cut:]) and re.match(r"</?(?:[a-zA-Z!]|\Z)", rest[cut:]) else rest)
    flush()
    return out


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "inside", "outside", "boiler", "heading")


def features(blocks: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block.  ``outside``: the page has an article, and not here."""
    n = len(blocks)
    x = np.zeros((n, len(FEATURES)))
    x[:, 0] = [b.n_words for b in blocks]
    x[:, 1] = [b.link_density for b in blocks]
    x[1:, 2:4], x[:-1, 4:6] = x[:-1, 0:2], x[1:, 0:2]
    x[:, 6] = [b.inside for b in blocks]
    x[:, 7] = (1 - x[:, 6]) * (x[:, 6].max() if n else 0)
    x[:, 8] = [b.boiler for b in blocks]
    x[:, 9] = [b.heading for b in blocks]
    return x


#: Labelled pages that the tree is trained on, whatever the table.
PAGES = 600
DEPTH, LEAST = 9, 6


def labelled(pages: int = PAGES, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Features of the blocks of ``pages`` pages made by rule, and 1 for main text: the words of an article are marked, not its tags."""
    x, y = [], []
    for html in htmlpages.pages(pages, seed):
        blocks = blocks_of(html)
        x.append(features(blocks))
        y += [b.text.startswith(htmlpages.MARK) for b in blocks]
    return np.concatenate(x), np.array(y).astype(int)


class DecisionTree:
    """Binary CART by Gini impurity; ties go to the first feature and the lowest threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = DEPTH, least: int = LEAST) -> None:
        self.value = float(y.mean())
        self.feature = None
        n, ones = len(y), int(y.sum())
        if depth == 0 or ones in (0, n) or n < 2 * least:
            return
        best = (ones * (n - ones) / n - 1e-9, None, None)
        for k in range(x.shape[1]):
            order = np.argsort(x[:, k], kind="stable")
            v, left_ones = x[order, k], np.cumsum(y[order])[:-1]
            left = np.arange(1, n)
            allowed = (v[1:] > v[:-1]) & (left >= least) & (n - left >= least)
            if not allowed.any():
                continue
            right_ones = ones - left_ones
            score = left_ones * (left - left_ones) / left + right_ones * (n - left - right_ones) / (n - left)
            at = int(np.argmin(np.where(allowed, score, np.inf)))
            if score[at] < best[0] - 1e-12:
                best = float(score[at]), k, float((v[at] + v[at + 1]) / 2)
        if best[1] is not None:
            _, self.feature, self.cut = best
            low = x[:, self.feature] <= self.cut
            self.low, self.high = DecisionTree(x[low], y[low], depth - 1, least), DecisionTree(x[~low], y[~low], depth - 1, least)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of main text in each row's leaf."""
        if self.feature is None:
            return np.full(len(x), self.value)
        low = x[:, self.feature] <= self.cut
        out = np.empty(len(x))
        out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out

    def splits(self) -> list[str]:
        """The feature of each inner node, from the root down."""
        return [] if self.feature is None else [FEATURES[self.feature], *self.low.splits(), *self.high.splits()]


@lru_cache(maxsize=1)
def trained() -> DecisionTree:
    return DecisionTree(*labelled())


def main_text(html: str | None, tree: DecisionTree | None = None) -> str:
    blocks = blocks_of(html)
    if not blocks:
        return ""
    keep = (tree or trained()).predict(features(blocks)) >= 0.5
    return " ".join(b.text for b, k in zip(blocks, keep.tolist(), strict=True) if k)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page; no shuffle.  The tree is trained once, on the driver."""
    read = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))
    kinds = {c: read.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    tree = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, tree) for html in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return read.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
