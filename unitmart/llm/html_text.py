"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block elements. The features of a block are
its number of words and its link density (share of words in links), those of
the blocks before and after it, the greatest number of words and the link
density among the ``NEAR`` blocks on both sides, whether it is a heading, and
as one weak feature its place: in an article or main element (1), in neither,
on a page without (0) or with (-1) such an element, or in an element for
something else, such as a menu, footer, sidebar or form (-2). Of classes and
ids only whole names of the parts that lengths cannot tell, such as reader
comments, count as such an element. A decision tree learned from the labelled
pages of ``html_examples`` (Gini splits, on the driver) keeps or drops each
block; a split by place has to be ``1 / WEAK`` times as good as one by words,
links or headings to be taken.

Character references are decoded; white space within a block becomes one
space; kept blocks are joined by an empty line. Scripts, styles, comments,
hidden elements and other unseen ones are no text.

Defined results: a null, empty or textless page has an empty text; unclosed
and stray tags are tolerated, an unclosed comment or script ends with the
page, a tag that meets the next "<" before its end is text; the time is in
proportion to the page; repeated rows are treated alike; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, slices, table
from .html_examples import pages

# fixed values: element names and naming habits of web pages
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section
select summary table tbody textarea tfoot thead title tr ul""".split())
SPACES = frozenset(["br", "td", "th", "img", "input", "wbr"])
UNSEEN = frozenset("head script style noscript template svg math iframe object canvas audio video textarea select title".split())
# elements whose content is raw text up to their own end tag
RAW = frozenset("script style textarea title iframe noscript template svg math".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(["article", "main"])
REST = frozenset(["nav", "aside", "footer", "header", "form", "menu", "dialog", "button"])
ROLES = frozenset("navigation complementary contentinfo banner search form dialog alert alertdialog menu menubar toolbar".split())
# whole names of parts that read like an article or like its short paragraphs
REST_NAMES = frozenset("""ad ads advert advertisement comments comment-list consent cookies cookie-notice footer header
menu nav navbar navigation newsletter notice promo related replies sidebar""".split())

# A quoted value may hold anything; "<" outside of one ends the attempt, and
# possessive repeats never go back, so that broken markup costs no second scan.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/><]*+)((?:[^>\"'<]++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
UNSHOWN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*+:\s*+none|aria-hidden\s*+=\s*+[\"']?true", re.I)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "words_near", "links_near",
            "heading", "place")
NEAR = 3
WEAK = 0.4  # what a gain of the last feature counts against the others


class Block(NamedTuple):
    text: str
    words: int
    links: float
    heading: bool
    place: int


def _place(tag: str, attrs: str, outer: int) -> int:
    if outer == -2:
        return -2
    if tag in REST:
        return 1 if tag == "header" and outer == 1 else -2
    role = None
    if attrs and tag != "body":
        for m in NAMES.finditer(attrs):
            names = (m[2] or m[3] or m[4] or "").lower().split()
            if m[1].lower() == "role":
                role = names[0] if names else None
            elif any(n in REST_NAMES for n in names):
                return -2
    if role in ROLES:
        return -2
    return 1 if tag in MAIN or role in MAIN else outer


def blocks(page: str | None) -> list[Block]:
    """Flat text blocks of a page, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []  # open elements: name, place, unseen
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked: list[str] = []
    link, heading, at, page = 0, False, 0, page or ""

    def flush() -> None:
        words = html.unescape("".join(text)).split()
        if words:
            in_links = len(html.unescape(" ".join(linked)).split())
            out.append(Block(" ".join(words), len(words), min(in_links / len(words), 1.0), heading,
                             stack[-1][1] if stack else 0))
        text.clear()
        linked.clear()

    def seen(part: str) -> None:
        if part and not (stack and stack[-1][2]):
            text.append(part)
            if link:
                linked.append(part)

    while True:
        m = TOKEN.search(page, at)
        seen(page[at:m.start()] if m else page[at:])
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), m[3]
        closing = bool(m[1])
        if tag in BLOCKS:
            flush()
            heading = tag in HEADINGS and not closing
        elif tag in SPACES:
            text.append(" ")
        if tag == "a":
            link = 0 if closing else 1
        if closing:
            if tag in BLOCKS or tag in UNSEEN:
                while opened[tag]:
                    name = stack.pop()[0]
                    opened[name] -= 1
                    if name == tag:
                        break
        elif (tag in BLOCKS or tag in UNSEEN) and tag not in VOID and not attrs.endswith("/"):
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif tag not in ("p", "li", "tr", "dt", "dd", "option", *HEADINGS) or attrs.strip():
                if tag == "body":
                    stack.clear()  # whatever an unclosed head left open
                    opened.clear()
                unseen = tag in UNSEEN or bool(stack and stack[-1][2]) or bool(attrs and UNSHOWN.search(attrs))
                stack.append((tag, _place(tag, attrs, stack[-1][1] if stack else 0), unseen))
                opened[tag] += 1
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    n = len(found)
    x = np.zeros((n, len(FEATURES)))
    if not n:
        return x
    x[:, 0] = [b.words for b in found]
    x[:, 1] = [b.links for b in found]
    words, links = x[:, 0], x[:, 1]
    x[1:, 2:4] = x[:-1, :2]
    x[:-1, 4:6] = x[1:, :2]
    linked, around = np.zeros(n), np.zeros(n)
    for d in range(1, min(NEAR, n - 1) + 1):
        for mine, other in ((slice(d, n), slice(0, n - d)), (slice(0, n - d), slice(d, n))):
            x[mine, 6] = np.maximum(x[mine, 6], words[other])
            around[mine] += words[other]
            linked[mine] += words[other] * links[other]
    x[:, 7] = linked / np.maximum(around, 1)
    x[:, 8] = [b.heading for b in found]
    x[:, 9] = [b.place for b in found]
    if (x[:, 9] == 1).any():
        x[x[:, 9] == 0, 9] = -1
    return x


Tree = tuple  # (share,) at a leaf, else (feature, threshold, low tree, high tree)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 3) -> Tree:
    """Decision tree by Gini impurity; ties go to the first feature, gains of
    the last one count ``WEAK``."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return (share,)
    whole = share * (1 - share) * len(y)
    best = (1e-9, None, None)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(np.diff(v) > 0)
        cut = cut[(cut + 1 >= least) & (len(y) - cut - 1 >= least)]
        if len(cut) == 0:
            continue
        a, b = cut + 1.0, len(y) - cut - 1.0
        p, q = t[cut] / a, (t[-1] - t[cut]) / b
        gain = whole - p * (1 - p) * a - q * (1 - q) * b
        k = int(gain.argmax())
        worth = float(gain[k]) * (WEAK if f == x.shape[1] - 1 else 1.0)
        if worth > best[0] + 1e-12:
            best = (worth, f, float(v[cut[k]] + v[cut[k] + 1]) / 2)
    if best[1] is None:
        return (share,)
    low = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def classify(tree: Tree, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0] >= 0.5)
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x), bool)
    out[low] = classify(tree[2], x[low])
    out[~low] = classify(tree[3], x[~low])
    return out


def labelled(examples: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages, by default the examples."""
    xs, ys = [], []
    for page in pages() if examples is None else examples:
        found = blocks(f"<!DOCTYPE html><html><head><title>t</title></head><body>{page}</body></html>")
        ys += [b.text.startswith("+") for b in found]
        xs.append(features(found))
    return np.concatenate(xs), np.array(ys, float)


@lru_cache(1)
def trained() -> Tree:
    return grow(*labelled())


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = classify(tree, features(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract(df: DataFrame, markup: str, *keep: str, tree: Tree | None = None) -> DataFrame:
    """``keep`` columns plus ``text`` and ``n_chars``, one row per page."""
    tree = tree or trained()
    src = df.select(*keep, F.col(markup).alias("_html"))

    def run(batch: pa.RecordBatch):
        for part in slices(batch, batch.num_columns - 1):
            texts = [main_text(h, tree) for h in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*part.schema.names[:-1], "text", "n_chars"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.drop("_html").schema)
    return map_arrow(src, run, f"{kept}, text string, n_chars bigint")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), "html", "page_id", "url")
