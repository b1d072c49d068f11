"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read as a flat list of blocks: runs of text between tags that break lines. Each block has its
number of words, its link density, and those of the blocks before and after it, and what it stands in:
the innermost element that says article or not (by its tag, role, class or id), and its own kind of
tag. A decision tree (Gini splits) trained on a small labelled table of pages decides which blocks are main text.

Text of scripts, styles, the head, comments in the markup and form controls is never a block.

Cases: NULL or empty pages, and those without main text, have the empty text; unclosed tags, comments and
scripts end with the page; repeated rows give repeated results; extra columns are ignored. Pages are
read whole, and no block is dropped for its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most labelled pages that are learnt from.
MAX_PAGES = 2000

_TAG = re.compile(
    r"<!--(?:.*?-->|.*+\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*>|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
#: Elements whose text is not part of the page's text.
SILENT = frozenset("script style head title noscript template textarea select button svg iframe object".split())
#: Elements that stay within a line.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
#: Elements that others are inside of, and that must be closed to end.
HOLDERS = frozenset("article main section div nav header footer aside form ul ol table dl figure body".split())
CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav footer aside form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
CONTENT_WORDS = frozenset("article content main post entry story text".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies "
    "dialog disqus footer form gdpr header login masthead menu modal nav navbar navigation navigational newsletter notice pager "
    "pagination popup promo promoted recommended related replies reply search share sharing sidebar signup social sponsor "
    "sponsored subscribe tags toolbar topbar widget".split())

FEATURES = [
    "words_before", "words", "words_after", "links_before", "links", "links_after", "inside", "in_content", "heading", "item", "paragraph"]


@dataclass
class Block:
    text: str
    words: int
    linked: int
    inside: int  # 1: the innermost telling element says article, -1: it says something else, 0: none does
    in_content: int  # whether any element around says article
    kind: str  # tag that began the block


def _says(name: str, rest: str, in_content: bool) -> int:
    """What an element says of its text: 1 article, -1 something else, 0 nothing."""
    if name in CONTENT_TAGS:
        verdict = 1
    elif name in OTHER_TAGS or (name == "header" and not in_content):
        verdict = -1
    else:
        verdict = 0
    if "=" in rest:
        words = {w for m in _NAMES.findall(rest) for w in _WORDS.findall("".join(m).lower())}
        if words & OTHER_WORDS:
            return -1
        if words & CONTENT_WORDS and verdict == 0:
            return 1
    return verdict


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; a block has at least one word."""
    out: list[Block] = []
    holders: list[tuple[str, int]] = []  # open holders, and what is said inside them
    said: list[int] = [0]
    depth_content = 0
    parts: list[str] = []
    linked = links = 0
    kind = ""
    at = 0

    def flush() -> None:
        nonlocal linked
        words = "".join(parts).split()
        if words:
            out.append(Block(" ".join(words), len(words), min(linked, len(words)), said[-1], int(depth_content > 0), kind))
        parts.clear()
        linked = 0

    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text.split())
        if not m:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in SILENT:
            if not m["end"] and not m["rest"].endswith("/"):
                close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = close.end() if close else len(page)
            if name not in ("button", "svg", "select", "textarea"):
                flush()
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if m["end"] else 1
            elif name in ("br", "img"):
                parts.append(" ")
            continue
        flush()
        links = 0
        if name not in HOLDERS:
            kind = "" if m["end"] else name
            continue
        kind = ""
        if not m["end"]:
            verdict = _says(name, m["rest"], depth_content > 0)
            holders.append((name, verdict))
            said.append(verdict or said[-1])
            depth_content += verdict == 1
        elif any(h[0] == name for h in holders):
            while holders:
                closed, verdict = holders.pop()
                said.pop()
                depth_content -= verdict == 1
                if closed == name:
                    break
    flush()
    return out


def block_features(page: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` for each block."""
    words = np.array([0, *[b.words for b in page], 0], dtype=float)
    links = np.array([0, *[b.linked / b.words for b in page], 0], dtype=float)
    own = np.array([
        [b.inside, b.in_content, b.kind in HEADINGS, b.kind in ("li", "dd", "dt", "td", "th"), b.kind in ("p", "pre", "blockquote")]
        for b in page], dtype=float).reshape(len(page), 5)
    near = [words[:-2], words[1:-1], words[2:], links[:-2], links[1:-1], links[2:]]
    return np.column_stack([*near, own])


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays: feature (-1 at a leaf), border (values up to it go left), children, share of main text."""

    feature: np.ndarray
    border: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(self.feature[node] >= 0)
            if not len(open_):
                return self.share[node]
            n = node[open_]
            low = rows[open_, self.feature[n]] <= self.border[n]
            node[open_] = np.where(low, self.left[n], self.right[n])


def grow(rows: np.ndarray, label: np.ndarray, depth: int = 8, least: int = 8) -> Tree:
    """A tree of Gini splits; no leaf has fewer than ``least`` rows."""
    nodes: list[list[float]] = []

    def add(which: np.ndarray, level: int) -> int:
        me = len(nodes)
        y = label[which]
        nodes.append([-1, 0.0, 0, 0, float(y.mean()) if len(y) else 0.0])
        best = (1e-9, -1, 0.0)
        whole = len(y) * y.mean() * (1 - y.mean()) if len(y) else 0.0
        if level < depth and whole > 0 and len(y) >= 2 * least:
            for f in range(rows.shape[1]):
                order = np.argsort(rows[which, f], kind="stable")
                x, run = rows[which[order], f], np.cumsum(y[order])
                cut = np.flatnonzero(x[1:] > x[:-1]) + 1
                cut = cut[(cut >= least) & (cut <= len(y) - least)]
                if not len(cut):
                    continue
                left, total = run[cut - 1], run[-1]
                right, n = total - left, len(y)
                after = left * (1 - left / cut) + right * (1 - right / (n - cut))
                at = int(np.argmin(after))
                if whole - after[at] > best[0]:
                    best = (whole - after[at], f, (x[cut[at] - 1] + x[cut[at]]) / 2)
        if best[1] >= 0:
            low = rows[which, best[1]] <= best[2]
            a, b = add(which[low], level + 1), add(which[~low], level + 1)
            nodes[me][:4] = [best[1], best[2], a, b]
        return me

    add(np.arange(len(label)), 0)
    feature, border, left, right, share = map(np.array, zip(*nodes))
    return Tree(feature.astype(np.int64), border.astype(float), left.astype(np.int64), right.astype(np.int64), share)


def train(pages: list[tuple[str, str]]) -> Tree:
    """Learn from (html, main text) pairs; a block is main text if it is a line of the main text."""
    rows, label = [], []
    for page, text in pages:
        found, lines = blocks(page), set(text.split("\n"))
        rows.append(block_features(found))
        label += [b.text in lines for b in found]
    if not label:
        return Tree(np.array([-1]), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1))
    return grow(np.concatenate(rows), np.array(label, dtype=float))


def trained(labelled: DataFrame) -> Tree:
    """A tree from a labelled table (``html``, ``text``) of at most ``MAX_PAGES`` rows."""
    rows = labelled.select("html", "text").orderBy("html", "text").limit(MAX_PAGES).toPandas()
    return train(list(zip(rows["html"], rows["text"])))


def examples(spark: SparkSession, pages: int = 400, seed: int = 3) -> DataFrame:
    """The small labelled table: ``html`` and the main ``text``, made by rule in several layouts.

    Layouts with article elements, with telling classes only, and with neither; around the article stand menus,
    headers, footers, side bars, adverts, cookie notices, forms, related links and comments of readers.
    """
    rng = np.random.default_rng(seed)

    def pick(*options):
        return options[int(rng.integers(len(options)))]

    def words(low: int, high: int) -> str:
        return " ".join("".join(map(chr, rng.integers(97, 123, int(rng.integers(2, 10))))) for _ in range(int(rng.integers(low, high + 1))))

    def link(low: int = 1, high: int = 3) -> str:
        return f'<a href="/{words(1, 1)}">{words(low, high)}</a>'

    def links(low: int, high: int) -> str:
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(int(rng.integers(low, high + 1)))) + "</ul>"

    def box(tag: str, name: str, inner: str) -> str:
        return f'<{tag} {pick("class", "id")}="{name}">{inner}</{tag}>'

    def article() -> tuple[str, list[str]]:
        parts, lines = [], []

        def say(tag: str, text: str, shown: str | None = None) -> None:
            parts.append(f"<{tag}>{shown or text}</{tag}>")
            lines.append(text)

        say(pick("h1", "h1", "h2"), words(2, 12))
        for _ in range(int(rng.integers(1, 9))):
            what = rng.random()
            if what < 0.08:
                say("h3", words(1, 8))
            elif what < 0.16:
                for _ in range(int(rng.integers(2, 5))):
                    say("li", words(1, 20))
            elif what < 0.24:
                a, b, c = words(3, 30), words(1, 4), words(3, 30)
                say("p", f"{a} {b} {c}", f'{a} <a href="/x">{b}</a> {c}')
            elif what < 0.3:
                say(pick("blockquote", "pre"), words(4, 30))
            elif what < 0.34:
                parts.append(pick(box("div", "ad", words(3, 14)), f"<aside>{words(4, 25)}</aside>", box("div", "share", link() + link())))
            else:
                say("p", words(1, 8) if rng.random() < 0.25 else words(10, 120))
        return "".join(parts), lines

    rows = []
    for i in range(pages):
        inner, lines = article()
        layout = i % 4
        head = f"<html><head><title>{words(2, 9)}</title><style>p{{}}</style></head><body>"
        extra = [
            box("div", pick("cookie-notice", "cookie-consent", "notice"), f"<p>{words(6, 40)}</p>"), box("div", pick("ad", "advert", "sponsored"), words(3, 30)),
            f"<form><label>{words(1, 4)}</label><input><p>{words(2, 12)}</p></form>", box("div", "newsletter", f"<p>{words(5, 25)}</p>")]
        comments = box(pick("section", "div"), pick("comments", "comment-list"), "".join(
            f"<div><p>{words(4, 60)}</p></div>" for _ in range(int(rng.integers(1, 5)))))
        side = f"<h3>{words(1, 3)}</h3>" + links(2, 6) + f"<p>{words(3, 25)}</p>"
        end = f"&copy; {words(1, 3)} &middot; {words(3, 15)}"
        if layout in (0, 1):
            tag = pick("article", "article", "main")
            page = (f"{pick('', '<header>' + words(1, 8) + '</header>')}<nav>{links(3, 8)}</nav>{pick('', *extra)}<{tag}>{inner}"
                    f"{pick('', '', comments)}</{tag}>{pick('', comments)}{pick('', '<aside>' + side + '</aside>')}{pick('', *extra)}<footer>{end}</footer>")
        elif layout == 2:
            page = (box("div", pick("header", "topbar"), words(1, 8)) + box("div", pick("menu", "nav"), links(3, 8)) + pick("", *extra)
                    + box("div", pick("content", "post-body", "entry-content", "article"), inner) + pick("", comments)
                    + box("div", pick("sidebar", "related"), side) + box("div", "footer", end))
        else:
            page = f"<div>{' | '.join(link() for _ in range(6))}</div><div>{inner}</div><div>{' '.join(link(2, 6) for _ in range(5))}</div><div>{words(2, 6)} {link()} {link()}</div>"
        rows.append((head + page + pick("</body></html>", ""), "\n".join(lines)))
    return spark.createDataFrame(rows, "html string, text string")


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """The main text of each page: its blocks in order, one to a line."""
    found = [blocks(p) for p in pages]
    if not any(found):
        return [""] * len(pages)
    main = tree(np.concatenate([block_features(f) for f in found])) >= 0.5
    ends = np.cumsum([len(f) for f in found])
    return ["\n".join(b.text for b, keep in zip(f, main[e - len(f) : e]) if keep) for f, e in zip(found, ends)]


def extracted(pages: DataFrame, tree: Tree) -> DataFrame:
    """``pages`` with ``text``: the main text of ``html``, in place of any column of that name."""
    sent = pages.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("string")
    def main(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for at in range(0, len(batch), 200):
                out += main_texts([p or "" for p in batch.iloc[at : at + 200]], sent.value)
            yield pd.Series(out, dtype="object")

    return pages.withColumn("text", main("html"))
