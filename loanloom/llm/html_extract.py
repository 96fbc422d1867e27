"""Main text of web pages by a tree-structured graphical model.

A page becomes the tree of its block elements. Every node has a hidden state, content or not, with a unary potential
from its tag, class and id words, amount of text and share of links, and a potential with its parent. Sum-product
messages go up from the leaves and down again, level by level over many pages at once, and give each node's
marginal. Blocks of nodes that are more likely content than not are the main text.

The potentials are counts from labelled pages: pages that mark their own parts with the elements of ``INSIDE`` and
``OUTSIDE`` label their nodes. At most ``train_pages`` of them, by hash, are counted, on top of prior counts.

Defined cases: null and empty pages give an empty text; unclosed and stray tags are repaired; repeated rows are
separate pages; other columns are ignored; with no labelled page the prior potentials stand alone.
"""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dense_sums import per_partition

# Names of HTML elements and usual class words.
INSIDE = ["article", "main"]
OUTSIDE = ["nav", "header", "footer", "aside", "form", "menu", "dialog"]
INLINE = ["a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
CLOSES_ITSELF = {"li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr", "td", "th"], "td": ["td", "th"], "th": ["td", "th"], "option": ["option"]}
BAD_WORDS = ["nav", "navbar", "navigation", "menu", "header", "masthead", "footer", "sidebar", "aside", "ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "notice", "gdpr", "popup", "modal", "overlay", "related", "recommended", "share", "social", "comment", "comments", "disqus", "reply", "replies", "form", "login", "signup", "subscribe", "newsletter", "search", "breadcrumb", "breadcrumbs", "pagination", "pager", "copyright", "legal", "widget", "toolbar", "tags", "skip"]
GOOD_WORDS = ["article", "content", "post", "entry", "main", "story", "body", "text", "prose"]
TAGS = ["#root", "html", "body", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "section", "blockquote", "pre", "figure", "figcaption", "address", "button", *INSIDE, *OUTSIDE]
#: Elements whose inside is no markup, up to their own end tag, and elements skipped with all that they hold.
_RAW = "script|style|title|textarea"
SKIPPED = ["head", "template", "object", "svg", "select", "canvas", "noscript", "iframe"]
#: Elements that may stand in a head; any other start tag ends it.
IN_HEAD = ["base", "link", "meta", "noscript", "script", "style", "template", "title"]
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>(?:{_RAW})(?=[\s/>]))[^>]*>(?<!/>).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*>|<[!?/][^>]*>",
    re.S | re.I,
)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_INLINE, _VOID, _BAD, _GOOD = set(INLINE), set(VOID), set(BAD_WORDS), set(GOOD_WORDS)
_SKIPPED, _IN_HEAD = set(SKIPPED), set(IN_HEAD)
_TAG = {t: k for k, t in enumerate(TAGS)}
_N_TAGS = len(TAGS) + 1
#: Sizes of the unary features: tag, class words, text, links.
_FEATURES = (_N_TAGS, 3, 6, 4)
_OFFSETS = np.concatenate(([0], np.cumsum(_FEATURES)))


@dataclass
class Page:
    tag: list[int]
    parent: list[int]
    mark: list[int]  # 0 none, 1 usual for content, 2 usual for the rest
    blocks: list[tuple[int, str]]  # node and text, in page order
    links: list[int]  # characters in links, by node
    label: list[int]  # 1 inside, 0 outside, -1 unknown


def parse(page: str | None) -> Page:
    """Block elements and their texts."""
    out = Page([0], [-1], [0], [], [0], [-1])
    stack, names = [0], ["#root"]
    buffer: list[str] = []
    skipped: list[str] = []  # open elements of a skipped subtree, from its root
    text, link = page or "", 0

    def flush() -> None:
        block = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if block:
            out.blocks.append((stack[-1], block))

    def add(part: str) -> None:
        buffer.append(part)
        if link:
            out.links[stack[-1]] += len(part)

    def close(depth: int) -> None:
        del stack[depth:], names[depth:]

    def text_or_skip(part: str) -> None:
        if skipped == ["head"] and part.strip():
            skipped.clear()  # text ends a head
        if not skipped:
            add(part)

    def skips(tag: str, end: bool, closed: bool) -> bool:
        """Whether a tag belongs to the skipped subtree; what cannot stand in it ends it."""
        if end:
            if tag in skipped:
                del skipped[len(skipped) - 1 - skipped[::-1].index(tag) :]
                return True
            if tag in names:  # the end of an element around it
                skipped.clear()
                return False
            return True
        if tag == "body" or skipped == ["head"] and tag not in _IN_HEAD:
            skipped.clear()
            return False
        if tag in _SKIPPED and not closed:
            skipped.append(tag)
        return True

    at = 0
    for m in _TOKEN.finditer(text):
        if m.start() > at:
            text_or_skip(text[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if skipped and skips(tag, bool(m["end"]), m["rest"].endswith("/")):
            continue
        if tag in _SKIPPED and not m["end"]:
            flush()
            if not m["rest"].endswith("/"):
                skipped.append(tag)
            continue
        if tag in _INLINE:
            if tag == "a":
                link = 0 if m["end"] else 1
            elif tag == "br":
                buffer.append("\n")
            continue
        flush()
        if m["end"]:
            if tag in names:
                close(len(names) - 1 - names[::-1].index(tag))
            continue
        for other in CLOSES_ITSELF.get(tag, ()):
            if names[-1] == other or len(names) > 1 and names[-1] == "p" and names[-2] == other:
                close(len(names) - 1 - names[::-1].index(other))
        if names[-1] == "p":
            close(len(names) - 1)
        parent = stack[-1]
        node = len(out.tag)
        marks = {w for groups in _MARKS.findall(m["rest"]) for g in groups for w in re.split(r"[^a-z0-9]+", g.lower())} if "=" in m["rest"] else ()
        out.tag.append(_TAG.get(tag, _N_TAGS - 1))
        out.parent.append(parent)
        out.mark.append(2 if _BAD.intersection(marks) else 1 if _GOOD.intersection(marks) else 0)
        out.links.append(0)
        bad = tag in OUTSIDE or out.mark[-1] == 2
        out.label.append(0 if bad or out.label[parent] == 0 else 1 if tag in INSIDE or out.label[parent] == 1 else -1)
        if tag not in _VOID and not m["rest"].endswith("/"):
            stack.append(node)
            names.append(tag)
    if at < len(text):
        text_or_skip(text[at:])
    flush()
    return out


def _features(page: Page) -> np.ndarray:
    """The four features of each node."""
    n = len(page.tag)
    size = np.zeros(n, np.int64)
    for node, block in page.blocks:
        size[node] += len(block)
    links = np.array(page.links)
    amount = np.digitize(size, (1, 20, 60, 200, 600))
    share = np.where(size > 0, np.digitize(links / np.maximum(size, 1), (0.01, 0.3, 0.7)), 0)
    return np.column_stack((page.tag, page.mark, amount, share)) + _OFFSETS[:-1]


@dataclass
class Potentials:
    unary: np.ndarray  # log-likelihood of each feature's value, by state
    pair: np.ndarray  # log probability of a child's state, by the parent's

    @staticmethod
    def from_counts(features: np.ndarray, pairs: np.ndarray) -> Potentials:
        """Counts by (value, state) and (parent's state, child's state), on top of the prior's."""
        prior = np.full((int(_OFFSETS[-1]), 2), 1.0)
        for tags, state in ((INSIDE, 1), (OUTSIDE, 0)):
            prior[[_TAG[t] for t in tags], state] += 40
            prior[[_TAG[t] for t in tags], 1 - state] = 0.05
        prior[_TAG["p"], 1] += 5
        prior[_OFFSETS[1] + 1, 1] += 10
        prior[_OFFSETS[1] + 2] = (40, 0.05)
        prior[_OFFSETS[1], :] += 40
        prior[_OFFSETS[2] + 4 : _OFFSETS[3], 1] += 5
        prior[_OFFSETS[3] + 2 : _OFFSETS[4], 0] += 5
        total = features + prior
        unary = np.empty_like(total)
        for a, b in zip(_OFFSETS, _OFFSETS[1:]):
            unary[a:b] = np.log(total[a:b] / total[a:b].sum(0))
        pair = pairs + np.array([[20.0, 2.0], [3.0, 20.0]])
        return Potentials(unary, np.log(pair / pair.sum(1, keepdims=True)))


def marginals(unary: np.ndarray, pair: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """P(content) of all nodes of a forest by sum-product messages; parents come before their children (-1: root)."""
    n = len(parent)
    depth = np.zeros(n, np.int64)
    for k in range(n):
        if parent[k] >= 0:
            depth[k] = depth[parent[k]] + 1
    order = np.argsort(depth, kind="stable")
    bounds = np.searchsorted(depth[order], np.arange(int(depth.max(initial=0)) + 2))
    levels = [order[a:b] for a, b in zip(bounds, bounds[1:])]
    inside, up = unary.copy(), np.zeros((n, 2))
    for level in levels[:0:-1]:
        up[level] = np.logaddexp(pair[:, 0] + inside[level, :1], pair[:, 1] + inside[level, 1:])
        np.add.at(inside, parent[level], up[level])
    down = np.zeros((n, 2))
    for level in levels[1:]:
        rest = down[parent[level]] + inside[parent[level]] - up[level]
        down[level] = np.logaddexp(rest[:, :1] + pair[0], rest[:, 1:] + pair[1])
        down[level] -= down[level].max(1, keepdims=True)
    both = inside + down
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))


def learn(pages: DataFrame, *, html_col: str = "html", train_pages: int = 4000) -> Potentials:
    """Potentials from at most about ``train_pages`` pages, chosen by hash."""
    rows = pages.select(F.col(html_col).cast("string").alias("html")).dropna()
    count = rows.count()
    share = min(1.0, train_pages / max(1, count))
    sample = rows.filter(F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else rows

    def add(batch: pa.RecordBatch, arrays: list[np.ndarray]) -> None:
        for text in batch.column(0).to_pylist():
            page = parse(text)
            label, parent = np.array(page.label), np.array(page.parent)
            if not (label == 1).any():
                continue
            label = np.where(label < 0, 0, label)  # what a labelled page leaves unmarked is not its article
            for column in _features(page).T:
                np.add.at(arrays[0], (column, label), 1)
            np.add.at(arrays[1], (label[parent[1:]], label[1:]), 1)

    return Potentials.from_counts(*per_partition(sample, add, [(int(_OFFSETS[-1]), 2), (2, 2)]))


def extract(pages: DataFrame, potentials: Potentials, *, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",), least: float = 0.5) -> DataFrame:
    """Per page: id, the columns ``keep``, ``text`` and ``blocks`` (text and content marginal of every block)."""
    columns = [id_col, *keep]
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                parsed = [parse(t) for t in part.column(len(columns)).to_pylist()]
                starts = np.cumsum([0, *(len(p.tag) for p in parsed)])
                parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + s) for p, s in zip(parsed, starts)])
                unary = potentials.unary[np.concatenate([_features(p) for p in parsed])].sum(1)
                content = marginals(unary, potentials.pair, parent)
                texts, blocks = [], []
                for p, s in zip(parsed, starts):
                    scored = [(b, float(content[s + node])) for node, b in p.blocks]
                    texts.append("\n".join(b for b, c in scored if c > least))
                    blocks.append([{"text": b, "content": c} for b, c in scored])
                kind = pa.list_(pa.struct([("text", pa.string()), ("content", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(columns)], pa.array(texts, pa.string()), pa.array(blocks, kind)], names=[*columns, "text", "blocks"])

    source = pages.select(*columns, F.col(html_col).cast("string").alias("_html"))
    return source.mapInArrow(run, f"{kinds}, text string, blocks array<struct<text: string, content: double>>")
