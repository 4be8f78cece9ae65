"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every block-level node has features: density of text in its subtree,
links, depth, place among its siblings, and how main or not its tag and
attribute tokens (and those of its ancestors) were in training. Boosted
trees give the log-odds that a node is main text. The decision is taken
per tree of nodes: a node is kept only with its ancestors, and the kept
nodes are those of greatest total log-odds, weighted by text, so that no
descendant is kept from a dropped ancestor.

Training labels come from a bounded sample of the pages (an article or
main element is main text, other sectioning elements are not) and from
random layouts filled with the words of those pages.
"""

from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm import layouts
from tickflow.llm.common import batch, columns, map_arrow
from tickflow.llm.dom import Page, read

#: Pages of the table (about) and layouts to learn from; a page of more characters is not sampled.
SAMPLE, LAYOUTS, SAMPLE_CHARS = 300, 900, 60_000
#: Depth from which nodes are walked one by one, not level by level.
DEEP = 64
TREES, DEPTH, BINS, RATE, LEAST = 50, 4, 32, 0.3, 20
#: Share of a subtree's text that counts for a container besides its own text, and the share of a page from which it is a mere wrapper.
CONTAINER, WRAPPER = 0.1, 0.8
PAGES = 64

_PLAIN_MAIN = frozenset(("article", "main"))
_PLAIN_SIDE = frozenset(("nav", "aside", "footer", "form", "header", "dialog", "menu"))
_SIDE_TOKENS = frozenset(x for names in layouts.SIDE.values() for x in names)


@dataclass
class Trees:
    cuts: list[np.ndarray]
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float


@dataclass
class Model:
    trees: Trees
    tags: dict[str, float]
    tokens: dict[str, float]


class _Nodes:
    """Nodes of several pages as arrays; parents come before children."""

    def __init__(self, pages: list[Page]):
        starts = np.cumsum([0, *(len(p.tags) for p in pages)])
        self.pages, self.starts = pages, starts
        self.page = np.repeat(np.arange(len(pages)), np.diff(starts))
        n = int(starts[-1])
        self.parent = np.concatenate([np.array(p.parents) + s for p, s in zip(pages, starts, strict=False)]) if pages else np.zeros(0, int)
        self.root = np.zeros(n, bool)
        self.root[starts[:-1]] = True
        self.depth = np.zeros(n, int)
        parent, depth = self.parent.tolist(), [0] * n
        for k in range(n):
            if parent[k] != k:
                depth[k] = depth[parent[k]] + 1
        self.depth[:] = depth
        by_depth = np.argsort(self.depth, kind="stable")
        self.levels = np.split(by_depth, np.searchsorted(self.depth[by_depth], np.arange(1, max(depth, default=0) + 1))) if n else []
        self.deep = len(self.levels) > DEEP
        after = list(range(1, n + 1))  # a subtree is a run of nodes
        for k in range(n - 1, -1, -1):
            if parent[k] != k and after[k] > after[parent[k]]:
                after[parent[k]] = after[k]
        self.after = np.array(after, int)
        chars, marks, words = np.zeros(n), np.zeros(n), np.zeros(n)
        for p, s in zip(pages, starts, strict=False):
            for node, text in p.pieces:
                if node >= 0:
                    t = text.strip()
                    if t:
                        chars[s + node] += len(t)
                        words[s + node] += t.count(" ") + 1
                        marks[s + node] += t.count(".") + t.count(",")
        self.chars, self.marks, self.words = chars, marks, words
        self.links = np.concatenate([np.array(p.links, float) for p in pages]) if pages else np.zeros(0)

    def below(self, x: np.ndarray) -> np.ndarray:
        """Sums over subtrees, of whole numbers."""
        total = np.concatenate([[0.0], np.cumsum(x.astype(float))])
        return total[self.after] - total[:-1]

    def above(self, x: np.ndarray, best) -> np.ndarray:
        """``best`` of x over a node and its ancestors."""
        if self.deep:
            pick, values, parent = (min if best is np.minimum else max), x.tolist(), self.parent.tolist()
            for k, p in enumerate(parent):
                values[k] = pick(values[k], values[p])
            return np.array(values, x.dtype)
        out = x.copy()
        for level in self.levels[1:]:
            out[level] = best(out[level], out[self.parent[level]])
        return out

    def scores(self, model_tags: dict[str, float], model_tokens: dict[str, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tag = np.array([model_tags.get(t, 0.0) for p in self.pages for t in p.tags])
        low, high = [], []
        for p in self.pages:
            for tokens in p.tokens:
                own = [model_tokens.get(t, 0.0) for t in tokens]
                low.append(min(own, default=0.0)), high.append(max(own, default=0.0))
        return tag, np.array(low), np.array(high)

    def features(self, tags: dict[str, float], tokens: dict[str, float]) -> np.ndarray:
        tag, low, high = self.scores(tags, tokens)
        n = len(self.parent)
        number = self.below(np.ones(n))
        text, links, words, marks = (self.below(x) for x in (self.chars, self.links, self.words, self.marks))
        whole = np.maximum(text[self.starts[:-1]], 1)[self.page] if n else text
        siblings = np.zeros(n)
        np.add.at(siblings, self.parent[~self.root], 1)
        order = np.zeros(n)
        seen: defaultdict[int, int] = defaultdict(int)
        for k, p in enumerate(self.parent.tolist()):
            order[k] = seen[p]
            seen[p] += 1
        around = siblings[self.parent]
        at = np.arange(n) - self.starts[:-1][self.page] if n else order
        up = lambda x: x[self.parent]
        return np.stack([
            np.log1p(self.chars), np.log1p(text), text / whole, text / number, links / np.maximum(text, 1), self.links / np.maximum(self.chars, 1),
            words / number, marks / np.maximum(words, 1), self.depth, around, order / np.maximum(around, 1), at / np.maximum(number[self.starts[:-1]][self.page], 1),
            np.log1p(up(text)) - np.log1p(text), up(text / number), tag, low, high, self.above(tag, np.minimum), self.above(tag, np.maximum),
            self.above(low, np.minimum), self.above(high, np.maximum)], 1) if n else np.zeros((0, 21))


def _labels(nodes: _Nodes, marked: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is main, has a label) of each node: by its own mark, tag or tokens, else as its parent."""
    label, known, k = np.zeros(len(nodes.parent)), np.zeros(len(nodes.parent), bool), 0
    parent = nodes.parent.tolist()
    for p in nodes.pages:
        for tag, tokens, mark in zip(p.tags, p.tokens, p.marks, strict=True):
            up = label[parent[k]] if parent[k] != k else 0.0
            if marked:
                label[k] = float(mark) if mark else up
            elif tag in _PLAIN_MAIN:
                label[k] = 1.0
            else:
                label[k] = 0.0 if tag in _PLAIN_SIDE or _SIDE_TOKENS.intersection(tokens) else up
            k += 1
    text = nodes.below(nodes.chars)
    main = nodes.below(nodes.chars * label)
    known = text > 0
    # a container is main if most of its text is
    return np.where(nodes.chars > 0, label, main > text / 2).astype(float), known


def _log_odds(seen: dict[str, list[float]]) -> dict[str, float]:
    return {t: float(np.log((yes + 1) / (n - yes + 1))) for t, (n, yes) in seen.items()}


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Gradient boosting with the logistic loss over binned features; complete trees of DEPTH levels."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    feature, cut, value = np.zeros((TREES, inner), int), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves))
    rate = np.clip((weight @ y) / weight.sum(), 0.01, 0.99)
    base = float(np.log(rate / (1 - rate)))
    score = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), int)
        for d in range(DEPTH):
            first, width = (1 << d) - 1, 1 << d
            g0, h0 = np.bincount(node, grad, width), np.bincount(node, hess, width)
            best = np.full(width, 1e-9)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                key, size = node * (BINS + 1) + bins[:, f], width * (BINS + 1)
                g, h, n = (np.bincount(key, w, size).reshape(width, -1).cumsum(1)[:, :len(c)] for w in (grad, hess, np.ones(len(y))))
                total = np.bincount(node, minlength=width)[:, None]
                gain = g**2 / (h + 1) + (g0[:, None] - g)**2 / (h0[:, None] - h + 1) - (g0**2 / (h0 + 1))[:, None]
                gain[(n < LEAST) | (total - n < LEAST)] = -1
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best
                best[better] = gain[np.arange(width), k][better]
                feature[t, first:first + width][better], cut[t, first:first + width][better] = f, c[k[better]]
            node = 2 * node + (x[np.arange(len(y)), feature[t, first + node]] > cut[t, first + node])
        value[t] = RATE * np.bincount(node, grad, leaves) / (np.bincount(node, hess, leaves) + 1)
        score += value[t][node]
    return Trees(cuts, feature, cut, value, base)


def log_odds(trees: Trees, x: np.ndarray) -> np.ndarray:
    score, rows = np.full(len(x), trees.base), np.arange(len(x))
    for feature, cut, value in zip(trees.feature, trees.cut, trees.value, strict=True):
        node = np.zeros(len(x), int)
        for d in range(DEPTH):
            at = (1 << d) - 1 + node
            node = 2 * node + (x[rows, feature[at]] > cut[at])
        score += value[node]
    return score


def train(sample: list[str], seed: int = 0) -> Model:
    """Learn from sampled pages (those with an article or main element) and random layouts."""
    pages = [read(h, _SIDE_TOKENS) for h in sorted(sample)]
    vocab = sorted({w for p in pages for _, t in p.pieces for w in t.split() if 1 < len(w) < 25}) or ["word", "text,", "and.", "of", "the"]
    rng = random.Random(seed)
    real = _Nodes([p for p in pages if _PLAIN_MAIN.intersection(p.tags)])
    made = _Nodes([read(layouts.page(rng, vocab), _SIDE_TOKENS) for _ in range(LAYOUTS)])
    sets = [(n, *_labels(n, marked)) for n, marked in ((real, False), (made, True)) if len(n.pages)]
    by_tag: dict[str, list[float]] = defaultdict(lambda: [0, 0])
    by_token: dict[str, list[float]] = defaultdict(lambda: [0, 0])
    for nodes, y, known in sets:
        k = 0
        for p in nodes.pages:
            for tag, tokens in zip(p.tags, p.tokens, strict=True):
                if known[k]:
                    for seen, names in ((by_tag, (tag,)), (by_token, tokens)):
                        for name in names:
                            seen[name][0] += 1
                            seen[name][1] += y[k]
                k += 1
    tags, tokens = _log_odds(by_tag), _log_odds(by_token)
    x = np.concatenate([n.features(tags, tokens)[known] for n, _, known in sets])
    y = np.concatenate([y[known] for _, y, known in sets])
    return Model(boost(x, y, np.ones(len(y))), tags, tokens)


def fit(pages: DataFrame) -> Model:
    rows = columns(pages, page_id="long", html="string").filter(F.length("html").between(1, SAMPLE_CHARS))
    total = rows.count()
    chosen = rows.filter(F.pmod(F.xxhash64("page_id", F.lit("main text")), F.lit(1 << 30)) < F.lit(min(1.0, SAMPLE / max(1, total)) * (1 << 30)))
    return train([r["html"] for r in chosen.select("html").collect()])


def extract(model: Model, pages: list[Page]) -> list[str]:
    """Main text of each page: blocks in order, one blank between."""
    nodes = _Nodes(pages)
    if not pages:
        return []
    odds = log_odds(model.trees, nodes.features(model.tags, model.tokens))
    text = nodes.below(nodes.chars)
    share = text / np.maximum(text[nodes.starts[:-1]], 1)[nodes.page]
    value = odds * (nodes.chars + CONTAINER * np.where(share < WRAPPER, text - nodes.chars, 0))
    # greatest total over sets of nodes that hold the parent of each member
    if nodes.deep:
        values, parent = value.tolist(), nodes.parent.tolist()
        for k in range(len(parent) - 1, -1, -1):
            if parent[k] != k and values[k] > 0:
                values[parent[k]] += values[k]
        value = np.array(values)
    else:
        for level in reversed(nodes.levels[1:]):
            np.add.at(value, nodes.parent[level], np.maximum(value[level], 0))
    keep = value > 0
    keep[nodes.root] = True
    keep = nodes.above(keep.astype(int), np.minimum) > 0
    out = []
    for p, s in zip(pages, nodes.starts, strict=False):
        kept = keep[s:s + len(p.tags)].tolist()
        if value[s] <= 0 and len(kept) > 1:  # a page without elements is its text
            kept[0] = False
        out.append(" ".join("".join(t for n, t in p.pieces if n < 0 or kept[n]).split()))
    return out


def _run(model: Model):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            html = b.column("html").to_pylist()
            found: list[str] = []
            for at in range(0, len(html), PAGES):
                found += extract(model, [read(h or "", _SIDE_TOKENS) for h in html[at:at + PAGES]])
            yield batch(schema, [b.column("page_id"), b.column("url"), found, [len(t) for t in found]])

    return run


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    The whole html is read, in linear time; null counts as empty and gives an
    empty text, as does a page without main text. A page without an element
    is its text. The model learns from about SAMPLE pages of at most
    SAMPLE_CHARS characters. Unclosed, stray and broken tags are read
    as browsers would, roughly; equal html gives equal text. An empty table
    gives no rows.
    """
    rows = columns(pages, page_id="long", url="string", html="string")
    return map_arrow(rows, _run(model or fit(pages)), "page_id long, url string, text string, n_chars long")
