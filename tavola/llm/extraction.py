"""Main-text extraction by a tree-structured graphical model over the blocks of a page.

The blocks of a page (its block-level elements) form a tree; each is main text or not. Own
potentials come from what a block is and holds: its element, the words in its class, id and
role, the length of its text and the share of it in links. Potentials of a pair connect a block
to its parent. Messages are passed from the leaves up and from the root down (sum-product), which
gives the exact probability of each block to be main text; blocks of at least one half are
extracted. Potentials of both kinds are trained together in numpy, from labelled pages.

A block's text has its character references decoded, white space turned into single spaces and
its ends trimmed; blocks are joined in page order by a line feed. What a browser would not show
(scripts, styles, the head) and controls are no part of the tree. Missing end tags are implied
as browsers do for paragraphs, list items, table cells and the head. Another hidden element that
is not closed ends with the block that holds it, a control also at the next section; scripts,
styles and what else is raw text run to their own end tag.

Rows: a missing or empty html gives an empty text. Repeated rows are extracted alike, other
columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.llm.labelled_pages import labelled_pages

SCHEMA = "page_id long, url string, text string, n_chars long"

#: Elements by their part in a page (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select textarea button datalist".split()
)
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form fieldset "
    "table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary hgroup".split()
)
#: Start tags that may stand in a head, controls, and what no control may hold.
HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
CONTROL = frozenset("select textarea button datalist".split())
SECTION = frozenset("article main section nav header footer aside".split())
#: A start tag of the key ends an open element of the values, up to the nearest of the stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
SCOPE = frozenset("html body article main section div td th li blockquote table form nav header footer aside".split())
WORD = re.compile("[a-z]+")


@dataclass
class Block:
    tag: str
    parent: int
    names: tuple[str, ...]
    main: bool
    length: int = 0
    linked: int = 0
    children: list[int] = field(default_factory=list)


class _Tree(HTMLParser):
    """Blocks of a page in page order, and pieces of text with the block that they are in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks = [Block("root", -1, (), False)]
        self.pieces: list[tuple[int, str]] = []
        self.open: list[tuple[str, int]] = [("root", 0)]
        self.hidden: list[str] = []
        self.links = 0
        self.text: list[str] = []

    def flush(self) -> None:
        if self.text:
            joined = " ".join("".join(self.text).split())
            if joined:
                self.pieces.append((self.open[-1][1], joined))
            self.text = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.hidden and self.stays_hidden(tag):
            return
        if tag in HIDDEN:
            self.hidden.append(tag)
            return
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr"):
                self.text.append("" if tag == "wbr" else " ")
            return
        if tag not in BLOCK:
            if tag == "a":
                self.links += 1
            self.open.append((tag, self.open[-1][1]))
            return
        self.flush()
        self.end_up_to({"p"}, SCOPE)
        if tag in ENDS:
            self.end_up_to(*ENDS[tag])
        values = dict(attrs)
        told = " ".join(values.get(k) or "" for k in ("class", "id", "role")).lower()
        block = Block(tag, self.open[-1][1], tuple(dict.fromkeys(WORD.findall(told))), "data-main" in values)
        self.blocks[block.parent].children.append(len(self.blocks))
        self.open.append((tag, len(self.blocks)))
        self.blocks.append(block)

    def stays_hidden(self, tag: str) -> bool:
        """Whether a start tag is inside what is hidden, after what it ends has been ended."""
        hidden = self.hidden
        if tag == "body" and all(name != "body" for name, _ in self.open):
            hidden.clear()
        elif tag in SECTION and all(name in CONTROL or name not in HIDDEN for name in hidden):
            hidden.clear()
        elif tag in ("button", "select") and tag in hidden:
            self.unhide(tag)
        if hidden and hidden[-1] == "title":
            hidden.pop()
        if hidden and hidden[-1] == "head" and tag not in HEAD:
            hidden.pop()
        if hidden and tag not in ("html", "head") and (tag in HIDDEN or tag in BLOCK):
            hidden.append(tag)
        return bool(hidden)

    def unhide(self, tag: str) -> None:
        """Close the innermost ``tag`` inside what is hidden."""
        del self.hidden[len(self.hidden) - 1 - self.hidden[::-1].index(tag) :]

    def end_up_to(self, tags: set[str], stops: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of ``tags`` above the nearest of ``stops``."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in tags:
                self.close_from(k)
                return
            if self.open[k][0] in stops:
                return

    def close_from(self, k: int) -> None:
        self.flush()
        self.links -= sum(tag == "a" for tag, _ in self.open[k:])
        del self.open[k:]

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag in self.hidden:
                self.unhide(tag)
                return
            if tag not in BLOCK or all(name != tag for name, _ in self.open):
                return
            self.hidden.clear()
        inline = tag not in BLOCK
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                if inline:
                    self.links -= tag == "a"
                    del self.open[k]
                else:
                    self.close_from(k)
                return
            if inline and self.open[k][0] in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if self.hidden == ["head"] and data.strip():
            self.hidden.clear()
        if self.hidden:
            return
        self.text.append(data)
        size = len(data) - data.count(" ")
        block = self.blocks[self.open[-1][1]]
        block.length += size
        block.linked += size if self.links else 0


def parse(html: str) -> _Tree:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    tree.flush()
    return tree


def _features(tree: _Tree) -> list[list[tuple[str, float]]]:
    """Named features of each block; lengths are those of the text in it and below it."""
    length = [b.length for b in tree.blocks]
    linked = [b.linked for b in tree.blocks]
    for k in range(len(tree.blocks) - 1, 0, -1):
        length[tree.blocks[k].parent] += length[k]
        linked[tree.blocks[k].parent] += linked[k]
    out = []
    for k, block in enumerate(tree.blocks):
        share = linked[k] / length[k] if length[k] else 0.0
        found = [("bias", 1.0), (f"tag={block.tag}", 1.0), ("links", share)]
        found += [("long", min(length[k], 400) / 400), ("own", min(block.length, 400) / 400)]
        found += [(f"name={name}", 1.0) for name in block.names]
        below = [tree.blocks[c].tag for c in block.children]
        found += [("paragraphs", min(below.count("p"), 5) / 5), ("title", float("h1" in below))]
        out.append(found)
    return out


@dataclass(frozen=True)
class Model:
    """Weights of features, and how strongly a block of an element goes with its parent."""

    weights: dict[str, float]
    ties: dict[str, float]


class _Forest:
    """The trees of several pages side by side; messages are passed a level at a time."""

    def __init__(self, trees: list[_Tree]) -> None:
        self.tags = [block.tag for tree in trees for block in tree.blocks]
        sizes = [len(tree.blocks) for tree in trees]
        self.first = np.cumsum([0, *sizes])
        parent, depth = [], []
        for base, tree in zip(self.first.tolist(), trees):
            for block in tree.blocks:
                parent.append(base + block.parent if block.parent >= 0 else -1)
                depth.append(0 if block.parent < 0 else depth[parent[-1]] + 1)
        self.parent, depth = np.array(parent, dtype=np.int64), np.array(depth)
        self.levels = [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)]

    def marginals(self, own: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each block, the probability to be main text and the expected product of its label
        and its parent's (1 or -1). ``own`` is the log odds of a block by itself."""
        n, parent, join = len(own), self.parent, np.logaddexp
        up0, up1, sent0, sent1 = np.zeros(n), own.copy(), np.zeros(n), np.zeros(n)
        for nodes in self.levels[:0:-1]:
            t, u0, u1 = tie[nodes], up0[nodes], up1[nodes]
            sent0[nodes], sent1[nodes] = join(t + u0, u1 - t), join(u0 - t, t + u1)
            np.add.at(up0, parent[nodes], sent0[nodes])
            np.add.at(up1, parent[nodes], sent1[nodes])
        down0, down1, product = np.zeros(n), np.zeros(n), np.zeros(n)
        for nodes in self.levels[1:]:
            t, above = tie[nodes], parent[nodes]
            # what the parent believes without this child's own message
            b0 = up0[above] + down0[above] - sent0[nodes]
            b1 = up1[above] + down1[above] - sent1[nodes]
            down0[nodes], down1[nodes] = join(b0 + t, b1 - t), join(b0 - t, b1 + t)
            alike = join(b0 + up0[nodes], b1 + up1[nodes]) + t
            apart = join(b0 + up1[nodes], b1 + up0[nodes]) - t
            product[nodes] = np.tanh((alike - apart) / 2)
        odds = np.clip(up1 + down1 - up0 - down0, -500, 500)
        return 1 / (1 + np.exp(-odds)), product


def train(pages: list[str], steps: int = 250, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Both kinds of potentials by the likelihood of the labels of whole trees.

    The slope is what the labels show less what the model expects, which the messages give
    exactly; steps are scaled by running means of the slope and its square.
    """
    trees = [parse(page) for page in pages]
    rows = [found for tree in trees for found in _features(tree)]
    y = np.array([block.main for tree in trees for block in tree.blocks], dtype=float)
    forest = _Forest(trees)
    names = sorted({name for found in rows for name, _ in found})
    index = {name: k for k, name in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for k, found in enumerate(rows):
        for name, value in found:
            x[k, index[name]] += value
    kinds = sorted(set(forest.tags))
    kind = np.array([kinds.index(tag) for tag in forest.tags])
    sign, inner = 2 * y - 1, forest.parent >= 0
    shown = np.where(inner, sign * sign[forest.parent], 0.0)
    learnt = np.zeros(len(names) + len(kinds))
    mean, square = np.zeros_like(learnt), np.zeros_like(learnt)
    for step in range(1, steps + 1):
        weights, ties = learnt[: len(names)], learnt[len(names) :]
        likely, product = forest.marginals(x @ weights, ties[kind])
        slope = np.concatenate([x.T @ (y - likely), np.bincount(kind, shown - product, len(kinds))])
        slope = slope / len(pages) - decay * learnt
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        learnt = learnt + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(
        dict(zip(names, learnt[: len(names)].tolist())), dict(zip(kinds, learnt[len(names) :].tolist()))
    )


def main_blocks(trees: list[_Tree], model: Model) -> list[np.ndarray]:
    """For each tree, the probability of each of its blocks to be main text."""
    forest = _Forest(trees)
    own = np.array(
        [
            sum(model.weights.get(name, 0.0) * value for name, value in found)
            for tree in trees
            for found in _features(tree)
        ]
    )
    likely, _ = forest.marginals(own, np.array([model.ties.get(tag, 0.0) for tag in forest.tags]))
    return [likely[a:b] for a, b in zip(forest.first[:-1], forest.first[1:])]


def extract(pages: list[str], model: Model) -> list[str]:
    """The main text of each page."""
    if not pages:
        return []
    trees = [parse(page) for page in pages]
    return [
        "\n".join(text for block, text in tree.pieces if likely[block] >= 0.5)
        for tree, likely in zip(trees, main_blocks(trees, model))
    ]


def extract_pages(pages: DataFrame, training: list[str] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row, with a model trained on ``training``."""
    model = train(training or labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = extract([html or "" for html in batch.column("html").to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, SCHEMA)
