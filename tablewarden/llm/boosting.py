"""Gradient-boosted trees for binary labels: logistic loss, binned features, numpy and Spark.

A level of a tree is chosen from the sums of the gradients in each bin of each feature. They are
whole numbers, so they add up to the same trees however the rows are cut into blocks and whatever
order the blocks come in. ``boost`` has its rows at hand; ``boost_blocks`` adds the sums of blocks
that stay on the executors, one pass for a level of the trees of all labels.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD

BINS = 32
DEPTH = 3
TREES = 40
# Gradients are counted in such parts of one.
PARTS = 1 << 20
# Scores are tallied in such parts of one to choose a threshold.
SCORE_PARTS = 1 << 14


@dataclass
class Trees:
    """Complete trees of one depth: node k has the children 2k+1 and 2k+2."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes; a value above goes right
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        columns = x.T
        inner = self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            total += v[reached(columns, f, c, inner.bit_length()) - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))

    def on(self, edges: Sequence[np.ndarray]) -> Trees:
        """Trees whose cuts are places in ``edges`` as trees over the values themselves."""
        cut = np.full(self.cut.shape, np.inf)
        for t, k in zip(*np.nonzero(np.isfinite(self.cut)), strict=True):
            cut[t, k] = edges[self.feature[t, k]][int(self.cut[t, k])]
        return Trees(self.start, self.feature, cut, self.leaf)


@dataclass
class Block:
    """Distinct rows: ``bins`` features x rows, of each row how many it stands for and how many have each label."""

    bins: np.ndarray
    total: np.ndarray
    hits: np.ndarray  # labels x rows
    held: np.ndarray  # rows kept back


@dataclass
class Label:
    """What the trees of one label learn from; a hit counts ``weight`` times."""

    place: int
    weight: int = 1
    all_rows: bool = False  # also those kept back

    def counts(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Weighted hits and all weights of the rows of a block."""
        hits = block.hits[self.place]
        total = block.total + (self.weight - 1) * hits
        hits = self.weight * hits
        return (hits, total) if self.all_rows else (hits * ~block.held, total * ~block.held)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def reached(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Node of each row after so many levels of one tree."""
    node = np.zeros(columns.shape[1], np.int16)
    for level in range(levels):
        first = (1 << level) - 1
        right = np.zeros(len(node), bool)
        for k in range(first, 2 * first + 1):
            if np.isfinite(cut[k]):
                limit = cut[k] if columns.dtype.kind == "f" else int(cut[k])
                right |= (node == k) & (columns[feature[k]] > limit)
        node = 2 * node + 1 + right
    return node


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Features x rows: how many edges of its feature lie below each value."""
    kind = np.uint8 if max(map(len, edges), default=0) < 256 else np.int32
    return np.stack([np.searchsorted(e, x[:, j], "left").astype(kind) for j, e in enumerate(edges)])


def level_sums(block: Block, labels: Sequence[Label], models: Sequence[Trees], level: int, width: int) -> np.ndarray:
    """Labels x nodes of the level x features x bins x (gradient, second order) of the last tree of each model."""
    nodes = 1 << level
    out = np.zeros((len(labels), nodes, len(block.bins), width, 2), np.int64)
    columns = [b.astype(np.int64) for b in block.bins]
    for label, model, sums in zip(labels, models, out, strict=True):
        hits, total = label.counts(block)
        past = Trees(model.start, model.feature[:-1], model.cut[:-1], model.leaf[:-1])
        p = past.probability(block.bins.T)
        grad, hess = np.rint(PARTS * (total * p - hits)), np.rint(PARTS * total * p * (1 - p))
        place = (reached(block.bins, model.feature[-1], model.cut[-1], level) - (nodes - 1)).astype(np.int64) * width
        for j, column in enumerate(columns):
            cell = place + column
            for i, part in enumerate((grad, hess)):
                sums[:, j, :, i] = np.bincount(cell, part, nodes * width).reshape(nodes, width)
    return out


def grow(
    sums_of: Callable[[list[Trees], int], np.ndarray],
    starts: Sequence[float],
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = 0.3,
    ridge: float = 1.0,
    least: float = 2.0,
) -> list[Trees]:
    """Newton boosting; each split maximises the gain of second order over the bins of all features.

    ``sums_of`` gives the sums of ``level_sums`` over all rows for models whose last tree is being grown.
    """
    inner = (1 << depth) - 1
    models = [Trees(s, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1))) for s in starts]
    for _ in range(trees):
        for m in models:
            m.feature = np.vstack([m.feature, np.zeros((1, inner), np.int64)])
            m.cut = np.vstack([m.cut, np.full((1, inner), np.inf)])
            m.leaf = np.vstack([m.leaf, np.zeros((1, inner + 1))])
        for level in range(depth):
            found = sums_of(models, level) / PARTS
            for m, nodes in zip(models, found, strict=True):
                for k, of_node in enumerate(nodes, (1 << level) - 1):
                    whole = of_node[0].sum(0)
                    left = of_node.cumsum(1)[:, :-1]
                    right = whole - left
                    gain = (left[..., 0] ** 2 / (left[..., 1] + ridge)) + (right[..., 0] ** 2 / (right[..., 1] + ridge))
                    gain = gain - whole[0] ** 2 / (whole[1] + ridge)
                    gain[(left[..., 1] * 4 < least) | (right[..., 1] * 4 < least)] = 0
                    j, at = np.unravel_index(int(gain.argmax()), gain.shape)
                    sides = whole, np.zeros(2)
                    if gain[j, at] > 1e-6:
                        m.feature[-1, k], m.cut[-1, k] = j, at
                        sides = left[j, at], right[j, at]
                    if level == depth - 1:
                        for side, (g, h) in enumerate(sides):
                            m.leaf[-1, 2 * k + 1 + side - inner] = -rate * g / (h + ridge)
    return models


def start_of(hits: float, total: float) -> float:
    share = np.clip(hits / total if total else 0.5, 1e-3, 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Trees for rows at hand; bins lie between the quantiles of each feature."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[:-1])) if n else np.zeros(1) for j in range(width)]
    block = Block(binned(x, edges), np.ones(n, np.int64), y.astype(np.int64)[None], np.zeros(n, bool))
    bins = max(map(len, edges)) + 1
    grown = grow(lambda models, level: level_sums(block, [Label(0)], models, level, bins), [start_of(y.sum(), n)], trees, depth)
    return grown[0].on(edges)


def boost_blocks(
    blocks: RDD, labels: Sequence[Label], starts: Sequence[float], edges: Sequence[np.ndarray], trees: int = TREES
) -> list[Trees]:
    """Trees of each label over all rows of an RDD of ``Block``s that has at least one; cuts are places in ``edges``."""
    bins = max(map(len, edges)) + 1

    def sums_of(models: list[Trees], level: int) -> np.ndarray:
        return blocks.map(lambda b: level_sums(b, labels, models, level, bins)).treeReduce(np.add)

    return grow(sums_of, starts, trees)


def score_tally(blocks: RDD, labels: Sequence[Label], models: Sequence[Trees]) -> np.ndarray:
    """Labels x score in parts of one x (hits, rows) of all rows kept back."""

    def tally(block: Block) -> np.ndarray:
        out = np.zeros((len(labels), SCORE_PARTS + 1, 2), np.int64)
        for label, model, row in zip(labels, models, out, strict=True):
            part = np.floor(model.probability(block.bins.T) * SCORE_PARTS).astype(np.int64)
            for i, counts in enumerate((block.hits[label.place], block.total)):
                row[:, i] = np.bincount(part, counts * block.held, SCORE_PARTS + 1)
        return out

    return blocks.map(tally).treeReduce(np.add)


def threshold(scores: np.ndarray, y: np.ndarray, precision: float, support: int, rows: np.ndarray | None = None) -> float:
    """Least score from which on ``precision`` is reached over at least ``support`` positives, else inf.

    The precision is the one-sided lower estimate (hits) / (n + 1), so few examples never suffice.
    With ``rows`` a score stands for so many rows, ``y`` of them positive.
    """
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(y[order])
    reached = hits / (np.cumsum(np.ones(len(y)) if rows is None else rows[order]) + 1) >= precision
    last = np.append(scores[order][1:] < scores[order][:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero(reached & (hits >= support) & last)
    return float(scores[order][good[-1]]) if len(good) else float("inf")
