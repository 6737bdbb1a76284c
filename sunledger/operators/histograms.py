"""Regression trees grown from histograms of binned features, in numpy: what tasks and driver of `boosting` compute.

A block of rows holds its features as bins, two of them in a number, and what is left of the label. A tree is grown level
by level. All that a level asks of the rows is one histogram for each feature of each node; how those are gathered is
left to the caller. Thresholds, gain, draws of rows and of features follow Spark ML's trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np

# Rows of a block: its temporary arrays stay small, and a histogram is small against it.
BLOCK_ROWS = 1 << 18
# Rows that thresholds are taken from at least, as in Spark ML.
THRESHOLD_ROWS = 10_000


@dataclass(frozen=True)
class Growth:
    """How a tree is grown. `seed` is that of the tree."""

    depth: int
    bins: int
    features: int
    row_sample: float
    features_per_node: int
    seed: int


@dataclass
class Tree:
    """A tree of full depth in heap order. A node without split sends all its rows on to its left child."""

    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray  # negative: no split
    stats: np.ndarray  # of each node: rows, sum and sum of squares

    def values(self) -> np.ndarray:
        """What the nodes below the last level predict."""
        means = self.stats[:, 1] / np.maximum(self.stats[:, 0], 1)
        for node in range(len(self.feature)):  # parents come first: a leaf's value is handed down
            if self.gain[node] < 0:
                means[2 * node + 1 : 2 * node + 3] = means[node]
        return means[len(self.feature) :]

    def settle(self, squares: np.ndarray) -> None:
        """Adds the sums of squares, given below the last level."""
        self.stats[len(self.feature) :, 2] = squares
        for node in reversed(range(len(self.feature))):
            self.stats[node, 2] = self.stats[2 * node + 1 : 2 * node + 3, 2].sum()


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts of one feature: halfway between its distinct values if they are few, else about equally many rows apart."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) <= bins:
        return (distinct[:-1] + distinct[1:]) / 2
    stride, cuts, seen, target = len(values) / bins, [], counts[0], len(values) / bins
    for i in range(1, len(distinct)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            cuts.append((distinct[i - 1] + distinct[i]) / 2)
            target += stride
    return np.array(cuts)


def packed(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray], bins: int) -> np.ndarray:
    """Bins of the features, a row for each two of them. A value's bin is the number of cuts below it."""
    codes = [np.searchsorted(c, x).astype(np.uint16) for c, x in zip(cuts, columns)]
    codes += [np.zeros_like(codes[0])] * (len(codes) % 2)
    return np.stack([high * np.uint16(bins) + low for high, low in zip(codes[::2], codes[1::2])])


def _steps(tree: Tree, growth: Growth) -> tuple[np.ndarray, np.ndarray]:
    """For each node: the row of `codes` it reads, and whether a number there goes right."""
    number = np.arange(growth.bins**2)
    both = np.stack([number // growth.bins, number % growth.bins])
    right = (both[tree.feature % 2] > tree.bin[:, None]) & (tree.gain >= 0)[:, None]
    return tree.feature // 2, right.astype(np.uint8).ravel()


def placed(codes: np.ndarray, tree: Tree, growth: Growth, levels: int, at: np.ndarray | None = None, first: int = 0) -> np.ndarray:
    """The node of each row, counted within its level, after `levels` levels; `at`: after `first` of them."""
    n = codes.shape[1]
    at = np.zeros(n, np.int64) if at is None else at
    if levels == first:
        return at
    reads, right = _steps(tree, growth)
    flat, rows = codes.ravel(), np.arange(n)
    for level in range(first, levels):
        node = at + ((1 << level) - 1)
        number = flat.take(reads.take(node) * n + rows)
        at = 2 * at + right.take(node * growth.bins**2 + number)
    return at


def drawn(n: int, growth: Growth, place: tuple[int, int]) -> np.ndarray | None:
    """The rows of a block that a tree sees: each with the same chance, told by the tree's seed and the block's place."""
    if growth.row_sample >= 1:
        return None
    return np.flatnonzero(np.random.default_rng([growth.seed, *place]).random(n, np.float32) < growth.row_sample)


def histogram(codes: np.ndarray, label: np.ndarray, at: np.ndarray, level: int, wanted: Sequence[int], growth: Growth) -> np.ndarray:
    """(rows, sum) by node, feature and bin, for the wanted nodes of a level; `at` is each row's node there."""
    bins, nodes = growth.bins, len(wanted)
    out = np.zeros((2, nodes, growth.features, bins))
    if level == 0:
        start, kept = np.zeros(len(label), np.int64), None
    else:
        slots = np.full(1 << level, -1)
        slots[wanted] = np.arange(nodes)
        slot = slots.take(at)
        kept = np.flatnonzero(slot >= 0)
        start, label = slot.take(kept) * bins**2, label.take(kept)
    index = np.empty_like(start)
    for pair, numbers in enumerate(codes):
        np.add(start, numbers if kept is None else numbers.take(kept), out=index)
        for k, weight in enumerate((None, label)):
            both = np.bincount(index, weight, nodes * bins**2).reshape(nodes, bins, bins)
            out[k, :, 2 * pair] = both.sum(2)
            if 2 * pair + 1 < growth.features:
                out[k, :, 2 * pair + 1] = both.sum(1)
    return out


def grow(growth: Growth, gathered: Callable[[Tree, int, list[int]], np.ndarray]) -> Tree:
    """A tree without its sums of squares. `gathered(tree, level, wanted)` is the histogram over all rows for some nodes of
    a level, given the levels above; of two children it is asked for the one with fewer rows, the other is the rest."""
    inner = (1 << growth.depth) - 1
    tree = Tree(np.zeros(inner, np.int64), np.zeros(inner, np.int64), np.full(inner, -1.0), np.zeros((2 * inner + 1, 3)))
    above: dict[int, np.ndarray] = {}
    noise = 0.0
    for level in range(growth.depth):
        first = (1 << level) - 1
        wanted = [0] if level == 0 else sorted(min(2 * k + 1, 2 * k + 2, key=lambda c: tree.stats[c, 0]) - first for k in above)
        if not wanted:
            break
        found = dict(zip((first + k for k in wanted), gathered(tree, level, wanted).swapaxes(0, 1)))
        if level == 0:
            noise = 1e-12 * np.abs(found[0][1]).sum(1).max()  # what sums may owe to rounding
            tree.stats[0, :2] = found[0][:, 0].sum(1)
        for node in list(found) if level else ():
            found[node - 1 if node % 2 == 0 else node + 1] = above[(node - 1) // 2] - found[node]
        above = {node: histograms for node, histograms in found.items() if _split(tree, node, histograms, growth, noise)}
        for node in above:
            left = found[node][:, tree.feature[node], : tree.bin[node] + 1].sum(1)
            tree.stats[2 * node + 1, :2], tree.stats[2 * node + 2, :2] = left, tree.stats[node, :2] - left
    return tree


def _split(tree: Tree, node: int, found: np.ndarray, growth: Growth, noise: float) -> bool:
    """Gives the node the split that lowers the variance most, of the features drawn for it, if any lowers it."""
    (n, total, _), bins = tree.stats[node], growth.bins
    rows, sums = found.cumsum(2)[:, :, : bins - 1]
    other = n - rows
    off = sums - rows * (total / max(n, 1))  # around the mean; the right side's is the negative
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = off * off * (1 / rows + 1 / other) / n
    gain[(rows < 0.5) | (other < 0.5) | (np.abs(off) <= noise)] = 0
    if growth.features_per_node < growth.features:
        left_out = np.random.default_rng([growth.seed, node, 1]).permutation(growth.features)[growth.features_per_node :]
        gain[left_out] = 0
    best = int(gain.argmax())
    if not gain.flat[best] > 0:
        return False
    tree.feature[node], tree.bin[node] = divmod(best, bins - 1)
    tree.gain[node] = gain.flat[best]
    return True


@dataclass
class Block:
    """Rows that a task holds: their place, numbers and what is left of the label."""

    place: tuple[int, int]
    codes: np.ndarray
    left: np.ndarray


def seen(block: Block, growth: Growth, round_: int) -> tuple[np.ndarray | None, np.ndarray]:
    """The rows of a block that a round's tree sees (None: all), and what it is fitted to: the label first, then the negative
    gradient of the squared loss."""
    rows, label = drawn(len(block.left), growth, block.place), block.left if round_ == 0 else 2 * block.left
    return rows, label if rows is None else label.take(rows)


def explain(block: Block, tree: Tree, growth: Growth, weight: float, round_: int) -> np.ndarray:
    """Takes the tree's prediction off what is left; returns the sum of squares of what the tree was fitted to, by leaf."""
    at = placed(block.codes, tree, growth, growth.depth)
    rows, label = seen(block, growth, round_)
    squares = np.bincount(at if rows is None else at.take(rows), label * label, 1 << growth.depth)
    block.left = block.left - weight * tree.values().take(at)
    return squares


def boosted(blocks: Sequence[Block], growths: Sequence[Growth], weights: Sequence[float]) -> Iterator[Tree]:
    """Trees one after another over rows that are all here; the blocks are left with what no tree explains."""
    for round_, (growth, weight) in enumerate(zip(growths, weights)):
        parts = []
        for block in blocks:
            rows, label = seen(block, growth, round_)
            parts.append((block.codes if rows is None else block.codes.take(rows, 1), label))
        at: list[np.ndarray | None] = [None] * len(parts)

        def gathered(tree: Tree, level: int, wanted: list[int]) -> np.ndarray:
            total = 0
            for i, (codes, label) in enumerate(parts):
                at[i] = placed(codes, tree, growth, level, at[i], max(level - 1, 0))
                total = total + histogram(codes, label, at[i], level, wanted, growth)
            return total

        tree = grow(growth, gathered)
        tree.settle(sum(explain(block, tree, growth, weight, round_) for block in blocks))
        yield tree


def judged(block: Block, trees: Sequence[Tree], growth: Growth, weights: Sequence[float]) -> np.ndarray:
    """The sum of absolute errors after each tree; the block is left with what no tree explains."""
    errors = np.zeros(len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        block.left = block.left - weight * tree.values().take(placed(block.codes, tree, growth, growth.depth))
        errors[i] = np.abs(block.left).sum()
    return errors
