"""Histogram gradient-boosted trees for a probability, in numpy, flattened for traversal.

Columns are cut into at most `bins` bins at quantiles of the learning rows. A tree grows level by level:
one histogram of gradients and one of curvatures per node, column and bin, from which the best cut of
every node is read by prefix sums. Nodes of all trees then lie in four arrays, so that a batch walks all
trees together, one array step a level, without a branch per row.

Rows have weights and targets between 0 and 1. Equal inputs in equal order give equal trees.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Node k sends a row to `child[k]` if its bin in column `column[k]` is at most `cut[k]`, else to the next node.
    A leaf is its own child. `roots` has the trees' first nodes, `edges` the bin borders of each column."""

    edges: list[np.ndarray]
    column: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin of every value: how many borders lie below it."""
        out = np.empty(x.shape, np.uint8)
        for j, edges in enumerate(self.edges):
            out[:, j] = np.searchsorted(edges, x[:, j], "left")
        return out

    def raw(self, bins: np.ndarray) -> np.ndarray:
        rows = np.arange(len(bins))[:, None]
        node = np.broadcast_to(self.roots, (len(bins), len(self.roots)))
        for _ in range(self.depth):
            node = self.child[node] + (bins[rows, self.column[node]] > self.cut[node])
        return self.start + self.value[node].sum(1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of rows of column values."""
        return 1 / (1 + np.exp(-self.raw(self.bins(x))))


def borders(values: np.ndarray, bins: int) -> np.ndarray:
    """Quantiles that part the values into at most `bins` bins."""
    found = np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower")) if len(values) else np.empty(0)
    return found[found < values.max()] if len(found) else found


def _grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, width: int, ridge: float, least: float) -> list[tuple]:
    """Nodes of one tree, level by level: [column, cut, child, value]; children are neighbours."""
    nodes: list[list] = [[0, 255, 0, 0.0]]
    at = np.zeros(len(bins), np.int64)  # every row's node
    level = [0]
    for d in range(depth + 1):
        first, n = level[0], level[-1] - level[0] + 1
        here = at >= first
        local, gh, hh = at[here] - first, g[here], h[here]
        total_g, total_h = np.bincount(local, gh, n), np.bincount(local, hh, n)
        for k in level:
            nodes[k][2:] = [k, -total_g[k - first] / (total_h[k - first] + ridge)]
        if d == depth:
            break
        best, column, cut = np.zeros(n), np.zeros(n, np.int64), np.full(n, 255)
        base = total_g**2 / (total_h + ridge)
        for j in range(bins.shape[1]):
            slot = local * width + bins[here, j]
            left_g = np.bincount(slot, gh, n * width).reshape(n, width).cumsum(1)
            left_h = np.bincount(slot, hh, n * width).reshape(n, width).cumsum(1)
            right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
            gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - base[:, None]
            gain[(left_h < least) | (right_h < least)] = 0
            b = gain.argmax(1)
            better = gain[np.arange(n), b] > best + 1e-9
            best, column, cut = np.where(better, gain[np.arange(n), b], best), np.where(better, j, column), np.where(better, b, cut)
        split, level = np.flatnonzero(best > 0), []
        for i in split.tolist():
            child = len(nodes)
            nodes[first + i][:3] = [int(column[i]), int(cut[i]), child]
            nodes += [[0, 255, child, 0.0], [0, 255, child + 1, 0.0]]
            level += [child, child + 1]
        if not level:
            break
        child = np.array([node[2] for node in nodes])
        rows = np.flatnonzero(here)[np.isin(local, split)]
        where = at[rows]
        of = np.array([node[:2] for node in nodes])[where]
        at[rows] = child[where] + (bins[rows, of[:, 0]] > of[:, 1])
    return nodes


def fit(
    x: np.ndarray,
    target: np.ndarray,
    weight: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 1.0,
) -> Forest:
    """Boosted trees for the log odds of the target; without rows the probability is one half everywhere."""
    edges = [borders(x[:, j], bins) for j in range(x.shape[1])]
    share = (float(target @ weight) + 0.5) / (float(weight.sum()) + 1.0)  # never 0 or 1
    start = float(np.log(share / (1 - share)))
    forest = Forest(edges, *(np.zeros(0, np.int64),) * 3, np.zeros(0), np.zeros(0, np.int64), depth, start)
    binned = forest.bins(x)
    raw = np.full(len(x), start)
    nodes: list = []
    roots: list[int] = []
    for _ in range(trees if len(x) else 0):
        p = 1 / (1 + np.exp(-raw))
        tree = _grow(binned, (p - target) * weight, p * (1 - p) * weight, depth, bins, ridge, least)
        if len(tree) == 1:
            break
        roots.append(len(nodes))
        nodes += [[c, cut, child + roots[-1], value * rate] for c, cut, child, value in tree]
        one = _forest(edges, nodes[roots[-1] :], [0], depth, 0.0, roots[-1])
        raw += one.raw(binned)
    return _forest(edges, nodes, roots, depth, start)


def _forest(edges: list[np.ndarray], nodes: list, roots: list[int], depth: int, start: float, shift: int = 0) -> Forest:
    columns = list(zip(*nodes)) or [[]] * 4
    column, cut, child = (np.array(c, np.int64) for c in columns[:3])
    return Forest(edges, column, cut, child - shift, np.array(columns[3], float), np.array(roots, np.int64), depth, start)
