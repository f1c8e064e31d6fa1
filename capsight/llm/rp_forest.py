"""Random-projection trees over vectors: building, routing with spill, and best-first search over many trees.

A tree is four arrays: ``normal`` (one row per inner node), ``low``/``high`` (the split with its overlap) and ``child`` (two per
inner node; ``-1 - leaf`` for leaves).  Splits are at the median of the projections on the difference of two random
rows, or on a Gaussian direction where the two are equal; with ``spill`` the rows around the median go both ways.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Tree:
    normal: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    leaves: int
    whole: list[int] = field(default_factory=list)  # leaves that ``divide`` keeps whole

    def dump(self) -> bytes:
        return pickle.dumps((self.normal, self.low, self.high, self.child, self.leaves, self.whole))

    @staticmethod
    def load(data: bytes) -> "Tree":
        return Tree(*pickle.loads(data))


def build(rows: np.ndarray, leaf: int, seed: list[int], spill: float = 0.0, divide: Callable | None = None) -> Tree:
    """A tree whose leaves hold at most ``leaf`` of ``rows``, or rows that no split separates.

    ``divide``, asked first, gives a node's rows a split of its own (``normal, low, high``), keeps them ``"whole"`` or leaves them (None).
    """
    rng = np.random.Generator(np.random.PCG64([abs(int(s)) for s in seed]))
    normal, low, high, child, leaves, whole = [], [], [], [], 0, []
    todo = [(np.arange(len(rows)), -1, 0)]
    while todo:
        some, parent, side = todo.pop()
        split = own = None
        if len(some) > leaf:
            own = divide(rows[some]) if divide else None
            if own is not None and own != "whole":
                at = rows[some] @ own[0]
                split = *own, some[at < own[2]], some[at >= own[1]]
        if len(some) > leaf and own is None:
            for _ in range(3):
                a, b = rows[rng.choice(some, 2, replace=False)]
                way = a - b
                if not way.any():
                    way = rng.normal(size=rows.shape[1])
                way = way / np.linalg.norm(way)
                at = rows[some] @ way
                lo, hi = np.quantile(at, [0.5 - spill / 2, 0.5 + spill / 2])
                left, right = at < hi, at >= lo
                if 0 < left.sum() < len(some) * 0.95 and 0 < right.sum() < len(some) * 0.95:
                    split = way, lo, hi, some[left], some[right]
                    break
        if split is None:
            node = -1 - leaves
            if own is not None:
                whole.append(leaves)
            leaves += 1
        else:
            node = len(normal)
            normal.append(split[0])
            low.append(split[1])
            high.append(split[2])
            child.append([0, 0])
            todo += [(split[4], node, 1), (split[3], node, 0)]
        if parent >= 0:
            child[parent][side] = node
    width = rows.shape[1] if rows.ndim == 2 else 0
    return Tree(np.array(normal, dtype=np.float64).reshape(len(normal), width), np.array(low, dtype=np.float64), np.array(high, dtype=np.float64),
                np.array(child, dtype=np.int64).reshape(len(child), 2), leaves, whole)


def route(tree: Tree, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, leaf)`` of every row, several leaves for rows in an overlap."""
    if not len(tree.normal):
        return np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64)
    out_row, out_leaf = [], []
    todo = [(0, np.arange(len(rows)))]
    while todo:
        node, some = todo.pop()
        if node < 0:
            out_row.append(some)
            out_leaf.append(np.full(len(some), -1 - node))
        elif len(some):
            at = rows[some] @ tree.normal[node]
            todo += [(int(tree.child[node, 0]), some[at < tree.high[node]]), (int(tree.child[node, 1]), some[at >= tree.low[node]])]
    return np.concatenate(out_row), np.concatenate(out_leaf)


def search(trees: list[Tree], counts: list[np.ndarray], query: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """``(tree, leaf)`` in the order of one priority queue over all trees, until their rows reach ``wanted``.

    A branch's priority is the least margin on its way: how far the query lies on the branch's side of the worst split.
    """
    margins = [t.normal @ query - t.high if len(t.normal) else np.zeros(0) for t in trees]
    heap = [(-np.inf, t, 0 if len(trees[t].normal) else -1) for t in range(len(trees))]
    heapq.heapify(heap)
    found, rows = [], 0
    while heap and rows < wanted:
        key, t, node = heapq.heappop(heap)
        child, margin = trees[t].child, margins[t]
        while node >= 0:
            m = margin[node]
            near = 1 if m >= 0 else 0
            heapq.heappush(heap, (max(key, abs(m)), t, int(child[node, 1 - near])))
            node = int(child[node, near])
        found.append((t, -1 - node))
        rows += counts[t][-1 - node]
    return found


def usable(v: Column, width: int) -> Column:
    """Vectors that take part: of the table's width, finite, without nulls and not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) == width) & ~bad & F.exists(v, lambda x: x != 0)


def common_width(rows: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors (ties: the largest); 0 for none."""
    sizes = rows.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("w")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    return top[0]["w"] if top else 0


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows (none of them zero) scaled to length 1."""
    rows = rows / np.abs(rows).max(1, initial=0, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def lengths(rows: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows whose squares may overflow or vanish."""
    with np.errstate(over="ignore"):
        plain = np.sqrt((rows * rows).sum(1))
    odd = ~((plain > 1e-150) & (plain < 1e150))
    if odd.any():
        size = np.abs(rows[odd]).max(1)
        plain[odd] = np.sqrt(((rows[odd] / np.where(size > 0, size, 1)[:, None]) ** 2).sum(1)) * size
    return plain


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """List column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
