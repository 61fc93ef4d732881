"""Exact nearest entries of a small table by a geometric near-neighbour access tree.

A node holds a few entries as split points. Every other entry of the node belongs
to its nearest split point, and each split point keeps, for every split point's
subtree, the least and greatest distance to what is in it. Once a query's distance
to one split point is known, a subtree whose range cannot hold anything as near as
the best so far is left out whole.

Distances are whole: squares are compared, and roots are only taken of them to test
ranges, rounded so that a range is never too narrow. A subtree goes only if its
bound is strictly farther than the best, so entries at the same distance are all
met, and among them the lowest index wins. Numbers are 64-bit where no square can
overflow and Python's own beyond that.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

ARITY = 4
#: Sums of squares stay below this in 64-bit arithmetic.
ROOM = 1 << 62


def whole_numbers(values: np.ndarray, most: int) -> np.ndarray:
    """64-bit numbers if all are at most `most` in size, else Python's own."""
    if values.dtype == object and all(abs(v) <= most for v in values.flat):
        return values.astype("int64")
    if values.dtype != object and len(values) and values.size and np.abs(values).max() > most:
        return values.astype(object)
    return values


def largest_square_root(length: int) -> int:
    """Components up to this size have squared distances below `ROOM`."""
    return math.isqrt(ROOM // max(length, 1)) // 2


def floor_roots(squares: np.ndarray) -> np.ndarray:
    """Integer square roots, rounded down."""
    if squares.dtype == object:
        return np.array([math.isqrt(int(v)) for v in squares], dtype=object)
    roots = np.sqrt(squares.astype("float64")).astype("int64")
    roots -= roots * roots > squares
    return roots + ((roots + 1) * (roots + 1) <= squares)


def ceil_roots(squares: np.ndarray) -> np.ndarray:
    roots = floor_roots(squares)
    return roots + (roots * roots < squares)


def squared(queries: np.ndarray, point: np.ndarray) -> np.ndarray:
    apart = queries - point
    return (apart * apart).sum(1) if apart.shape[1] else np.zeros(len(apart), dtype=queries.dtype)


@dataclass
class Node:
    splits: list[int]
    least: np.ndarray  # [i, j]: no entry under j is nearer to split i
    most: np.ndarray  # [i, j]: none is farther
    children: list[Node | None] = field(default_factory=list)


class Gnat:
    """The entries (one a row) as a tree; `nearest` answers many queries at once."""

    def __init__(self, entries: np.ndarray, arity: int = ARITY) -> None:
        self.entries = entries
        self.arity = max(arity, 2)
        self.measured = 0  # distances taken so far, to show what the ranges spare
        self.root = self._node(list(range(len(entries)))) if len(entries) else None

    def _node(self, members: list[int]) -> Node:
        splits = [members[0]]
        squares = [squared(self.entries[members], self.entries[splits[0]])]
        while len(splits) < min(self.arity, len(members)):
            gap = np.minimum.reduce(squares)
            gap = [-1 if m in splits else g for m, g in zip(members, gap, strict=True)]
            splits.append(members[max(range(len(members)), key=gap.__getitem__)])
            squares.append(squared(self.entries[members], self.entries[splits[-1]]))
        table = np.array(squares)
        owner = table.argmin(0)
        for j, split in enumerate(splits):
            owner[members.index(split)] = j
        shape = (len(splits), len(splits))
        least, most = np.zeros(shape, dtype=table.dtype), np.zeros(shape, dtype=table.dtype)
        children: list[Node | None] = []
        for j, split in enumerate(splits):
            under = owner == j
            for i in range(len(splits)):
                least[i, j] = floor_roots(table[i, under]).min()
                most[i, j] = ceil_roots(table[i, under]).max()
            rest = [m for m, mine in zip(members, under, strict=True) if mine and m != split]
            children.append(self._node(rest) if rest else None)
        return Node(splits, least, most, children)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance, for every row of `queries`."""
        best = np.zeros(len(queries), dtype="int64")
        if self.root is None or not len(queries):
            return best, np.zeros(len(queries), dtype="int64")
        first = self.root.splits[0]
        best[:] = first
        distance = squared(queries, self.entries[first])
        self.measured += len(queries)
        self._visit(self.root, np.arange(len(queries)), queries, best, distance, distance)
        return best, distance.copy()

    def _visit(self, node, rows, queries, best, distance, known=None) -> None:
        """Look for entries nearer than `distance`; `known` holds those to the first split point."""
        n = len(node.splits)
        alive = np.ones((len(rows), n), dtype=bool)
        for i, split in enumerate(node.splits):
            asked = np.flatnonzero(alive[:, i])
            if not len(asked):
                continue
            at = rows[asked]
            if known is not None and i == 0:
                here = known[at].copy()
            else:
                here = squared(queries[at], self.entries[split])
                self.measured += len(at)
                nearer = (here < distance[at]) | ((here == distance[at]) & (split < best[at]))
                best[at[nearer]] = split
                distance[at[nearer]] = here[nearer]
            low = floor_roots(here)
            high = low + (low * low < here)
            reach = ceil_roots(distance[at])
            for j in range(n):
                if j != i or node.children[j] is not None:
                    out = (low - node.most[i, j] > reach) | (node.least[i, j] - high > reach)
                    alive[asked[out.astype(bool)], j] = False
        for j, child in enumerate(node.children):
            if child is not None and alive[:, j].any():
                self._visit(child, rows[alive[:, j]], queries, best, distance)
