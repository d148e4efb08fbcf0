"""Text regions of probability maps: connected cells, their borders and least rectangles.

Maps of a batch lie one after another in flat arrays, row by row, so that cells of all maps are
labelled at once. Cells over the threshold hang together in eight directions, the others in four,
and what surrounds a map is one of the others. Each pair of a patch and a gap that touch is a
border: the patch's outer one if the gap surrounds it, else that of a hole in it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def connected(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest that edges (u, v) connect it with: union-find, all edges at once."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != (up := root[root])).any():
            root = up
    return root


@dataclass
class Borders:
    """Borders of a batch: map, first cell, hole or not, and the cells of each (a slice of x and y)."""

    of: np.ndarray
    start: np.ndarray
    hole: np.ndarray
    bounds: np.ndarray
    x: np.ndarray
    y: np.ndarray


def borders(on: np.ndarray, width: np.ndarray, height: np.ndarray) -> Borders:
    """Borders of the maps whose cells over the threshold are ``on``, in order of map, then the last to begin first."""
    cells = width * height
    first = np.r_[0, np.cumsum(cells)]
    n = len(on)
    of = np.repeat(np.arange(len(width)), cells)
    at, w = np.arange(n), width[of]
    y, x = np.divmod(at - first[of], np.maximum(w, 1))
    right, down = at[x + 1 < w], at[y + 1 < height[of]]
    edge = at[(x == 0) | (y == 0) | (x + 1 == w) | (y + 1 == height[of])]
    near = np.c_[np.r_[right, down], np.r_[right + 1, down + w[down]]]
    slant = np.r_[down[x[down] + 1 < w[down]], down[x[down] > 0] - 1]  # upper left cells of squares of four
    cross = np.r_[np.c_[slant, slant + w[slant] + 1], np.c_[slant + 1, slant + w[slant]]]
    alike = near[on[near[:, 0]] == on[near[:, 1]]]
    cross = cross[on[cross[:, 0]] & on[cross[:, 1]]]
    gap_edge = edge[~on[edge]]
    joined = np.r_[alike, cross, np.c_[gap_edge, n + of[gap_edge]]]
    root = connected(n + len(width), joined[:, 0], joined[:, 1])

    touch = near[on[near[:, 0]] != on[near[:, 1]]]
    touch = np.where(on[touch[:, :1]], touch, touch[:, ::-1])  # the patch's cell first
    patch_edge = edge[on[edge]]
    touch = np.r_[touch, np.c_[patch_edge, n + of[patch_edge]]]
    patch, gap = root[touch[:, 0]], root[touch[:, 1]]
    # What lies above a patch's first cell surrounds it.
    above = np.where(y[patch] > 0, patch - w[patch], n + of[patch])
    hole = root[above] != gap
    start = np.where(hole, gap - 1, patch)
    order = np.lexsort((touch[:, 0], gap, patch, -start, of[patch]))
    keys = np.c_[of[patch], start, patch, gap, touch[:, 0]][order]
    hole = hole[order]
    once = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)] if len(keys) else np.zeros(0, bool)
    keys, hole = keys[once], hole[once]
    new = np.flatnonzero(np.r_[True, (keys[1:, :4] != keys[:-1, :4]).any(axis=1)]) if len(keys) else np.zeros(0, np.int64)
    cell = keys[:, 4]
    return Borders(keys[new, 0], keys[new, 1] - first[keys[new, 0]], hole[new], np.r_[new, len(keys)], x[cell], y[cell])


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of whole points, in turn."""
    rows = np.unique(points[:, 1])
    if len(points) > 4 * len(rows):  # of a row only its ends can be corners
        at = np.searchsorted(rows, points[:, 1])
        ends = np.full((2, len(rows)), points[0, 0])
        ends[0], ends[1] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        np.minimum.at(ends[0], at, points[:, 0])
        np.maximum.at(ends[1], at, points[:, 0])
        points = np.c_[ends.ravel(), np.tile(rows, 2)]
    points = sorted({*map(tuple, points.tolist())})
    if len(points) < 3:
        return np.array(points)
    sides = []
    for some in (points, points[::-1]):
        chain: list[tuple] = []
        for p in some:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) <= (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]):
                chain.pop()
            chain.append(p)
        sides += chain[:-1]
    return np.array(sides)


@dataclass
class Rectangle:
    """A rectangle with one side in direction (c, s): from low to high along it and across it."""

    c: float
    s: float
    low: tuple[float, float]
    high: tuple[float, float]

    @property
    def sides(self) -> tuple[float, float]:
        return self.high[0] - self.low[0], self.high[1] - self.low[1]

    @property
    def corners(self) -> list[list[float]]:
        turn = [(self.low[0], self.low[1]), (self.high[0], self.low[1]), (self.high[0], self.high[1]), (self.low[0], self.high[1])]
        return [[a * self.c - b * self.s, a * self.s + b * self.c] for a, b in turn]

    def mean_inside(self, values: np.ndarray) -> float:
        """The mean of a map's cells whose centres lie in the rectangle (at its border too); 0 without any."""
        height, width = values.shape
        xs, ys = zip(*self.corners, strict=True)
        left, top = max(int(np.floor(min(xs))), 0), max(int(np.floor(min(ys))), 0)
        part = values[top : int(np.ceil(max(ys))) + 1, left : int(np.ceil(max(xs))) + 1]
        y, x = np.mgrid[top : top + part.shape[0], left : left + part.shape[1]]
        along, across = x * self.c + y * self.s, y * self.c - x * self.s
        slack = 1e-6
        inside = (along >= self.low[0] - slack) & (along <= self.high[0] + slack) & (across >= self.low[1] - slack) & (across <= self.high[1] + slack)
        return float(part[inside].mean(dtype=np.float64)) if inside.any() else 0.0


def least_rectangle(points: np.ndarray) -> Rectangle:
    """The rectangle of least area around whole points: it has a side along one of their hull's.

    Of equal areas the one with the shortest side counts, then the one turned least.
    """
    around = hull(points)
    turns = np.roll(around, -1, axis=0) - around if len(around) > 1 else np.array([[1, 0]])
    # The same rectangles by directions from 0 up to 90 degrees.
    dx, dy = turns[:, 0], turns[:, 1]
    for _ in range(3):
        later = ~((dx > 0) & (dy >= 0))
        dx, dy = np.where(later, dy, dx), np.where(later, -dx, dy)
    long = np.sqrt(dx * dx + dy * dy)
    along = (np.outer(dx, around[:, 0]) + np.outer(dy, around[:, 1])) / long[:, None]
    across = (np.outer(dx, around[:, 1]) - np.outer(dy, around[:, 0])) / long[:, None]
    low, high = np.c_[along.min(axis=1), across.min(axis=1)], np.c_[along.max(axis=1), across.max(axis=1)]
    sides = high - low
    k = np.lexsort((dy / dx, np.round(sides.min(axis=1), 6), np.round(sides.prod(axis=1), 6)))[0]
    return Rectangle(dx[k] / long[k], dy[k] / long[k], tuple(low[k].tolist()), tuple(high[k].tolist()))
