"""Common pieces of texts by the rule of Ratcliff and Obershelp, for many pairs at once, in numpy.

Of two texts the longest common piece is taken: of equally long ones the first in the first text,
then the first in the second. What lies before it in both texts, and what lies behind it, is
treated likewise. In a long second text frequent characters don't begin a piece; a piece found
without them is made longer by them at both ends.

All pairs of a block go down together, level by level. A level lists where characters are equal,
at most CELLS places at a time, whatever the texts' length: sorted by diagonal, places that follow
each other are pieces, and a piece that a batch of places cuts is taken up by the next one.
"""

from __future__ import annotations

import numpy as np

# From this length on a second text has frequent characters, which are more than this share of it and one more.
LONG, SHARE = 200, 100
#: Places with equal characters that are held at a time, and characters of a block of pairs.
CELLS, BLOCK_CHARS = 1 << 20, 1 << 20
#: Characters by which pieces are made longer at a time.
STRIDE = 32


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points, one text after another, and where each text ends."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return points, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the spans, span by span."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def equal_run(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
    """How many characters from (i, j) on, forwards or backwards, are equal; at most ``most``."""
    out = np.zeros(len(i), np.int64)
    going = np.flatnonzero(most > 0)
    while len(going):
        steps = out[going, None] + np.arange(STRIDE)
        inside = steps < most[going, None]
        steps = np.where(inside, steps, 0) * way
        same = inside & (a[i[going, None] + steps] == b[j[going, None] + steps])
        run = np.where(same.all(1), STRIDE, same.argmin(1))
        out[going] += run
        going = going[run == STRIDE]
    return out


class Places:
    """Where the characters of the second texts stand, but for the frequent ones of long texts."""

    def __init__(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray):
        sizes = np.diff(np.r_[0, b_ends])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        kinds, kind, times = np.unique(owner << 32 | b, return_inverse=True, return_counts=True)
        size = sizes[kinds >> 32]
        rare = (size < LONG) | (times <= size // SHARE + 1)
        asked = np.repeat(np.arange(len(a_ends)), np.diff(np.r_[0, a_ends])) << 32 | a
        found = np.minimum(np.searchsorted(kinds, asked), max(len(kinds) - 1, 0))
        #: of each character of the first texts its kind in the second one; -1 for none
        self.kind = np.where((kinds[found] == asked) & rare[found], found, -1) if len(kinds) else np.full(len(a), -1)
        self.width = len(b) + 1
        own = np.flatnonzero(rare[kind])
        own = own[np.argsort(kind[own], kind="stable")]
        self.keys, self.at = kind[own] * self.width + own, own

    def within(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the first of its places from ``low`` to ``high``, and their number."""
        base = self.kind[rows] * self.width
        first = np.searchsorted(self.keys, base + low)
        return first, np.searchsorted(self.keys, base + high) - first


def longest(places: Places, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in both texts and length of each section's longest piece of rare characters; length 0 at its start for none."""
    i, j, size = alo.copy(), blo.copy(), np.zeros(len(alo), np.int64)
    rows, section = spans(alo, ahi - alo), np.repeat(np.arange(len(alo)), ahi - alo)
    known = places.kind[rows] >= 0
    rows, section = rows[known], section[known]
    first, number = places.within(rows, blo[section], bhi[section])
    some = number > 0
    rows, section, first, number = rows[some], section[some], first[some], number[some]
    upto, start = np.cumsum(number), 0
    cut = np.zeros((3, 0), np.int64)  # ends in the second text, lengths and sections of the pieces that reach the row before
    while start < len(rows):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CELLS, side="right")))
        n = number[start:end]
        at, to, of = np.repeat(rows[start:end], n), places.at[spans(first[start:end], n)], np.repeat(section[start:end], n)
        stride = int(rows[-1]) + 2
        key = (to - at + stride) * stride + at
        order = np.argsort(key)
        key, at, to, of = key[order], at[order], to[order], of[order]
        heads = np.flatnonzero(np.r_[True, (np.diff(key) != 1) | (of[1:] != of[:-1])])
        length = np.diff(np.r_[heads, len(key)])
        at, to, of = at[heads], to[heads], of[heads]
        last = to + length - 1, at + length - 1
        if cut.shape[1] and rows[start] == rows[start - 1] + 1:
            k = np.minimum(np.searchsorted(cut[0], to - 1), cut.shape[1] - 1)
            more = np.where((at == rows[start]) & (cut[0][k] == to - 1) & (cut[2][k] == of), cut[1][k], 0)
            length, at, to = length + more, at - more, to - more
        open_ = np.flatnonzero(last[1] == rows[end - 1])
        open_ = open_[np.argsort(last[0][open_])]
        cut = np.stack([last[0][open_], length[open_], of[open_]])
        best = np.zeros(len(alo), np.int64)
        np.maximum.at(best, of, length)
        top = np.flatnonzero((length == best[of]) & (length > size[of]))
        top = top[np.lexsort((to[top], at[top], of[top]))]
        top = top[np.r_[True, of[top][1:] != of[top][:-1]]] if len(top) else top
        i[of[top]], j[of[top]], size[of[top]] = at[top], to[top], length[top]
        start = end
    return i, j, size


def matched(first: list[str], second: list[str]) -> np.ndarray:
    """How many characters lie in common pieces, for each pair."""
    (a, a_ends), (b, b_ends) = codes(first), codes(second)
    places, total, pair = Places(a, a_ends, b, b_ends), np.zeros(len(first), np.int64), np.arange(len(first))
    alo, ahi, blo, bhi = np.r_[0, a_ends[:-1]], a_ends, np.r_[0, b_ends[:-1]], b_ends
    while True:
        open_ = (alo < ahi) & (blo < bhi)
        if not open_.any():
            return total
        alo, ahi, blo, bhi, pair = (x[open_] for x in (alo, ahi, blo, bhi, pair))
        i, j, size = longest(places, alo, ahi, blo, bhi)
        back = equal_run(a, b, i - 1, j - 1, np.minimum(i - alo, j - blo), -1)
        i, j, size = i - back, j - back, size + back
        size = size + equal_run(a, b, i + size, j + size, np.minimum(ahi - i, bhi - j) - size, 1)
        np.add.at(total, pair, size)
        some = size > 0
        alo, ahi, blo, bhi, i, j, size, pair = (x[some] for x in (alo, ahi, blo, bhi, i, j, size, pair))
        alo, ahi, blo, bhi, pair = np.r_[alo, i + size], np.r_[i, ahi], np.r_[blo, j + size], np.r_[j, bhi], np.r_[pair, pair]
        order = np.argsort(alo, kind="stable")
        alo, ahi, blo, bhi, pair = (x[order] for x in (alo, ahi, blo, bhi, pair))


def shares(first: list[str], second: list[str]) -> np.ndarray:
    """Twice the characters in common pieces over all characters; 1 for two empty texts."""
    sizes = np.fromiter((len(x) + len(y) for x, y in zip(first, second, strict=True)), np.int64, len(first))
    found, start = np.zeros(len(first), np.int64), 0
    upto = np.cumsum(sizes)
    while start < len(first):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + BLOCK_CHARS, side="right")))
        found[start:end] = matched(first[start:end], second[start:end])
        start = end
    return np.where(sizes > 0, 2.0 * found / np.maximum(sizes, 1), 1.0)
