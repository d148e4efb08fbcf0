from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import geometry, regions
from pagemill.operators.regions import region_boxes, regions_of, widened


def filled(on):
    """Labels by flood fill: patches in eight directions, gaps in four, the frame a gap of its own."""
    h, w = on.shape
    padded = np.zeros((h + 2, w + 2), bool)
    padded[1:-1, 1:-1] = on
    label = np.full(padded.shape, -1)
    for y in range(h + 2):
        for x in range(w + 2):
            if label[y, x] >= 0:
                continue
            todo, name = [(y, x)], y * (w + 2) + x
            while todo:
                b, a = todo.pop()
                if not (0 <= a < w + 2 and 0 <= b < h + 2) or label[b, a] >= 0 or padded[b, a] != padded[y, x]:
                    continue
                label[b, a] = name
                todo += [(b + q, a + p) for q in (-1, 0, 1) for p in (-1, 0, 1) if padded[y, x] or abs(p) + abs(q) == 1]
    return padded, label


def plain_borders(on):
    padded, label = filled(on)
    h, w = on.shape
    found = {}
    for y in range(1, h + 1):
        for x in range(1, w + 1):
            if padded[y, x]:
                for b, a in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                    if not padded[b, a]:
                        found.setdefault((label[y, x], label[b, a]), set()).add((x - 1, y - 1))
    out = []
    for (patch, gap), cells in found.items():
        y, x = divmod(patch, w + 2)
        hole = label[y - 1, x] != gap
        y, x = divmod(gap, w + 2) if hole else (y, x)
        out.append(((y - 1) * w + x - 1 - hole, hole, tuple(sorted(cells))))
    return sorted(out)


def grid(seed, h, w, share):
    return np.random.default_rng(seed).random((h, w)) < share


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 9), st.sampled_from([0.0, 0.3, 0.5, 0.8, 1.0])), min_size=1, max_size=4))
def test_borders_equal_a_flood_fill(some):
    maps = [grid(*m) for m in some]
    got = regions.borders(np.concatenate([m.ravel() for m in maps]), np.array([m.shape[1] for m in maps]), np.array([m.shape[0] for m in maps]))
    for k, m in enumerate(maps):
        own = [i for i in range(len(got.of)) if got.of[i] == k]
        found = [(int(got.start[i]), bool(got.hole[i]), tuple(sorted(zip(got.x[got.bounds[i] : got.bounds[i + 1]].tolist(), got.y[got.bounds[i] : got.bounds[i + 1]].tolist(), strict=True)))) for i in own]
        assert sorted(found) == plain_borders(m)
        assert [f[0] for f in found] == sorted((f[0] for f in found), reverse=True)


def test_a_ring_within_a_ring():
    on = np.zeros((7, 7), bool)
    on[0], on[-1], on[:, 0], on[:, -1], on[3, 3] = True, True, True, True, True
    got = regions.borders(on.ravel(), np.array([7]), np.array([7]))
    # the dot, then the ring's hole, found at the cell to its left, then the ring itself
    assert got.start.tolist() == [24, 7, 0] and got.hole.tolist() == [False, True, False]
    assert np.diff(got.bounds).tolist() == [1, 20, 24]  # the hole touches all but the corners


@settings(deadline=None, max_examples=80)
@given(st.sets(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=30))
def test_the_least_rectangle_is_not_above_any_turned_box(points):
    p = np.array(sorted(points))
    got = regions.least_rectangle(p)
    area, best = got.sides[0] * got.sides[1], math.inf
    for t in np.r_[np.linspace(0, math.pi / 2, 721), [math.atan2(b[1] - a[1], b[0] - a[0]) for a in p for b in p if (a != b).any()]]:
        c, s = math.cos(t), math.sin(t)
        best = min(best, np.ptp(p[:, 0] * c + p[:, 1] * s) * np.ptp(p[:, 1] * c - p[:, 0] * s))
    assert area == pytest.approx(best, abs=1e-6)
    along, across = p[:, 0] * got.c + p[:, 1] * got.s, p[:, 1] * got.c - p[:, 0] * got.s
    assert (along > got.low[0] - 1e-9).all() and (along < got.high[0] + 1e-9).all() and (across > got.low[1] - 1e-9).all() and (across < got.high[1] + 1e-9).all()


def test_the_mean_inside_equals_a_test_of_each_cell():
    rng = np.random.default_rng(5)
    for _ in range(60):
        values = rng.random((11, 14))
        p = rng.integers(0, 11, (int(rng.integers(1, 9)), 2))
        box = regions.least_rectangle(p)
        ring = np.array(box.corners)
        inside = [v for (y, x), v in np.ndenumerate(values) if all((b - a)[0] * (y - a[1]) - (b - a)[1] * (x - a[0]) >= -1e-6 for a, b in zip(ring, np.roll(ring, -1, axis=0), strict=True))
                  and ring[:, 0].min() - 1e-6 <= x <= ring[:, 0].max() + 1e-6 and ring[:, 1].min() - 1e-6 <= y <= ring[:, 1].max() + 1e-6]
        assert box.mean_inside(values) == pytest.approx(np.mean(inside) if inside else 0.0)


def ring_distance(p, ring):
    out = math.inf
    for a, b in zip(ring, [*ring[1:], ring[0]], strict=True):
        d = (b[0] - a[0], b[1] - a[1])
        n = d[0] ** 2 + d[1] ** 2
        t = max(0.0, min(1.0, ((p[0] - a[0]) * d[0] + (p[1] - a[1]) * d[1]) / n)) if n else 0.0
        out = min(out, math.hypot(p[0] - a[0] - t * d[0], p[1] - a[1] - t * d[1]))
    return out


RINGS = [
    [[0.0, 0.0], [4.0, 0.0], [4.0, 2.0], [0.0, 2.0]], [[0.0, 0.0], [0.0, 2.0], [4.0, 2.0], [4.0, 0.0]], [[0.0, 0.0], [3.0, 1.0], [2.0, 4.0], [-1.0, 3.0]],
    [[0.0, 0.0], [4.0, 0.0], [4.0, 0.0], [2.0, 5.0]], [[1.0, 1.0], [5.0, 1.0], [6.0, 3.0], [4.0, 5.0], [0.0, 4.0]],
]
FLAT = [[[0.0, 0.0], [3.0, 3.0], [1.0, 1.0]], [[1.0, 2.0]] * 4]


def test_a_moved_ring_keeps_its_distance(spark):
    rows = spark.createDataFrame([(r,) for r in RINGS + FLAT], "p array<array<double>>")
    d = geometry.unclip_offset(F.col("p"))
    got = rows.select(d.alias("d"), geometry.moved_ring(F.col("p"), d).alias("r")).collect()
    for ring, row in zip(RINGS, got, strict=False):
        assert row["d"] > 0 and len(row["r"]) >= 27
        assert all(ring_distance(q, ring) == pytest.approx(row["d"], abs=1e-9) for q in row["r"])
        x, y = zip(*row["r"], strict=True)
        turns = [(x[k] - x[k - 1]) * (y[(k + 1) % len(x)] - y[k]) - (y[k] - y[k - 1]) * (x[(k + 1) % len(x)] - x[k]) for k in range(len(x))]
        assert min(turns) > -1e-9  # it never crosses itself
    assert [r["r"] for r in got[len(RINGS) :]] == FLAT


def test_moved_corners_are_the_rectangle_around_the_moved_ring(spark):
    boxes = [RINGS[0], RINGS[1], [[1.0, 0.0], [4.0, 4.0], [0.0, 7.0], [-3.0, 3.0]]]
    rows = spark.createDataFrame([(r,) for r in boxes], "p array<array<double>>")
    d = geometry.unclip_offset(F.col("p"))
    for r in rows.select(d.alias("d"), geometry.moved_ring(F.col("p"), d, 64).alias("r"), geometry.moved_corners(F.col("p"), d).alias("c")).collect():
        a, b, c = (np.array(p) for p in r["c"][:3])
        u, v = (b - a) / np.linalg.norm(b - a), (c - b) / np.linalg.norm(c - b)
        ring = np.array(r["r"])
        assert [np.ptp(ring @ u), np.ptp(ring @ v)] == pytest.approx([np.linalg.norm(b - a), np.linalg.norm(c - b)], abs=1e-9)


def page(*rows):
    return [float(c) / 10 for r in rows for c in r]


def test_boxes_of_a_page(spark):
    first = page("0000000000", "0999999900", "0999999900", "0999999900", "0999999900", "0000000000", "0000000000", "0440000000")
    maps = [(1, first, 10, 100, 80), (2, None, 10, 100, 80), (3, [], 10, 100, 80), (4, first[:-1], 10, 100, 80), (5, first, None, 100, 80), (6, [None, math.nan, 0.9, 0.9], 2, 100, 80), (None, first, 10, 200, 80)]
    rows = spark.createDataFrame(maps, "id long, values array<double>, width int, w int, h int")
    found = regions_of(rows, ["id"]).orderBy("id", "region").collect()
    assert [(r["id"], r["region"], r["start"], r["points"], r["side"], r["area"], r["score"]) for r in found] == [
        (None, 0, 71, 2, 0.0, 0.0, 0.4), (None, 1, 11, 18, 3.0, 18.0, 0.9), (1, 0, 71, 2, 0.0, 0.0, 0.4), (1, 1, 11, 18, 3.0, 18.0, 0.9), (6, 0, 2, 2, 0.0, 0.0, 0.9)
    ]
    moved = widened(regions_of(rows, ["id"])).where("id = 1 and region = 1").first()
    assert moved["offset"] == 1.5 and moved["side_after"] == 6.0
    boxes = region_boxes(rows, ["id", "w", "h"], "w", "h").collect()
    assert sorted((str(r["id"]), r["box"]) for r in boxes) == [("1", [[0, 0], [85, 0], [85, 55], [0, 55]]), ("None", [[0, 0], [170, 0], [170, 55], [0, 55]])]


def test_no_maps(spark):
    rows = spark.createDataFrame([], "id long, values array<double>, width int, w int, h int")
    assert region_boxes(rows, ["id", "w", "h"], "w", "h").count() == 0


def test_maps_in_several_groups(spark, monkeypatch):
    from pagemill.operators import regions as operator

    rng = np.random.default_rng(9)
    maps = [(k, rng.random(64).tolist(), 8) for k in range(50)]
    rows = spark.createDataFrame(maps, "id long, values array<double>, width int").coalesce(1)
    whole = sorted(map(str, regions_of(rows, ["id"], threshold=0.6).collect()))
    monkeypatch.setattr(operator, "CELLS", 200)
    assert sorted(map(str, regions_of(rows, ["id"], threshold=0.6).collect())) == whole
