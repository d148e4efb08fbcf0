"""Page and crop sizes, page lists and greedy decoding as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Input shapes (height, width) for which the detector is prepared.
SHAPES = [
    (1408, 832), (1408, 864), (1088, 832), (1376, 832), (1088, 864), (1376, 864), (1472, 1920), (1120, 832), (1504, 1920), (1120, 864),
    (1536, 1920), (1408, 896), (1440, 896), (1600, 1920), (1440, 1920), (1440, 928), (1472, 960), (1152, 832), (1504, 1024), (1568, 1920),
    (1088, 896), (1632, 1056), (1440, 864), (1632, 1024), (1472, 992), (1632, 1152), (1504, 928), (1600, 928), (1568, 960), (1568, 928),
    (1792, 1152), (1152, 864), (1120, 896), (1696, 1088), (1696, 1184), (1760, 1120), (1504, 960), (1504, 992), (1792, 1184), (1280, 1920),
    (1152, 896), (1792, 1120), (1472, 928), (1216, 960), (1600, 992), (1056, 832), (1472, 896), (1184, 832), (1440, 960), (1440, 832),
]


def kept_pages(n: Column, most: int = 30, head: int = 25, tail: int = 5) -> Column:
    """Page numbers from 0 that are worked on: all, or the first ones and the last ones."""
    every = F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.filter(every, lambda p: (n <= most) | (p < head) | (p >= n - tail))


def rendered_size(width: Column, height: Column, dpi: int = 100, most_width: int = 2000, most_height: int = 3000, buffer: int = 18_500_000) -> Column:
    """Struct (width, height) in pixels of a page given in points, shrunk to fit the buffer."""
    scale = F.lit(dpi / 72)
    w, h = (width * scale).cast("int"), (height * scale).cast("int")
    fit = F.least(F.lit(most_width) / w, F.lit(most_height) / h, F.lit(1.0))
    small = w.cast("long") * h * 3 <= buffer
    return F.struct(F.when(small, w).otherwise((width * scale * fit).cast("int")).alias("width"), F.when(small, h).otherwise((height * scale * fit).cast("int")).alias("height"))


def detector_side(side: Column, longest: Column, limit: int = 1920, step: int = 32) -> Column:
    """A side scaled so that the longest is at most ``limit``, to the nearest multiple (half to even)."""
    ratio = F.when(longest > limit, F.lit(float(limit)) / longest).otherwise(F.lit(1.0))
    return F.greatest(F.bround(side * ratio / step).cast("int") * step, F.lit(step))


def detector_shape(height: Column, width: Column) -> Column:
    longest = F.greatest(height, width)
    return F.struct(detector_side(height, longest).alias("height"), detector_side(width, longest).alias("width"))


def nearest_shape(height: Column, width: Column, shapes: list[tuple[int, int]] = SHAPES) -> Column:
    """The prepared shape with the least squared distance; ties go to the smaller one."""
    known = F.array(*[F.struct(F.lit(h).alias("height"), F.lit(w).alias("width")) for h, w in shapes])
    far = lambda s: (s["height"] - height) * (s["height"] - height) + (s["width"] - width) * (s["width"] - width)
    best = F.array_min(F.transform(known, lambda s: F.struct(far(s).alias("far"), s["height"].alias("height"), s["width"].alias("width"))))
    return F.struct(best["height"].alias("height"), best["width"].alias("width"))


def crop_width(width: Column, height: Column, step: int = 128, most: int = 3200) -> Column:
    """The width in which a line's crop is read: at a height of 48, up to the next step."""
    at_48 = (F.lit(48) * F.greatest(width / F.greatest(height, F.lit(1)), F.lit(320.0 / 48.0))).cast("int")
    return F.least(F.greatest(F.ceil(at_48 / step).cast("int") * step, F.lit(step)), F.lit(most))


def greedy_decode(steps: Column, letters: list[str]) -> Column:
    """Struct (text, confidence) of an array of probability vectors; letter 0 is the blank.

    Of each step the first most probable letter counts; repeats, then blanks, are dropped.
    """
    table = F.array(*map(F.lit, letters))
    none = F.struct(F.lit(0).alias("before"), F.lit("").alias("text"), F.lit(0.0).alias("total"), F.lit(0).alias("n"))

    def step(s: Column, v: Column) -> Column:
        top = F.array_max(v)
        k = (F.array_position(v, top) - 1).cast("int")
        new = (k != 0) & (k != s["before"])
        return F.struct(
            k.alias("before"), F.when(new, F.concat(s["text"], F.get(table, k))).otherwise(s["text"]).alias("text"),
            F.when(new, s["total"] + top).otherwise(s["total"]).alias("total"), F.when(new, s["n"] + 1).otherwise(s["n"]).alias("n"),
        )

    end = lambda s: F.struct(s["text"].alias("text"), F.coalesce(F.try_divide(s["total"], s["n"].cast("double")), F.lit(0.0)).alias("confidence"))
    return F.aggregate(steps, none, step, end)


def clipped(value: Column, scale: Column, most: Column) -> Column:
    """A coordinate brought to the source's size, rounded half to even and kept inside."""
    return F.greatest(F.least(F.bround(value * scale).cast("int"), most), F.lit(0))


def ring_area(points: Column) -> Column:
    """Area of a polygon given as an array of [x, y]."""
    n = F.size(points)
    turn = lambda p, i: p[0] * F.get(points, (i + 1) % n)[1] - F.get(points, (i + 1) % n)[0] * p[1]
    return F.abs(F.aggregate(F.transform(points, turn), F.lit(0.0), lambda s, x: s + x)) / 2


def ring_length(points: Column) -> Column:
    n = F.size(points)
    side = lambda p, i: F.sqrt(F.pow(p[0] - F.get(points, (i + 1) % n)[0], F.lit(2)) + F.pow(p[1] - F.get(points, (i + 1) % n)[1], F.lit(2)))
    return F.aggregate(F.transform(points, side), F.lit(0.0), lambda s, x: s + x)


def unclip_offset(points: Column, ratio: float = 1.5) -> Column:
    """How far a text region's polygon is moved outwards; 0 for a polygon without an area."""
    return F.coalesce(F.try_divide(ring_area(points) * ratio, ring_length(points)), F.lit(0.0))


def ordered_corners(points: Column) -> Column:
    """The four [x, y] of a rectangle as upper left, upper right, lower right, lower left.

    The two of smaller x are the left ones; of each side the one of smaller y is the upper one, and
    of two at the same height the later one in the order of x.
    """
    keyed = F.array_sort(F.transform(points, lambda p, i: F.struct(p[0].alias("x"), i.alias("i"), p.alias("p"))))
    a, b, c, d = (F.get(keyed, k)["p"] for k in range(4))
    left, right = b[1] > a[1], d[1] > c[1]
    pick = lambda first, yes, no: F.when(first, yes).otherwise(no)
    return F.array(pick(left, a, b), pick(right, c, d), pick(right, d, c), pick(left, b, a))


def short_side(corners: Column) -> Column:
    """The shorter side of a rectangle given by its corners in order."""
    side = lambda p, q: F.sqrt(F.pow(p[0] - q[0], F.lit(2)) + F.pow(p[1] - q[1], F.lit(2)))
    return F.least(side(corners[0], corners[1]), side(corners[1], corners[2]))


def scaled_corners(corners: Column, width: Column, height: Column, to_width: Column, to_height: Column) -> Column:
    """Corners found on a map of one size, in whole pixels of the page that it stands for."""
    return F.transform(corners, lambda p: F.array(clipped(p[0] / width, to_width, to_width), clipped(p[1] / height, to_height, to_height)))


def towards(p: Column, q: Column) -> Column:
    """The unit vector [x, y] from q to p; zero where they are the same."""
    far = F.sqrt(F.pow(p[0] - q[0], F.lit(2)) + F.pow(p[1] - q[1], F.lit(2)))
    return F.array(F.coalesce(F.try_divide(p[0] - q[0], far), F.lit(0.0)), F.coalesce(F.try_divide(p[1] - q[1], far), F.lit(0.0)))


def moved_corners(corners: Column, distance: Column) -> Column:
    """A rectangle's corners, given in turn, after its sides have moved outwards: the least
    rectangle around :func:`moved_ring`. A rectangle that doesn't move stays as it is."""

    def move(p: Column, i: Column) -> Column:
        n = F.size(corners)
        a, b = towards(p, F.get(corners, (i + 1) % n)), towards(p, F.get(corners, (i + n - 1) % n))
        return F.array(p[0] + distance * (a[0] + b[0]), p[1] + distance * (a[1] + b[1]))

    return F.when(distance == 0, corners).otherwise(F.transform(corners, move))


def moved_ring(points: Column, distance: Column, steps: int = 8) -> Column:
    """A convex polygon, given in turn, moved outwards, with rounded corners.

    Around each corner lie ``steps`` + 1 points of a circle, from the one side's normal to the
    next one's. Repeated corners count once; a polygon that doesn't move stays as it is.
    """
    n = F.size(points)
    ring = F.filter(points, lambda p, i: (p[0] != F.get(points, (i + 1) % n)[0]) | (p[1] != F.get(points, (i + 1) % n)[1]))
    turn = lambda r: F.aggregate(F.transform(r, lambda p, i: p[0] * F.get(r, (i + 1) % F.size(r))[1] - F.get(r, (i + 1) % F.size(r))[0] * p[1]), F.lit(0.0), lambda s, x: s + x)
    ring = F.when(turn(ring) < 0, F.reverse(ring)).otherwise(ring)
    normal = lambda p, q: F.atan2(p[0] - q[0], q[1] - p[1])  # of the side from p to q, when the inside is on its left

    def corner(r: Column, p: Column, i: Column) -> Column:
        m = F.size(r)
        start, end = normal(F.get(r, (i + m - 1) % m), p), normal(p, F.get(r, (i + 1) % m))
        bend = F.pmod(end - start, F.lit(2 * math.pi))
        angle = lambda k: start + bend * k / steps
        return F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda k: F.array(p[0] + distance * F.cos(angle(k)), p[1] + distance * F.sin(angle(k))))

    # bound once, so that the ring isn't worked out anew for each corner
    bound = F.transform(F.array(ring), lambda r: F.flatten(F.transform(r, lambda p, i: corner(r, p, i))))
    return F.when(distance == 0, points).otherwise(bound[0])
