"""Text regions of pages: from a detector's probability maps to boxes in pixels.

A map's regions are its borders (see :mod:`pagemill.functions.regions`) with the least rectangle
around each and the mean probability inside it; which of them are read, how far they are widened
and where they lie on the page are column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import geometry
from pagemill.functions.regions import borders, least_rectangle
from pagemill.operators.recognition import kept_regions

#: Cells of maps that a task labels at a time (one map at least).
CELLS = 4_000_000
FOUND = "region int, start long, hole boolean, points int, corners array<array<double>>, area double, side double, score double"


def regions_of(maps: DataFrame, by: list[str], values: str = "values", width: str = "width", threshold: float = 0.3) -> DataFrame:
    """One row for each border of each map: ``by``, and the columns of FOUND.

    ``values`` is an array of a map's rows, one after another; ``width`` the number of its columns.
    Null cells and those that are no number are below the threshold and count as 0. Regions are
    numbered from the last to begin (in reading order) to the first. ``corners`` are those of the least rectangle around
    the border's cells, ``side`` its shorter side, ``score`` the mean of the cells in it; figures
    are rounded to nine places, so that a side of three cells is three. Maps that are null, empty or
    not made of whole rows have no regions.
    """
    kept = [maps.schema[c] for c in by]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", {FOUND}"

    def found(keys: pa.RecordBatch, cells: np.ndarray, widths: np.ndarray, heights: np.ndarray, threshold: float) -> pa.RecordBatch:
        got = borders(cells > threshold, widths, heights)
        first = np.r_[0, np.cumsum(widths * heights)]
        boxes = [least_rectangle(np.c_[got.x[s:e], got.y[s:e]]) for s, e in zip(got.bounds[:-1].tolist(), got.bounds[1:].tolist(), strict=True)]
        scores = [b.mean_inside(cells[first[m] : first[m + 1]].reshape(heights[m], widths[m])) for m, b in zip(got.of.tolist(), boxes, strict=True)]
        number = np.arange(len(got.of)) - np.searchsorted(got.of, got.of)
        sides = np.array([b.sides for b in boxes]).reshape(-1, 2)
        columns = [
            *keys.take(pa.array(got.of)).columns, pa.array(number, pa.int32()), pa.array(got.start, pa.int64()), pa.array(got.hole), pa.array(np.diff(got.bounds), pa.int32()),
            pa.array([b.corners for b in boxes], pa.list_(pa.list_(pa.float64()))), *(pa.array(np.round(x, 9), pa.float64()) for x in (sides.prod(axis=1), sides.min(axis=1), np.array(scores, float))),
        ]
        return pa.RecordBatch.from_arrays(columns, [*by, *(f.split(" ")[0] for f in FOUND.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, widths = batch.column(len(by)), batch.column(len(by) + 1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = pa.compute.list_value_length(maps).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            widths = np.where((widths > 0) & (sizes % np.maximum(widths, 1) == 0), widths, 0)
            sizes = np.where(widths > 0, sizes, 0)
            group = np.cumsum(sizes) // CELLS
            for g in np.unique(group):
                at = np.flatnonzero((group == g) & (sizes > 0))
                if not len(at):
                    continue
                flat = maps.take(pa.array(at)).flatten().cast(pa.float64()).fill_null(0.0)
                cells = np.nan_to_num(flat.to_numpy(zero_copy_only=False), nan=0.0)
                keys = batch.select(by).take(pa.array(at))
                yield found(keys, cells, widths[at], sizes[at] // widths[at], threshold)

    return maps.select(*by, F.col(values), F.col(width)).mapInArrow(run, schema)


def widened(regions: DataFrame, ratio: float = 1.5) -> DataFrame:
    """Regions with ``offset``, how far they are moved outwards, their corners ``box`` after it and ``side_after``."""
    offset = F.round(geometry.unclip_offset(F.col("corners"), ratio), 9)
    out = regions.withColumn("offset", offset).withColumn("box", geometry.moved_corners(F.col("corners"), F.col("offset")))
    return out.withColumn("side_after", F.round(F.col("side") + 2 * F.col("offset"), 9))


def region_boxes(maps: DataFrame, by: list[str], page_width: str, page_height: str, values: str = "values", width: str = "width", threshold: float = 0.3, least_score: float = 0.6, most: int = 1000, ratio: float = 1.5) -> DataFrame:
    """The regions that are read, ``box`` in whole pixels of the page; ``by`` has to include the page's size."""
    found = widened(regions_of(maps, by, values, width, threshold), ratio)
    kept = kept_regions(found, by, "region", least_score, most)
    size = maps.select(*by, F.col(width).cast("double").alias("__w"), F.size(values).alias("__n")).where("__w > 0")
    kept = kept.join(size, [kept[c].eqNullSafe(size[c]) for c in by]).select(*[kept[c] for c in kept.columns], "__w", (F.col("__n") / F.col("__w")).alias("__h"))
    box = geometry.scaled_corners(geometry.ordered_corners(F.col("box")), F.col("__w"), F.col("__h"), F.col(page_width), F.col(page_height))
    return kept.withColumn("box", box).drop("__w", "__h")
