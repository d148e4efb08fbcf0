"""Recognition of pages by an engine, with a second pass for documents without text."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.json import merged
from pagemill.functions.texts import LINES, is_blank


class Engine(Protocol):
    """Reads a page image; made once for each task by a factory that can be pickled."""

    def read(self, image: bytes, dpi: int) -> list[dict]:
        """Lines of the page: dicts of text, confidence and bbox."""


def recognised(pages: DataFrame, make: Callable[[], Engine], dpi: int = 100) -> DataFrame:
    """``pages`` (with a binary column image) with status, error and lines in its place.

    A null image or an engine's error gives a failed page and never fails the task.
    """
    kept = [f for f in pages.schema.fields if f.name != "image"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", status string, error string, lines {LINES}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = make()
        for batch in batches:
            out = []
            for image in batch["image"]:
                try:
                    out.append(("success", None, engine.read(image, dpi)) if image is not None else ("error", "Render failed", None))
                except Exception as error:  # an engine may raise anything
                    out.append(("error", str(error), None))
            status, errors, lines = zip(*out, strict=True) if out else ((), (), ())
            yield batch.drop(columns="image").assign(status=list(status), error=list(errors), lines=list(lines))

    return pages.mapInPandas(run, schema)


def marked(results: DataFrame, dpi: int, column: str = "ocr_metadata") -> DataFrame:
    """Results whose metadata say that they come from a second pass, and at which resolution."""
    marks = F.to_json(F.struct(F.lit(True).alias("fallback"), F.lit(dpi).alias("fallback_dpi")))
    return results.withColumn(column, merged(F.coalesce(column, F.lit("{}")), marks))


def with_second_pass(results: DataFrame, again: Callable[[DataFrame], DataFrame], key: str = "document_id", dpi: int | None = None) -> DataFrame:
    """Results, those without text read once more; ``again`` maps their keys to new results.

    Documents that still have no text are dropped, so that they stay pending; text that was there
    is never replaced. With ``dpi`` the new results' metadata are marked.
    """
    blank = results.where(is_blank(F.col("full_text")))
    better = again(blank.select(key)).where(~is_blank(F.col("full_text")))
    better = better if dpi is None else marked(better, dpi)
    return results.where(~is_blank(F.col("full_text"))).unionByName(better, allowMissingColumns=True)


def kept_regions(regions: DataFrame, by: list[str], order: str, least_score: float = 0.6, most: int = 1000) -> DataFrame:
    """Text regions (side, score, side_after) that are read: of each page the first ``most`` in their
    order, then those with a short side of at least 3, enough of a score, and a short side of at
    least 5 after they were widened."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    early = regions.withColumn("__nth", nth).where(F.col("__nth") <= most)
    return early.where((F.col("side") >= 3) & (F.col("score") >= least_score) & (F.col("side_after") >= 5)).drop("__nth")
