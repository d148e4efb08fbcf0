"""Comparison of two engines' results over a fixed list of documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_figures(pages: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for each document: pages, lines, chars, avg_confidence, full_text.

    All pages' texts are joined, empty ones too; confidence is the mean over lines, as a share.
    """
    text = F.coalesce(F.array_join(F.transform("lines", lambda x: F.coalesce(x["text"], F.lit(""))), "\n"), F.lit(""))
    total = lambda f: F.coalesce(F.aggregate("lines", F.lit(0.0), lambda s, x: s + f(x)), F.lit(0.0))
    own = pages.select(
        *by, "page", text.alias("t"), F.coalesce(F.size("lines"), F.lit(0)).alias("n"), total(lambda x: F.coalesce(x["confidence"], F.lit(0.0))).alias("c"),
        total(lambda x: F.length(F.coalesce(x["text"], F.lit(""))).cast("double")).alias("chars"),
    )
    texts = F.transform(F.array_sort(F.collect_list(F.struct("page", "t"))), lambda x: x["t"])
    return own.groupBy(*by).agg(
        F.count("*").alias("pages"), F.sum("n").cast("long").alias("lines"), F.sum("chars").cast("long").alias("chars"),
        F.coalesce(F.try_divide(F.sum("c"), F.sum("n").cast("double")), F.lit(0.0)).alias("avg_confidence"), F.array_join(texts, "\n\n").alias("full_text"),
    )


def side_by_side(corpus: DataFrame, first: DataFrame, second: DataFrame, key: str = "path") -> DataFrame:
    """The corpus with both results (columns first_..., second_...) and ``state``: ok or MISSING."""
    named = lambda rows, name: rows.select(F.col(key), *[F.col(c).alias(f"{name}_{c}") for c in rows.columns if c != key], F.lit(True).alias(f"has_{name}"))
    both = corpus.join(named(first, "first"), key, "left").join(named(second, "second"), key, "left")
    there = F.coalesce(F.col("has_first") & F.col("has_second"), F.lit(False))
    return both.withColumn("state", F.when(there, "ok").otherwise("MISSING")).drop("has_first", "has_second")


def era(path: Column, years: Sequence[int] = (1988, 2005, 2024)) -> Column:
    """The year that a path names as a folder; null for none."""
    out = F.lit(None).cast("string")
    for y in reversed(years):
        out = F.when(path.contains(f"/{y}/"), str(y)).otherwise(out)
    return out


def by_group(rows: DataFrame, group: str) -> DataFrame:
    """For each group: documents, line-weighted confidence of both, mean, least and largest similarity."""
    weighted = lambda s: F.coalesce(F.try_divide(F.sum(F.col(f"{s}_avg_confidence") * F.col(f"{s}_lines")), F.sum(f"{s}_lines").cast("double")), F.lit(0.0))
    return rows.groupBy(group).agg(
        F.count("*").alias("documents"), weighted("first").alias("first_confidence"), weighted("second").alias("second_confidence"),
        *[F.coalesce(f("similarity"), F.lit(0.0)).alias(n) for f, n in ((F.avg, "similarity"), (F.min, "least_similarity"), (F.max, "most_similarity"))],
    )


def corpus_totals(rows: DataFrame) -> DataFrame:
    """Rows (metric, first, second, difference): lines, chars and line-weighted confidence of all
    documents of each engine that have no error; confidence is null without a line."""
    sums = []
    for s in ("first", "second"):
        good = F.col(f"{s}_error").isNull() if f"{s}_error" in rows.columns else F.lit(True)
        lines, chars = (F.coalesce(F.sum(F.when(good, F.col(f"{s}_{c}"))), F.lit(0)).cast("double") for c in ("lines", "chars"))
        weight = F.sum(F.when(good, F.col(f"{s}_avg_confidence") * F.col(f"{s}_lines")))
        sums.append(F.array(lines, chars, F.try_divide(weight, lines)).alias(s))
    both = rows.agg(*sums)
    each = both.select(F.posexplode(F.arrays_zip("first", "second")).alias("k", "x"))
    name = F.element_at(F.array(*map(F.lit, ("lines", "chars", "confidence"))), F.col("k") + 1)
    return each.select(name.alias("metric"), "x.first", "x.second", (F.col("x.first") - F.col("x.second")).alias("difference"))


def save_comparison(rows: DataFrame, path: str, key: str = "path") -> None:
    """Write both engines' results of each document as JSON lines: engine, key and the engine's figures."""
    sides = []
    for s in ("first", "second"):
        own = [c for c in rows.columns if c.startswith(f"{s}_")]
        sides.append(rows.select(F.lit(s).alias("engine"), key, *[F.col(c).alias(c.removeprefix(f"{s}_")) for c in own]))
    sides[0].unionByName(sides[1], allowMissingColumns=True).write.mode("overwrite").json(path)
