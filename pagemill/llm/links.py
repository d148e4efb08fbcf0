"""From candidate pairs to classes: verification of pairs and connected components.

Everything is a join or an aggregation over pairs, never over all pairs of a group: a bucket of
documents that share a sketch gives one pair for each member and its smallest member (a star), and
only members that the verified stars left in different components are compared further.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import discard, stored, trim


def stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of the smallest member of each bucket and each other one; rows (bucket, id)."""
    pivots = members.groupBy(F.col("bucket").alias("of")).agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("of", "a")
    return members.join(pivots, F.col("bucket") == F.col("of")).where("id <> a").select("a", F.col("id").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (id, class) for every id that a link (a, b) names: the smallest id it is linked to.

    Alternating stars: each round hangs the larger neighbours of every node, then all smaller ones,
    onto the smallest. Each round at least halves the longest chain; they end when no edge changes,
    however many that takes. Edges are written between rounds.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("of")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("of")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, stored(small.unionByName(low.select(F.col("of").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        discard(last)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("class"))
    return ids.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("class"))).distinct()


def verified(pairs: DataFrame, content: DataFrame, similarity: Callable[[bytes, bytes], float], least: float) -> DataFrame:
    """Those pairs (a, b) whose contents, rows (id, content), have at least that similarity."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([similarity(x, y) for x, y in zip(batch["first"], batch["second"], strict=True)], float)
            yield batch.loc[found >= least, ["a", "b"]].assign(similarity=found[found >= least])
            trim()

    second = content.select(F.col("id").alias("b"), F.col("content").alias("second"))
    first = content.select(F.col("id").alias("a"), F.col("content").alias("first"))
    kinds = dict(pairs.dtypes)
    return pairs.join(second, "b").join(first, "a").select("a", "b", "first", "second").mapInPandas(judge, f"a {kinds['a']}, b {kinds['b']}, similarity double")
