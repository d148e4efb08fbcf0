"""Approximate nearest neighbours by collision counting (operator 9).

Nearness is the inner product. Vectors get one more component so that all have the length of the
longest, and queries are scaled to it; the largest inner product is then the smallest distance.

An index is ``PROJECTIONS`` arrays, each the vectors of a shard in the order of one random
projection, cut into ``CELLS`` cells of equally many. A query opens a window around its own place
in every array; the windows grow by virtual rehashing (a larger radius over the same cells), and a
vector that lies in at least ``THRESHOLD`` of a query's windows has collided often enough. When at
least ``SPARE`` vectors, the share ``SHARE`` and the number asked for have, they are verified by
their exact inner products, in double precision. Nothing is fitted to a sample: every vector is
indexed, at every size by the same rule.

Windows are bitmaps: the vectors below each cell's start are one, so a window is the exclusive or of
two. Collisions of a block of queries with 64 vectors at a time are added up by full adders, whose
highest digit says whether the threshold is reached.

Equal vectors are one entry with its smallest ids, as many as an answer could need; so a vector
that a third of all rows share is searched once. Queries are cut into blocks and vectors into
shards of bounded size; each pair of them is one task, and only the nearest of each are merged.
So all shards are searched for each query: where the nearest are hardly nearer than the rest, as
here, no window could leave a shard out and still find them.

Vectors that are null, zero or hold a null or non-finite component take no part, nor do rows with a
null id. Vectors of another length are never compared. Repeated rows count once; ties go to the
smaller id. An empty table gives an empty result; further columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.common import stored, table

#: A power of two less one, and the same power's half: the highest digit of a count says if it is reached.
PROJECTIONS, THRESHOLD = 255, 128
CELLS = 64
#: Vectors of a shard that are verified at least: so many more than are asked for, and a share of them.
SPARE, SHARE = 80, 0.03
#: Share of a shard's vectors in a query's first windows. The radius grows by GROWTH for each factor
#: of STEP by which the vectors over the threshold are too few, and once more.
FIRST_WINDOW, GROWTH, STEP = 0.43, 1.01, 1.25
#: Vectors in a shard, queries in a block, and queries searched together.
SHARD, BLOCK, LANES = 8192, 4096, 64
NEAREST = 20


def directions(size: int, seed: int) -> np.ndarray:
    """Random directions as columns: of each ``size`` in turn every two are at right angles.

    So the places of a difference on them have its length together, and counts vary less.
    """
    rng = np.random.default_rng(seed)
    return np.concatenate([np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-PROJECTIONS // size))], axis=1)[:, :PROJECTIONS]


class Adder:
    """Adds bitmaps up place by place; ``digits`` are the bitmaps of the sums' binary digits."""

    def __init__(self):
        self.digits: list[np.ndarray] = []
        self.waiting: list[np.ndarray | None] = []

    def add(self, bits: np.ndarray, k: int = 0) -> None:
        if k == len(self.digits):
            self.digits.append(bits)
            self.waiting.append(None)
            return
        other = self.waiting[k]
        if other is None:
            self.waiting[k] = bits
            return
        self.waiting[k] = None
        own = self.digits[k]
        odd = other ^ bits
        other &= bits
        bits = own & odd
        bits |= other
        odd ^= own
        self.digits[k] = odd
        self.add(bits, k + 1)


class Index:
    """The projections of a shard's vectors: where their cells begin, and the vectors below each."""

    def __init__(self, vectors: np.ndarray, longest: float, seed: int = 23):
        self.vectors, self.longest = vectors, longest
        n = len(vectors)
        rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
        self.lines = directions(vectors.shape[1] + 1, seed)
        places = np.ascontiguousarray((np.c_[vectors, rest] @ self.lines).T)
        order = np.argsort(places, axis=1, kind="stable")
        starts = np.arange(CELLS + 1) * n // CELLS
        self.edges = np.take_along_axis(places, order[:, starts[:-1]], 1)
        self.below = np.zeros((PROJECTIONS, CELLS + 1, -(-n // 64) * 8), np.uint8)
        rank = np.empty(n, np.int32)
        for j in range(PROJECTIONS):
            rank[order[j]] = np.arange(n, dtype=np.int32)
            self.below[j, :, : -(-n // 8)] = np.packbits(rank < starts[:, None], axis=1)
        self.below = self.below.view(np.uint64)

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Numbers and inner products of the vectors that are nearest to each query."""
        n = len(self.vectors)
        lengths = np.sqrt((queries**2).sum(1))
        centres = (queries * (self.longest / lengths)[:, None]) @ self.lines[:-1]
        out = []
        for a in range(0, len(queries), LANES):
            collided = self.collided(centres[a : a + LANES], min(n, k + SPARE + int(SHARE * n)))
            for own, query in zip(collided, queries[a : a + LANES], strict=True):
                found = np.flatnonzero(np.unpackbits(own.view(np.uint8), count=n))
                scores = np.einsum("ij,j->i", self.vectors[found], query)
                if len(found) > k:  # all that tie with the last one stay
                    keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                    found, scores = found[keep], scores[keep]
                out.append((found, scores))
        return out

    def collided(self, centres: np.ndarray, needed: int) -> np.ndarray:
        """Bitmaps of the vectors that reach the threshold, at the first radius where enough do."""
        gaps = np.abs(self.edges[None, :, CELLS // 16 :: CELLS // 8] - centres[:, :, None])
        radius = np.maximum(np.quantile(gaps.reshape(len(centres), -1), FIRST_WINDOW, axis=1), 1e-9 * max(self.longest, 1e-300))
        out = np.zeros((len(centres), self.below.shape[2]), np.uint64)
        active = np.arange(len(centres))
        while len(active):
            adder = Adder()
            for j, edges in enumerate(self.edges):
                low = edges.searchsorted(centres[active, j] - radius, "right") - 1
                high = edges.searchsorted(centres[active, j] + radius, "right")
                window = self.below[j].take(high, axis=0)
                window ^= self.below[j].take(np.maximum(low, 0), axis=0)
                adder.add(window)
            out[active] = adder.digits[-1]
            reached = np.bitwise_count(out[active]).sum(1)
            few = reached < needed
            lacking = np.log(needed / np.maximum(reached[few], 1)) / np.log(STEP)
            active, radius = active[few], radius[few] * GROWTH ** (1 + lacking)
        return out


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def nearest(rows: DataFrame, is_query: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, id, score): the k nearest rows of every row for which ``is_query`` holds.

    ``is_query`` is a condition on the column ``id``.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("key", F.concat_ws("_", F.xxhash64("vector"), F.hash("vector")))
    first = F.row_number().over(Window.partitionBy("key", "id").orderBy("key"))  # repeated rows count once
    rows = rows.withColumn("nth", first).where("nth = 1").drop("nth")
    few = rows.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("nth") <= k + 1)
    asks = rows.where(is_query).select("key").distinct().withColumn("asks", F.lit(True))
    entries = few.groupBy("key").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids"))
    entries = stored(entries.join(asks, "key", "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    n, queries, longest = entries.agg(F.count("*"), F.coalesce(F.count_if("asks"), F.lit(0)), F.sqrt(F.max(square))).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-queries // BLOCK))

    def run(key: tuple, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held) and len(asked):
            held = held.sort_values("key", kind="stable")
            index = Index(np.stack(held["vector"].to_numpy()).astype(np.float64), longest)
            for name, (found, scores) in zip(asked["asker"], index.search(np.stack(asked["wanted"].to_numpy()).astype(np.float64), k + 1), strict=True):
                out.append(pd.DataFrame({"key": name, "ids": held["ids"].to_numpy()[found], "score": scores}))
        none = {"key": pd.Series([], dtype=object), "ids": pd.Series([], dtype=object), "score": pd.Series([], dtype=float)}
        return pd.concat(out) if out else pd.DataFrame(none)

    size = F.size("vector").alias("dim")
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")
    block = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).alias("block")
    held = entries.select("key", "vector", "ids", size, shard, F.explode(upto(blocks)).alias("block"))
    asked = entries.where("asks").select(F.col("key").alias("asker"), F.col("vector").alias("wanted"), size, block, F.explode(upto(shards)).alias("shard"))
    asked = asked.toDF("asker", "wanted", "of_dim", "of_block", "of_shard")
    found = held.groupBy("dim", "shard", "block").cogroup(asked.groupBy("of_dim", "of_shard", "of_block")).applyInPandas(run, f"key string, ids array<{kind}>, score double")
    best = Window.partitionBy("key").orderBy(F.desc("score"), F.col("ids")[0])
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).select("key", "ids", "score")
    asking = rows.where(is_query).select(F.col("id").alias("query_id"), "key")
    pairs = asking.join(found, "key").select("query_id", F.explode("ids").alias("id"), "score").where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the 20 nearest of every vector whose vec_id is divisible by 20."""
    found = nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")
