"""Conflict-constrained best-fit packing (operator 3).

Documents are cut into pieces of at most ``CAPACITY`` tokens (words, and one end mark for each
document) and packed into bins of that capacity. A bin never holds two pieces of one source, of
one duplicate cluster or of one document. Bins are ordered by what is left in them; each carries a
bitmap of its sources and one of its clusters. For a piece, the search starts at the tightest bin
it fits into and goes on to the next as long as bins are in conflict, so the tightest compatible
bin is found; without any, a new bin is opened. Longer pieces go first.

Pieces are dealt by a hash into groups of about ``GROUP`` pieces and each group is packed by one
task, so a hot source or a large cluster is spread evenly and no task grows with the data; the
search is for the tightest bin of the group, and what that costs is in the README. Only ids,
lengths and digests move, never texts, and texts are read once. Full pieces of long documents need
no search: a bin of their own. Hash and order follow from what a row says and from its number among
equal rows, so neither the table's partitions nor a task that runs again change a bin.

Null and empty texts are one piece of one token (the end mark). A null source is no source, and
conflicts with nothing; a null id keeps its row. Repeated rows are packed each, and are in one
cluster. An empty table gives an empty result; further columns aren't read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import stored, table

#: Tokens in a bin, and pieces that a task packs together.
CAPACITY, GROUP = 2048, 1500


class Bits(dict):
    """A bit for each name; names that conflict with nothing (null, or met once) have none."""

    def __init__(self, names):
        super().__init__((name, 1 << k) for k, name in enumerate(n for n, c in Counter(names).items() if c > 1 and n is not None))

    def __missing__(self, name) -> int:
        return 0


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Bin and offset of each piece; longest first, ties in the given order."""
    of_source, of_cluster = Bits(sources), Bits(clusters)
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    left: list[tuple[int, int]] = []  # (tokens left, bin), ascending
    held: list[tuple[int, int]] = []  # of each bin: bitmaps of sources and clusters
    out = [(0, 0)] * len(lengths)
    for k in order:
        n, source, cluster = lengths[k], of_source[sources[k]], of_cluster[clusters[k]]
        at = bisect_left(left, (n, -1))
        while at < len(left):
            in_source, in_cluster = held[left[at][1]]
            if not in_source & source and not in_cluster & cluster:
                break
            at += 1
        if at < len(left):
            room, place = left.pop(at)
            in_source, in_cluster = held[place]
            held[place] = in_source | source, in_cluster | cluster
        else:
            room, place = capacity, len(held)
            held.append((source, cluster))
        out[k] = place, capacity - room
        if room > n:
            insort(left, (room - n, place))
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Rows (id, piece, start, n_tokens, bin, bin_offset), one for each piece of each row.

    ``start`` is the piece's first token in its document. Clusters are given by a column, or are
    the documents with equal texts.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.md5(text)
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"), (F.regexp_count(text, F.lit(r"\S+")) + 1).cast("long").alias("total"))
    rows = stored(rows.groupBy("id", "source", "cluster", "total").agg(F.count("*").alias("times")), "packing-rows")
    rows = rows.select("id", "source", "cluster", "total", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth"))
    said = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("id", "source", "cluster", "total", "nth")]
    rows = rows.withColumn("row", F.md5(F.concat_ws("\x1f", *said)))
    whole = (F.col("total") / capacity).cast("long")
    pieces = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("total") / capacity) - 1)
    rows = rows.select("id", "source", "cluster", "row", "total", whole.alias("whole"), F.explode(pieces).alias("piece"))
    rows = rows.withColumn("start", F.col("piece") * capacity).withColumn("n_tokens", F.least(F.lit(capacity), F.col("total") - F.col("start")))
    full = rows.where("piece < whole").select(
        "id", "piece", "start", "n_tokens", F.concat(F.lit("full-"), F.col("row"), F.lit("-"), F.col("piece")).alias("bin"), F.lit(0).cast("long").alias("bin_offset")
    )
    rest = rows.where("piece >= whole")
    groups = max(1, -(-docs.count() // GROUP))
    rest = rest.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))

    def run(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("row")
        names = batch["source"].astype(object).where(batch["source"].notna(), None).tolist()
        placed = best_fit(batch["n_tokens"].tolist(), names, batch["cluster"].tolist(), capacity)
        bins = [f"{key[0]}-{b}" for b, _ in placed]
        return batch[["id", "piece", "start", "n_tokens"]].assign(bin=bins, bin_offset=[o for _, o in placed])

    packed = rest.groupBy("group").applyInPandas(run, f"id {kind}, piece long, start long, n_tokens long, bin string, bin_offset long")
    return full.unionByName(packed).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the bins of all documents."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of the documents that came this far."""
    return pack(docs.select("doc_id", "text", "source"))
