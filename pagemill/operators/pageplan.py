"""Planning of work: numbering, batches and groups of crops, and files that exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.geometry import kept_pages
from pagemill.functions.paths import candidates
from pagemill.session import stored

#: Rows that a task numbers, in the mean at most.
ROWS_OF_PART = 200_000
#: Bits of a row's place that count within its task.
WITHIN = 33


def numbered(rows: DataFrame, key: str, name: str = "ordinal") -> DataFrame:
    """Rows numbered from 0 in ascending order of a key, nulls first.

    Rows are dealt by ranges of the key and of a hash of the row, more of them for more rows, so
    hot keys and nulls are split too, as their own order is free. The sorted ranges are written
    once; each row's number is its place in its range and the number of rows in those before it.
    What reaches the driver is one number for each range.
    """
    parts = max(1, -(-rows.count() // ROWS_OF_PART))
    order = [F.col(key).asc_nulls_first(), F.xxhash64(*rows.columns)]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    dealt = stored(dealt, "numbered")
    part = F.shiftright("__place", WITHIN)
    starts, before = [], 0
    for p, n in sorted((r["part"], r["count"]) for r in dealt.groupBy(part.alias("part")).count().collect()):
        starts.append((p, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "__part long, __start long")
    own = dealt.join(F.broadcast(starts), part == F.col("__part"))
    return own.withColumn(name, F.col("__start") + F.col("__place").bitwiseAND(F.lit((1 << WITHIN) - 1))).drop("__part", "__start", "__place")


def batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows with a batch number: ``size`` rows each in the order of the key, the last one shorter."""
    return numbered(rows, key).withColumn("batch", F.floor(F.col("ordinal") / size).cast("long"))


def batches_within(rows: DataFrame, by: list[str], order: Column, size: int) -> DataFrame:
    """Rows with a batch number within each group (a page's crops of one width)."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return rows.withColumn("batch", F.floor((nth - 1) / size).cast("long"))


def page_tasks(files: DataFrame, pages: str = "page_count") -> DataFrame:
    """A row for each page that is worked on, with its number; files without pages have none."""
    return files.withColumn("page", F.explode(kept_pages(F.col(pages))))


def on_disk(rows: DataFrame, inventory: DataFrame, path: str = "path") -> DataFrame:
    """Rows with ``found``: the first name of each path that the inventory (path) holds, else null."""
    tried = rows.select(F.col(path).alias("__path")).distinct().select("__path", F.posexplode(candidates(F.col("__path"))).alias("rank", "name"))
    there = tried.join(inventory.select(F.col("path").alias("name")).distinct(), "name")
    best = there.groupBy("__path").agg(F.min_by("name", "rank").alias("found"))
    return rows.join(best, F.col(path) == F.col("__path"), "left").drop("__path")
