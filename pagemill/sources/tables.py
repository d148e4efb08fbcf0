"""Tables, file inventories, samples, manifests and saved runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "seed int, source_path string, count int, host_paths array<string>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def database(spark: SparkSession, url: str, query: str, by: str | None = None, parts: int = 16, **options: str) -> DataFrame:
    """Rows of a query over JDBC; a driver for the database must be on the class path.

    With a numeric or time column ``by`` the rows are read in ``parts`` ranges of it, each a task
    and a connection of its own (the first one also reads nulls); without, in one task.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if by is None:
        return reader.option("query", query).load()
    ends = reader.option("query", f"SELECT min({by}) AS lo, max({by}) AS hi FROM ({query}) ranged").load().first()
    reader = spark.read.format("jdbc").options(url=url, **options)
    if ends[0] is None:
        return reader.option("query", query).load()
    return reader.options(dbtable=f"({query}) ranged", partitionColumn=by, lowerBound=str(ends[0]), upperBound=str(ends[1]), numPartitions=str(parts)).load()


def inventory(spark: SparkSession, root: str, suffix: str = ".pdf") -> DataFrame:
    """Rows (path, length) of all files below ``root`` with that suffix (case matters).

    Names may hold any character, colons too; only names are read, not contents.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select("path", "length").where(F.col("path").endswith(suffix))


def sampled(files: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """``count`` files at most, those of the least digests of path and seed; the same ones for the same seed."""
    return files.orderBy(F.md5(F.concat("path", F.lit(str(seed)))), *files.columns).limit(count)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows (ordinal, path) of a saved sample; none if it names no files."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.posexplode("host_paths").alias("ordinal", "path"))


def usable_manifest(listed: DataFrame, inventory: DataFrame) -> DataFrame:
    """A saved sample, or no rows if the first file that it names is gone."""
    first = listed.where("ordinal = 0").join(inventory.select("path"), "path", "left_semi").select(F.lit(True).alias("there"))
    return listed.crossJoin(F.broadcast(first.limit(1))).drop("there")


def save_manifest(files: DataFrame, path: str, seed: int, source_path: str) -> None:
    """Write a sample (of a bounded number of files) as one JSON row below ``path``."""
    row = files.agg(F.lit(seed).alias("seed"), F.lit(source_path).alias("source_path"), F.count("*").cast("int").alias("count"), F.array_sort(F.collect_list("path")).alias("host_paths"))
    row.coalesce(1).write.mode("overwrite").json(path)


def saved_run(spark: SparkSession, path: str, numbers: list[str]) -> DataFrame:
    """The figures of an earlier run as one row; those it hasn't are 0.

    A run that can't be read, or isn't whole JSON, is an error when it is read and not a run of zeros.
    """
    schema = ", ".join(f"`{n}` double" for n in numbers)
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").select(*[F.coalesce(n, F.lit(0.0)).alias(n) for n in numbers])


def save_run(run: DataFrame, path: str) -> None:
    run.coalesce(1).write.mode("overwrite").json(path)


def answers(spark: SparkSession, path: str) -> DataFrame:
    """Saved JSON answers of a recognition service, one in each file: rows (path, value)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")


def letters(path: str) -> list[str]:
    """The recogniser's letters from a file of one a line: a blank first, a space last."""
    with open(path, encoding="utf-8") as f:
        return ["blank", *(line.rstrip("\n") for line in f), " "]


def sampled_windows(samples: DataFrame, at: str, value: Column, every: str = "2 seconds") -> DataFrame:
    """Mean and number of samples in tumbling windows: rows (start, mean, samples)."""
    own = samples.groupBy(F.window(at, every).alias("w")).agg(F.avg(value).alias("mean"), F.count(value).alias("samples"))
    return own.select(F.col("w.start").alias("start"), "mean", "samples")
