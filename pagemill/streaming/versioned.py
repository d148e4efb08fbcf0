"""A table by key that changes batch by batch, and goes on after a restart."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.pageplan import batches

Change = Callable[[DataFrame, DataFrame], DataFrame]
LOG = "version long, writer string, number long, parts int, part int, folder string, rows long"

#: Rows of a part beyond which the table is dealt into twice as many parts.
ROWS_OF_PART = 1_000_000
#: Entries of the log after which they are put together, and folders that nothing names removed.
ENTRIES = 50
#: Folders of a part beyond which it is written anew.
FOLDERS = 32


@dataclass
class State:
    """What the log says: the last version, into how many parts the table is dealt, the newest
    (version, folder, rows) of each part, and the last batch of each writer. A part that batches
    were added to lies in several folders, named together with ``|`` between them."""

    version: int
    parts: int
    newest: dict[int, tuple[int, str | None, int]]
    written: dict[str, int]
    entries: int

    def folders(self, part: int) -> list[str]:
        folder = self.newest.get(part, (-1, None, 0))[1]
        return folder.split("|") if folder else []


class VersionedTable:
    """Rows are dealt into parts by a hash of their key, into more of them as the table grows.

    A batch reads the parts that its keys touch, writes them anew (or adds to them, where a change
    is by key and all keys are new) into a folder of its own, and then adds one file to the log,
    which appears whole or not at all: it names the folders of each part, the writer, and the
    writer's number of the batch. Readers take the newest folders of each part. So what a broken-off batch has written is never read, and a batch that comes again after
    it was logged isn't applied again. Each stream is a writer of its own, and so is each caller
    that numbers its batches; versions are counted over all of them. Only one writer may write at a
    time. Every ENTRIES entries the log is put together, and folders that the versions before the
    last one alone have named are removed: readers have one version's time to finish.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str, parts: int = 16):
        self.spark, self.folder, self.schema, self.key, self.first_parts = spark, folder, schema, key, parts
        spark.createDataFrame([], LOG).write.mode("ignore").parquet(f"{folder}/log")

    def state(self) -> State:
        log = self.spark.read.schema(LOG).parquet(f"{self.folder}/log")
        # a row for each part of each layout and for each writer
        last = log.groupBy("parts", "part", "writer").agg(F.max_by(F.struct("version", "folder", "rows"), "version").alias("last"), F.max("number").alias("number"), F.count_distinct("version").alias("n")).collect()
        parts = max((r for r in last if r["part"] >= 0), key=lambda r: (r["last"]["version"], r["parts"]), default={"parts": self.first_parts})["parts"]
        newest: dict[int, tuple[int, str | None, int]] = {}
        written: dict[str, int] = {}
        for r in last:
            written[r["writer"]] = max(r["number"], written.get(r["writer"], -1))
            if r["parts"] == parts and r["part"] >= 0:
                newest[r["part"]] = max(newest.get(r["part"], (-1, None, 0)), tuple(r["last"]), key=lambda x: x[0])
        return State(max((r["last"]["version"] for r in last), default=-1), parts, newest, written, sum(r["n"] for r in last if r["part"] < 0))

    def newest(self) -> list[tuple[int, int, str | None]]:
        """(version, part, folder) of every part that was ever written; the folder is null if it is empty."""
        return [(version, part, folder) for part, (version, folder, _) in self.state().newest.items()]

    @property
    def version(self) -> int:
        """How many batches were applied, less one; -1 before the first."""
        return self.state().version

    def read(self) -> DataFrame:
        """The table as it is now."""
        return self.rows_of(self.state())

    def rows_of(self, state: State, only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.folder}/{folder}/versioned_part={part}" for part in state.newest if only is None or part in only for folder in state.folders(part)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def part_of(self, parts: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(parts)).cast("int").alias("versioned_part")

    def holding(self, state: State, batch: DataFrame, touched: set[int]) -> set[int]:
        """The parts that hold keys of the batch already, and those that lie in too many folders."""
        held = self.rows_of(state, touched).select(self.key).join(batch.select(self.key), self.key, "left_semi")
        found = {r["versioned_part"] for r in held.select(self.part_of(state.parts)).distinct().collect()}
        return found | {p for p in touched if len(state.folders(p)) >= FOLDERS}

    def update(self, change: Change, batch: DataFrame, number: int | None = None, writer: str = "", by_key: bool = False) -> bool:
        """The table becomes ``change(table, batch)``, unless this writer's batch, or a later one of it, was applied before.

        ``change`` may only return rows of keys that the batch or the touched parts of the table have.
        With ``by_key`` it has to treat each key for itself: then parts that hold none of the
        batch's keys aren't written anew, what the batch has for them is added.
        """
        state = self.state()
        number = state.written.get(writer, -1) + 1 if number is None else number
        if number <= state.written.get(writer, -1):
            return False
        batch = batch.persist()
        try:
            grow = any(rows > ROWS_OF_PART for _, _, rows in state.newest.values())
            parts = state.parts * 2 if grow else state.parts
            part = self.part_of(parts)
            touched = {r["versioned_part"] for r in batch.select(part).distinct().collect()}
            if not touched:
                return False
            touched = set(range(parts)) if grow else touched
            anew = self.holding(state, batch, touched) if by_key and not grow else touched
            version = state.version + 1
            folder = f"v{version}-{uuid.uuid4().hex}"
            new = change(self.rows_of(state, None if grow else anew), batch).select("*", part).repartition(len(touched), "versioned_part")
            new.write.partitionBy("versioned_part").parquet(f"{self.folder}/{folder}")
            written = self.spark.read.schema(f"{self.schema}, versioned_part int").parquet(f"{self.folder}/{folder}")
            there = {r["versioned_part"]: r["count"] for r in written.groupBy("versioned_part").count().collect()}
            if not set(there) <= touched:
                raise ValueError("a change returned rows of keys that are neither in the batch nor in its parts of the table")
            before = {p: ([], 0) if p in anew else (state.folders(p), state.newest.get(p, (-1, None, 0))[2]) for p in touched}
            rows = [(version, writer, number, parts, p, "|".join(before[p][0] + [folder] * (p in there)) or None, before[p][1] + there.get(p, 0)) for p in sorted(touched)]
            self.commit([*rows, (version, writer, number, parts, -1, None, 0)])
        finally:
            batch.unpersist()
        if state.entries >= ENTRIES:
            self.compact()
        return True

    def commit(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def compact(self) -> None:
        """Put the log together and remove folders that it no longer names, but for the last version's."""
        old = self.spark.read.parquet(f"{self.folder}/log").inputFiles()
        state = self.state()
        rows = [(version, "", -1, state.parts, part, folder, n) for part, (version, folder, n) in state.newest.items()]
        self.commit([*rows, *((state.version, writer, number, state.parts, -1, None, 0) for writer, number in state.written.items())])
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for name in old:  # whoever reads both old and new entries finds the same state
            files.delete(hadoop.Path(name), False)
        named = {folder for part in state.newest for folder in state.folders(part)}
        for found in files.listStatus(path):
            name = found.getPath().getName()
            if name.startswith("v") and name not in named and int(name[1:].split("-")[0]) < state.version:
                files.delete(found.getPath(), True)

    def apply(self, change: Change, most_rows: int | None = None) -> Callable[[DataFrame, int], None]:
        """For foreachBatch: the table becomes ``change(table, batch)``.

        With ``most_rows`` a batch is applied in pieces of so many rows, each logged for itself; a
        batch that broke off goes on with the piece that is missing.
        """

        def run(batch: DataFrame, number: int) -> None:
            writer = writer_of(batch)
            if most_rows is None:
                self.update(change, batch, number, writer)
                return
            # The same rows get the same pieces if the batch comes again: equal digests are equal rows.
            dealt = batches(batch.withColumn("__digest", F.xxhash64(*batch.columns)), "__digest", most_rows).persist()
            try:
                pieces = dealt.agg(F.max("batch")).first()[0]
                for k in range(0 if pieces is None else pieces + 1):
                    self.update(change, dealt.where(F.col("batch") == k).select(*batch.columns), number << 24 | k, writer)
            finally:
                dealt.unpersist()

        return run


def writer_of(batch: DataFrame) -> str:
    """The stream that a batch of foreachBatch belongs to, as its checkpoint names it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
