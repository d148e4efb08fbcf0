"""Results that arrive as a stream, applied in micro-batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from pagemill import session
from pagemill.streaming.states import ACTIONS, COUNTED, job_states, newest_ended, poll_stream, replaced, summed, tracked, with_status
from pagemill.streaming.versioned import Change, VersionedTable

__all__ = ["ACTIONS", "COUNTED", "Change", "VersionedTable", "applied", "file_stream", "job_states", "newest_ended", "poll_stream", "replaced", "run_through", "shared_dir", "summed", "tracked", "with_status"]


def shared_dir(spark: SparkSession) -> str:
    """A new folder that all executors reach."""
    return f"{session.shared_dir(spark)}/streams/{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, folder: str, name: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of that name (or in the folder of that name) as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true")
    return reader.parquet(f"{folder}/{{{name}}}")  # a pattern of one name: it may be a file or a folder


STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch writes its changes, not the store's files anew; stores are put together now and then.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Timers are looked at when a batch has rows; without this a run through what has arrived would never end.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in a store on disk, which keyed state needs."""
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_through(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Pass all that has arrived to ``each``, batch by batch, from where ``checkpoint`` says."""
    with keyed_state(stream.sparkSession):
        query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def applied(stream: DataFrame, table: VersionedTable, change: Change, mode: str = "append", most_rows: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run all that has arrived through ``change``, batch by batch, and return the table.

    ``checkpoint`` names the stream; by default the table has one. With ``most_rows`` no change
    gets more rows at a time.
    """
    run_through(stream, table.apply(change, most_rows), checkpoint or f"{table.folder}/offsets", mode)
    return table.read()
