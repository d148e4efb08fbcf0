"""Jobs in a stream: pages counted once, polls counted until a good one, and the newest ended jobs.

State is kept by key on disk (the state store's), and only the keys of a batch are read and written.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pagemill.functions.texts import is_not_found
from pagemill.operators.jobs import ENDED, polled, status_of
from pagemill.streaming.versioned import VersionedTable, writer_of

#: Pages of one range of a job, and parts that a job's ranges are dealt into.
CHUNK, PARTS = 1 << 14, 16
#: The part of a job that holds its submission.
WHOLE = -1
#: Groups that parts of jobs are dealt into, for as long as a stream goes on. A group's state is one
#: entry, so a row makes no more than that be written anew.
GROUPS = 1 << 14

COUNTED = "job_id long, part int, total_pages long, processed_pages long, failed_pages long, dropped_pages long, last_page long"
ROW = ["job_id", "part", "kind", "page", "failed", "total_pages"]
KINDS = ("page", "dropped", "submitted", "forget")
PAGE, DROPPED, SUBMITTED, FORGET = range(4)
#: What stands for a number that isn't there.
NONE = np.iinfo(np.int64).min


def packed(columns: np.ndarray) -> bytes:
    """Whole numbers, a row for each column, as bytes: differences, as sorted numbers differ little."""
    return zlib.compress(np.diff(columns, prepend=np.int64(0), axis=1).tobytes(), 1)


def unpacked(data: bytes, columns: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int64).reshape(columns, -1), axis=1)


class PageCounts:
    """Counts the pages of the parts of jobs of a group, each once of each kind; the first result of a page counts.

    The state holds a column for each part of a job (job, part, total, done, failed, dropped, last
    page, time of its last row) and one for each page that was seen (place of its part, kind,
    page), in order.
    """

    STATE = "parts binary, pages binary"

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def held(self, state: GroupState, now: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts and the pages of the state, without parts that are too old."""
        if not state.exists:
            return np.zeros((8, 0), np.int64), np.zeros((3, 0), np.int64)
        parts, pages = (unpacked(data, n) for data, n in zip(state.get, (8, 3), strict=True))
        return parts, pages if self.ttl_ms is None else pages[:, now - parts[7][pages[0]] < self.ttl_ms]

    def keep(self, state: GroupState, parts: np.ndarray, pages: np.ndarray, now: int) -> None:
        """The state from now on: the parts that count anything, and their pages."""
        counts = (parts[2] != NONE) | (parts[3] > 0) | (parts[5] > 0)
        place = np.cumsum(counts) - 1
        parts, pages = parts[:, counts], pages[:, counts[pages[0]]]
        if not parts.size:
            state.remove()
            return
        state.update((packed(parts), packed(np.vstack([place[pages[0]], pages[1:]]))))
        if self.ttl_ms is not None:
            state.setTimeoutDuration(max(1, int(parts[7].min()) + self.ttl_ms - now))

    def __call__(self, key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        parts, pages = self.held(state, now)
        batch = [*rows]  # a micro-batch's rows of one group; none if a timer has woken it
        job, part, kind, page, failed, total = (np.concatenate([np.zeros(0, np.int64), *(b[c].to_numpy(np.int64) for b in batch)]) for c in ROW)
        # each part of a job that is held or comes has its place
        ids, place = np.unique(np.hstack([parts[:2], np.vstack([job, part])]), axis=1, return_inverse=True)
        place = place.reshape(-1)
        old, at = place[: parts.shape[1]], place[parts.shape[1] :]
        new = np.vstack([ids, np.zeros((6, ids.shape[1]), np.int64)])
        new[2], new[6] = NONE, NONE
        new[2:, old] = parts[2:]
        gone = np.zeros(ids.shape[1], bool)
        gone[at[kind == FORGET]] = True
        if self.ttl_ms is not None:
            gone |= (now - new[7] >= self.ttl_ms) & np.isin(np.arange(ids.shape[1]), old)
        new[2:, gone] = np.array([[NONE], [0], [0], [0], [NONE], [now]])
        pages = np.vstack([old[pages[0]], pages[1:]])
        pages = pages[:, ~gone[pages[0]]]

        asked = kind == SUBMITTED
        np.maximum.at(new[2], at[asked], total[asked])
        done = kind == PAGE
        np.maximum.at(new[6], at[done], page[done])
        came = done | (kind == DROPPED)
        every = np.hstack([pages, np.vstack([at[came], kind[came], page[came]])])
        order = np.lexsort(every[::-1])  # stable: what was seen before stays before what comes
        every = every[:, order]
        first = np.ones(len(order), bool)
        first[1:] = (every[:, 1:] != every[:, :-1]).any(axis=0)
        fresh = first & (order >= pages.shape[1])
        bad = np.zeros(len(order), bool)
        bad[fresh] = failed[came][order[fresh] - pages.shape[1]] == 1
        count = lambda which: np.bincount(every[0, which], minlength=ids.shape[1])
        new[3] += count(fresh & (every[1] == PAGE))
        new[4] += count(bad & (every[1] == PAGE))
        new[5] += count(fresh & (every[1] == DROPPED))
        touched = np.unique(at)
        new[7, touched] = now
        self.keep(state, new, every[:, first], now)
        if touched.size:
            out = new[:, touched]
            whole = lambda x: pd.arrays.IntegerArray(x, x == NONE)
            yield pd.DataFrame({"job_id": out[0], "part": out[1].astype(np.int32), "total_pages": whole(out[2]), "processed_pages": out[3], "failed_pages": out[4], "dropped_pages": out[5], "last_page": whole(out[6])})


def job_states(events: DataFrame, ttl_ms: int | None = None, parts: int = PARTS) -> DataFrame:
    """A stream of what happens to jobs, rows (job_id, kind, page, failed, total_pages), as counts of parts of jobs.

    The kind is ``submitted`` (with the number of pages that are expected), ``page`` (a result),
    ``dropped`` (a page that won't come) or ``forget`` (the job is no longer wanted). Each page
    counts once of each kind, the first time that it comes, whether its job is known by then or
    not. A job's pages are dealt into ``parts`` parts by ranges of their numbers, so a job of many
    pages is many tasks' work; its submission is a part of its own. A job that is forgotten starts
    anew with whatever comes after it, and in the same batch. With ``ttl_ms`` parts that nobody
    forgets go when no row of them has come for so long, so it has to be longer than jobs take.

    Parts of jobs are dealt into GROUPS groups by a hash, whose rows of a batch are counted
    together, so that many small jobs don't cost a call each. Rows without a job count for nobody.
    The rows that come out are to replace those of their (job_id, part): see :func:`replaced` and
    :func:`summed`.
    """
    part = F.pmod(F.floor(F.col("page") / CHUNK), F.lit(parts)).cast("int")
    every = F.sequence(F.lit(WHOLE), F.lit(parts - 1))
    own = events.select("job_id", "kind", "page", "failed", "total_pages").where("job_id is not null")
    own = own.where((F.col("kind").isin("page", "dropped") & F.col("page").isNotNull()) | F.col("kind").isin("submitted", "forget"))
    own = own.withColumn("part", F.explode(F.when(F.col("kind") == "forget", every).otherwise(F.array(F.when(F.col("kind") == "submitted", WHOLE).otherwise(part)))))
    code = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    own = own.select(F.pmod(F.xxhash64("job_id", "part"), F.lit(GROUPS)).cast("int").alias("group"), F.col("job_id").cast("long").alias("job_id"), "part", code.cast("int").alias("kind"), zero("page"), zero("failed"), zero("total_pages"))
    count = PageCounts(ttl_ms)
    return own.groupBy("group").applyInPandasWithState(lambda key, rows, state: count(key, rows, state), COUNTED, PageCounts.STATE, "append", GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def tracked(results: DataFrame, ttl_ms: int | None = None, parts: int = PARTS) -> DataFrame:
    """A stream of results (job_id, page, failed) as counts of parts of jobs, known or not."""
    return job_states(results.select("job_id", F.lit("page").alias("kind"), "page", "failed", F.lit(None).cast("long").alias("total_pages")), ttl_ms, parts)


def replaced(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Counts after a batch: its rows in the place of those of the same part; parts without any count go."""
    rest = table.join(batch.select("job_id", "part"), ["job_id", "part"], "left_anti")
    return rest.unionByName(batch).where("total_pages is not null or processed_pages > 0 or dropped_pages > 0")


def summed(counts: DataFrame, known_only: bool = True) -> DataFrame:
    """Rows (job_id, total_pages, processed_pages, failed_pages, dropped_pages, last_page) from the counts of parts.

    A job is known once its submission has come; until then, and after it is forgotten, it has no row.
    """
    own = counts.groupBy("job_id").agg(*[F.sum(c).alias(c) for c in ("total_pages", "processed_pages", "failed_pages", "dropped_pages")], F.max("last_page").alias("last_page"))
    return own.where("total_pages is not null") if known_only else own


def with_status(states: DataFrame) -> DataFrame:
    return states.withColumn("status", status_of(F.col("total_pages"), F.col("processed_pages"), F.col("failed_pages"), F.col("dropped_pages")))


ACTIONS = "job_id long, at timestamp, action string, not_found int"


class PollCounts(StatefulProcessor):
    """Counts how often in a row a job wasn't found, and wakes up when it is too old."""

    def __init__(self, most_misses: int, most_age_ms: int):
        self.most_misses, self.most_age_ms = most_misses, most_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("polls", "misses int, wakes long")

    def end(self) -> None:
        if self.state.exists():
            self.handle.deleteTimer(self.state.get()[1])
            self.state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("at", kind="stable")  # a micro-batch's polls of one job
        misses, wakes = self.state.get() if self.state.exists() else (0, None)
        actions, counts, over = [], [], False
        for missed, meant in zip(batch["missed"].fillna(False), batch["meant"], strict=True):
            misses = misses + 1 if missed else 0
            action = ("abandoned" if misses >= self.most_misses else "wait") if missed else meant
            actions.append(action)
            counts.append(misses)
            over = action != "wait"
            misses = 0 if over else misses
        if over:
            self.end()
        else:
            if wakes is None:
                wakes = timerValues.getCurrentProcessingTimeInMs() + self.most_age_ms
                self.handle.registerTimer(wakes)
            self.state.update((misses, wakes))
        yield pd.DataFrame({"job_id": key[0], "at": batch["at"].to_numpy(), "action": actions, "not_found": counts})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        misses = self.state.get()[0] if self.state.exists() else 0
        self.state.clear()
        yield pd.DataFrame({"job_id": [key[0]], "at": pd.to_datetime([expiredTimerInfo.getExpiryTimeInMs()], unit="ms"), "action": ["abandoned"], "not_found": [misses]})

    def close(self) -> None:
        pass


def poll_stream(polls: DataFrame, most_misses: int = 3, most_age: float = 600) -> DataFrame:
    """A stream of polls (job_id, at, status, error, age, processed, dropped, total) as rows of ACTIONS.

    What a poll means is :func:`pagemill.operators.jobs.polled`; that a job wasn't found counts in
    a row, a poll that finds it starts anew. A job of which no poll has told the end ``most_age``
    seconds after its first one is abandoned by a timer, polled again or not. What ended is
    forgotten.
    """
    zero = F.lit(0)
    meant = polled(F.col("status"), F.col("error"), zero, F.col("age"), F.col("processed"), F.col("dropped"), F.col("total"))
    own = polls.where("job_id is not null").select("job_id", "at", F.coalesce(is_not_found(F.col("error")), F.lit(False)).alias("missed"), meant.alias("meant"))
    return own.groupBy("job_id").transformWithStateInPandas(PollCounts(most_misses, int(most_age * 1000)), ACTIONS, "append", "processingTime")


def newest_ended(kept: VersionedTable, forgotten: str, most: int = 100, oldest: float = 1800) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over ended jobs (job_id, ended, status): ``kept`` holds the newest ``most`` of all of them.

    Jobs more than ``oldest`` seconds older than the newest one go too. Each batch is merged with
    what was kept, so no more than ``most`` rows of a task and of the table meet. Jobs that go are
    written to the folder ``forgotten`` as events that make :func:`job_states` forget them.
    """

    def newest(rows: DataFrame) -> DataFrame:
        top = rows.orderBy(F.desc("ended"), F.desc("job_id")).limit(most)
        clock = top.agg(F.max("ended").alias("clock"))
        return top.join(F.broadcast(clock), F.unix_micros("clock") - F.unix_micros("ended") <= int(oldest * 1_000_000)).drop("clock")

    def change(table: DataFrame, batch: DataFrame) -> DataFrame:
        return newest(table.join(batch.select("job_id"), "job_id", "left_anti").unionByName(batch))

    def run(batch: DataFrame, number: int) -> None:
        ended = batch.where(F.col("status").isin(*ENDED)).select("job_id", "ended", "status")
        once = ended.groupBy("job_id").agg(F.max_by(F.struct("ended", "status"), "ended").alias("last")).select("job_id", "last.*").persist()
        try:
            before = kept.read()
            gone = before.select("job_id").union(once.select("job_id")).distinct().join(change(before, once).select("job_id"), "job_id", "left_anti")
            events = gone.select("job_id", F.lit("forget").alias("kind"), F.lit(None).cast("long").alias("page"), F.lit(None).cast("boolean").alias("failed"), F.lit(None).cast("long").alias("total_pages"))
            writer = writer_of(batch)
            events.write.mode("overwrite").parquet(f"{forgotten}/{writer or 'batch'}-{number}")
            kept.update(change, once, number, writer)
        finally:
            once.unpersist()

    return run
