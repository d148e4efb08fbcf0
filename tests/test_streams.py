from __future__ import annotations

import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagemill.operators import jobs
from pagemill.streaming import apply as streams
from pagemill.streaming import states, versioned

EVENTS = "job_id long, kind string, page long, failed boolean, total_pages long"


def total(old, new):
    return old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))


def numbers(spark, rows):
    return spark.createDataFrame(rows, "k string, n long")


def arrivals(spark, tmp_path, schema="k string, n long"):
    """A function that adds rows as one file, and the stream of such files."""
    add = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in.parquet"))
    return add, lambda: streams.file_stream(spark, str(tmp_path), "in.parquet", schema, files_per_batch=1)


def test_a_stream_into_a_table_that_was_changed_by_hand(spark, tmp_path):
    add, stream = arrivals(spark, tmp_path)
    kept = streams.VersionedTable(spark, str(tmp_path / "out"), "k string, n long", "k", 4)
    kept.update(total, numbers(spark, [("a", 1)]))
    kept.update(total, numbers(spark, [("a", 1)]))
    add([("b", 1), ("c", 1)])
    add([("b", 1)])
    assert {tuple(r) for r in streams.applied(stream(), kept, total).collect()} == {("a", 2), ("b", 2), ("c", 1)} and kept.version == 3
    add([("a", 5)])
    assert {tuple(r) for r in streams.applied(stream(), kept, total).collect()} == {("a", 7), ("b", 2), ("c", 1)}


def test_a_second_stream_and_one_whose_checkpoint_is_lost(spark, tmp_path):
    add, stream = arrivals(spark, tmp_path)
    kept = streams.VersionedTable(spark, str(tmp_path / "out"), "k string, n long", "k", 4)
    add([("a", 1)])
    streams.applied(stream(), kept, total)
    add([("b", 1)])
    # another stream begins at its first batch: both of its rows count, once
    other = str(tmp_path / "other")
    assert {tuple(r) for r in streams.applied(stream(), kept, total, checkpoint=other).collect()} == {("a", 2), ("b", 1)}
    assert {tuple(r) for r in streams.applied(stream(), kept, total, checkpoint=other).collect()} == {("a", 2), ("b", 1)}
    # with an upsert, a stream that starts from the beginning leaves the same table
    latest = lambda old, new: old.join(new, "k", "left_anti").unionByName(new)
    assert {r["k"] for r in streams.applied(stream(), kept, latest, checkpoint=str(tmp_path / "lost")).collect()} == {"a", "b"}


def test_no_batch_has_more_rows_than_asked(spark, tmp_path):
    add, stream = arrivals(spark, tmp_path)
    rows = [(f"k{k % 7}", 1) for k in range(53)]
    add(rows)
    sizes = []

    def change(old, new):
        sizes.append(new.count())
        return total(old, new)

    kept = streams.VersionedTable(spark, str(tmp_path / "out"), "k string, n long", "k", 2)
    got = streams.applied(stream(), kept, change, most_rows=20)
    assert sizes == [20, 20, 13] and sum(r["n"] for r in got.collect()) == 53
    # one that breaks off goes on with what is missing
    broken = versioned.VersionedTable(spark, str(tmp_path / "broken"), "k string, n long", "k", 2)
    apply, commit, left = broken.apply(total, 20), broken.commit, [2]

    def fails(entries):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("broke off")
        commit(entries)

    broken.commit = fails
    with pytest.raises(RuntimeError):
        apply(numbers(spark, rows), 0)
    assert sum(r["n"] for r in broken.read().collect()) == 40
    broken.commit = commit
    apply(numbers(spark, rows), 0)
    assert {tuple(r) for r in broken.read().collect()} == {tuple(r) for r in numbers(spark, rows).groupBy("k").agg(F.sum("n")).collect()}


def test_parts_grow_with_the_table_and_the_log_is_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "ROWS_OF_PART", 10)
    monkeypatch.setattr(versioned, "ENTRIES", 4)
    kept = versioned.VersionedTable(spark, str(tmp_path / "t"), "k string, n long", "k", 1)
    rows = [(f"k{k}", 1) for k in range(30)]
    for _ in range(7):
        kept.update(total, numbers(spark, rows))
    state = kept.state()
    assert state.version == 6 and state.parts >= 4 and {tuple(r) for r in kept.read().collect()} == {(k, 7) for k, _ in rows}
    assert max(n for _, _, n in state.newest.values()) < 30 and state.entries <= 4
    folders = [f for f in os.listdir(tmp_path / "t") if f.startswith("v")]
    assert len(folders) <= 4 and sum(f.endswith(".parquet") for f in os.listdir(tmp_path / "t" / "log")) <= 4
    kept.apply(total)(numbers(spark, [("k0", 1)]), 5)  # numbered by hand: the seventh batch was 6
    assert kept.version == 6
    again = versioned.VersionedTable(spark, str(tmp_path / "t"), "k string, n long", "k", 1)
    again.update(total, numbers(spark, [("k0", 1)]))
    assert {r["k"]: r["n"] for r in again.read().collect()}["k0"] == 8


class Jobs:
    def __init__(self, spark, tmp_path, **how):
        self.add, self.stream = arrivals(spark, tmp_path, EVENTS)
        self.kept = streams.VersionedTable(spark, str(tmp_path / "out"), streams.COUNTED, "job_id")
        self.how = how

    def __call__(self, *rows):
        self.add([*rows])
        found = streams.applied(streams.job_states(self.stream(), **self.how), self.kept, streams.replaced)
        return {r["job_id"]: (r["processed_pages"], r["failed_pages"], r["dropped_pages"], r["status"]) for r in streams.with_status(streams.summed(found)).collect()}


def test_jobs_in_a_stream_know_what_they_wait_for(spark, tmp_path):
    run = Jobs(spark, tmp_path)
    assert run((1, "page", 0, False, None), (1, "submitted", None, None, 3), (2, "page", 0, False, None), (1, "page", 0, True, None), (None, "page", 0, False, None), (1, "page", None, False, None)) == {1: (1, 0, 0, "processing")}
    # a page that came before its job counts once the job is known, and once only
    assert run((2, "page", 0, False, None)) == {1: (1, 0, 0, "processing")}
    assert run((2, "submitted", None, None, 1), (1, "page", 1, True, None), (1, "dropped", 2, None, None)) == {1: (2, 1, 1, "completed_with_errors"), 2: (1, 0, 0, "completed")}
    assert run((1, "dropped", 2, None, None), (1, "page", 1, False, None), (2, "submitted", None, None, 1)) == {1: (2, 1, 1, "completed_with_errors"), 2: (1, 0, 0, "completed")}


def test_a_job_that_is_forgotten_and_submitted_again(spark, tmp_path):
    run = Jobs(spark, tmp_path)
    run((1, "submitted", None, None, 2), (1, "page", 0, False, None), (1, "page", 100_000, False, None), (2, "submitted", None, None, 1))
    assert run((1, "forget", None, None, None)) == {2: (0, 0, 0, "processing")}
    assert run((1, "page", 0, False, None)) == {2: (0, 0, 0, "processing")}
    assert run((1, "submitted", None, None, 2), (1, "page", 100_000, True, None))[1] == (2, 1, 0, "completed_with_errors")
    assert run((1, "forget", None, None, None), (1, "submitted", None, None, 1), (1, "page", 0, False, None))[1] == (1, 0, 0, "completed")


def test_many_pages_of_one_job_in_several_parts(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    pages = [rng.randrange(200_000) for _ in range(3000)]
    run = Jobs(spark, tmp_path, parts=5)
    got = run((1, "submitted", None, None, 10**6), *((1, "page", p, p % 3 == 0, None) for p in pages))
    assert got[1][:2] == (len(set(pages)), len({p for p in pages if p % 3 == 0}))
    got = run(*((1, "page", p, True, None) for p in pages[:500]), (1, "page", 200_001, True, None))
    assert got[1][:2] == (len(set(pages)) + 1, len({p for p in pages if p % 3 == 0}) + 1)
    assert run.kept.read().count() == 6  # five parts and the submission


def test_entries_that_nobody_forgets_go_after_a_while(spark, tmp_path):
    run = Jobs(spark, tmp_path, ttl_ms=1500)
    assert run((1, "submitted", None, None, 2), (1, "page", 0, False, None))[1][0] == 1
    time.sleep(3)
    assert run((1, "page", 0, False, None))[1][0] == 1  # seen long ago: it counts as the first page of a new count


def test_many_small_jobs_in_a_few_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(states, "GROUPS", 3)
    rng, run = random.Random(5), Jobs(spark, tmp_path, parts=4)
    counts: dict[int, dict] = {}
    for _ in range(3):
        rows = [(rng.randrange(60), rng.choice(["page"] * 6 + ["dropped", "submitted"]), rng.randrange(-5, 9) * 9_000, False, 7) for _ in range(400)]
        gone = set(rng.sample(range(60), 9))
        for j in gone:
            counts.pop(j, None)
        for j, kind, page, _, total in rows:
            own = counts.setdefault(j, {"page": set(), "dropped": set(), "total": None})
            if kind == "submitted":
                own["total"] = total
            else:
                own[kind].add(page)
        got = run(*rows, *((j, "forget", None, None, None) for j in gone))
        assert {j: (n[0], n[2]) for j, n in got.items()} == {j: (len(c["page"]), len(c["dropped"])) for j, c in counts.items() if c["total"]}


class Held:
    """A group's state without a stream."""

    def __init__(self):
        self.now, self.value, self.wakes = 0, None, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.wakes = self.now + ms


def test_parts_of_a_group_are_counted_together_and_grow_old_one_by_one():
    count, state = states.PageCounts(100), Held()

    def run(now, *rows):
        state.now = now
        batch = [pd.DataFrame(rows, columns=states.ROW)] if rows else []
        return [tuple(None if x is pd.NA else x for x in r) for out in count((0,), iter(batch), state) for r in out.itertuples(index=False, name=None)]

    far = 2**62
    assert run(0, (1, 0, states.PAGE, far, 1, 0), (1, 0, states.PAGE, far, 0, 0), (1, 0, states.PAGE, -far, 0, 0), (2, 3, states.DROPPED, far, 0, 0)) == [(1, 0, None, 2, 1, 0, far), (2, 3, None, 0, 0, 1, None)]
    assert run(60, (2, 3, states.PAGE, 5, 0, 0), (2, -1, states.SUBMITTED, 0, 0, 4)) == [(2, -1, 4, 0, 0, 0, None), (2, 3, None, 1, 0, 1, 5)] and state.wakes == 100
    assert run(100) == [] and state.wakes == 160  # the first job's part is too old, the second's aren't
    assert run(120, (1, 0, states.PAGE, far, 0, 0), (2, 3, states.PAGE, 5, 1, 0)) == [(1, 0, None, 1, 0, 0, far), (2, 3, None, 1, 0, 1, 5)]
    assert run(121, (1, 0, states.FORGET, 0, 0, 0), (2, 3, states.FORGET, 0, 0, 0), (2, -1, states.FORGET, 0, 0, 0)) == [(1, 0, None, 0, 0, 0, None), (2, -1, None, 0, 0, 0, None), (2, 3, None, 0, 0, 0, None)]
    assert not state.exists


def test_the_newest_ended_jobs_stay_and_the_others_are_forgotten(spark, tmp_path):
    schema = "job_id long, ended timestamp, status string"
    add, stream = arrivals(spark, tmp_path, schema)
    kept = streams.VersionedTable(spark, str(tmp_path / "kept"), schema, "job_id", 1)
    rng, seen, gone = random.Random(2), [], set()
    start = 1_700_000_000
    for k in range(4):
        batch = [(k * 100 + n, start + rng.randrange(900) * (k + 1), rng.choice(["completed", "failed", "processing", "completed_with_errors"])) for n in range(30)]
        seen += [b for b in batch if b[2] != "processing"]
        rows = spark.createDataFrame(batch, "job_id long, s long, status string").select("job_id", F.timestamp_seconds("s").alias("ended"), "status")
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in.parquet"))
        streams.run_through(stream(), streams.newest_ended(kept, str(tmp_path / "gone"), 20, 600), str(tmp_path / "offsets"))
        every = spark.createDataFrame(seen, "job_id long, s long, status string").select("job_id", F.timestamp_seconds("s").alias("ended"), "status")
        want = jobs.retained(every, F.lit(max(s for _, s, _ in seen)).cast("timestamp"), [], "ended", "job_id", 20, 600)
        assert sorted(kept.read().select("job_id").collect()) == sorted(want.select("job_id").collect())
        events = spark.read.option("recursiveFileLookup", "true").schema(EVENTS).parquet(str(tmp_path / "gone"))
        gone = {r["job_id"] for r in events.where("kind = 'forget'").collect()}
        assert gone == {i for i, _, _ in seen} - {r["job_id"] for r in kept.read().collect()}
    assert len(gone) > 40


POLLS = "job_id long, at timestamp, status string, error string, age double, processed long, dropped long, total long"


def test_polls_count_in_a_row_and_end(spark, tmp_path):
    add, stream = arrivals(spark, tmp_path, POLLS)

    def run(*rows, age=600.0):
        frame = spark.createDataFrame(rows, "job_id long, s long, status string, error string, age double, processed long, dropped long, total long")
        frame.withColumn("at", F.timestamp_seconds(F.col("s") + 1_700_000_000)).select(*[c.split(" ")[0] for c in POLLS.split(", ")]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in.parquet"))
        out = []
        streams.run_through(streams.poll_stream(stream(), most_age=age), lambda batch, _: out.extend(batch.collect()), str(tmp_path / "offsets"))
        return sorted((r["job_id"], r["action"], r["not_found"]) for r in out)

    miss = (None, "Job Not Found", 10.0, 0, 0, 5)
    busy = ("processing", None, 10.0, 1, 0, 5)
    assert run((1, 1, *miss), (1, 2, *miss), (2, 1, *miss), (2, 3, *miss), (2, 2, *busy), (3, 1, "completed", None, 5.0, 5, 0, 5), (4, 1, "processing", None, 5.0, 4, 1, 5), (None, 1, *busy)) == [
        (1, "wait", 1), (1, "wait", 2), (2, "wait", 0), (2, "wait", 1), (2, "wait", 1), (3, "complete", 0), (4, "complete", 0),
    ]
    assert run((1, 3, *busy), (2, 4, *miss)) == [(1, "wait", 0), (2, "wait", 2)]  # a good poll starts anew
    assert run((1, 4, *miss), (2, 5, *miss), (5, 1, "failed", None, 1.0, 0, 0, 0), (6, 1, "processing", None, 601.0, 0, 0, 5)) == [(1, "wait", 1), (2, "abandoned", 3), (5, "failed", 0), (6, "abandoned", 0)]
    assert run((2, 6, *miss)) == [(2, "wait", 1)]  # what ended is forgotten


def test_a_job_that_is_no_longer_polled_is_abandoned_by_a_timer(spark, tmp_path):
    add, stream = arrivals(spark, tmp_path, POLLS)
    out = []
    run = lambda: streams.run_through(streams.poll_stream(stream(), most_age=1.0), lambda batch, _: out.extend(batch.collect()), str(tmp_path / "offsets"))
    add([(1, None, "processing", None, 0.0, 0, 0, 5), (2, None, "completed", None, 0.0, 0, 0, 5)])
    run()
    assert sorted((r["job_id"], r["action"]) for r in out) == [(1, "wait"), (2, "complete")]
    time.sleep(2.5)
    add([(3, None, "completed", None, 0.0, 0, 0, 5)])
    run()
    assert sorted((r["job_id"], r["action"]) for r in out[2:]) == [(1, "abandoned"), (3, "complete")]
