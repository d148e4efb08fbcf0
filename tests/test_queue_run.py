from __future__ import annotations

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.functions.json import merged
from pagemill.operators import accuracy, metrics, pageplan, results, workqueue
from pagemill.operators.upsert import Breaker
from pagemill.sources.tables import table
from pagemill.streaming import versioned
from pagemill.streaming.queue import Queue, ResultSink

SCHEMA = "document_id long, full_text string, pages int, created_at timestamp, updated_at timestamp"


def waiting(spark, n=23):
    rng = random.Random(1)
    rows = [(k, None if k % 6 == 0 else dt.datetime(2024, 1, 1 + rng.randrange(5))) for k in range(n)]
    return spark.createDataFrame(rows, "id long, recorded_at timestamp")


@pytest.mark.parametrize("ascending", [False, True])
def test_a_queue_goes_on_after_a_restart_and_passes_each_row_once(spark, tmp_path, ascending):
    rows, got = waiting(spark), []
    queue = lambda: Queue(spark, str(tmp_path), rows, size=5, ascending=ascending)
    take = lambda page, number: got.append((number, [r["id"] for r in page.collect()]))
    assert queue().run(take, most_pages=2) == 10
    with pytest.raises(ZeroDivisionError):
        queue().run(lambda page, number: 1 / 0)
    assert queue().run(take) == 13
    assert [n for n, _ in got] == [0, 1, 2, 3, 4]
    t, i = F.col("recorded_at"), F.col("id")
    order = [t.asc_nulls_last(), i.asc()] if ascending else [t.desc_nulls_first(), i.desc()]
    assert [k for _, page in got for k in page] == [r["id"] for r in rows.orderBy(*order).collect()]
    assert [k for page in workqueue.pages(rows, 5, ascending=ascending) for k in (r["id"] for r in page)] == [k for _, page in got for k in page]
    queue().run(take, most_pages=1)  # worked through: it begins anew
    assert got[-1] == (5, got[0][1])
    assert Queue(spark, str(tmp_path), rows.limit(0), name="none").run(take) == 0


def test_a_write_that_fails_leaves_the_old_version_and_its_rows_come_again(spark, tmp_path):
    now = [0.0]
    sink = ResultSink(spark, str(tmp_path), SCHEMA, breaker=Breaker(2, 60, lambda: now[0]))
    docs = spark.createDataFrame([(k,) for k in range(6)], "id long")
    batch = lambda *ids: spark.createDataFrame([(k, f"text {k}", 2) for k in ids], "document_id long, full_text string, pages int")
    pending = lambda: sorted(r["id"] for r in docs.join(sink.read().select(F.col("document_id").alias("id")), "id", "left_anti").collect())
    assert sink.save(batch(0, 1), 0) == {"saved": 2, "pages": 4}
    assert sink.save(batch(0, 1), 0) == {"saved": 0, "pages": 0}  # it comes again
    bad = batch(2, 3).withColumn("full_text", F.raise_error(F.lit("no text")).cast("string"))
    assert sink.save(bad, 1) is None and sink.save(batch(4, 4), 1) is None
    assert pending() == [2, 3, 4, 5]
    assert sink.save(batch(5), 1) is None  # the breaker is open
    assert pending() == [2, 3, 4, 5] and sink.table.version == 0
    found = sorted((r["rows"], "no text" in r["error"], "more than once" in r["error"], "in a row" in r["error"]) for r in sink.failures().collect())
    assert found == [(1, False, False, True), (2, False, True, False), (2, True, False, False)]
    now[0] = 61.0
    assert sink.save(batch(*pending()), 1) == {"saved": 4, "pages": 8} and pending() == []
    # counters come from the job that writes: only what this batch saved
    assert sink.save(batch(0), 2) == {"saved": 1, "pages": 2} and sink.read().count() == 6


def written(spark, folder):
    """The rows of all folders of a table, whether they are read or not."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").parquet(*map(str, folder.glob("v*"))).count()


def test_new_documents_are_added_and_only_parts_that_hold_known_ones_are_written_anew(spark, tmp_path, monkeypatch):
    sink = ResultSink(spark, str(tmp_path), SCHEMA)
    batch = lambda ids, text: spark.createDataFrame([(k, text, 2) for k in ids], "document_id long, full_text string, pages int")
    for k in range(4):
        assert sink.save(batch(range(k * 50, k * 50 + 50), "first"), k) == {"saved": 50, "pages": 100}
    assert written(spark, tmp_path / "results") == 200 == sink.read().count()
    state = sink.table.state()
    assert sum(rows for _, _, rows in state.newest.values()) == 200 and max(len(state.folders(p)) for p in state.newest) == 4
    before = {r["document_id"]: r["created_at"] for r in sink.read().collect()}
    assert sink.save(batch([7, 500], "second"), 4) == {"saved": 2, "pages": 4}  # one part is written anew, another added to
    assert 200 < written(spark, tmp_path / "results") < 260
    got = {r["document_id"]: r for r in sink.read().collect()}
    assert len(got) == 201 == sink.read().count() and {k for k, r in got.items() if r["full_text"] == "second"} == {7, 500}
    assert {k: got[k]["created_at"] for k in before} == before
    # what lies in many folders is put together, and the log with all folders of a part
    monkeypatch.setattr(versioned, "FOLDERS", 3)
    monkeypatch.setattr(versioned, "ENTRIES", 4)
    assert sink.save(batch(range(600, 700), "third"), 5) == {"saved": 100, "pages": 200}
    state = sink.table.state()
    assert max(len(state.folders(p)) for p in state.newest) <= 3
    assert sink.save(batch(range(700, 720), "third"), 6) == {"saved": 20, "pages": 40}
    assert sorted(r["document_id"] for r in sink.read().collect()) == [*range(200), 500, *range(600, 720)]
    assert sink.save(batch([None], "none"), 7) is None and sink.read().count() == 321


def test_few_targets_find_the_same_files(spark):
    files = spark.createDataFrame([("/a/x.pdf", 1), ("/b/x.pdf", 0), ("/b/y.pdf", 2), ("/b/xx.pdf", 3), ("", 4), ("/b/x.pdf", 5)], "path string, ordinal int")
    targets = spark.createDataFrame([("/a/x.pdf",), ("/q/x.pdf",), ("/q/y.pdf",), ("/q/z.pdf",), ("/q/",), (None,), ("",)], "target string")
    found = [sorted(map(repr, results.by_suffix(targets, files.withColumn("at", F.col("ordinal")), few).collect())) for few in (False, True)]
    assert found[0] == found[1] and len(found[0]) == 7


def test_numbers_by_date_and_text(spark, monkeypatch):
    monkeypatch.setattr(pageplan, "ROWS_OF_PART", 20)
    rows = spark.createDataFrame([(k, dt.date(2024, 1, 1 + k % 9) if k % 7 else None, f"t{k % 4}") for k in range(150)], "k long, d date, t string").repartition(4)
    for key in ("d", "t"):
        got = sorted((r["ordinal"], r[key]) for r in pageplan.numbered(rows, key).collect())
        assert [o for o, _ in got] == [*range(150)]
        want = sorted((r[key] for r in rows.collect()), key=lambda v: (v is not None, v if v is not None else 0))
        assert [v for _, v in got] == want
    assert pageplan.numbered(rows.limit(0), "k").count() == 0


@pytest.mark.parametrize("part", [7, 200_000])
def test_percentiles_of_a_hot_group(spark, monkeypatch, part):
    monkeypatch.setattr(metrics, "ROWS_OF_PART", part)
    rng = random.Random(3)
    rows = [("hot", round(rng.gauss(0, 9), 1)) for _ in range(400)] + [("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None), (None, 3.0), ("same", 4.0), ("same", 4.0), ("same", 4.0)]
    got = {r["g"]: tuple(r)[1:] for r in metrics.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", (0.0, 0.5, 0.95, 1.0)).collect()}
    for g in {r[0] for r in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        assert got[g] == pytest.approx(tuple(np.percentile(values, [0, 50, 95, 100])) if values else (0.0,) * 4)
    assert metrics.exact_percentiles(spark.createDataFrame([], "g string, v double"), ["g"], "v").count() == 0


def test_no_task_orders_a_whole_group(spark, monkeypatch):
    monkeypatch.setattr(metrics, "ROWS_OF_PART", 50)
    rows = spark.range(500).select(F.lit("hot").alias("g"), F.col("id").cast("double").alias("v"))
    seen = []
    stored = metrics.stored
    monkeypatch.setattr(metrics, "stored", lambda df, name: seen.append(df.groupBy("__part").count().agg(F.max("count")).first()[0]) or stored(df, name))
    assert metrics.exact_percentiles(rows, ["g"], "v", (0.5,)).first()["p50"] == 249.5
    assert seen[0] < 150


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_counts_of_whole_tables_read_no_column(spark, sf):
    plan = plan_of(workqueue.about_pending(table(spark, sf, "documents"), table(spark, sf, "labels")))
    assert plan.count("ReadSchema: struct<>") == 2 and "ReadSchema: struct<doc" not in plan


def test_merging_many_keys(spark):
    old, new = "{" + ", ".join(f'"k{k}": {k}' for k in range(300)) + "}", "{" + ", ".join(f'"k{k}": null' for k in range(150, 400)) + "}"
    rows = spark.createDataFrame([(old, new), (None, new), (old, None), (None, None)], "o string, n string")
    got = [r["m"] for r in rows.select(merged(F.col("o"), F.col("n")).alias("m")).collect()]
    assert [json.loads(g) for g in got] == [{**json.loads(old), **json.loads(new)}, json.loads(new), json.loads(old), {}]


def test_texts_are_joined_last(spark):
    docs = spark.createDataFrame([("/a/x.pdf", 1, "first"), ("/b/x.pdf", 0, "earlier"), ("/b/y.pdf", 2, ""), ("/b/x.pdf", 5, "later")], "path string, ordinal int, full_text string")
    targets = spark.createDataFrame([("/a/x.pdf",), ("/q/x.pdf",), ("/q/y.pdf",), ("/q/z.pdf",)], "target string")
    got = {r["target"]: r["full_text"] for r in results.texts_for(targets, docs).collect()}
    assert got == {"/a/x.pdf": "first", "/q/x.pdf": "earlier", "/q/y.pdf": "", "/q/z.pdf": None}


def test_a_comparison_is_written_side_by_side(spark, tmp_path):
    rows = spark.createDataFrame([("a.pdf", 1, "x", 2, "y"), ("b.pdf", None, None, 3, "z")], "path string, first_pages int, first_text string, second_pages int, second_text string")
    accuracy.save_comparison(rows, str(tmp_path / "c"))
    got = sorted(map(str, (tuple(r) for r in spark.read.schema("engine string, path string, pages int, text string").json(str(tmp_path / "c")).collect())))
    assert got == sorted(map(str, [("first", "a.pdf", 1, "x"), ("first", "b.pdf", None, None), ("second", "a.pdf", 2, "y"), ("second", "b.pdf", 3, "z")]))
