from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pagemill.functions import texts
from pagemill.operators import jobs, metrics, upsert
from pagemill.sources import tables
from pagemill.streaming import apply as streams

NOW = dt.datetime(2024, 5, 1)


def test_job_states(spark):
    own = spark.createDataFrame([(1, 2, 0), (2, 2, 0), (3, 2, 0), (4, 3, 1), (5, 2, 0)], "job_id int, total_pages long, dropped_pages long")
    got = [(1, 0, "success"), (1, 1, "success"), (2, 0, "success"), (2, 1, "error"), (3, 0, "success"), (4, 0, "success"), (4, 1, "success"), (5, 0, "success"), (5, 0, "success"), (99, 0, "success")]
    pages = spark.createDataFrame([(j, "p", n, s) for j, n, s in got], "job_id int, path string, page int, status string")
    states = {r["job_id"]: (r["status"], r["processed_pages"], r["failed_pages"]) for r in jobs.accounts(own, pages).collect()}
    assert states == {1: ("completed", 2, 0), 2: ("completed_with_errors", 2, 1), 3: ("processing", 1, 0), 4: ("completed_with_errors", 2, 0), 5: ("processing", 1, 0)}
    expected = spark.createDataFrame([(3, "p", 0), (3, "p", 1)], "job_id int, path string, page int")
    assert [tuple(r) for r in jobs.missing_pages(expected, pages).collect()] == [(3, "p", 1)]


def test_retention(spark):
    rows = [("all", k, NOW - dt.timedelta(seconds=k)) for k in range(103)]
    keep = lambda r: sorted(x["job_id"] for x in jobs.retained(spark.createDataFrame(r, "g string, job_id int, ended timestamp"), F.lit(NOW), ["g"]).collect())
    assert keep(rows) == [*range(100)]
    assert keep([("all", 1, NOW - dt.timedelta(seconds=1800)), ("all", 2, NOW - dt.timedelta(seconds=1801))]) == [1]


def test_polls(spark):
    rows = [("completed", None, 0, 1, 0, 0, 5), ("processing", None, 0, 1, 3, 2, 5), ("processing", None, 0, 1, 3, 1, 5), ("processing", None, 0, 601, 0, 0, 5), ("failed", None, 0, 1, 0, 0, 5), (None, "Job not found", 1, 1, 0, 0, 0), (None, "HTTP 404", 3, 1, 0, 0, 0)]
    df = spark.createDataFrame(rows, "s string, e string, m int, age int, p int, d int, t int")
    got = [r["a"] for r in df.select(jobs.polled(*map(F.col, ("s", "e", "m", "age", "p", "d", "t"))).alias("a")).collect()]
    assert got == ["complete", "complete", "wait", "abandoned", "failed", "wait", "abandoned"]


RESULT = "document_id string, full_text string, confidence double, ocr_metadata string, created_at timestamp, updated_at timestamp"


def test_upsert(spark):
    old = NOW - dt.timedelta(days=1)
    target = spark.createDataFrame([("a", "x", 1.0, '{"a":1,"b":{"c":2}}', old, old), ("b", "y", 2.0, None, old, old)], RESULT)
    batch = upsert.staged(spark.createDataFrame([("a", "new", None, '{"a":"x","d":null}'), ("c", None, 3.0, None)], "document_id string, full_text string, confidence double, ocr_metadata string"))
    got = {r["document_id"]: r for r in upsert.upserted(target, batch, now=F.lit(NOW)).collect()}
    assert len(got) == 3 and got["a"]["full_text"] == "new" and got["a"]["confidence"] == 95.0 and got["a"]["created_at"] == old and got["a"]["updated_at"] == NOW
    assert json.loads(got["a"]["ocr_metadata"]) == {"a": "x", "b": {"c": 2}, "d": None}
    assert got["b"]["full_text"] == "y" and got["b"]["updated_at"] == old and got["c"]["full_text"] == "" and got["c"]["created_at"] == NOW and got["c"]["ocr_metadata"] == "{}"
    twice = upsert.upserted(upsert.upserted(target, batch, now=F.lit(NOW)), batch, now=F.lit(NOW))
    assert sorted(map(str, twice.collect())) == sorted(map(str, got.values()))
    assert upsert.upserted(target, batch.limit(0), now=F.lit(NOW)).count() == 2
    with pytest.raises(Exception, match="comes more than once"):
        upsert.upserted(target, batch.unionByName(batch), now=F.lit(NOW)).collect()
    with pytest.raises(upsert.RepeatedKey):
        upsert.refuse_repeats(batch.unionByName(batch), "document_id")
    upsert.refuse_repeats(batch, "document_id")


def test_metadata_of_a_batch_is_text_struct_or_map(spark):
    old = NOW - dt.timedelta(days=1)
    target = spark.createDataFrame([("a", "x", 1.0, '{"dpi":1,"b":2}', old, old)], RESULT)
    for meta, want in (("named_struct('dpi', 3, 'model', null)", {"dpi": 3, "model": None}), ("map('dpi', 3)", {"dpi": 3}), ('\'{"dpi":3}\'', {"dpi": 3}), ("cast(null as map<string,int>)", {})):
        batch = upsert.staged(spark.range(2).selectExpr("if(id = 0, 'a', 'z') AS document_id", "'t' AS full_text", f"{meta} AS ocr_metadata"))
        got = {r["document_id"]: json.loads(r["ocr_metadata"]) for r in upsert.upserted(target, batch, now=F.lit(NOW)).collect()}
        assert got == {"a": {"dpi": 1, "b": 2} | want, "z": want}, meta


def test_a_row_without_a_key_is_refused(spark):
    schema = "document_id long, full_text string"
    with pytest.raises(Exception, match="has no document_id"):
        upsert.upserted(spark.createDataFrame([(1, "a")], schema), spark.createDataFrame([(None, "b"), (2, "c")], schema)).collect()


def test_breaker():
    now = [0.0]
    breaker = upsert.Breaker(failures=2, pause=60, clock=lambda: now[0])

    def fails():
        raise OSError

    for _ in range(2):
        with pytest.raises(OSError):
            breaker.call(fails)
    with pytest.raises(upsert.BreakerOpen):
        breaker.call(lambda: 1)
    now[0] = 60
    with pytest.raises(OSError):  # tried once, and open again
        breaker.call(fails)
    assert breaker.state == "open"
    now[0] = 120
    assert breaker.call(lambda: 7) == 7 and breaker.state == "closed"


def test_figures(spark):
    rows = spark.createDataFrame([(v,) for v in (1.0, 2.0, 10.0, 11.0)], "v double")
    got = rows.agg(*metrics.percentiles(F.col("v"))).first()
    assert (got["p50"], round(got["p95"], 6), round(got["p99"], 6)) == (6.0, 10.85, 10.97)
    none = rows.where("v > 99").agg(*metrics.percentiles(F.col("v")), metrics.positive_mean(F.col("v")).alias("m"), metrics.spread(F.col("v")).alias("s")).first()
    assert tuple(none) == (0.0, 0.0, 0.0, 0.0, 0.0)
    some = spark.createDataFrame([(0.0,), (2.0,), (4.0,)], "v double")
    assert some.agg(metrics.positive_mean(F.col("v")).alias("m")).first()["m"] == 3.0
    assert some.limit(1).agg(metrics.spread(F.col("v")).alias("s")).first()["s"] == 0.0


def test_usage_and_deltas(spark):
    usage = spark.createDataFrame([("3.8GiB / 62.5GiB",), ("512MiB / 1GiB",), ("1048576KiB",), ("3.8GB",), ("",), (None,), ("1073741824B",)], "u string")
    assert [r["g"] for r in usage.select(texts.gibibytes(F.col("u")).alias("g")).collect()] == [3.8, 0.5, 1.0, 0.0, 0.0, 0.0, 1.0]
    pairs = spark.createDataFrame([(0.0, 0.0), (0.0, 5.0), (10.0, 12.0), (10.0, 9.0)], "a double, b double")
    assert [r["d"] for r in pairs.select(texts.delta(F.col("a"), F.col("b")).alias("d")).collect()] == ["0.00 (no change)", "5.00 (new)", "10.00 → 12.00 (+20.0%)", "10.00 → 9.00 (-10.0%)"]
    gate = spark.createDataFrame([(10.0, 9.0), (10.0, 8.9), (0.0, 5.0)], "a double, b double")
    assert [r["g"] for r in gate.select(metrics.regressed(F.col("a"), F.col("b")).alias("g")).collect()] == [0, 1, 0]
    loads = spark.createDataFrame([("12.3%",), ("0%",), (None,)], "u string")
    assert [r["p"] for r in loads.select(texts.percent(F.col("u")).alias("p")).collect()] == [12.3, 0.0, 0.0]


def test_files_manifests_and_runs(spark, tmp_path):
    (tmp_path / "in/a").mkdir(parents=True)
    for name in ("x.pdf", "B: 1 P: 2.pdf", "y.PDF", "z.txt"):
        (tmp_path / "in/a" / name).write_bytes(b"x")
    files = tables.inventory(spark, str(tmp_path / "in"))
    assert sorted(r["path"].rpartition("/")[2] for r in files.collect()) == ["B: 1 P: 2.pdf", "x.pdf"]
    assert tables.sampled(files, 1).collect() == tables.sampled(files, 1).collect() and tables.sampled(files, 9).count() == 2
    tables.save_manifest(files, str(tmp_path / "m"), 42, "src")
    assert tables.manifest(spark, str(tmp_path / "m")).count() == 2
    tables.save_manifest(files.limit(0), str(tmp_path / "n"), 42, "src")
    assert tables.manifest(spark, str(tmp_path / "n")).count() == 0
    listed = tables.manifest(spark, str(tmp_path / "m"))
    assert tables.usable_manifest(listed, files).count() == 2
    assert tables.usable_manifest(listed, files.where(~F.col("path").endswith(": 2.pdf"))).count() == 0  # the first one is gone
    assert tables.usable_manifest(listed, files.where(~F.col("path").endswith("x.pdf"))).count() == 2
    (tmp_path / "letters").write_text("a\n b\n", encoding="utf-8")
    assert tables.letters(str(tmp_path / "letters")) == ["blank", "a", " b", " "]
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers/1.json").write_text('{"job_id": "j",\n "status": "completed"}')
    assert [r["value"].startswith('{"job_id"') for r in tables.answers(spark, str(tmp_path / "answers")).collect()] == [True]
    tables.save_run(spark.range(1).select(F.lit(5.0).alias("pages")), str(tmp_path / "r"))
    assert tuple(tables.saved_run(spark, str(tmp_path / "r"), ["pages", "missing"]).first()) == (5.0, 0.0)


def test_a_stream_in_several_batches(spark, sf, tmp_path):
    events = tables.table(spark, sf, "events")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    stream = streams.file_stream(spark, str(tmp_path), "events.parquet", schema, files_per_batch=2)
    pages = stream.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("page"), (F.col("event_type") == "error").alias("failed"))
    kept = streams.VersionedTable(spark, str(tmp_path / "out"), streams.COUNTED, "job_id", 3)
    found = streams.summed(streams.applied(streams.tracked(pages), kept, streams.replaced), known_only=False)
    got = {tuple(r) for r in found.select("job_id", "processed_pages", "failed_pages").collect()}
    want = events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("e"))
    assert got == {tuple(r) for r in want.collect()} and kept.version >= 2


def total(old, new):
    return old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))


def test_a_table_goes_on_after_a_restart(spark, tmp_path):
    incoming, out = tmp_path / "in", str(tmp_path / "out")
    frame = lambda rows: spark.createDataFrame(rows, "k string, n long")
    frame([("a", 1), ("b", 1), ("c", 1), ("d", 1), (None, 1)]).write.parquet(str(incoming / "part.parquet"))
    run = lambda: streams.applied(streams.file_stream(spark, str(incoming), "part.parquet", "k string, n long"), streams.VersionedTable(spark, out, "k string, n long", "k", 4), total)
    assert {tuple(r) for r in run().collect()} == {("a", 1), ("b", 1), ("c", 1), ("d", 1), (None, 1)}
    frame([("a", 5), ("e", 1), ("f", 1)]).write.mode("append").parquet(str(incoming / "part.parquet"))
    want = {("a", 6), ("b", 1), ("c", 1), ("d", 1), ("e", 1), ("f", 1), (None, 1)}
    assert {tuple(r) for r in run().collect()} == want and {tuple(r) for r in run().collect()} == want


def test_a_batch_that_comes_again_or_broke_off(spark, tmp_path):
    kept = streams.VersionedTable(spark, str(tmp_path), "k string, n long", "k", 4)
    frame = lambda rows: spark.createDataFrame(rows, "k string, n long")
    rows = lambda: {tuple(r) for r in streams.VersionedTable(spark, str(tmp_path), "k string, n long", "k", 4).read().collect()}
    one = kept.apply(total)
    one(frame([("a", 1), ("b", 2)]), 0)
    one(frame([("a", 1), ("b", 2)]), 0)
    assert rows() == {("a", 1), ("b", 2)}
    before = {f for _, _, f in kept.newest()}
    one(frame([("a", 1)]), 1)
    assert rows() == {("a", 2), ("b", 2)} and len(before & {f for _, _, f in kept.newest()}) == 1  # the other part stays as it was
    commit, kept.commit = kept.commit, None  # breaks off between writing and the log
    with pytest.raises(TypeError):
        one(frame([("a", 10)]), 2)
    assert rows() == {("a", 2), ("b", 2)}
    kept.commit = commit
    one(frame([("a", 10)]), 2)
    assert rows() == {("a", 12), ("b", 2)}
    kept.update(lambda old, new: old.join(new, "k", "left_anti"), frame([("a", 0)]))
    assert rows() == {("b", 2)} and kept.version == 3
    with pytest.raises(ValueError):
        streams.VersionedTable(spark, str(tmp_path / "n"), "k string, n long", "k", 64).update(lambda old, new: new.withColumn("k", F.lit("z")), frame([("a", 0)]))
    kept.update(total, frame([]))
    assert kept.version == 3


def test_a_run_that_cannot_be_read_is_an_error(spark, tmp_path):
    (tmp_path / "cut.json").write_text('{"pages_per_sec_wall": 12.5, "page_la')
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        tables.saved_run(spark, str(tmp_path / "cut.json"), ["pages_per_sec_wall"]).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.saved_run(spark, str(tmp_path / "none.json"), ["pages_per_sec_wall"]).collect()


def test_report_and_counters(spark):
    old = spark.createDataFrame([(10.0, "1GiB / 2GiB")], "pages_per_sec_wall double, memory_peak string")
    new = spark.createDataFrame([(9.0, None, 0.25)], "pages_per_sec_wall double, memory_peak string, page_latency_p50 double")
    got = {r["label"]: r["change"] for r in metrics.report(old, new).collect()}
    assert len(got) == 12 and got["Pages/sec (wall)"] == "10.0 → 9.0 (-10.0%)" and got["Memory"] == "1.0GiB → 0.0GiB (-100.0%)" and got["Page p50"] == "0.25s (new)" and got["GPU utilization"] == "0% (no change)"
    runs = spark.createDataFrame([(True, True, 3), (True, False, 2), (False, False, 9), (None, None, None)], "ok boolean, saved boolean, pages int")
    assert tuple(metrics.counters(runs, 2).first()) == (2, 2, 1, 5, 1.0, 2.5)
    assert tuple(metrics.counters(runs.limit(0), 0).first()) == (0, 0, 0, 0, 0.0, 0.0)
    none = spark.createDataFrame([(None, None)], "a double, b double")
    assert tuple(none.agg(*metrics.time_shares(F.col("a"), F.col("b"))).first()) == (0.0, 0.0, 0.0, 0.0)


def test_a_database_is_read_in_ranges(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.range(100).selectExpr("cast(id as int) as N", "cast(id % 7 as string) as S").unionAll(spark.sql("select cast(null as int), 'x'")).write.format("jdbc").options(url=url, dbtable="t").save()
    whole, parts = tables.database(spark, url, "SELECT * FROM t"), tables.database(spark, url, "SELECT * FROM t WHERE N IS NULL OR N >= 10", by="N", parts=4)
    assert whole.count() == 101 and parts.count() == 91 and parts.rdd.getNumPartitions() == 4
    assert tables.database(spark, url, "SELECT * FROM t WHERE N < 0", by="N").count() == 0


def test_the_rest_works_without_the_training_data_operators(spark):
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['pagemill.llm'] = None; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e; n = [*e.queries()]; assert n and not [x for x in n if x.startswith('op') or x == 'pipeline']; assert {*e.oracle_sql()} <= {*n}"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True)
