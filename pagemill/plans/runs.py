"""Queries on jobs and figures of runs. Users stand for jobs, their events for pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.functions import texts
from pagemill.operators import jobs, metrics
from pagemill.plans.catalogue import registered
from pagemill.sources.tables import sampled_windows, table
from pagemill.streaming import apply as streams

JOBS = """jobs AS (SELECT user_id AS job_id, count(*) + CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS total_pages, user_id % 2 AS dropped_pages, count(*) AS processed_pages, count(*) FILTER (event_type = 'error') AS failed_pages,
date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts)))::DOUBLE AS seconds FROM events GROUP BY 1),
states AS (SELECT *, CASE WHEN processed_pages < total_pages - dropped_pages THEN 'processing' WHEN failed_pages > 0 OR dropped_pages > 0 THEN 'completed_with_errors' ELSE 'completed' END AS status FROM jobs)"""


def states(spark, sf):
    events = table(spark, sf, "events")
    own = events.groupBy(F.col("user_id").alias("job_id")).agg(F.count("*").alias("n"), (F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.min("ts").cast("timestamp"))).cast("double").alias("seconds"))
    own = own.select("job_id", (F.col("n") + F.when(F.col("job_id") % 3 == 0, 1).otherwise(0)).alias("total_pages"), (F.col("job_id") % 2).alias("dropped_pages"), "seconds")
    got = events.select(F.col("user_id").alias("job_id"), F.lit("").alias("path"), F.col("event_id").alias("page"), F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"))
    return jobs.accounts(own, got)


@registered(f"WITH {JOBS} SELECT job_id, total_pages, dropped_pages, processed_pages, failed_pages, status FROM states")
def job_status(spark, sf):
    return states(spark, sf).select("job_id", "total_pages", "dropped_pages", "processed_pages", "failed_pages", "status")


@registered(f"""WITH {JOBS} SELECT count(*) AS jobs, count(*) FILTER (status LIKE 'completed%') AS completed_jobs, coalesce(sum(processed_pages) FILTER (status LIKE 'completed%'), 0)::BIGINT AS pages,
sum(seconds) FILTER (status LIKE 'completed%') AS seconds, round(sum(processed_pages) FILTER (status LIKE 'completed%') / sum(seconds) FILTER (status LIKE 'completed%'), 6) AS pages_per_second FROM states""")
def server_totals(spark, sf):
    return jobs.totals(states(spark, sf)).withColumn("pages_per_second", F.round("pages_per_second", 6))


@registered("""SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM orders)
WHERE nth <= 5 AND o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 1000 DAY""")
def retention_keep(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return jobs.retained(rows, F.lit("2001-08-01").cast("timestamp"), ["o_custkey"], "o_orderdate", "o_orderkey", 5, 1000 * 86400)


@registered("""SELECT event_id, CASE WHEN event_type = 'error' AND k >= 50 THEN 'abandoned' WHEN event_type = 'error' THEN 'wait' WHEN event_type IN ('view', 'click') THEN 'complete' WHEN event_type = 'signup' THEN 'failed' WHEN value > 60 THEN 'abandoned' ELSE 'wait' END AS action
FROM (SELECT *, json_extract_string(props, '$.k')::INTEGER AS k FROM events)""")
def poll_actions(spark, sf):
    kind = F.col("event_type")
    status = F.when(kind.isin("view", "click"), "completed").when(kind == "signup", "failed").otherwise("processing")
    misses = F.when(F.get_json_object("props", "$.k").cast("int") >= 50, 3).otherwise(1)
    error = F.when(kind == "error", "Job Not Found")
    action = jobs.polled(status, error, misses, F.col("value") * 10, F.lit(1), F.lit(0), F.lit(2))
    return table(spark, sf, "events").select("event_id", action.alias("action"))


@registered("SELECT user_id, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1")
def latency_percentiles(spark, sf):
    found = metrics.exact_percentiles(table(spark, sf, "events"), ["user_id"], "value")
    return found.select("user_id", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")])


@registered("""WITH days AS (SELECT user_id, count(*) AS pages, sum(value) AS wall FROM events GROUP BY user_id, date_trunc('day', ts))
SELECT user_id, sum(pages)::BIGINT AS pages, round(CASE WHEN sum(wall) > 0 THEN sum(pages) / sum(wall) ELSE 0 END, 6) AS pages_per_second, round(avg(pages / wall), 6) AS mean_rate, round(coalesce(stddev_samp(pages / wall), 0), 6) AS spread FROM days WHERE pages > 0 AND wall > 0 GROUP BY 1""")
def throughput_stats(spark, sf):
    days = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("pages"), F.sum("value").alias("wall")).where("pages > 0 and wall > 0")
    each = metrics.rate(F.col("pages"), F.col("wall"))
    found = days.groupBy("user_id").agg(F.sum("pages").alias("pages"), metrics.rate(F.sum("pages"), F.sum("wall")).alias("pages_per_second"), F.avg(each).alias("mean_rate"), metrics.spread(each).alias("spread"))
    return found.withColumns({c: F.round(c, 6) for c in ("pages_per_second", "mean_rate", "spread")})


@registered("""WITH j AS (SELECT user_id, value - 50 AS queue_wait, CASE WHEN value % 2 > 1 THEN value - value % 2 ELSE 0 END AS overhead FROM events)
SELECT user_id, round(coalesce(avg(queue_wait) FILTER (queue_wait > 0), 0), 6) AS queue_wait, round(coalesce(avg(overhead) FILTER (overhead > 0), 0), 6) AS overhead FROM j GROUP BY 1""")
def positive_means(spark, sf):
    v = F.col("value")
    rows = table(spark, sf, "events").select("user_id", F.lit(50.0).alias("submit_time"), v.alias("start_time"), v.alias("wall_time"), F.when(v % 2 > 1, v % 2).otherwise(0.0).alias("server_time"))
    found = metrics.waits(rows).groupBy("user_id").agg(metrics.positive_mean(F.col("queue_wait")).alias("queue_wait"), metrics.positive_mean(F.col("overhead")).alias("overhead"))
    return found.withColumns({c: F.round(c, 6) for c in ("queue_wait", "overhead")})


@registered("SELECT user_id, count(*) FILTER (event_type = 'error') AS page_errors, count(*) AS pages FROM events GROUP BY 1")
def error_counts(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("page_errors"), F.count("*").alias("pages"))


@registered("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, round(avg(value), 6) AS mean, count(*) AS samples FROM events GROUP BY 1")
def gpu_sample_windows(spark, sf):
    return sampled_windows(table(spark, sf, "events"), "ts", F.col("value"), "1 hour").withColumn("mean", F.round("mean", 6))


USAGE = "CASE p_size % 5 WHEN 0 THEN concat(p_size, '.5GiB / 64GiB') WHEN 1 THEN concat(p_size * 100, 'MiB / 1GiB') WHEN 2 THEN concat(p_size * 1000, ' KiB / x') WHEN 3 THEN concat(p_size, 'GB') ELSE '' END"
GIB = "CASE p_size % 5 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size * 100 / 1024.0 WHEN 2 THEN p_size * 1000 / 1048576.0 ELSE 0 END"


@registered(f"SELECT p_partkey, {USAGE} AS usage, round({GIB}, 6)::DOUBLE AS gib FROM part")
def mem_parse(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.expr(USAGE).alias("usage"))
    return rows.withColumn("gib", F.round(texts.gibibytes(F.col("usage")), 6))


@registered(f"SELECT p_brand, arg_max(usage, {{'gib': gib, 'first': -p_partkey}}) AS peak FROM (SELECT p_brand, p_partkey, {USAGE} AS usage, {GIB} AS gib FROM part) GROUP BY 1")
def mem_peak(spark, sf):
    rows = table(spark, sf, "part").select("p_brand", "p_partkey", F.expr(USAGE).alias("usage"))
    return rows.groupBy("p_brand").agg(F.max_by("usage", F.struct(texts.gibibytes(F.col("usage")), -F.col("p_partkey"))).alias("peak"))


HALVES = """SELECT ts < TIMESTAMP '2024-01-16' AS old, count(*)::DOUBLE AS pages, count(*) FILTER (event_type = 'error')::DOUBLE AS errors, round(avg(value), 4) AS mean, max(value) AS longest, 0::DOUBLE AS none FROM events GROUP BY 1"""


@registered(f"""WITH halves AS ({HALVES}), m AS (UNPIVOT halves ON pages, errors, mean, longest, none INTO NAME metric VALUE value)
SELECT a.metric, a.value AS old, b.value AS new, CASE WHEN a.value = 0 AND b.value = 0 THEN printf('%.2f (no change)', b.value) WHEN a.value = 0 THEN printf('%.2f (new)', b.value)
ELSE printf('%.2f → %.2f (%s%.1f%%)', a.value, b.value, CASE WHEN b.value >= a.value THEN '+' ELSE '' END, (b.value - a.value) / abs(a.value) * 100) END AS change,
CASE WHEN a.value > 0 AND (a.value - b.value) / a.value * 100 > 1 THEN 1 ELSE 0 END AS regressed FROM m a JOIN m b ON a.metric = b.metric AND a.old AND NOT b.old""")
def baseline_compare(spark, sf):
    half = lambda rows: metrics.as_metrics(rows.agg(F.count("*").alias("pages"), F.count_if(F.col("event_type") == "error").alias("errors"), F.round(F.avg("value"), 4).alias("mean"), F.max("value").alias("longest"), F.lit(0.0).alias("none")), ["pages", "errors", "mean", "longest", "none"])
    events, old = table(spark, sf, "events"), F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    return metrics.compared(half(events.where(old)), half(events.where(~old))).withColumn("regressed", metrics.regressed(F.col("old"), F.col("new"), 1.0))


FIGURES = "count(*)::DOUBLE AS pages_per_sec_wall, round(quantile_cont(value, 0.5), 4) AS page_latency_p50, round(quantile_cont(value, 0.95), 4) AS page_latency_p95, round(stddev_samp(value), 4) AS batch_throughput_std, count(*) FILTER (event_type = 'error')::DOUBLE AS total_page_errors, '1.5GiB / 64GiB' AS memory_peak"
LABELS = ", ".join(f"({k}, '{label}', '{name}', {places}, '{unit}')" for k, (label, name, places, unit) in enumerate(metrics.SHOWN))


@registered(f"""WITH a AS (SELECT {FIGURES} FROM events WHERE user_id % 2 = 1), b AS (SELECT {FIGURES} FROM events WHERE user_id % 2 = 0),
labels AS (SELECT * FROM (VALUES {LABELS}) AS v(ordinal, label, metric, places, unit)),
pick AS (SELECT 'a' AS run, *, 1.5 AS gib FROM a UNION ALL SELECT 'b', *, 0.5 FROM b),
figures AS (SELECT run, metric, ordinal, label, places, unit, coalesce(CASE metric WHEN 'pages_per_sec_wall' THEN pages_per_sec_wall WHEN 'page_latency_p50' THEN page_latency_p50 WHEN 'page_latency_p95' THEN page_latency_p95
WHEN 'batch_throughput_std' THEN batch_throughput_std WHEN 'total_page_errors' THEN total_page_errors WHEN 'memory_peak' THEN gib END, 0)::DOUBLE AS value FROM labels, pick),
said AS (SELECT *, CASE places WHEN 0 THEN printf('%.0f', value) WHEN 1 THEN printf('%.1f', value) WHEN 2 THEN printf('%.2f', value) ELSE printf('%.3f', value) END || unit AS shown FROM figures)
SELECT o.ordinal, o.label, o.value AS old, n.value AS new, CASE WHEN o.value = 0 AND n.value = 0 THEN n.shown || ' (no change)' WHEN o.value = 0 THEN n.shown || ' (new)'
ELSE o.shown || ' → ' || n.shown || ' (' || CASE WHEN n.value >= o.value THEN '+' ELSE '' END || printf('%.1f', (n.value - o.value) / abs(o.value) * 100) || '%)' END AS change FROM said o JOIN said n ON o.metric = n.metric AND o.run = 'a' AND n.run = 'b'""")
def baseline_report(spark, sf):
    """Events of users with odd and with even ids as two runs, in the report's fixed order; figures that neither has are 0."""

    def run(user):
        v = F.col("value")
        p50, p95, _ = metrics.percentiles(v)
        return table(spark, sf, "events").where(F.col("user_id") % 2 == user).agg(
            F.count("*").cast("double").alias("pages_per_sec_wall"), F.round(p50, 4).alias("page_latency_p50"), F.round(p95, 4).alias("page_latency_p95"), F.round(metrics.spread(v), 4).alias("batch_throughput_std"),
            F.count_if(F.col("event_type") == "error").cast("double").alias("total_page_errors"), F.lit(f"{user}.5GiB / 64GiB").alias("memory_peak"),
        )

    return metrics.report(run(1), run(0)).select("ordinal", "label", "old", "new", "change")


@registered("""WITH t AS (SELECT user_id, avg(value) FILTER (value > 0 AND event_type = 'view') AS a, avg(value) FILTER (value > 0 AND event_type = 'click') AS b FROM events GROUP BY 1), s AS (SELECT user_id, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM t)
SELECT user_id, round(a, 6) AS render_time, round(b, 6) AS ocr_time, round(CASE WHEN a + b > 0 THEN a / (a + b) * 100 ELSE 0 END, 4) AS render_percent, round(CASE WHEN a + b > 0 THEN b / (a + b) * 100 ELSE 0 END, 4) AS ocr_percent FROM s""")
def time_split(spark, sf):
    of = lambda kind: F.when(F.col("event_type") == kind, F.col("value"))
    found = table(spark, sf, "events").groupBy("user_id").agg(*metrics.time_shares(of("view"), of("click")))
    return found.select("user_id", *[F.round(c, n).alias(c) for c, n in (("render_time", 6), ("ocr_time", 6), ("render_percent", 4), ("ocr_percent", 4))])


@registered("""SELECT lang, count(*) FILTER (NOT bad) AS processed, count(*) FILTER (bad) AS failed, count(*) FILTER (NOT bad AND n_chars >= 200) AS saved, coalesce(sum(1 + n_chars // 1000) FILTER (NOT bad), 0)::BIGINT AS pages,
round(count(*) FILTER (NOT bad) / 60.0, 6)::DOUBLE AS documents_per_second, round(coalesce(sum(1 + n_chars // 1000) FILTER (NOT bad), 0) / 60.0, 6)::DOUBLE AS pages_per_second FROM (SELECT lang, n_chars, doc_id % 13 = 0 AS bad FROM documents) GROUP BY 1""")
def run_counters(spark, sf):
    docs = table(spark, sf, "documents").select("lang", (F.col("doc_id") % 13 != 0).alias("ok"), (F.col("n_chars") >= 200).alias("saved"), (F.lit(1) + F.floor(F.col("n_chars") / 1000)).alias("pages"))
    return metrics.counters(docs, 60, ["lang"]).withColumns({c: F.round(c, 6) for c in ("documents_per_second", "pages_per_second")})


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


@registered("SELECT user_id AS document_id, count(*) AS pages, max(value) AS longest, max(ts) AS updated_at FROM events GROUP BY 1")
def micro_batch_apply(spark, sf):
    """Events as a file stream, added to a table batch by batch."""

    def change(table_, batch):
        new = batch.groupBy("document_id").agg(F.count("*").alias("pages"), F.max("value").alias("longest"), F.max("ts").alias("updated_at"))
        both = table_.unionByName(new)
        return both.groupBy("document_id").agg(F.sum("pages").alias("pages"), F.max("longest").alias("longest"), F.max("updated_at").alias("updated_at"))

    kept = streams.VersionedTable(spark, streams.shared_dir(spark), "document_id long, pages long, longest double, updated_at timestamp", "document_id")
    return streams.applied(streams.file_stream(spark, sf, "events.parquet", EVENTS).withColumnRenamed("user_id", "document_id"), kept, change)


@registered("SELECT user_id AS job_id, count(*) AS processed_pages, count(*) FILTER (event_type = 'error') AS failed_pages, max(event_id) AS last_page FROM events GROUP BY 1")
def stateful_job_tracker(spark, sf):
    """Events as a stream of page results; the state of every job after the last one."""
    results = streams.file_stream(spark, sf, "events.parquet", EVENTS).select(F.col("user_id").alias("job_id"), F.col("event_id").alias("page"), (F.col("event_type") == "error").alias("failed"))
    kept = streams.VersionedTable(spark, streams.shared_dir(spark), streams.COUNTED, "job_id")
    return streams.summed(streams.applied(streams.tracked(results), kept, streams.replaced), known_only=False).select("job_id", "processed_pages", "failed_pages", "last_page")


@registered("""WITH e AS (SELECT user_id AS job_id, CASE WHEN event_type = 'signup' THEN 'submitted' WHEN json_extract_string(props, '$.k')::INTEGER % 10 = 0 THEN 'dropped' ELSE 'page' END AS kind, event_type = 'error' AS failed FROM events),
c AS (SELECT job_id, 10 + job_id % 40 AS total_pages, count(*) FILTER (kind = 'page') AS processed_pages, count(*) FILTER (kind = 'page' AND failed) AS failed_pages, count(*) FILTER (kind = 'dropped') AS dropped_pages
FROM e GROUP BY 1, 2 HAVING count(*) FILTER (kind = 'submitted') > 0)
SELECT *, CASE WHEN processed_pages < total_pages - dropped_pages THEN 'processing' WHEN failed_pages > 0 OR dropped_pages > 0 THEN 'completed_with_errors' ELSE 'completed' END AS status FROM c""")
def stream_job_states(spark, sf):
    """Events as a stream: a signup submits the user's job, other events are its pages; users without one are unknown."""
    kind = F.when(F.col("event_type") == "signup", "submitted").when(F.get_json_object("props", "$.k").cast("int") % 10 == 0, "dropped").otherwise("page")
    events = streams.file_stream(spark, sf, "events.parquet", EVENTS).select(F.col("user_id").alias("job_id"), kind.alias("kind"), F.col("event_id").alias("page"), (F.col("event_type") == "error").alias("failed"), (F.lit(10) + F.col("user_id") % 40).alias("total_pages"))
    kept = streams.VersionedTable(spark, streams.shared_dir(spark), streams.COUNTED, "job_id")
    return streams.with_status(streams.summed(streams.applied(streams.job_states(events), kept, streams.replaced))).drop("last_page")


@registered("""SELECT o_custkey AS document_id, count(*)::BIGINT AS pages, arg_max(o_orderstatus, o_orderkey) AS full_text FROM orders GROUP BY 1""")
def upsert_versions(spark, sf):
    """Three batches of orders, each added to a table by customer that is kept on disk and read again."""
    orders = table(spark, sf, "orders")
    folder = streams.shared_dir(spark)

    def change(old, batch):
        new = batch.groupBy(F.col("o_custkey").alias("document_id")).agg(F.count("*").alias("pages"), F.max(F.struct("o_orderkey", "o_orderstatus")).alias("last"))
        both = old.select("document_id", "pages", F.struct(F.col("last_key").alias("o_orderkey"), F.col("full_text").alias("o_orderstatus")).alias("last")).unionByName(new)
        return both.groupBy("document_id").agg(F.sum("pages").alias("pages"), F.max("last").alias("last")).select("document_id", "pages", F.col("last.o_orderkey").alias("last_key"), F.col("last.o_orderstatus").alias("full_text"))

    schema = "document_id long, pages long, last_key long, full_text string"
    for k in range(3):
        kept = streams.VersionedTable(spark, folder, schema, "document_id")
        kept.update(change, orders.where(F.col("o_orderkey") % 3 == k).withColumn("document_id", F.col("o_custkey")), k)
        kept.update(change, orders.where(F.col("o_orderkey") % 3 == k).withColumn("document_id", F.col("o_custkey")), k)  # comes again, counts once
    return kept.read().drop("last_key")

@registered("""WITH e AS (SELECT o_orderkey AS job_id, o_orderdate AS ended, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'failed' ELSE 'processing' END AS status FROM orders),
n AS (SELECT *, row_number() OVER (ORDER BY ended DESC, job_id DESC) AS nth, max(ended) OVER () AS clock FROM e WHERE status <> 'processing') SELECT job_id, ended, status FROM n WHERE nth <= 100 AND clock - ended <= INTERVAL 20 DAY""")
def stream_retention(spark, sf):
    """Orders as a stream of jobs: of all that ended the newest hundred, none more than twenty days older than the newest."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table(spark, sf, "orders").schema)
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed").otherwise("processing")
    jobs_ = streams.file_stream(spark, sf, "orders.parquet", schema).select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").cast("timestamp").alias("ended"), status.alias("status"))
    folder = streams.shared_dir(spark)
    kept = streams.VersionedTable(spark, f"{folder}/kept", "job_id long, ended timestamp, status string", "job_id", 1)
    streams.run_through(jobs_, streams.newest_ended(kept, f"{folder}/gone", 100, 20 * 86400), f"{folder}/offsets")
    return kept.read()


@registered("""WITH e AS (SELECT user_id AS job_id, ts AS polled_at, event_type, event_type = 'error' AS missed, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT *, n - row_number() OVER (PARTITION BY job_id, missed ORDER BY n) AS island FROM e), k AS (SELECT *, row_number() OVER (PARTITION BY job_id, missed, island ORDER BY n) AS k FROM r)
SELECT job_id, polled_at, CASE WHEN missed THEN CASE WHEN k % 3 = 0 THEN 'abandoned' ELSE 'wait' END WHEN event_type IN ('view', 'click') THEN 'complete' WHEN event_type = 'signup' THEN 'failed' ELSE 'wait' END AS action,
CASE WHEN missed THEN (k - 1) % 3 + 1 ELSE 0 END::INTEGER AS not_found FROM k""")
def stream_polls(spark, sf):
    """Events as a stream of polls: how often in a row a job wasn't found, and what each poll means."""
    kind = F.col("event_type")
    status = F.when(kind.isin("view", "click"), "completed").when(kind == "signup", "failed").otherwise("processing")
    polls = streams.file_stream(spark, sf, "events.parquet", EVENTS).select(F.col("user_id").alias("job_id"), F.col("ts").alias("at"), status.alias("status"), F.when(kind == "error", "404").alias("error"), F.lit(0.0).alias("age"), F.lit(0).alias("processed"), F.lit(0).alias("dropped"), F.lit(5).alias("total"))
    kept = streams.VersionedTable(spark, streams.shared_dir(spark), streams.ACTIONS, "job_id")
    return streams.applied(streams.poll_stream(polls), kept, lambda old, new: old.unionByName(new)).withColumnRenamed("at", "polled_at")
