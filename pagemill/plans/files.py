"""Queries on what is written and read again: files, samples, runs, comparisons and saved results."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.functions import texts
from pagemill.operators import accuracy, metrics, workqueue
from pagemill.plans.catalogue import registered
from pagemill.plans.documents import RESULT
from pagemill.sources import tables
from pagemill.sources.tables import table
from pagemill.streaming import apply as streams
from pagemill.streaming.queue import ResultSink


@registered("SELECT lang, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes FROM documents GROUP BY 1")
def file_inventory(spark, sf):
    """Texts written as files into a folder for each language, found again with their sizes; a line feed ends each text."""
    folder = streams.shared_dir(spark)
    table(spark, sf, "documents").select(F.coalesce("text", F.lit("")).alias("value"), "lang").write.partitionBy("lang").text(folder)
    lang = F.nullif(F.regexp_extract("path", "/lang=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return tables.inventory(spark, folder, ".txt").groupBy(lang.alias("lang")).agg(F.sum("length").alias("bytes"))


@registered("""WITH s AS (SELECT url FROM pages WHERE url IS NOT NULL ORDER BY md5(url || '42'), url, page_id LIMIT 100) SELECT (row_number() OVER (ORDER BY url) - 1)::INTEGER AS ordinal, url AS path FROM s""")
def sample_manifest(spark, sf):
    """A seeded sample of 100 files (a top-k report) as it is saved, read again and used, as its first file is still there."""
    folder, files = streams.shared_dir(spark), table(spark, sf, "pages").where("url is not null").select(F.col("url").alias("path"), "page_id")
    tables.save_manifest(tables.sampled(files, 100), folder, 42, sf)
    return tables.usable_manifest(tables.manifest(spark, folder), files)


@registered("SELECT count(*)::DOUBLE AS pages, count(*) FILTER (event_type = 'error')::DOUBLE AS errors, round(avg(value), 4) AS mean, max(value) AS longest, 0::DOUBLE AS startup_time FROM events")
def run_saved_and_read(spark, sf):
    """Figures of a run as they are saved and read again; one that the run hasn't is 0."""
    v, folder = F.col("value"), streams.shared_dir(spark)
    run = table(spark, sf, "events").agg(F.count("*").alias("pages"), F.count_if(F.col("event_type") == "error").alias("errors"), F.round(F.avg(v), 4).alias("mean"), F.max(v).alias("longest"))
    tables.save_run(run, folder)
    return tables.saved_run(spark, folder, ["pages", "errors", "mean", "longest", "startup_time"])


LOAD = "CASE p_size % 5 WHEN 0 THEN concat(p_size, '.25%') WHEN 1 THEN concat(p_size, '%') WHEN 2 THEN concat(p_size, '.5') WHEN 3 THEN 'N/A' ELSE NULL END"


@registered(f"SELECT p_brand, round(coalesce(avg(load) FILTER (load > 0), 0), 6) AS mean, max(load) AS most FROM (SELECT p_brand, CASE p_size % 5 WHEN 0 THEN p_size + 0.25 WHEN 1 THEN p_size WHEN 2 THEN p_size + 0.5 ELSE 0 END::DOUBLE AS load FROM part) GROUP BY 1")
def load_percent(spark, sf):
    """Loads written as percentages; what is no number, and null, is 0."""
    rows = table(spark, sf, "part").select("p_brand", texts.percent(F.expr(LOAD)).alias("load"))
    return rows.groupBy("p_brand").agg(F.round(metrics.positive_mean(F.col("load")), 6).alias("mean"), F.max("load").alias("most"))


@registered("""SELECT 'first' AS engine, doc_id, n_chars AS chars, NULL::BIGINT AS quality FROM documents
UNION ALL SELECT 'second', d.doc_id, NULL, l.quality FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id""")
def comparison_saved(spark, sf):
    """Both engines' figures of each document as they are saved and read again, side by side with documents that one hasn't."""
    docs, folder = table(spark, sf, "documents"), streams.shared_dir(spark)
    second = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    both = accuracy.side_by_side(docs.select("doc_id"), docs.select("doc_id", F.col("n_chars").alias("chars")), second, "doc_id")
    accuracy.save_comparison(both, folder, "doc_id")
    return spark.read.schema("engine string, doc_id long, chars long, quality long").json(folder)


@registered("SELECT o_orderkey, o_orderdate, (row_number() OVER (ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) - 1) // 500 AS page FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC LIMIT 1200")
def queue_target(spark, sf):
    """The queue up to a target of 1,200 documents (a top-k report), in pages of 500 at most."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    found = [(*r, k) for k, page in enumerate(workqueue.pages(rows, 500, 1200, at="o_orderdate", key="o_orderkey")) for r in page]
    return spark.createDataFrame(found, "o_orderkey long, o_orderdate timestamp, page long")


@registered("""SELECT doc_id AS document_id, coalesce(text, '') AS full_text, 1 AS pages, 95::DOUBLE AS confidence, doc_id % 3 = 1 AS came_again, (SELECT count(*) + 1 FROM documents WHERE doc_id % 3 = 1) AS rows_refused
FROM documents""")
def sink_with_refused_batch(spark, sf):
    """Documents saved in three batches; the second one names a document twice at first, is refused whole and kept apart, and comes again."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), F.col("text").alias("full_text"), F.lit(1).alias("pages"), F.lit(None).cast("double").alias("confidence"))
    sink = ResultSink(spark, streams.shared_dir(spark), RESULT)
    batch = lambda k: docs.where(F.col("document_id") % 3 == k)
    sink.save(batch(0), 0)
    sink.save(batch(1).unionByName(batch(1).orderBy("document_id").limit(1)), 1)  # refused
    missing = docs.where(F.col("document_id") % 3 < 2).join(sink.read().select("document_id"), "document_id", "left_anti")
    sink.save(missing, 2)
    sink.save(batch(2), 3)
    sink.save(batch(2), 3)  # comes again, counts once
    refused = sink.failures().agg(F.sum("rows").alias("rows_refused"))
    return sink.read().select("document_id", "full_text", "pages", "confidence", (F.col("document_id") % 3 == 1).alias("came_again")).crossJoin(F.broadcast(refused))
