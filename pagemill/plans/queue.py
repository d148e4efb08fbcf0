"""Queries on the work queue and on names of files. Orders stand for documents, lines for results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import paths
from pagemill.operators import workqueue
from pagemill.operators.pageplan import batches, on_disk, page_tasks
from pagemill.operators.results import by_suffix
from pagemill.operators.workqueue import QueueFilter
from pagemill.plans.catalogue import registered
from pagemill.sources.tables import sampled, table
from pagemill.streaming import apply as streams
from pagemill.streaming.queue import Queue

NAMES = {"id": "o_orderkey", "document_type": "o_orderpriority", "recorded_at": "o_orderdate", "created_at": "o_orderdate"}
SHOWN = ["o_orderkey", "o_orderdate", "o_orderpriority"]
NEW = QueueFilter(end_date="2000-12-31", excluded_types=("5-LOW",), needs_url=False, columns=NAMES)
EVERY = QueueFilter(excluded_types=("none",), needs_url=False, columns=NAMES)
AGAIN = QueueFilter(excluded_types=("5-LOW",), reprocess_before="1998-01-01", needs_url=False, columns=NAMES)
PENDING = "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"
NEW_SQL = f"{PENDING} AND o_orderpriority <> '5-LOW' AND o_orderdate <= TIMESTAMP '2000-12-31'"
DUE_SQL = """SELECT o_orderkey, o_orderdate, updated_at FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS updated_at FROM lineitem GROUP BY 1) r
ON o_orderkey = l_orderkey WHERE o_orderpriority <> '5-LOW' AND updated_at < TIMESTAMP '1998-01-01'"""


def orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders")


def waiting(spark, sf, where: QueueFilter = EVERY) -> DataFrame:
    return workqueue.pending(orders(spark, sf), table(spark, sf, "lineitem"), where, "o_orderkey", "l_orderkey").select(*SHOWN)


def due(spark, sf) -> DataFrame:
    results = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("updated_at"))
    return workqueue.due_again(orders(spark, sf), results, AGAIN, "o_orderkey", "l_orderkey").select("o_orderkey", "o_orderdate", "updated_at")


@registered("""SELECT o_orderkey AS id, o_custkey::VARCHAR AS source_document_id, o_orderpriority AS document_type, NULL::VARCHAR AS book_page_number, o_orderdate AS recorded_at, o_orderdate AS created_at, nullif(o_orderstatus, 'P') AS pdf_url, NULL::VARCHAR AS legal_description,
l_orderkey AS ocr_result_id FROM orders JOIN (SELECT DISTINCT l_orderkey FROM lineitem) r ON o_orderkey = l_orderkey WHERE o_orderpriority NOT IN ('UNUSED FILE NUMBER', 'BLANK') AND nullif(o_orderstatus, 'P') IS NOT NULL""")
def queue_fields(spark, sf):
    """Documents that are due again, as the queue shows them; only those with a URL (the status stands for it, P for none)."""
    none = F.lit(None).cast("string")
    docs = orders(spark, sf).select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("source_document_id"), F.col("o_orderpriority").alias("document_type"), none.alias("book_page_number"),
        F.col("o_orderdate").alias("recorded_at"), F.col("o_orderdate").alias("created_at"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("pdf_url"), none.alias("legal_description"),
    )
    results = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.lit(None).cast("timestamp").alias("updated_at")).distinct()
    return workqueue.queue_fields(workqueue.due_again(docs, results))


HOW = {"at": "o_orderdate", "key": "o_orderkey"}


@registered(PENDING)
def pending_anti(spark, sf):
    return waiting(spark, sf)


@registered("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def pending_left_isnull(spark, sf):
    """The older form of the queue: an outer join, and of it the rows without a result."""
    return workqueue.pending_by_outer_join(orders(spark, sf), table(spark, sf, "lineitem"), EVERY, "o_orderkey", "l_orderkey").select(*SHOWN)


@registered("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_docs(spark, sf):
    where = QueueFilter(excluded_types=("none",), needs_url=False, columns={"document_type": "lang"})
    return workqueue.pending(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), where, "doc_id", "doc_id")


@registered(f"{NEW_SQL} ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC LIMIT 50")
def pending_page_desc(spark, sf):
    return workqueue.page_of(waiting(spark, sf, NEW), 50, **HOW)


@registered(f"{NEW_SQL} ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC LIMIT 50 OFFSET 50")
def pending_page_cursor(spark, sf):
    rows = waiting(spark, sf, NEW)
    after = workqueue.next_cursor(workqueue.page_of(rows, 50, **HOW).collect(), 50, *HOW.values())
    return workqueue.page_of(rows, 50, after, **HOW) if after else rows.limit(0)


@registered(f"{DUE_SQL} ORDER BY o_orderdate ASC NULLS LAST, o_orderkey ASC LIMIT 50")
def reprocess_page_asc(spark, sf):
    return workqueue.page_of(due(spark, sf), 50, ascending=True, **HOW)


@registered("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC LIMIT 100")
def legacy_top_recent(spark, sf):
    return workqueue.page_of(orders(spark, sf).select(*SHOWN), 100, **HOW)


@registered(f"SELECT count(*) AS n FROM ({NEW_SQL})")
def count_new_filtered(spark, sf):
    return waiting(spark, sf, NEW).agg(F.count("*").alias("n"))


@registered(f"SELECT count(*) AS n FROM ({DUE_SQL})")
def count_reprocess_filtered(spark, sf):
    return due(spark, sf).agg(F.count("*").alias("n"))


@registered("SELECT greatest((SELECT count(*) FROM documents) - (SELECT count(*) FROM labels), 0)::BIGINT AS n")
def count_approx_new(spark, sf):
    return workqueue.about_pending(table(spark, sf, "documents"), table(spark, sf, "labels"))


@registered("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')")
def filter_excluded_types(spark, sf):
    where = QueueFilter(excluded_types=("5-LOW", "4-NOT SPECIFIED"), needs_url=False, columns=NAMES)
    return orders(spark, sf).where(where.condition()).select(*SHOWN)


@registered("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31'")
def filter_included_types(spark, sf):
    where = QueueFilter(included_types=("1-URGENT", "5-LOW"), excluded_types=("5-LOW",), needs_url=False, columns=NAMES, **workqueue.year(1997))
    return orders(spark, sf).where(where.condition()).select(*SHOWN)


EVENTS = {"document_type": "event_type", "recorded_at": "ts", "created_at": "ts"}


@registered("SELECT event_id, ts FROM events WHERE event_type <> 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-10'")
def filter_date_range_midnight(spark, sf):
    where = QueueFilter(start_date="2024-01-05", end_date="2024-01-10", excluded_types=("click",), needs_url=False, columns=EVENTS)
    return table(spark, sf, "events").where(where.condition()).select("event_id", "ts")


@registered("SELECT event_id, ts FROM events WHERE event_type <> 'click' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def filter_uploaded_inclusive(spark, sf):
    where = QueueFilter(excluded_types=("click",), needs_url=False, columns=EVENTS, **workqueue.on_day("2024-01-10"))
    return table(spark, sf, "events").where(where.condition()).select("event_id", "ts")


FORMS = """CASE page_id % 6 WHEN 0 THEN concat('https://h/web/document-image-pdf/DOC', page_id, 'S1//', page_id, '-1.pdf') WHEN 1 THEN concat('x?Type=DOC/DOCC', page_id, '/', page_id, '-2.pdf')
WHEN 2 THEN concat('/p/DOCC', page_id, '/a.pdf') WHEN 3 THEN concat('/p/DOC7S', page_id, '/b.pdf') WHEN 4 THEN concat(url, '/q', page_id, '.pdf') ELSE url END"""
_P = [*paths.URL_PATTERNS]


@registered(f"""SELECT page_id, u AS pdf_url,
CASE {" ".join(f"WHEN regexp_matches(u, '{p}') THEN regexp_extract(u, '{p}', 1)" for p in _P)} WHEN regexp_matches(u, '{paths.FILE_PATTERN}') THEN 'DOC' ELSE 'unknown' END AS doc_id,
CASE {" ".join(f"WHEN regexp_matches(u, '{p}') THEN regexp_extract(u, '{p}', 2)" for p in _P)} WHEN regexp_matches(u, '{paths.FILE_PATTERN}') THEN regexp_extract(u, '{paths.FILE_PATTERN}', 1) ELSE 'document' END AS name
FROM (SELECT page_id, {FORMS} AS u FROM pages)""")
def url_parts(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.expr(FORMS).alias("pdf_url"))
    return rows.withColumn("part", paths.url_parts(F.col("pdf_url"))).select("page_id", "pdf_url", "part.doc_id", "part.name")


@registered("SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') || '/DOC' || o_orderkey || '_' || o_orderpriority || '.pdf' AS path FROM orders")
def date_paths(spark, sf):
    path = paths.relative_path(F.col("o_orderdate"), F.concat(F.lit("DOC"), "o_orderkey"), F.col("o_orderpriority"))
    return orders(spark, sf).select("o_orderkey", path.alias("path"))


PART_PATH = "concat('1999/01/02/DOC', p_partkey, CASE WHEN p_size % 7 = 0 THEN '_BM' ELSE '_' END, p_partkey, '-00', p_size, '-1.pdf')"
NAMES_SQL = f"""paths AS (SELECT p_partkey, p_size, {PART_PATH} AS path FROM part),
cut AS (SELECT *, regexp_extract(path, '/(DOC[^_]+)_\\d+-\\d+-\\d+\\.pdf', 1) AS d, regexp_extract(path, '_(\\d+)-\\d+-\\d+\\.pdf', 1) AS b, regexp_extract(path, '_\\d+-(\\d+)-\\d+\\.pdf', 1) AS p, regexp_extract(path, '_\\d+-\\d+-(\\d+)\\.pdf', 1) AS s FROM paths),
tried AS (SELECT p_partkey, p_size, path, 0 AS rank, path AS name FROM cut UNION ALL SELECT p_partkey, p_size, path, 1, path || '.pdf' FROM cut
UNION ALL SELECT p_partkey, p_size, path, 2, '1999/01/02/' || d || '_B: ' || b || ' P: ' || p || '-' || s || '.pdf' FROM cut WHERE d <> ''
UNION ALL SELECT p_partkey, p_size, path, 3, '1999/01/02/' || d || '_B' || b || 'P' || p || '-' || s || '.pdf' FROM cut WHERE d <> ''
UNION ALL SELECT p_partkey, p_size, path, 4, '1999/01/02/' || d || '_B_' || b || '_P_' || p || '-' || s || '.pdf' FROM cut WHERE d <> '')"""


@registered(f"WITH {NAMES_SQL} SELECT p_partkey, rank, name FROM tried")
def alt_path_candidates(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.expr(PART_PATH).alias("path"))
    return rows.select("p_partkey", F.posexplode(paths.candidates(F.col("path"))).alias("rank", "name"))


@registered(f"WITH {NAMES_SQL} SELECT p_partkey, path, max(CASE WHEN rank = p_size % 6 THEN name END) AS found FROM tried GROUP BY 1, 2")
def resolve_paths(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", F.expr(PART_PATH).alias("path"))
    # on disk lies the name whose rank is p_size modulo 6, if there is one
    there = rows.select("p_size", F.posexplode(paths.candidates(F.col("path"))).alias("rank", "name")).where("rank = p_size % 6").select(F.col("name").alias("path"))
    return on_disk(rows.select("p_partkey", "path"), there)


@registered("SELECT page_id, CASE WHEN starts_with(url, 'https://m.') THEN '/data/' || substr(url, 11) ELSE url END AS path FROM pages")
def container_prefix(spark, sf):
    return table(spark, sf, "pages").select("page_id", paths.with_prefix(F.col("url"), "https://m.", "/data/").alias("path"))


@registered("SELECT user_id, page::INTEGER AS page FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1), LATERAL (SELECT unnest(range(n)) AS page) WHERE n <= 30 OR page < 25 OR page >= n - 5")
def page_cap(spark, sf):
    return page_tasks(table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("page_count"))).select("user_id", "page")


@registered("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch FROM documents")
def doc_batches(spark, sf):
    return batches(table(spark, sf, "documents").select("doc_id"), "doc_id", 16).select("doc_id", "batch")


PLAIN = "regexp_replace(url, '[?#].*$', '')"


@registered(f"""WITH files AS (SELECT page_id, {PLAIN} AS path FROM pages), asked AS (SELECT page_id, '/data/' || regexp_extract(path, '[^/]*$') AS target FROM files)
SELECT a.page_id, a.target, f.path, f.page_id AS file_id FROM asked a LEFT JOIN LATERAL (SELECT path, page_id FROM files WHERE ends_with(path, regexp_extract(a.target, '[^/]*$')) ORDER BY page_id LIMIT 1) f ON true""")
def suffix_lookup(spark, sf):
    files = table(spark, sf, "pages").select("page_id", F.expr(PLAIN).alias("path"))
    asked = files.select("page_id", F.concat(F.lit("/data/"), paths.basename(F.col("path"))).alias("target"))
    return by_suffix(asked, files.select("path", F.col("page_id").alias("ordinal"), F.col("page_id").alias("file_id")))


@registered("SELECT url AS path, page_id FROM pages ORDER BY md5(url || '42') NULLS FIRST, url NULLS FIRST, page_id LIMIT 100")
def seeded_sample(spark, sf):
    """A top-k report: 100 files by the digest of their name and a seed."""
    return sampled(table(spark, sf, "pages").select(F.col("url").alias("path"), "page_id"), 100)


@registered(f"WITH p AS ({PENDING}), n AS (SELECT *, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) - 1 AS nth, count(*) OVER () AS every FROM p) SELECT o_orderkey, (nth // greatest(100, every // 3 + 1))::BIGINT AS page FROM n")
def queue_in_pages(spark, sf):
    """The pending orders page by page, newest first; the run breaks off after a page and goes on."""
    rows, folder = waiting(spark, sf), streams.shared_dir(spark)
    pages = streams.VersionedTable(spark, f"{folder}/pages", "o_orderkey long, page long", "o_orderkey")
    size = min(100_000, max(100, rows.count() // 3 + 1))

    def handle(page, number):
        pages.update(lambda old, new: old.unionByName(new), page.select("o_orderkey", F.lit(number).cast("long").alias("page")), number, "queue")

    queue = lambda: Queue(spark, folder, rows, "o_orderdate", "o_orderkey", size)
    queue().run(handle, most_pages=1)
    if queue().place()[1] is not None:  # else one page was all
        queue().run(handle)
    return pages.read()
