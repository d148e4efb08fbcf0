"""From pages to documents: text, confidence, summaries, and lookup of a document's pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.texts import LINES, page_confidence, page_text

PAGE = f"struct<job_id:string,page_num:double,pdf_path:string,status:string,error:string,text_lines:{LINES},process_time:double,render_time:double,ocr_time:double,det_shape_snapped:double>"
JOB = f"struct<job_id:string,status:string,total_pages:int,process_time:double,results:map<string,map<string,{PAGE}>>>"


def parsed_jobs(texts: DataFrame, column: str = "value") -> DataFrame:
    """Rows (job_id, status, total_pages, process_time, results) of JSON answers."""
    return texts.select(F.from_json(F.col(column), JOB).alias("job")).select("job.*")


def readable(jobs: DataFrame) -> DataFrame:
    """Jobs whose answer could be read and names its job; a broken answer costs only its own job."""
    return jobs.where(F.col("job_id").isNotNull() & F.col("results").isNotNull())


def page_rows(jobs: DataFrame) -> DataFrame:
    """A row for each page: job_id, ordinal and path of its document, page and the page's fields."""
    files = jobs.select("job_id", F.posexplode("results").alias("ordinal", "path", "pages"))
    found = files.select("job_id", "ordinal", "path", F.explode("pages").alias("page_key", "found"))
    number = F.when(F.col("page_key").rlike("^[0-9]+$"), F.col("page_key").try_cast("int")).otherwise(0)
    return found.select("job_id", "ordinal", "path", number.alias("page"), "found.status", "found.error", F.col("found.text_lines").alias("lines"), "found.process_time", "found.render_time", "found.ocr_time")


def documents_of(pages: DataFrame, by: Sequence[str], lines: Column | None = None) -> DataFrame:
    """One row for each document: full_text, pages, confidence.

    Successful pages with text are joined in the order of path and page number. Confidence is the
    mean over successful pages of more than 0. All pages count, failed ones too. A document's pages
    are few (a page list is capped), so gathering them is bounded.
    """
    lines = F.col("lines") if lines is None else lines
    good = F.col("status") == "success"
    own = pages.select(*by, "path", "page", good.alias("good"), page_text(lines).alias("t"), page_confidence(lines).alias("c"))
    texts = F.array_sort(F.collect_list(F.when(F.col("good") & (F.col("t") != ""), F.struct("path", "page", "t"))))
    return own.groupBy(*by).agg(
        F.array_join(F.transform(texts, lambda x: x["t"]), "\n\n").alias("full_text"),
        F.count("*").cast("int").alias("pages"),
        F.coalesce(F.avg(F.when(F.col("good") & (F.col("c") > 0), F.col("c"))), F.lit(0.0)).alias("confidence"),
    )


def summary(pages: DataFrame) -> DataFrame:
    """A row for each page: status, text, confidence, number of lines (0 if it failed) and error."""
    good = F.col("status") == "success"
    return pages.withColumns({
        "text": F.when(good, page_text(F.col("lines"))).otherwise(""),
        "confidence": F.when(good, page_confidence(F.col("lines"))).otherwise(0.0),
        "line_count": F.when(good, F.coalesce(F.size("lines"), F.lit(0))).otherwise(0).cast("int"),
        "error": F.when(good, F.lit(None)).otherwise(F.coalesce("error", F.lit("Unknown error"))),
    })


def metadata(engine: Column, model: Column, job_id: Column, total_pages: Column, status: Column, time: Column) -> Column:
    """The metadata kept with a result, as JSON with its null fields."""
    row = F.struct(engine.alias("engine"), model.alias("model"), job_id.alias("job_id"), total_pages.alias("total_pages"), status.alias("job_status"), time.alias("job_process_time"))
    return F.to_json(row, {"ignoreNullFields": "false"})


def by_suffix(targets: DataFrame, files: DataFrame, few: bool = False) -> DataFrame:
    """Targets (target) with the file (path, ordinal, any more) that answers to each, if any does.

    A file of the same path answers first; else the first file, by ordinal, whose path ends with
    the target's base name. Files are looked up by their endings of the lengths that base names
    have, and only the first file of each ending is kept before the join. With ``few`` targets
    (a bounded number) theirs are picked where the files are read, so the others don't move.
    """
    kept = [c for c in files.columns if c != "ordinal"]
    name = F.element_at(F.split("target", "/"), -1)
    asked = targets.select("target", name.alias("name"), F.length(name).alias("size")).distinct()
    sizes = asked.select("size").distinct().agg(F.collect_set("size").alias("sizes"))  # at most a path's length
    first = lambda rows, by: rows.groupBy(*by).agg(F.min_by(F.struct(*kept), "ordinal").alias("file"))
    ends = files.crossJoin(F.broadcast(sizes)).withColumn("size", F.explode("sizes")).where(F.length("path") >= F.col("size"))
    ending = F.when(F.col("size") == 0, "").otherwise(F.right(F.col("path"), F.col("size"))).alias("name")
    picked = lambda rows, c: rows.join(F.broadcast(asked.select(c).distinct()), c, "left_semi") if few else rows
    ends = first(picked(ends.select(*files.columns, ending), "name"), ["name"]).withColumnRenamed("file", "by_name")
    same = first(picked(files.withColumn("target", F.col("path")), "target"), ["target"]).withColumnRenamed("file", "by_path")
    found = asked.join(same, "target", "left").join(ends, "name", "left").select("target", F.coalesce("by_path", "by_name").alias("file"))
    return targets.join(found, "target", "left").select(*targets.columns, "file.*")


def texts_for(targets: DataFrame, documents: DataFrame) -> DataFrame:
    """Targets (target) with the text of the document (path, ordinal, full_text) that answers to each.

    Null where no document answers, empty where the one that does has no text.
    """
    found = by_suffix(targets, documents.select("path", "ordinal", F.col("ordinal").alias("__at")))  # names only: no text is copied
    texts = documents.select(F.col("path").alias("__path"), F.col("ordinal").alias("__ordinal"), "full_text").dropDuplicates(["__path", "__ordinal"])
    return found.join(texts, (F.col("path") == F.col("__path")) & (F.col("__at") == F.col("__ordinal")), "left").select(*targets.columns, "full_text")
