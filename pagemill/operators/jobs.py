"""Jobs: expected and received pages, status, totals, retention and abandoned jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.texts import is_not_found

# States that end a job.
ENDED = ("completed", "completed_with_errors", "failed")


def missing_pages(expected: DataFrame, received: DataFrame) -> DataFrame:
    """Expected pages (job_id, path, page) that never came."""
    on = ["job_id", "path", "page"]
    return expected.select(*on).distinct().join(received.select(*on), on, "left_anti")


def status_of(expected: Column, received: Column, failed: Column, dropped: Column) -> Column:
    """A job's state; dropped pages aren't waited for."""
    return F.when(received < expected - dropped, "processing").when((failed > 0) | (dropped > 0), "completed_with_errors").otherwise("completed")


def accounts(jobs: DataFrame, received: DataFrame) -> DataFrame:
    """Jobs (job_id, total_pages, dropped_pages) with processed and failed pages and their state.

    A page that came twice counts once; pages of unknown jobs don't count.
    """
    once = received.groupBy("job_id", "path", "page").agg(F.bool_or(F.col("status") == "error").alias("bad"))
    counts = once.groupBy("job_id").agg(F.count("*").alias("processed_pages"), F.count_if("bad").alias("failed_pages"))
    own = jobs.join(counts, "job_id", "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("processed_pages", "failed_pages")})
    return own.withColumn("status", status_of(F.col("total_pages"), F.col("processed_pages"), F.col("failed_pages"), F.col("dropped_pages")))


def totals(jobs: DataFrame) -> DataFrame:
    """Number of jobs, of completed ones, their pages, and pages a second of summed job time."""
    done = F.col("status").isin("completed", "completed_with_errors")
    own = jobs.agg(F.count("*").alias("jobs"), F.count_if(done).alias("completed_jobs"), F.coalesce(F.sum(F.when(done, F.col("processed_pages"))), F.lit(0)).cast("long").alias("pages"), F.sum(F.when(done, F.col("seconds"))).alias("seconds"))
    return own.withColumn("pages_per_second", F.coalesce(F.when(F.col("seconds") > 0, F.try_divide(F.col("pages").cast("double"), F.col("seconds"))), F.lit(0.0)))


def retained(jobs: DataFrame, now: Column, by: list[str], ended: str = "ended", key: str = "job_id", most: int = 100, oldest: float = 1800) -> DataFrame:
    """Ended jobs that stay: the newest ``most`` of each group, none of more than ``oldest`` seconds."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(ended), F.desc(key)))
    young = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(ended).cast("timestamp")) <= F.lit(int(oldest * 1_000_000))
    return jobs.withColumn("__nth", nth).where((F.col("__nth") <= most) & young).drop("__nth")


def polled(status: Column, error: Column, not_found: Column, age: Column, processed: Column, dropped: Column, total: Column) -> Column:
    """What a poll of a job means: wait, complete, failed or abandoned."""
    stuck = (status == "processing") & (total > 0) & (processed + dropped >= total)
    return (
        F.when(is_not_found(error) & (not_found >= 3), "abandoned")
        .when(is_not_found(error), "wait")
        .when(status.isin("completed", "completed_with_errors", "partial") | stuck, "complete")
        .when(status == "failed", "failed")
        .when(age > 600, "abandoned")
        .otherwise("wait")
    )
