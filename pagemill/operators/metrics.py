"""Figures of a run: throughput, percentiles, means, and comparison with an earlier run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.texts import delta, gibibytes
from pagemill.session import stored

#: Rows whose values a task puts in order, in the mean at most.
ROWS_OF_PART = 200_000


def rate(amount: Column, seconds: Column) -> Column:
    """Amount a second; 0 where there is no time."""
    return F.when(seconds > 0, amount / seconds).otherwise(0.0)


def positive_mean(value: Column) -> Column:
    return F.coalesce(F.avg(F.when(value > 0, value)), F.lit(0.0))


def percentiles(value: Column, at: tuple[float, ...] = (0.5, 0.95, 0.99)) -> list[Column]:
    """Exact percentiles with linear interpolation, named p50 and so on; 0 without a value.

    All are taken from one aggregate, which Spark shares among the columns.
    """
    found = F.percentile(value, list(at))
    return [F.coalesce(found[k], F.lit(0.0)).alias(f"p{round(p * 100)}") for k, p in enumerate(at)]


def exact_percentiles(rows: DataFrame, by: list[str], value: str, at: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Rows (by, p50 and so on): exact percentiles with linear interpolation of each group, 0 without a value.

    No task holds a group: values are counted first, dealt by ranges of group and value, and summed
    within each range; a group's ranges, in order, tell how many of its values lie before each. So
    a group with most of the rows is the work of as many tasks as its values fill ranges.
    """
    groups = [F.col(c).alias(f"__g{k}") for k, c in enumerate(by)]
    names = [f"__g{k}" for k in range(len(by))]
    counts = rows.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    parts = max(1, -(-rows.count() // ROWS_OF_PART))
    dealt = stored(counts.repartitionByRange(parts, *names, "__v").withColumn("__part", F.spark_partition_id()), "percentiles")
    sums = dealt.groupBy(*names, "__part").agg(F.sum("__n").alias("__sum"))  # a row for each range that a group lies in
    group = Window.partitionBy(*names)
    sums = sums.withColumns({"__before": F.sum("__sum").over(group.orderBy("__part")) - F.col("__sum"), "__all": F.sum("__sum").over(group)})
    renamed = sums.select(*[F.col(c).alias(f"_{c}") for c in (*names, "__part")], "__before", "__all")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*names, "__part")]
    own = dealt.join(renamed, same)
    upto = F.col("__before") + F.sum("__n").over(Window.partitionBy(*names, "__part").orderBy("__v"))
    own = own.withColumn("__upto", upto)
    found = []
    for k, p in enumerate(at):
        place = (F.col("__all") - 1) * F.lit(p)
        for end, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            found.append(F.max(F.when((F.col("__upto") > rank) & (F.col("__upto") - F.col("__n") <= rank), F.col("__v"))).alias(f"__{end}{k}"))
    ends = own.groupBy(*names).agg(F.max("__all").alias("__all"), *found)
    place = [(F.col("__all") - 1) * F.lit(p) for p in at]
    value_at = [(F.ceil(x) - x) * F.col(f"__lo{k}") + (x - F.floor(x)) * F.col(f"__hi{k}") for k, x in enumerate(place)]
    ends = ends.select(*names, *[F.when(F.col(f"__lo{k}") == F.col(f"__hi{k}"), F.col(f"__lo{k}")).otherwise(v).alias(f"p{round(p * 100)}") for k, (p, v) in enumerate(zip(at, value_at, strict=True))])
    every = rows.select(*by).distinct()
    return every.join(ends, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)], "left").select(*by, *[F.coalesce(f"p{round(p * 100)}", F.lit(0.0)).alias(f"p{round(p * 100)}") for p in at])


def spread(value: Column) -> Column:
    """Sample standard deviation; 0 for fewer than two values."""
    return F.coalesce(F.stddev_samp(value), F.lit(0.0))


def waits(jobs: DataFrame) -> DataFrame:
    """Jobs with queue_wait (start less submission) and overhead (wall less server time, 0 without one)."""
    return jobs.withColumn("queue_wait", F.col("start_time") - F.col("submit_time")).withColumn("overhead", F.when(F.col("server_time") > 0, F.col("wall_time") - F.col("server_time")).otherwise(0.0))


# What a comparison shows, in this order: label, figure of a run, places, unit.
SHOWN = [
    ("Pages/sec (wall)", "pages_per_sec_wall", 1, ""), ("Pages/sec (svr)", "pages_per_sec_server", 1, ""), ("Page p50", "page_latency_p50", 2, "s"), ("Page p95", "page_latency_p95", 2, "s"),
    ("Batch throughput σ", "batch_throughput_std", 1, ""), ("GPU utilization", "avg_gpu_utilization", 0, "%"), ("Page errors", "total_page_errors", 0, ""), ("Memory", "memory_peak", 1, "GiB"),
    ("Avg queue wait", "avg_queue_wait", 2, "s"), ("Startup time", "startup_time", 1, "s"), ("Avg render time", "avg_render_time", 3, "s"), ("Avg OCR time", "avg_ocr_time", 3, "s"),
]


def report(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows (ordinal, label, old, new, change) of two one-row runs, for the figures of SHOWN.

    A figure that a run hasn't is 0; memory is text and counts in GiB.
    """
    lines = spark_rows(old.sparkSession, SHOWN, "label string, metric string, places int, unit string")

    def figures(run: DataFrame, name: str) -> DataFrame:
        there = {c: F.coalesce(gibibytes(F.col(c)) if c == "memory_peak" else F.col(c).cast("double"), F.lit(0.0)) for _, c, *_ in SHOWN if c in run.columns}
        own = run.select(*[there.get(c, F.lit(0.0)).alias(c) for _, c, *_ in SHOWN])
        return own.unpivot([], [c for _, c, *_ in SHOWN], "metric", name)

    both = F.broadcast(lines).join(figures(old, "old"), "metric").join(figures(new, "new"), "metric")
    return both.select("ordinal", "label", "old", "new", delta(F.col("old"), F.col("new"), F.col("places"), F.col("unit")).alias("change"))


def spark_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"ordinal int, {schema}")


def time_shares(render: Column, ocr: Column) -> list[Column]:
    """Mean times for drawing and for reading a page (over times of more than 0), and their shares in percent."""
    a, b = positive_mean(render), positive_mean(ocr)
    share = lambda x: F.coalesce(F.when(a + b > 0, F.try_divide(x, a + b) * 100), F.lit(0.0))
    return [a.alias("render_time"), b.alias("ocr_time"), share(a).alias("render_percent"), share(b).alias("ocr_percent")]


def counters(documents: DataFrame, seconds: float, by: list[str] | None = None) -> DataFrame:
    """What a run did, from rows (ok, saved, pages): processed and failed documents, saved ones, pages, and rates.

    Pages of documents that weren't saved count; documents that failed have none.
    """
    ok = F.coalesce(F.col("ok"), F.lit(False))
    own = documents.groupBy(*(by or [])).agg(
        F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed"), F.count_if(ok & F.coalesce(F.col("saved"), F.lit(False))).alias("saved"),
        F.coalesce(F.sum(F.when(ok, F.col("pages"))), F.lit(0)).cast("long").alias("pages"),
    )
    return own.withColumns({"documents_per_second": rate(F.col("processed"), F.lit(float(seconds))), "pages_per_second": rate(F.col("pages"), F.lit(float(seconds)))})


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """Metrics (metric, value) of two runs side by side, with the change as a report writes it."""
    both = old.select("metric", F.col("value").alias("old")).join(new.select("metric", F.col("value").alias("new")), "metric")
    return both.withColumn("change", delta(F.col("old"), F.col("new")))


def as_metrics(run: DataFrame, names: list[str]) -> DataFrame:
    """A one-row run as rows (metric, value)."""
    return run.unpivot([], [F.col(n).cast("double").alias(n) for n in names], "metric", "value")


def regressed(baseline: Column, current: Column, threshold: float = 10.0) -> Column:
    """1 if throughput fell by more than the threshold in percent; never without a baseline."""
    return F.when((baseline > 0) & (F.try_divide(baseline - current, baseline) * 100 > threshold), 1).otherwise(0)
