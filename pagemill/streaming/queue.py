"""The work queue as a source that goes on where it was, and a sink that keeps failures apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.upsert import Breaker, staged, upserted
from pagemill.operators.workqueue import page_of
from pagemill.streaming.versioned import VersionedTable

FAILED = "writer string, number long, rows long, error string"


class ResultSink:
    """Results by document, saved batch by batch behind a breaker.

    A batch that can't be saved leaves the table as it was; it is written to a log with its rows'
    number and the error, and its documents stay pending, so they come again. While the breaker is
    open batches fail at once. New documents are added to the table, of known ones the parts that
    hold them are written anew. A batch that comes again after it was saved isn't saved again. What
    a saved batch holds is counted in the job that writes it.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str = "document_id", breaker: Breaker | None = None):
        self.spark, self.key, self.log = spark, key, f"{folder}/failed"
        self.table = VersionedTable(spark, f"{folder}/results", schema, key)
        self.breaker = breaker or Breaker()
        spark.createDataFrame([], FAILED).write.mode("ignore").parquet(self.log)

    def read(self) -> DataFrame:
        return self.table.read()

    def failures(self) -> DataFrame:
        return self.spark.read.schema(FAILED).parquet(self.log)

    def save(self, results: DataFrame, number: int, writer: str = "") -> dict[str, int] | None:
        """Counts of what was saved (saved, pages), none of either if it was before; None if saving failed."""
        seen = Observation()
        now = self.spark.range(1).select(F.current_timestamp()).first()[0]
        written = []

        def change(table: DataFrame, batch: DataFrame) -> DataFrame:
            new = upserted(table, staged(batch), self.key, F.lit(now))
            own = F.col("updated_at") == F.lit(now)
            written.append(True)
            pages = F.sum(F.when(own, F.col("pages"))) if "pages" in new.columns else F.lit(0)
            return new.observe(seen, F.count_if(own).alias("saved"), F.coalesce(pages, F.lit(0)).cast("long").alias("pages"))

        try:
            self.breaker.call(self.table.update, change, results, number, writer, True)
        except Exception as error:  # whatever a sink raises: the batch is kept apart
            rows = self.count(results)
            self.spark.createDataFrame([(writer, number, rows, str(error)[:1000])], FAILED).coalesce(1).write.mode("append").parquet(self.log)
            return None
        return dict(seen.get) if written else {"saved": 0, "pages": 0}

    @staticmethod
    def count(results: DataFrame) -> int | None:
        """The rows of a batch that wasn't saved; null if they can't be worked out either."""
        try:
            return results.count()
        except Exception:
            return None


class Queue:
    """Works through a queue page by page in its order by (time, key), and goes on after a restart.

    Where it is lies in a table of its own, written after each page; a page that was handled when
    the run broke off before that comes again with the same number, so whoever handles it knows. A
    queue that was worked through begins anew the next time, with whatever is pending then.
    """

    def __init__(self, spark: SparkSession, folder: str, rows: DataFrame, at: str = "recorded_at", key: str = "id", size: int = 500, ascending: bool = False, name: str = "queue"):
        self.spark, self.rows, self.at, self.key, self.size, self.ascending, self.name = spark, rows, at, key, size, ascending, name
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        self.schema = f"name string, number long, ended boolean, at {kinds[at]}, last {kinds[key]}"
        self.places = VersionedTable(spark, f"{folder}/cursor", self.schema, "name", 1)

    def place(self) -> tuple[int, tuple | None]:
        """The number of the next page, and the (time, key) of the last row before it."""
        found = self.places.read().where(F.col("name") == self.name).collect()
        if not found:
            return 0, None
        return found[0]["number"] + 1, None if found[0]["ended"] else (found[0]["at"], found[0]["last"])

    def last(self, page: DataFrame) -> tuple[int, tuple]:
        """How many rows a page has, and (time, key) of the one that comes last in the queue's order."""
        t, i = F.col(self.at), F.col(self.key)
        ends = F.max if self.ascending else F.min
        found = page.agg(F.count("*").alias("n"), F.count(t).alias("timed"), ends(F.when(t.isNotNull(), F.struct(t.alias("t"), i.alias("i")))).alias("own"), ends(F.when(t.isNull(), i)).alias("none")).first()
        untimed = found["timed"] < found["n"] if self.ascending else found["timed"] == 0  # null times come last, or first
        return found["n"], (None, found["none"]) if untimed else (found["own"]["t"], found["own"]["i"])

    def run(self, handle: Callable[[DataFrame, int], None], most_pages: int | None = None) -> int:
        """Pass pages of at most ``size`` rows to ``handle(page, number)``; how many rows they had."""
        rows, pages = 0, 0
        while most_pages is None or pages < most_pages:
            number, after = self.place()
            page = page_of(self.rows, self.size, after, self.ascending, self.at, self.key).persist()
            try:
                n, last = self.last(page)
                if n:
                    handle(page, number)
                ended = n < self.size
                place = self.spark.createDataFrame([(self.name, number, ended, *last)], self.schema)
                self.places.update(lambda _, new: new, place)
            finally:
                page.unpersist()
            rows, pages = rows + n, pages + 1
            if ended:
                break
        return rows
