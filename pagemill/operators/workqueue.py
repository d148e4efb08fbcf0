"""The work queue: which documents are pending or due again, counted and paged."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Document types that are never worked on unless a filter names others.
EXCLUDED = ("UNUSED FILE NUMBER", "BLANK")
FIELDS = ("id", "source_document_id", "document_type", "book_page_number", "recorded_at", "created_at", "pdf_url", "legal_description")


@dataclass(frozen=True)
class QueueFilter:
    """Conditions on the queue; dates are ISO texts; a condition that isn't set doesn't count.

    The last recorded day counts only up to its midnight, the last upload day as a whole. A null
    type never passes. Excluded and included types hold both.
    """

    start_date: str | None = None
    end_date: str | None = None
    excluded_types: tuple[str, ...] = ()
    included_types: tuple[str, ...] = ()
    uploaded_after: str | None = None
    uploaded_before: str | None = None
    reprocess_before: str | None = None
    needs_url: bool = True
    columns: dict[str, str] = field(default_factory=dict)

    def __getitem__(self, name: str) -> Column:
        return F.col(self.columns.get(name, name))

    def conditions(self, again: bool = False) -> list[Column]:
        day = lambda text: F.lit(text).cast("date")
        out = [~self["document_type"].isin(*(self.excluded_types or EXCLUDED))]
        if self.needs_url:
            out.append(self["pdf_url"].isNotNull())
        if self.included_types:
            out.append(self["document_type"].isin(*self.included_types))
        if self.start_date:
            out.append(self["recorded_at"] >= day(self.start_date).cast("timestamp"))
        if self.end_date:
            out.append(self["recorded_at"] <= day(self.end_date).cast("timestamp"))
        if self.uploaded_after:
            out.append(self["created_at"] >= day(self.uploaded_after).cast("timestamp"))
        if self.uploaded_before:
            out.append(self["created_at"] < (F.date_add(day(self.uploaded_before), 1)).cast("timestamp"))
        if again and self.reprocess_before:
            out.append(F.col("updated_at") < day(self.reprocess_before).cast("timestamp"))
        return out

    def condition(self, again: bool = False) -> Column:
        return reduce(and_, self.conditions(again), F.lit(True))


def year(number: int) -> dict[str, str]:
    """The dates that stand for a whole year."""
    return {"start_date": f"{number}-01-01", "end_date": f"{number}-12-31"}


def on_day(day: str) -> dict[str, str]:
    """The dates that stand for all uploads of a day."""
    return {"uploaded_after": day, "uploaded_before": day}


def pending(documents: DataFrame, results: DataFrame, where: QueueFilter | None = None, key: str = "id", result_key: str = "document_id") -> DataFrame:
    """Documents without a result that pass the filter."""
    rows = documents.where((where or QueueFilter()).condition())
    return rows.join(results.select(F.col(result_key).alias(key)), key, "left_anti")


def pending_by_outer_join(documents: DataFrame, results: DataFrame, where: QueueFilter | None = None, key: str = "id", result_key: str = "document_id") -> DataFrame:
    """The same by the older form, an outer join of which the rows without a partner stay.

    Results are taken once for each document first, so those that have many don't multiply.
    """
    rows = documents.where((where or QueueFilter()).condition())
    known = results.groupBy(F.col(result_key).alias("__key")).agg(F.count("*").alias("__results"))
    return rows.join(known, F.col(key) == F.col("__key"), "left").where("__results is null").drop("__key", "__results")


def due_again(documents: DataFrame, results: DataFrame, where: QueueFilter | None = None, key: str = "id", result_key: str = "document_id") -> DataFrame:
    """Documents with a result, with its id and time; ``reprocess_before`` keeps the older ones."""
    known = results.select(F.col(result_key).alias(key), F.col("id").alias("ocr_result_id") if "id" in results.columns else F.col(result_key).alias("ocr_result_id"), "updated_at")
    return documents.join(known, key).where((where or QueueFilter()).condition(again=True))


def page_of(rows: DataFrame, size: int, after: tuple | None = None, ascending: bool = False, at: str = "recorded_at", key: str = "id") -> DataFrame:
    """A page of the queue by (time, id): newest first, or oldest first.

    ``after`` is the last row of the page before. Null times come first in descending order and
    last in ascending order, and are paged through like any other time.
    """
    t, i = F.col(at), F.col(key)
    if after is not None:
        time, last = after
        if ascending:
            rows = rows.where(t.isNull() & (i > last)) if time is None else rows.where((t > time) | ((t == time) & (i > last)) | t.isNull())
        else:
            rows = rows.where(t.isNotNull() | (i < last)) if time is None else rows.where((t < time) | ((t == time) & (i < last)))
    order = [t.asc_nulls_last(), i.asc()] if ascending else [t.desc_nulls_first(), i.desc()]
    return rows.orderBy(*order).limit(size)


def next_cursor(page: list[Row], size: int, at: str = "recorded_at", key: str = "id") -> tuple | None:
    """Where the next page starts; None after a short page."""
    return (page[-1][at], page[-1][key]) if len(page) == size else None


def pages(rows: DataFrame, size: int = 500, target: int | None = None, **how):
    """The pages of a queue, one after another, until it or ``target`` is used up."""
    after, made = None, 0
    while target is None or made < target:
        wanted = size if target is None else min(size, target - made)
        found = page_of(rows, wanted, after, **how).collect()  # one page: at most ``size`` rows
        made += len(found)
        if found:
            yield found
        after = next_cursor(found, wanted, how.get("at", "recorded_at"), how.get("key", "id"))
        if after is None:
            return


def queue_fields(rows: DataFrame) -> DataFrame:
    """What is known of a document in the queue: FIELDS, and its result's id where it has one."""
    return rows.select(*FIELDS, *[c for c in ("ocr_result_id",) if c in rows.columns])


def about_pending(documents: DataFrame, results: DataFrame) -> DataFrame:
    """How many documents have no result, from the tables' row counts alone; never below 0."""
    a, b = (x.agg(F.count(F.lit(1)).alias("n")) for x in (documents, results))
    return a.crossJoin(b.select(F.col("n").alias("m"))).select(F.greatest(F.col("n") - F.col("m"), F.lit(0)).cast("long").alias("n"))
