"""Saving results: defaults, insert or update by key, and a breaker around a failing sink."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.json import json_text, merged

# What a result holds where it names nothing.
DEFAULTS = {"full_text": "", "pages": 0, "confidence": 95.0, "processing_time": 0.0, "ocr_metadata": "{}"}


class RepeatedKey(ValueError):
    """A batch names a document twice."""


def staged(results: DataFrame) -> DataFrame:
    """Results with the defaults for what is null; metadata may be a text of JSON, a struct or a map."""
    value = lambda c: json_text(results, c) if c == "ocr_metadata" else F.col(c)
    return results.withColumns({c: F.coalesce(value(c), F.lit(v)) for c, v in DEFAULTS.items() if c in results.columns})


def refuse_repeats(batch: DataFrame, key: str) -> None:
    again = batch.groupBy(key).count().where("count > 1").limit(1).collect()
    if again:
        raise RepeatedKey(f"{key} {again[0][key]!r} comes {again[0]['count']} times in one batch")


def upserted(target: DataFrame, batch: DataFrame, key: str = "document_id", now: Column | None = None, merge: tuple[str, ...] = ("ocr_metadata",)) -> DataFrame:
    """``target`` after the batch: new keys added, known ones updated.

    ``created_at`` stays, ``updated_at`` is the batch's one time, JSON columns in ``merge`` are
    merged at their top level. Columns that the batch hasn't keep their values. A batch that names
    a key twice, or has a row without one, fails when it runs; the check shares the join's exchange.
    """
    now = F.current_timestamp() if now is None else now
    new = batch.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__times"), F.first(F.struct(*[F.col(c).alias(f"__{c}") for c in batch.columns])).alias("__row"))
    again = F.raise_error(F.concat(F.lit(f"{key} "), F.col("__key").cast("string"), F.lit(" comes more than once in one batch"))).cast("boolean")
    none = F.raise_error(F.lit(f"a row of the batch has no {key}")).cast("boolean")
    new = new.where(F.when(F.col("__key").isNull(), none).when(F.col("__times") > 1, again).otherwise(F.lit(True))).select("__key", *[F.col(f"__row.__{c}") for c in batch.columns if c != key])
    both = target.join(new, F.col(key) == F.col("__key"), "full_outer")
    given, known = F.col("__key").isNotNull(), F.col(key).isNotNull()
    out = []
    for c in target.columns:
        if c == key:
            value = F.coalesce(key, "__key")
        elif c == "created_at":
            value = F.when(known, F.col(c)).otherwise(now)
        elif c == "updated_at":
            value = F.when(given, now).otherwise(F.col(c))
        elif c not in batch.columns:
            value = F.col(c)
        elif c in merge:
            value = F.when(given & known, merged(F.col(c), F.col(f"__{c}"))).when(given, F.col(f"__{c}")).otherwise(F.col(c))
        else:
            value = F.when(given, F.col(f"__{c}")).otherwise(F.col(c))
        out.append(value.alias(c))
    return both.select(*out)


class BreakerOpen(RuntimeError):
    """The sink failed too often; it isn't tried for a while."""


class Breaker:
    """Stops calling a sink after ``failures`` in a row; tries it once again after ``pause`` seconds."""

    def __init__(self, failures: int = 5, pause: float = 60, clock: Callable[[], float] = time.monotonic):
        self.failures, self.pause, self.clock = failures, pause, clock
        self.failed, self.since = 0, 0.0

    @property
    def state(self) -> str:
        if self.failed < self.failures:
            return "closed"
        return "half-open" if self.clock() - self.since >= self.pause else "open"

    def call(self, work: Callable, *args):
        if self.state == "open":
            raise BreakerOpen(f"{self.failed} failures in a row")
        try:
            out = work(*args)
        except Exception:
            self.failed, self.since = self.failed + 1, self.clock()
            raise
        self.failed = 0
        return out
