"""Answers of a recognition service, asked for over HTTP by tasks."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from http.client import HTTPException
from urllib.error import HTTPError
from urllib.parse import quote
from urllib.request import urlopen

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of answers, about, and answers, that a task holds before it hands them on.
HELD, ROWS = 16_000_000, 200
SCHEMA = "job_id string, code int, value string, error string"


def answer(url: str, wait: float) -> tuple[int | None, str]:
    """The code and text of one answer; without a code the text says why there is none."""
    try:
        with urlopen(url, timeout=wait) as found:
            return found.status, found.read().decode("utf-8", "replace")
    except HTTPError as e:
        with e:
            return e.code, e.read().decode("utf-8", "replace")
    except (OSError, HTTPException) as e:
        return None, f"{type(e).__name__}: {e}"


def asked(jobs: DataFrame, url: str, what: str = "results", tasks: int = 8, wait: float = 30, tries: int = 3, pause: float = 1) -> DataFrame:
    """Rows (job_id, code, value, error): what the service at ``url`` says of each job below ``what``.

    Each job is asked for once, however often ``jobs`` names it; a null id has no row. ``tasks``
    requests are under way at most. The service's faults (5xx) and missing connections are tried
    ``tries`` times, with ``pause`` seconds between, and then are the row's error, as is a job that
    isn't found; no answer fails the others. Asking changes nothing, so a task that is run anew asks
    anew. Write the rows before they are used twice: each action asks again.
    """
    if not url.startswith(("http://", "https://")):
        raise ValueError(f"{url!r} isn't an address of a service")
    base = f"{url.rstrip('/')}/{what}/"

    def ask(job: str) -> tuple:
        for left in reversed(range(tries)):
            code, text = answer(base + quote(job, safe=""), wait)
            if not left or (code is not None and code < 500):
                break
            time.sleep(pause)
        if code == 200:
            return job, code, text, None
        return job, code, None, f"Job not found: {job}" if code == 404 else f"No {what} ({code}): {text}"

    kinds = [pa.string(), pa.int32(), pa.string(), pa.string()]
    names = ["job_id", "code", "value", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for job in batch.column(0).to_pylist():
                rows.append(ask(job))
                held += len(rows[-1][2] or "")
                if held >= HELD or len(rows) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    own = jobs.select(F.col("job_id").cast("string").alias("job_id")).where("job_id is not null").distinct()
    return own.repartition(tasks, "job_id").mapInArrow(run, SCHEMA)


def polls(answers: DataFrame, jobs: DataFrame, now: Column | None = None) -> DataFrame:
    """Answers about states as polls (job_id, at, status, error, age, processed, dropped, total) of jobs (job_id, submitted).

    ``age`` is in seconds; an answer that can't be read is an error of its own job, and counts that it hasn't are 0.
    """
    at = (F.current_timestamp() if now is None else now).alias("at")
    state = F.from_json("value", "status string, processed_pages int, dropped_pages int, total_pages int")
    rows = answers.withColumn("state", state).join(jobs.select(F.col("job_id").cast("string").alias("job_id"), "submitted").dropDuplicates(["job_id"]), "job_id")
    unread = F.when(F.col("error").isNull() & F.col("state.status").isNull(), "unreadable answer")
    age = (F.unix_micros("at") - F.unix_micros(F.col("submitted").cast("timestamp"))) / 1_000_000
    counts = [F.coalesce(f"state.{c}_pages", F.lit(0)).alias(c) for c in ("processed", "dropped", "total")]
    return rows.withColumn("at", at).select("job_id", "at", "state.status", F.coalesce("error", unread).alias("error"), age.alias("age"), *counts)


def healthy(url: str, wait: float = 10) -> bool:
    """Whether the service says that it is well."""
    code, text = answer(f"{url.rstrip('/')}/health", wait)
    try:
        found = json.loads(text) if code == 200 else None
    except ValueError:
        return False
    return isinstance(found, dict) and found.get("status") == "healthy"
