from __future__ import annotations

import json
import threading
from collections import Counter
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from pagemill.operators import results
from pagemill.operators.jobs import polled
from pagemill.sources import service

PAGE = {"job_id": "a/1", "page_num": 1, "pdf_path": "x.pdf", "status": "success", "text_lines": [{"text": "Häuser", "confidence": 0.9}]}
FOUND = {
    "/results/a/1": json.dumps({"job_id": "a/1", "status": "completed", "total_pages": 1, "results": {"x.pdf": {"1": PAGE}}}),
    "/results/broken": "{",
    "/status/a/1": json.dumps({"status": "completed", "total_pages": 1, "processed_pages": 1}),
    "/status/slow": json.dumps({"status": "processing", "total_pages": 5, "processed_pages": 1}),
    "/status/stuck": json.dumps({"status": "processing", "total_pages": 5, "processed_pages": 3, "dropped_pages": 2}),
    "/status/broken": "{",
    "/health": json.dumps({"status": "healthy"}),
}


@pytest.fixture
def server():
    seen = Counter()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            path = unquote(self.path)
            seen[path] += 1
            code = 503 if path.endswith("/busy") or (path.endswith("/once") and seen[path] == 1) else 200 if path in FOUND or path.endswith("/once") else 404
            body = FOUND.get(path, "{}").encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", seen
    httpd.shutdown()
    httpd.server_close()


def test_each_job_is_asked_for_once_and_none_fails_the_others(spark, server):
    url, seen = server
    jobs = spark.createDataFrame([(j,) for j in ["a/1", "a/1", "gone", "busy", "once", "broken", None]], "job_id string")
    got = {r["job_id"]: (r["code"], r["value"], r["error"]) for r in service.asked(jobs, url + "/", pause=0).collect()}
    assert got["a/1"] == (200, FOUND["/results/a/1"], None) and got["gone"] == (404, None, "Job not found: gone")
    assert got["busy"][:2] == (503, None) and got["once"] == (200, "{}", None) and len(got) == 5
    assert {p: n for p, n in seen.items()} == {"/results/a/1": 1, "/results/gone": 1, "/results/busy": 3, "/results/once": 2, "/results/broken": 1}


def test_answers_become_documents(spark, server):
    url, _ = server
    jobs = spark.createDataFrame([("a/1",), ("gone",), ("broken",)], "job_id string")
    pages = results.page_rows(results.readable(results.parsed_jobs(service.asked(jobs, url).where("code = 200"))))
    (row,) = results.documents_of(pages, ["job_id"]).collect()
    assert (row["job_id"], row["full_text"], row["pages"]) == ("a/1", "Häuser", 1)


def test_states_become_polls(spark, server):
    url, _ = server
    now = datetime(2024, 5, 1, 12)
    jobs = spark.createDataFrame([(j, now - timedelta(seconds=s)) for j, s in [("a/1", 5), ("slow", 5), ("old", 5), ("stuck", 5), ("gone", 5), ("broken", 700)]], "job_id string, submitted timestamp")
    rows = service.polls(service.asked(jobs, url, "status"), jobs, now=F.lit(now))
    action = polled(F.col("status"), F.col("error"), F.lit(3), F.col("age"), F.col("processed"), F.col("dropped"), F.col("total"))
    got = {r["job_id"]: (r["age"], r["error"], r["action"]) for r in rows.withColumn("action", action).collect()}
    assert got["a/1"] == (5.0, None, "complete") and got["slow"] == (5.0, None, "wait") and got["stuck"] == (5.0, None, "complete")
    assert got["gone"] == (5.0, "Job not found: gone", "abandoned") and got["broken"] == (700.0, "unreadable answer", "abandoned")


def test_no_service_and_no_jobs(spark, server):
    url, _ = server
    assert service.healthy(url) and not service.healthy("http://127.0.0.1:9")
    one = spark.createDataFrame([("j",)], "job_id string")
    row = service.asked(one, "http://127.0.0.1:9", tries=1).first()
    assert row["code"] is None and row["value"] is None and "None" in row["error"]
    assert service.asked(one.limit(0), url).count() == 0
    with pytest.raises(ValueError, match="address"):
        service.asked(one, "file:///etc")
