from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.operators import workqueue as w

DOC = "id string, document_type string, recorded_at timestamp, created_at timestamp, pdf_url string"
DAY = dt.datetime(2020, 1, 10)


def docs(spark):
    one = lambda i, kind="DEED", at=DAY, made=DAY, url="u": (i, kind, at, made, url)
    return spark.createDataFrame([
        one("a"), one("b", None), one("c", "BLANK"), one("d", "UNUSED FILE NUMBER"), one("e", url=None), one("f", at=None), one("g"), one("h"),
        one("i", at=DAY + dt.timedelta(seconds=1)), one("j", made=DAY + dt.timedelta(hours=23, minutes=59, seconds=59)), one("k", made=DAY + dt.timedelta(days=1)),
    ], DOC)


def results(spark):
    return spark.createDataFrame([("r1", "g", DAY), ("r2", "h", DAY - dt.timedelta(seconds=1)), ("r3", "z", DAY)], "id string, document_id string, updated_at timestamp")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_pending_and_its_filters(spark):
    assert ids(w.pending(docs(spark), results(spark))) == list("afijk")
    keep = lambda **f: ids(w.pending(docs(spark), results(spark), w.QueueFilter(**f)))
    assert keep(end_date="2020-01-10") == list("ajk")  # midnight of the last day
    assert keep(start_date="2020-01-10") == list("aijk")
    assert keep(uploaded_before="2020-01-10") == list("afij")  # the whole last day
    assert keep(uploaded_after="2020-01-11") == ["k"]
    assert keep(included_types=("BLANK",)) == []  # both lists hold
    assert keep(included_types=("BLANK",), excluded_types=("x",)) == ["c"]
    assert keep(excluded_types=("x",)) == list("acdfijk")  # a null type never passes
    assert w.year(2020) == {"start_date": "2020-01-01", "end_date": "2020-12-31"}


def test_due_again_is_strictly_before(spark):
    rows = w.due_again(docs(spark), results(spark), w.QueueFilter(reprocess_before="2020-01-10")).collect()
    assert [(r["id"], r["ocr_result_id"]) for r in rows] == [("h", "r2")]
    assert ids(w.due_again(docs(spark), results(spark))) == ["g", "h"]


def test_counts(spark):
    assert w.about_pending(docs(spark), results(spark)).first()["n"] == 8
    assert w.about_pending(results(spark), docs(spark)).first()["n"] == 0


@settings(deadline=None, max_examples=4)
@given(st.lists(st.sampled_from([None, 1, 2, 3]), min_size=1, max_size=9), st.integers(1, 4), st.booleans())
def test_pages_make_up_the_whole_order(spark, days, size, ascending):
    rows = [(f"{k:02}", None if d is None else DAY + dt.timedelta(days=d)) for k, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id string, recorded_at timestamp")
    got = [r["id"] for page in w.pages(df, size, ascending=ascending) for r in page]
    low = sorted(rows, key=lambda r: (r[1] is None, r[1] or DAY, r[0]))
    assert got == [r[0] for r in (low if ascending else low[::-1])]


def test_a_target_ends_the_pages(spark):
    df = spark.createDataFrame([(f"{k}", DAY) for k in range(7)], "id string, recorded_at timestamp")
    assert [len(p) for p in w.pages(df, 3, target=5)] == [3, 2]
    assert w.next_cursor([], 3) is None


@pytest.mark.parametrize("size", [1, 5])
def test_plan_takes_the_page_without_a_full_sort(spark, size):
    plan = w.page_of(w.pending(docs(spark), results(spark)), size)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "LeftAnti" in plan
