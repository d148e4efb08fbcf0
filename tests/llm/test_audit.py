from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import duckdb

from pagemill.llm import audit
from tests.llm import odd

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def brute(rows, labels):
    """Every document taken through every order; rows are (doc_id, text, source)."""
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = Counter()
    docs = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        docs.append((part or "", fails + "E" * (i is not None and first[text] < i), i))
    for order in permutations("ABCDE"):
        for part, fails, i in docs:
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, "".join(order), step)
                for name, holds in (("removed", f in fails and not gone), ("redundant", f in fails and gone), ("unique_fails", fails == f)):
                    out[(*key, name)] += holds
                if f in fails and not gone:
                    out[(*key, "good_lost")] += i in good
                    out[(*key, "toxic_lost")] += i in toxic
                    out[(part, f)] += 1
                    gone = True
                out[(*key, "kept")] += not gone
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return sorted((p, "".join(o), s, *(out[(p, "".join(o), s, n)] for n in names), out[(p, o[s - 1])]) for p in {d[0] for d in docs} for o in permutations("ABCDE") for s in range(1, 6))


def test_odd_rows_agree_with_taking_each_document_through_each_order(spark):
    rows = [*odd.rows(), (200, "AB " * 300, "en", "s1"), (201, "a b " * 150, "en", ""), (202, "50 % of $ #1", "en", None), (203, odd.varied(4, 300), "en", "s2"), (90, odd.varied(4, 300), "en", "s2"), (204, "A" + "a" * 49, "en", "s1"), (205, "A" + "a" * 48, "en", "s1")]
    labels = [(100, 1, 0, "p", 1), (100, 0, 1, "p", 1), (101, 1, None, "p", 1), (102, None, 1, "p", 1), (None, 1, 1, "p", 1), (111, 1, 1, "p", 1), (203, 1, 0, "p", 1), (9999, 1, 1, "p", 1)]
    got = audit.audit(odd.documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, got.collect())) == brute([(i, t, s) for i, t, _, s in rows], [x[:3] for x in labels])


def test_the_query_agrees_with_its_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = con.sql(audit.SQL).df()
    got = audit.query(spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    keys = ["part", "filter_order", "step"]
    assert got.sort_values(keys).values.tolist() == want[list(got.columns)].sort_values(keys).values.tolist()


def test_shapley_sums_and_kept_rows_add_up(spark, sf):
    got = audit.query(spark, sf).toPandas()
    last = got[got.step == 5].groupby("part").kept.agg(["min", "max"])
    assert (last["min"] == last["max"]).all()
    one = got[got.filter_order == "ABCDE"].groupby("part").agg({"shapley": "sum", "removed": "sum"})
    assert (one.shapley == 120 * one.removed).all()


def test_a_table_without_rows(spark):
    assert audit.audit(odd.empty(spark), spark.createDataFrame([], LABELS)).count() == 0
    assert audit.audit(odd.documents(spark, [(1, "x", "en", "s")]), spark.createDataFrame([], LABELS)).count() == 600
