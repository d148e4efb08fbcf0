from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import neighbours
from pagemill.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, key string, id string, vector string, shard int, score int, ids string, dim string, block long, rank int"
EXTRA = ("k", "i", "v", 1, 2, "s", "d", 3, 4)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, *EXTRA) for i, v in rows], SCHEMA)


def brute(rows, is_query, k=20):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(np.float32(v))), None)
    out = {}
    for (q, a) in ok:
        if is_query(q):
            found = [(-float(np.dot(np.float64(a), np.float64(b))), i) for i, b in ok if i != q and len(a) == len(b)]
            out[q] = [i for _, i in sorted(found)[:k]]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["id"])
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_scores_of_a_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    want, vectors = brute(rows, lambda i: i % 20 == 0), {i: np.float64(v) for i, v in rows}
    got = neighbours.query(spark, sf).collect()
    assert {r["query_id"] for r in got} == set(want) and len(got) == 20 * len(want)
    assert sum(r["vec_id"] in want[r["query_id"]] for r in got) >= 0.9 * len(got)
    assert all(abs(r["score"] - vectors[r["query_id"]] @ vectors[r["vec_id"]]) < 1e-12 for r in got)


def test_recall_where_only_a_part_is_verified(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((9000, 24)) + 2 * rng.standard_normal((9, 24))[np.arange(9000) % 9]
    index = neighbours.Index(vectors, float(np.sqrt((vectors**2).sum(1)).max()))
    hit = 0
    for q, (found, _) in zip(vectors[:60], index.search(vectors[:60], 20), strict=True):
        hit += len(set(found.tolist()) & set(np.argsort(-(vectors @ q))[:20].tolist()))
    assert hit >= 0.9 * 60 * 20


def test_odd_rows_ties_and_a_hot_vector(spark):
    rng = np.random.default_rng(1)
    hot = [1.0, 2.0, 0.5]
    rows = [(k, rng.standard_normal(3).tolist()) for k in range(60)] + [(100 + k, hot) for k in range(60)]
    rows += [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [float("nan"), 1.0, 1.0]), (280, [float("inf"), 1.0, 1.0]), (None, hot), (300, [1.0, 2.0]), (320, [2.0, 1.0]), (340, []), (0, rows[0][1])]
    got = by_query(neighbours.nearest(frame(spark, rows), F.col("id") % 20 == 0))
    assert got == brute(rows, lambda i: i % 20 == 0)


def test_empty_table(spark):
    assert neighbours.nearest(frame(spark, []), F.col("id") % 20 == 0).count() == 0
