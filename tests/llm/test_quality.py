from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pagemill.llm import quality
from pagemill.llm.common import table
from tests.llm import odd

N = quality.ORDER


def brute(rows, trusted):
    """(id, text) -> log10 probability by interpolated modified Kneser-Ney, counted in dicts."""
    role = {i: "calibrate" if zlib.crc32(str(i).encode()) % quality.PARTS == quality.CALIBRATION else "train" for i in trusted}
    grams = lambda t: [(b"\0" * (N - 1) + (t or "").encode() + b"\0")[k : k + N] for k in range(len((t or "").encode()) + 1)]
    counts = {N: Counter(g for i, t in rows if role.get(i) == "train" for g in grams(t))}
    for n in range(N - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut, sums, freed = {}, {}, {}
    for n in range(1, N + 1):
        tally = [sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4)]
        d = [0.5, 1.0, 1.5]
        if min(tally) > 0:
            y = tally[0] / (tally[0] + 2 * tally[1])
            found = [1 - 2 * y * tally[1] / tally[0], 2 - 3 * y * tally[2] / tally[1], 3 - 4 * y * tally[3] / tally[2]]
            d = [f if 0 < f < k else e for f, k, e in zip(found, (1, 2, 3), d, strict=True)]
        cut[n], sums[n], freed[n] = d, defaultdict(int), defaultdict(float)
        for g, c in counts[n].items():
            sums[n][g[:-1]] += c
            freed[n][g[:-1]] += d[min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        n, below = len(g), p(g[1:])
        if not sums[n].get(g[:-1]):
            return below
        c = counts[n][g]
        return ((c - cut[n][min(c, 3) - 1] if c else 0.0) + freed[n][g[:-1]] * below) / sums[n][g[:-1]]

    return {(i, t): sum(math.log10(p(g)) for g in grams(t)) for i, t in rows}


def test_log_probabilities_agree_with_plain_counting(spark, sf):
    docs = table(spark, sf, "documents").where("doc_id < 60")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    ids = quality.trusted_ids(table(spark, sf, "labels"))
    want = brute(rows, {r["id"] for r in ids.collect()})
    got = quality.classify(docs, ids).collect()
    assert np.allclose([r["log10_prob"] for r in got], [want[r["doc_id"], dict(rows)[r["doc_id"]]] for r in got], rtol=1e-5)
    assert all(abs(r["perplexity"] - 10 ** (-r["log10_prob"] / (r["n_bytes"] + 1))) < 1e-6 * r["perplexity"] for r in got)


def test_junk_goes_and_clean_documents_stay(spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    got = quality.query(spark, sf).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in table(spark, sf, "documents").select("doc_id").collect()}
    judged = [(labels[r["doc_id"]], r["keep"]) for r in got if r["doc_id"] in labels]
    assert sum(k for q, k in judged if q) >= 0.93 * sum(q for q, _ in judged)
    assert sum(k for q, k in judged if not q) <= 0.2 * sum(not q for q, _ in judged)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    ids = spark.createDataFrame([(k,) for k in range(0, 40, 2)] + [(None,), (100,)], "id long")
    got = quality.classify(docs, ids).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["perplexity"] is None) == (r["n_bytes"] == 0) and (r["n_bytes"] > 0 or not r["keep"])
    assert quality.classify(odd.empty(spark), ids).count() == 0
    free = quality.classify(docs, ids.limit(0)).collect()  # nothing to learn from: only empty texts go
    assert all(r["keep"] == (r["n_bytes"] > 0) for r in free)


def test_every_trusted_document_counts(spark):
    n = 40_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("a"), F.col("id") % 97).alias("text"), F.lit("en").alias("lang"))
    got = quality.perplexities(docs, docs.select(F.col("doc_id").alias("id")), "doc_id", "text", "lang").groupBy("role").count().collect()
    calibrating = sum(zlib.crc32(str(k).encode()) % quality.PARTS == quality.CALIBRATION for k in range(n))
    assert {r["role"]: r["count"] for r in got} == {quality.ROLES["train"]: n - calibrating, quality.ROLES["calibrate"]: calibrating}


def test_quantiles_are_exact(spark):
    # large and small groups, a null group, and one value that half of the rows have
    value = F.when(F.col("id") % 4 == 1, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40))
    group = F.when(F.col("id") < 7, "few").when(F.col("id") % 2 == 0, "many")
    rows = spark.range(300_000).select(group.alias("lang"), value.alias("v")).cache()
    values = defaultdict(list)
    for g, v in rows.collect():
        values[g].append(v)
    rank = lambda own, q: sorted(own)[math.ceil(q * len(own)) - 1]
    for q in (0.1, 0.5, quality.QUANTILE, 1.0):
        got = quality.quantiles(rows, ["lang"], "v", q).collect()
        assert {r["lang"]: (r["threshold"], r["n"]) for r in got} == {g: (rank(own, q), len(own)) for g, own in values.items()}
        whole = quality.quantiles(rows, [], "v", q).collect()
        assert [(r["threshold"], r["n"]) for r in whole] == [(rank(sum(values.values(), []), q), 300_000)]
    assert quality.quantiles(rows.limit(0), [], "v", 0.5).collect() == []


def test_blocks_are_coded_in_little_memory():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(500)]
    texts = [b" ".join(words[k] for k in rng.integers(0, 500, n)) for n in [*rng.integers(0, 800, 1700).tolist(), 0, 1, 60_000, 0]]
    data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    want, names = pd.factorize(quality.windows(data, np.r_[0, np.cumsum(sizes)]))
    tracemalloc.start()
    codes, distinct = quality.coded(data, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(codes, want) and np.array_equal(distinct, names)
    assert peak < 14 * len(data)  # all n-grams at once take over 20 bytes a place
    none, empty = quality.coded(np.zeros(0, np.uint8), np.zeros(0, np.int64))
    assert not len(none) and not len(empty)
