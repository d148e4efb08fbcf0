from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import brown
from pagemill.llm.common import crc_mod, stored, table
from tests.llm import odd


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def counted(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        own = tokens(t)
        out.append((i, held(i), len(own), sum(train[w] > 0 for w in own), n, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in own)))
    return out


def compare(got, rows):
    key = lambda r: tuple(map(str, r[:5]))
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=lambda r: (key(r), r[5]))
    want = sorted(counted(rows), key=lambda r: (key(r), r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want])


@pytest.fixture(scope="module")
def scored(spark, sf):
    return brown.query(spark, sf).collect()


def test_counts_and_base_scores_of_a_table(spark, sf, scored):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    compare(scored, rows)
    held = [r for r in scored if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in scored)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = brown.score(docs.withColumn("__held", crc_mod("doc_id", 7) == 2)).collect()
    compare(got, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert brown.score(odd.empty(spark).withColumn("__held", crc_mod("doc_id", 7) == 2)).count() == 0


def fitted(spark, docs, deal):
    """The model, and each word's count and class by its key."""
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)).alias("held"))
    made = stored(brown.to_blocks(rows), "test-blocks")
    model, answered = brown.fit(made, brown.asked(made, deal), deal)
    own = answered.toPandas()
    words = {}
    for r in made.collect():
        right = own[own["of_block"] == r["block"]]
        for k, c, cls in zip(np.frombuffer(r["keys"], np.uint64).tolist(), brown.in_order(right, "c", np.int64).tolist(), brown.in_order(right, "classes", np.int32).tolist(), strict=True):
            assert words.setdefault(k, (c, cls)) == (c, cls)
    return model, words


def key_of(word):
    data = np.frombuffer((word or "").encode(), np.uint8)
    return int(brown.tokens_of(data, np.array([0, len(data)]))[0][0])


def test_scores_equal_those_of_a_count_in_plain_python(spark, sf, scored):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = [(r["doc_id"], tokens(r["text"])) for r in docs.collect()]
    model, words = fitted(spark, docs, brown.Deal(3, 2))
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    keys = {w: key_of(w) for _, own in rows for w in own}
    assert len(set(keys.values())) == len(keys)
    train = Counter(w for i, own in rows if not held(i) for w in own)
    assert all(words[keys[w]][0] == train[w] for w in keys)
    of = {w: words[keys[w]][1] for w in train}
    n = brown.classes_for(len(train))
    assert of[None] == n and all(0 <= c < n for w, c in of.items() if w is not None) and len(set(of.values())) > n // 2
    grams, kinds = np.zeros((n + 1, n + 1)), Counter(of.values())
    for i, own in rows:
        if not held(i):
            for x, y in zip([None, *own], own, strict=False):
                grams[of[x], of[y]] += 1
    mass, alone = grams.sum(0), (grams.sum(0) + 1) / (grams.sum() + n + 1)

    def move(a):
        return alone if a is None else (grams[a] + brown.BACKOFF * alone) / (grams[a].sum() + brown.BACKOFF)

    def of_text(own):
        state, total = n, 0.0
        for w in own:
            p = move(state)
            if w in of:
                state = of[w]
                total += math.log10(p[state] * (1 if w is None else train[w] / (mass[state] + kinds[state])))
            else:
                state = None
                total += math.log10(sum(p[k] * (kinds[k] / (mass[k] + kinds[k]) if mass[k] else 1) for k in range(n)))
        return total

    got = {r["doc_id"]: r["score"] for r in scored}
    assert all(abs(got[i] - of_text(own)) < 1e-6 * len(own) for i, own in rows)
    for a in [*range(n + 1), None]:  # all words, the unknown one and the end
        p = move(a)
        every = sum(p[k] * (train[w] / (mass[k] + kinds[k])) for w, k in of.items() if w is not None) + p[n]
        assert abs(every + sum(p[k] * (kinds[k] / (mass[k] + kinds[k]) if mass[k] else 1) for k in range(n)) - 1) < 1e-9


def test_words_and_texts_are_told_apart():
    texts = [b"", b"Ab  c\td", b" \n", b"ab", "\u00e9 x".encode(), b"x\x0cy"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([*map(len, texts)])]
    keys, shards, sizes = brown.tokens_of(data, offsets)
    want = [[key_of(w.decode()) for w in t.lower().split()] + [int(brown.END)] for t in texts]
    assert keys.tolist() == [k for own in want for k in own] and sizes.tolist() == [len(own) for own in want]
    assert (shards[keys == brown.END] == 0).all()
    assert brown.tokens_of(np.zeros(0, np.uint8), np.zeros(3, np.int64))[2].tolist() == [1, 1]


def test_exchange_finds_words_that_are_used_alike():
    # three kinds of words, each followed by the next kind, of uneven numbers and frequencies
    grams, rng = np.zeros((41, 41), np.int64), np.random.default_rng(2)
    kinds = [list(range(0, 8)), list(range(8, 21)), list(range(21, 39))]
    for _ in range(20_000):
        k = rng.integers(0, 3)
        a, b = (kinds[x][int(len(kinds[x]) * rng.random() ** 2)] for x in (k, (k + 1) % 3))
        grams[a, b] += 1
    own = brown.exchange(grams, classes=3)
    assert own[39:].tolist() == [3, 4]
    used = [w for k in kinds for w in k if grams[w].sum()]
    true = np.array([next(n for n, k in enumerate(kinds) if w in k) for w in used])
    assert all(len(set(own[used][true == k])) == 1 for k in range(3)) and len(set(own[used])) == 3
