from __future__ import annotations

import random
import string
from collections import Counter

import numpy as np

from pagemill.llm import dedup
from pagemill.llm.common import table
from tests.llm import odd

PLAIN = str.maketrans({**{c: None for c in string.punctuation}, **{c: c.lower() for c in string.ascii_uppercase}})


def labelled(text):
    words, seen, out = (text or "").translate(PLAIN).split(), Counter(), []
    for k in range(max(1, len(words) - 4) if words else 0):
        gram = tuple(words[k : k + 5])
        out.append((gram, seen[gram]))
        seen[gram] += 1
    return out


def in_order(a, b):
    """Longest common subsequence, by the book."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def brute(texts: dict) -> dict:
    """Classes by comparing all texts that share a shingle."""
    grams = {i: labelled(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = grams[i], grams[j]
            like = (texts[i] or "") == (texts[j] or "")
            if not like and a and b and len(set(a) & set(b)) >= 0.444 * (len(a) + len(b)):
                m = in_order(a, b)
                like = m / (len(a) + len(b) - m) >= 0.8
            if like:
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i in ids}


def classes(df):
    return {r["doc_id"]: r["class_id"] for r in df.collect()}


def test_classes_of_a_table_agree_with_all_pairs(spark, sf):
    docs = table(spark, sf, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert classes(dedup.query(spark, sf)) == brute(texts)


def test_families_chains_and_moved_passages(spark):
    base = odd.text(1, 120)
    chain, texts = base, {0: base}
    for k in range(1, 12):  # each link is near the one before; the ends aren't near each other
        chain = odd.edited(chain, k, 2)
        texts[k] = chain
    words = base.split(" ")
    texts[50] = " ".join(words[60:] + words[:60])  # the same shingles in another order
    texts |= {60 + k: odd.edited(base, 900 + k, k) for k in range(1, 9)}
    texts |= {80 + k: odd.text(700 + k, 30) + " " + " ".join(words[:40]) + " " + odd.text(800 + k, 30) for k in range(12)}  # a shared passage
    rows = [(i, t, "en", "s") for i, t in texts.items()]
    assert classes(dedup.near_classes(odd.documents(spark, rows))) == brute(texts)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    out = dedup.near_classes(docs).collect()
    assert len(out) == docs.count()
    found = {r["doc_id"]: r["class_id"] for r in out}
    assert found[100] == found[101] == found[102] == 100 and found[None] is None
    assert found[103] == 103 and found[104] == found[105] == 104 and found[111] == 111
    assert dedup.near_classes(odd.empty(spark)).count() == 0


def test_one_of_each_class_stays(spark):
    docs = odd.documents(spark)
    stays = dedup.kept(spark, docs, "")
    ids = Counter(r["doc_id"] for r in stays.select("doc_id").collect())
    assert stays.columns == docs.columns
    assert ids[100] == 1 and not ids[101] and not ids[102] and ids[111] == 1 and ids[None] == 2 and ids[108] == 1


def test_alignment_is_the_longest_common_subsequence_where_it_matters():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = rng.sample(range(200), n)
        b = [x for x in a if rng.random() > 0.08]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.randint(300, 10**6))
        if rng.random() < 0.3:
            k = rng.randint(0, len(b))
            b = b[k:] + b[:k]
        m = in_order(a, b)
        exact = m / (len(a) + len(b) - m)
        got = dedup.aligned(np.array(a, np.uint64).tobytes(), np.array(b, np.uint64).tobytes())
        assert (got >= 0.8) == (exact >= 0.8)
        assert got < 0.8 or abs(got - exact) < 1e-12


def test_contained_texts_at_exactly_the_least_similarity():
    for k in range(1, 700):  # 4k of 5k: totals up to 6,300
        whole = np.arange(5 * k, dtype=np.uint64)
        assert dedup.aligned(whole[: 4 * k].tobytes(), whole.tobytes()) == 0.8 == dedup.aligned(whole.tobytes(), whole[k:].tobytes()), k
        if k > 1:
            assert dedup.aligned(whole[: 4 * k - 1].tobytes(), whole.tobytes()) < 0.8


def test_short_texts_are_found(spark):
    rng, rows = random.Random(8), []
    for k in range(2000):
        words = ["".join(rng.choices(string.ascii_lowercase, k=8)) for _ in range(9)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:8] if k % 2 else words[1:]))]
    got = dict(dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [i for i, c in got.items() if c != i - i % 2] == [] and len(got) == 4000
