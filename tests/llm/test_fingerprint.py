from __future__ import annotations

import hashlib
import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from pagemill.llm import fingerprint
from pagemill.llm.common import table
from tests.llm import odd


def brute_next(rows):
    """Edited texts by the rule, over a list of (id, text) of distinct ids."""
    rows = sorted(rows, reverse=True)
    out = {}
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1] or "", len(t or "") // 2
        out[i] = (len(t or ""), hashlib.sha256(((t or "")[: len(t or "") - half] + after[:half]).encode("utf-8")).hexdigest(), after)
    return out


def test_a_table_agrees_with_the_rule(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    want, got = brute_next([*texts.items()]), fingerprint.query(spark, sf).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == {i: w[:2] for i, w in want.items()}
    by_text = {}
    for r in got:
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if texts[r["doc_id"]] == want[r["doc_id"]][2]:
            assert r["near_next"] == 1
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.98 * len(got)


def test_a_fingerprint_depends_on_its_text_alone():
    texts = [odd.text(k, n) for k, n in enumerate([1, 3, 50, 700, 4000, 20_000])] + ["", "é🎈" * 50, "x" * 40_000]
    alone = [fingerprint.embed([t])[0] for t in texts]
    rng = random.Random(2)
    for _ in range(3):
        mixed = [rng.choice(texts) for _ in range(20)]
        assert (fingerprint.embed(mixed) == np.array([alone[texts.index(t)] for t in mixed])).all()


def test_few_edits_change_few_bits():
    base = odd.varied(4, 600)
    near = [fingerprint.likeness(fingerprint.embed([base]), fingerprint.embed([odd.edited(base, 1, n)]))[0] for n in (1, 10, 100, 500)]
    far = fingerprint.likeness(fingerprint.embed([base]), fingerprint.embed([odd.text(9, 600)]))[0]
    assert near[0] > 0.9 and near[1] > 0.75 and near[0] >= near[1] > near[2] > near[3] and near[2] > far


def test_bands_find_near_copies():
    texts = [odd.varied(k, 500) for k in range(60)]
    keys = fingerprint.band_keys(fingerprint.embed(texts))
    share = lambda other: (keys == fingerprint.band_keys(fingerprint.embed(other))).any(1).mean()
    assert share([odd.edited(t, k, 5) for k, t in enumerate(texts)]) >= 0.9
    assert share(texts[1:] + texts[:1]) <= 0.05


def test_odd_rows(spark):
    rows = [r for r in odd.rows() if r[0] is not None and r[0] != 111]
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(odd.documents(spark, rows)).collect()}
    assert {i: (r["n_chars"], r["edited_sha256"]) for i, r in got.items()} == {i: w[:2] for i, w in brute_next([r[:2] for r in rows]).items()}
    assert got[100]["fingerprint"] == got[101]["fingerprint"] and got[104]["fingerprint"] == got[105]["fingerprint"]
    assert fingerprint.fingerprints(odd.documents(spark)).count() == len(odd.rows())
    assert fingerprint.fingerprints(odd.empty(spark)).count() == 0
    one = fingerprint.fingerprints(odd.documents(spark, [(1, "alone here", "en", "s")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1


def test_ids_of_any_kind_and_many_nulls(spark):
    rows = [(f"k{k:03}", odd.text(k, 5 + k % 30)) for k in range(60)]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == {i: w[:2] for i, w in brute_next(rows).items()}
    nulls = spark.createDataFrame([(None, t) for _, t in rows] + [(7, "x y z")], "doc_id long, text string")
    assert fingerprint.fingerprints(nulls).count() == 61


def plain_walk(text):
    """The counters of a text, one character after another."""
    points = [ord(c) for c in text]
    width = fingerprint.ANCHOR
    turn = lambda x, k: (x << k | x >> (64 - k)) & (2**64 - 1) if k else x
    one = {p: int(fingerprint.mix(np.array([p]), 3)[0]) for p in set(points)}
    hashes = []
    for i in range(len(points)):
        h = 0
        for k in range(min(width, i + 1)):
            h ^= turn(one[points[i - k]], k)
        hashes.append(int(fingerprint.mix(np.array([h], np.uint64).view(np.int64), 5)[0]))
    cuts = [0] + [i + 1 for i, h in enumerate(hashes) if h % fingerprint.SPACING == 0 and width <= i + 1 < len(points)]
    starts = [s for a, b in zip(cuts, [*cuts[1:], len(points)], strict=True) for s in range(a, b, fingerprint.LONGEST)]
    sums = [0] * fingerprint.BITS
    for a, b in zip(starts, [*starts[1:], len(points)], strict=True):
        at, step = a, hashes[a - 1] >> 20 & fingerprint.PERIOD - 1 if a else 0
        while at < b:
            c = one[points[at]] >> 40 & 255
            sums[step % fingerprint.BITS] += int(fingerprint.SIGNS[step][c])
            at += int(fingerprint.MOVES[step][c])
            step = (step + 1) % fingerprint.PERIOD
    return np.packbits(np.array(sums) > 0)


def test_fingerprints_equal_plain_walks():
    texts = ["a", "ab", odd.text(3, 40), odd.varied(4, 300), "x" * 9000, "é🎈 " * 60, odd.text(5, 3000)]
    assert (fingerprint.embed(texts) == np.array([plain_walk(t) for t in texts])).all()


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    assert fingerprint.edit_distance(a, b) == row[-1]


def test_near_pairs(spark):
    base = odd.varied(1, 600)
    rows = [(1, base, "en", "s"), (2, odd.edited(base, 1, 1), "en", "s"), (3, base, "en", "s"), (4, odd.text(5, 300), "en", "s"), (5, None, "en", "s"), (6, "", "en", "s"), (None, base, "en", "s")]
    got = {(r["a"], r["b"]) for r in fingerprint.near_pairs(odd.documents(spark, rows)).collect()}
    assert {(1, 2), (1, 3)} <= got <= {(1, 2), (1, 3), (2, 3)}
    assert fingerprint.near_pairs(odd.empty(spark)).count() == 0


def test_near_pairs_of_a_bucket_are_linked_whatever_its_smallest_member(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "band_keys", lambda prints: np.zeros((len(prints), fingerprint.BANDS), np.int64))
    rows = [(1, "abcdefghij", "en", "s"), (2, "XYcdefghij", "en", "s"), (3, "XYZWefghij", "en", "s"), (4, "0123456789", "en", "s")]
    got = {(r["a"], r["b"]) for r in fingerprint.near_pairs(odd.documents(spark, rows)).collect()}
    assert got == {(1, 2), (2, 3)}
