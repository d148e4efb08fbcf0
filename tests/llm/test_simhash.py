from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import simhash
from pagemill.llm.common import table
from tests.llm import odd


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64(s.encode("utf-8"), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints):
    """The smallest place that each can reach, all pairs compared."""
    values = np.array(prints, np.uint64)
    of = np.arange(len(values))
    while True:
        near = np.bitwise_count(values[:, None] ^ values) <= 3
        new = np.where(near, of[None, :], len(values)).min(axis=1)
        if (new == of).all():
            return of.tolist()
        of = new


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="aAbB \t\n\x0b\x1c\x85\xa0é漢.", max_size=60))
def test_any_text(text):
    assert simhash.fingerprint(simhash.hashes(text)) == plain_print(text)


@settings(deadline=None, max_examples=200)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3, unique=True), st.lists(st.integers(0, 63), max_size=3, unique=True))
def test_whatever_is_within_three_bits_meets(x, flips, more):
    y, z = x, x
    for k in flips:
        y ^= 1 << k
    for k in more:
        z ^= 1 << k
    fps = np.unique(np.array([x, y, z], np.uint64))
    variants, places = [], []
    for f in fps:
        own = simhash.FLIPS if np.bitwise_count(f) % 2 == 0 else simhash.NEAR
        variants.append(f ^ own)
        places.append(np.arange(len(own), dtype=np.uint16))
    a, b = simhash.meetings(np.concatenate(variants), np.concatenate(places))
    links = {(int(p), int(q)) for p, q in zip(a, b, strict=True)}
    assert all((p ^ q).bit_count() <= 3 for p, q in links)
    want = brute_classes(fps)
    parent = {int(f): int(f) for f in fps}
    for _ in fps:
        for p, q in links:
            parent[p] = parent[q] = min(parent[p], parent[q])
    assert [parent[int(f)] for f in fps] == [int(fps[k]) for k in want]


def test_chains_and_clusters_of_fingerprints(spark):
    rng = random.Random(3)
    fps = {0, 2**64 - 1, 2**63}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(12):  # a walk: neighbours are near, its ends are not
            fps.add(base)
            for k in rng.sample(range(64), rng.randint(1, 4)):
                base ^= 1 << k
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = simhash.components(simhash.stored(simhash.links(frame, 200_000), "test-links")).collect()  # as if they were many: several shards
    got = {r["id"]: r["class"] for r in found}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    groups = {}
    for s, c in zip(signed, brute_classes(fps), strict=True):
        groups.setdefault(c, set()).add(s)
    theirs = {}
    for s in signed:
        theirs.setdefault(got.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, theirs.values()))


def checked(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_print(r["text"]) for r in rows]
    classes = brute_classes(prints)
    least = {}
    for r, c in zip(rows, classes, strict=True):
        if r["doc_id"] is not None:
            least[c] = min(r["doc_id"], least.get(c, r["doc_id"]))
    want = sorted((str(r["doc_id"]), f"{f:016x}", str(least.get(c))) for r, f, c in zip(rows, prints, classes, strict=True))
    got = simhash.near_classes(docs).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    return got


def test_a_table_and_odd_rows(spark, sf):
    checked(table(spark, sf, "documents"))
    got = checked(odd.documents(spark))
    blank = {r["component_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert blank == {104}


def test_rows_of_null_id_only_and_no_rows(spark):
    checked(odd.documents(spark, [(None, "a b c d", "en", "s"), (None, "a b c d", "en", "s"), (7, "quite another text than those", "en", "s"), (7, "one id but other words here again", "en", "s")]))
    assert simhash.near_classes(odd.empty(spark)).count() == 0
