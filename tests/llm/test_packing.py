from __future__ import annotations

from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st

from pagemill.llm import packing
from pagemill.llm.common import table
from tests.llm import odd


def plain_best_fit(lengths, sources, clusters, capacity):
    """Looks at every bin for every piece."""
    bins, out = [], [None] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [
            (capacity - sum(lengths[x] for x in b), n) for n, b in enumerate(bins)
            if capacity - sum(lengths[x] for x in b) >= lengths[k] and all((sources[x] is None or sources[x] != sources[k]) and clusters[x] != clusters[k] for x in b)
        ]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append([])
        bins[n].append(k)
        out[k] = n
    return out


@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from([None, "a", "b", "c"]), st.integers(0, 6)), max_size=40))
def test_best_fit_is_the_tightest_compatible_bin(pieces):
    lengths, sources, clusters = [p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces]
    got = packing.best_fit(lengths, sources, clusters, 20)
    assert [b for b, _ in got] == plain_best_fit(lengths, sources, clusters, 20)
    taken = defaultdict(set)
    for (b, at), n in zip(got, lengths, strict=True):
        places = set(range(at, at + n))
        assert not places & taken[b] and max(places) < 20
        taken[b] |= places


def check(docs, packed, capacity=packing.CAPACITY):
    rows = packed.collect()
    own = {}
    for r in docs.select("doc_id", "text", "source").collect():
        own.setdefault(r["doc_id"], []).append(r)
    want = Counter({i: sum(len((r["text"] or "").split()) + 1 for r in v) for i, v in own.items()})
    got, bins = Counter(), defaultdict(list)
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
        bins[r["bin"]].append(r)
    assert got == want
    for held in bins.values():
        assert sum(r["n_tokens"] for r in held) <= capacity
        if None not in {r["doc_id"] for r in held}:
            sources = [own[r["doc_id"]][0]["source"] for r in held]
            texts = [own[r["doc_id"]][0]["text"] or "" for r in held]
            assert len(set(texts)) == len(texts) and max(Counter(s for s in sources if s is not None).values(), default=0) <= 1
    return len(bins), sum(got.values()) / capacity


def test_a_table_is_packed_whole_and_without_conflicts(spark, sf):
    bins, least = check(table(spark, sf, "documents"), packing.query(spark, sf))
    assert bins < 1.3 * least + 5


def test_odd_rows(spark):
    docs = odd.documents(spark)
    check(docs, packing.pack(docs))
    assert packing.pack(odd.empty(spark)).count() == 0
    check(docs, packing.packed(spark, docs, ""))


def test_given_clusters(spark):
    rows = [(k, odd.text(k, 5), "en", f"s{k}") for k in range(20)]
    docs = odd.documents(spark, rows)
    packed = packing.pack(docs, cluster_col="bucket").collect()  # one cluster: every document in a bin of its own
    assert len({r["bin"] for r in packed}) == 20


def test_bins_do_not_depend_on_partitions(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    docs = docs.unionByName(docs.limit(3))  # repeated rows too

    def bins(n):
        out = defaultdict(list)
        for r in packing.pack(docs.repartition(n)).collect():
            out[r["bin"]].append((r["doc_id"], r["piece"], r["bin_offset"]))
        return {b: sorted(v) for b, v in out.items()}

    assert bins(3) == bins(5)
