from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from pagemill.llm import dedup, quality
from pagemill.llm.common import table
from tests.llm import odd
from tests.llm.test_dedup import brute


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows of each stage, each on all that the stage before it kept."""
    docs, out = table(spark, sf, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        out.append(docs)
    return out


def test_stages_are_the_four_in_order_and_keep_the_columns(spark, sf, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "packing"]
    assert all(s.columns == table(spark, sf, "documents").columns for s in stages[:-1])


def test_decisions_take_effect_and_clean_documents_stay(spark, sf, stages):
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in stages]
    judged = {r["doc_id"]: r["keep"] for r in quality.query(spark, sf).collect()}
    assert ids[0] == {i for i, k in judged.items() if k}
    assert sum(i in ids[1] for i, q in labels.items() if q) >= 0.92 * sum(labels.values())
    classes = brute({i: docs[i] for i in ids[1]})
    assert ids[2] == set(classes.values())
    assert ids[3] == ids[2]
    tokens = Counter()
    for r in stages[3].collect():
        tokens[r["doc_id"]] += r["n_tokens"]
    assert tokens == {i: len(docs[i].split()) + 1 for i in ids[3]}


def test_run_gives_the_last_stages_rows(spark, sf, stages):
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()) == Counter(r["doc_id"] for r in stages[3].collect())


def test_odd_rows_go_through_every_stage(spark, sf):
    for docs in (odd.documents(spark), odd.empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            all_ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
            docs = stage(spark, docs, sf)
            assert "bucket" in docs.columns, name
            assert not Counter(r["doc_id"] for r in docs.select("doc_id").collect()) - Counter(all_ids)
            if name == "quality":  # null and empty texts have no perplexity and go
                assert docs.where("text is null or text = ''").count() == 0
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()
    assert dedup.kept(spark, odd.documents(spark), sf).where("doc_id = 100").count() == 1


def test_rows_that_share_an_id_or_have_none_are_judged_one_by_one(spark, sf):
    good = table(spark, sf, "documents").join(table(spark, sf, "labels").where("quality = 1"), "doc_id").orderBy("doc_id").first()["text"]
    junk = "".join(random.Random(4).choices("zqxjkvw#%0189~", k=1600))
    some = [(None, good, "en", "s"), (None, "", "en", "s"), (None, None, "en", "s"), (None, junk, "en", "s"), (-1, good + " and so on", "en", "s"), (-1, junk, "en", "s"), (-1, "", "en", "s")]
    docs = table(spark, sf, "documents")
    docs = docs.unionByName(odd.documents(spark, some).select(docs.columns))
    left = quality.kept(spark, docs, sf).where("doc_id is null or doc_id = -1")
    assert sorted(r["text"] for r in left.collect()) == sorted([good, good + " and so on"])


def test_different_texts_of_one_id_are_different_documents(spark, sf):
    a, b, c = odd.varied(1, 60), odd.varied(2, 60), odd.varied(3, 60)
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (2, c, "en", "s"), (3, a + " x", "en", "s"), (0, b, "en", "s"), (1, a, "en", "s"), (None, a, "en", "s"), (4, c, "en", "s"), (4, a, "en", "s")]
    left = dedup.kept(spark, odd.documents(spark, rows), sf)
    assert sorted((str(r["doc_id"]), r["text"]) for r in left.collect()) == sorted([("1", a), ("0", b), ("2", c), ("None", a)])
    classes = sorted((str(r["doc_id"]), str(r["class_id"])) for r in dedup.near_classes(odd.documents(spark, rows)).collect())
    assert classes == sorted([("1", "1"), ("1", "0"), ("2", "2"), ("3", "1"), ("0", "0"), ("1", "1"), ("None", "None"), ("4", "2"), ("4", "1")])
