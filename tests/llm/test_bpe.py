from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import bpe
from pagemill.llm.common import table
from tests.llm import odd

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
THEIRS = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
OURS = bpe.Encoder(bpe.WordBpe(open(P.path("word_bpe_49k.json"), encoding="utf-8").read()))


def theirs(text):
    ids = THEIRS.encode(text, add_special_tokens=False).ids
    return ids, THEIRS.decode(ids, skip_special_tokens=False)


def digests(text):
    ids, said = theirs(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode("utf-8")).hexdigest()


@settings(deadline=None, max_examples=500)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_any_text(some):
    got = [(ids.tolist(), said) for ids, said in OURS.texts(some)]
    assert got == [theirs(t) for t in some]


@pytest.mark.parametrize("text", ["", " ", "it's we'LL 'S", "aaaa aaaaa aaaaaa", "<|endoftext|><|startoftext|> a<|endoftext|>b <|x|>", "ΣΑΣ İ ß Ⅷ ǅ é é", "漢字 ｱ 🎈👨‍👩‍👧 ​　x", "12345 1.5e-3", "a\x00b\x85c\xa0d e", "x" * 5000, "!?" * 300])
def test_odd_texts(text):
    assert [(ids.tolist(), said) for ids, said in OURS.texts([text])] == [theirs(text)]


def test_a_table_and_odd_rows(spark, sf):
    for docs in (table(spark, sf, "documents"), odd.documents(spark)):
        want = sorted((str(r["doc_id"]), *digests(r["text"])) for r in docs.select("doc_id", "text").collect())
        got = bpe.encode(docs, P.path("word_bpe_49k.json"), ids=False).collect()
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert bpe.encode(odd.empty(spark), P.path("word_bpe_49k.json")).count() == 0


def test_ids_are_returned(spark):
    docs = odd.documents(spark, [(1, "hello brave new world", "en", "s")])
    assert bpe.encode(docs, P.path("word_bpe_49k.json")).first()["ids"] == theirs("hello brave new world")[0]
