from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import alignment
from pagemill.llm.bpe import byte_letters
from pagemill.llm.common import table
from tests.llm import odd

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
A = tokenizers.Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
LETTERS = {c: b for b, c in enumerate(byte_letters())}
SIDES = alignment.Sides(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())


def tokens(text):
    """Both sides' (id, start, end) by the two libraries, byte by byte."""
    if not text:
        return [], []
    out = []
    for ids, said in ((A.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(LETTERS[c] for c in A.id_to_token(i))), (B.encode(text), lambda i: alignment.piece_bytes(B.id_to_piece(i)))):
        at, side, data = 0, [], b""
        for i in ids:
            data += said(i)
            side.append((i, at, len(data)))
            at = len(data)
        if data != (" " + text).encode("utf-8"):
            return [], []
        out.append(side)
    return out


def brute(texts):
    """What the contract asks for, by comparing every token of one side with every one of the other."""
    found, count = [], Counter()
    for text in texts:
        a, b = tokens(text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [("," .join(str(i) for i, _, e in a if lo < e <= hi), ",".join(str(i) for i, _, e in b if lo < e <= hi)) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        said = ";".join("|".join(g) for g in groups)
        found.append((len(a), len(b), len(cuts), links, hashlib.sha256(said.encode()).hexdigest() if a else ""))
        count.update(set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(n_a, n_b, n_g, len(ls), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls), sha) for n_a, n_b, n_g, ls, sha in found], count, best


def got(df):
    return [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect()]


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_the_libraries_do(text):
    a, b = tokens(text)
    assert SIDES.encode(text) == ([i for i, _, _ in a], [i for i, _, _ in b])


@pytest.mark.parametrize("text", ["<|endoftext|> a <s></s><unk>", "a▁b", "  two  spaces \n\n", "\x00", "x" * 20_000, " " * 20_000, "é é ﬁ", "漢字 \U0001f388", "<0x41> A"])
def test_odd_texts(spark, text):
    docs = odd.documents(spark, [(1, text, "en", "s")])
    a, b = tokens(text)
    assert SIDES.encode(text) == ([i for i, _, _ in a], [i for i, _, _ in b])
    if len(text) < 1000:
        assert got(alignment.align(docs, *PATHS)) == brute([text])[0]


def test_rows_agree_with_comparing_all_tokens(spark, monkeypatch):
    monkeypatch.setattr(alignment, "TOGETHER", 2)  # several parts and levels of sums
    docs = odd.documents(spark, [r for r in odd.rows() if r[0] != 108]).repartition(6)
    rows = docs.select("doc_id", "text").collect()
    want, count, best = brute([r["text"] for r in rows])
    made = alignment.Alignment(docs, *PATHS)
    assert made.parts > 2
    assert sorted(got(made.documents())) == sorted(want)
    pairs = {(r["a"], r["b"]): (r["n_docs"], r["best"]) for r in made.pairs().collect()}
    assert pairs == {p: (n, n == best[p[0]]) for p, n in count.items()}
    made.discard()


def test_a_table_by_id(spark, sf):
    docs = table(spark, sf, "documents").where("length(text) < 3000")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows])[0], strict=True))
    out = alignment.align(docs, *PATHS)
    assert dict(zip([r["doc_id"] for r in out.select("doc_id").collect()], got(out), strict=True)) == want


def test_null_and_repeated_ids_very_long_texts_and_no_rows(spark):
    docs = odd.documents(spark)
    out = alignment.align(docs, *PATHS)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in docs.collect())
    blank = {r["doc_id"]: r for r in out.where("n_a = 0").collect()}
    assert {104, 105} <= set(blank) and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in blank.values())
    assert out.where("doc_id = 108").first()["n_links"] > 30_000
    assert alignment.align(odd.empty(spark), *PATHS).count() == 0
