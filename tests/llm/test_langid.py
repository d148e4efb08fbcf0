from __future__ import annotations

import math
import tracemalloc
import zlib

import numpy as np

from pagemill.llm import langid
from pagemill.llm.common import table
from tests.llm import odd


def test_gradients_by_backpropagation_agree_with_differences():
    net = langid.Network(["a", "b", "c"], hidden=3, seed=1)
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (7, 4))
    codes[5:, 1] = 256
    labels = np.array([0, 1, 2, 1])
    for p in net.parameters():
        p[...] = p.astype(np.float64)
    _, grads = net.gradients(codes, labels)
    for p, g in zip(net.parameters(), grads, strict=True):
        flat, want = p.reshape(-1), g.reshape(-1)
        for k in np.argsort(-np.abs(want))[:4]:
            was, step = flat[k], np.float32(1e-2)
            flat[k] = was + step
            up = net.gradients(codes, labels)[0]
            flat[k] = was - step
            down = net.gradients(codes, labels)[0]
            flat[k] = was
            assert abs((up - down) / (2 * step) - want[k]) < 2e-2 * max(0.05, abs(want[k]))


def test_held_out_accuracy_and_contract(spark, sf):
    docs = {r["doc_id"]: (r["text"], r["lang"]) for r in table(spark, sf, "documents").select("doc_id", "text", "lang").collect()}
    got = langid.query(spark, sf).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == docs[r["doc_id"]][1] for r in held) >= 0.95 * len(held)


def plain_pooled(net, text):
    """Mean probabilities of a text, one byte and one number after another."""
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    h = net.forth.n.shape[0]

    def states(gru, codes):
        own, out = [0.0] * h, []
        for c in codes:
            z = [sigmoid(gru.x[c][k] + sum(own[i] * gru.zr[i][k] for i in range(h))) for k in range(h)]
            r = [sigmoid(gru.x[c][h + k] + sum(own[i] * gru.zr[i][h + k] for i in range(h))) for k in range(h)]
            n = [math.tanh(gru.x[c][2 * h + k] + sum(r[i] * own[i] * gru.n[i][k] for i in range(h))) for k in range(h)]
            own = [n[k] + z[k] * (own[k] - n[k]) for k in range(h)]
            out.append(own)
        return out

    total = [0.0] * len(net.languages)
    for a in range(0, len(text), langid.WINDOW):
        codes = [*text[a : a + langid.WINDOW]]
        real = len(codes)
        codes += [256] * (langid.WINDOW - real)
        forth, back = states(net.forth, codes), states(net.back, codes[::-1])[::-1]
        for f, b in zip(forth[:real], back[:real], strict=True):
            both = [*f, *b]
            logits = [net.bias[k] + sum(both[i] * net.out[i][k] for i in range(2 * h)) for k in range(len(total))]
            top = max(logits)
            each = [math.exp(x - top) for x in logits]
            total = [t + e / sum(each) for t, e in zip(total, each, strict=True)]
    return [t / len(text) for t in total]


def test_predictions_equal_a_plain_forward_pass():
    net = langid.Network(["a", "b", "c"], hidden=4, seed=5)
    texts = [odd.text(k, n).encode() for k, n in enumerate([1, 12, 40])] + ["é漢字 Ω".encode()]
    assert np.allclose(langid.pooled(net, texts), [plain_pooled(net, t) for t in texts], atol=1e-5)


def test_whole_texts_count():
    net = langid.Network(["a", "b"], seed=3)
    texts = [odd.text(k, n).encode() for k, n in enumerate([1, 5, 40, 700])]
    together = langid.pooled(net, texts)
    assert np.allclose(together, np.concatenate([langid.pooled(net, [t]) for t in texts]), atol=1e-5)
    assert np.allclose(together.sum(1), 1, atol=1e-4)
    assert not np.allclose(langid.pooled(net, [texts[3]]), langid.pooled(net, [texts[3][:300]]), atol=1e-6)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = langid.identify(docs, langid.learned(docs)).select("doc_id", "text", "language.lang_pred", "language.score").collect()
    assert len(got) == docs.count()
    for r in got:
        lettered = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] != "und") == lettered and (r["score"] > 0) == lettered
    assert langid.identify(odd.empty(spark), langid.learned(docs)).count() == 0
    none = langid.identify(docs, langid.learned(odd.empty(spark))).select("language.lang_pred").distinct().collect()
    assert [r[0] for r in none] == ["und"]
    kept = langid.kept(spark, docs, "")
    assert kept.columns == docs.columns and kept.where("doc_id = 100").count() == 1 and kept.where("text is null").count() == 0


def test_every_language_of_the_training_rows_is_learned(spark):
    names = [f"l{k:02d}" for k in range(70)]
    rows = [(100 * k + n, f"{chr(0x4E00 + 40 * k)}{chr(0x4E01 + 40 * k)} " * 30, name) for k, name in enumerate(names) for n in range(3)]
    network = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert network.languages == names
    p = langid.pooled(network, [t.encode() for _, t, _ in rows])
    assert p.shape == (210, 70) and np.allclose(p.sum(1), 1, atol=1e-4)
    assert np.mean([names[k] == r[2] for k, r in zip(p.argmax(1), rows, strict=True)]) > 0.5


def test_null_and_repeated_ids_lose_no_language(spark):
    rows = [(None, f"{chr(0x4E00 + 40 * k)}{n} " * 20, f"l{k}") for k in range(12) for n in range(500)]
    schema = "doc_id long, text string, lang string"
    network = langid.train(spark.createDataFrame(rows, schema))
    p = langid.pooled(network, [t.encode() for _, t, _ in rows[::50]])
    assert np.mean([network.languages[k] == r[2] for k, r in zip(p.argmax(1), rows[::50], strict=True)]) > 0.9
    same = langid.train(spark.createDataFrame([(None, "eins zwei drei", "de")] * 3000 + [(7, f"one two {k % 2}", "en") for k in range(3000)], schema))
    p = langid.pooled(same, [b"eins zwei drei", b"one two 1"])
    assert [same.languages[k] for k in p.argmax(1)] == ["de", "en"]


def test_prediction_takes_little_memory_and_agrees_with_the_states_of_training():
    net = langid.Network(["a", "b", "c"], seed=3)
    text = np.frombuffer(odd.text(4, 120_000).encode(), np.uint8)
    net.pooled(text[:1000], np.array([0, 1000]))
    tracemalloc.start()
    net.pooled(text, np.array([0, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000  # over 40 MB with the states of both directions
    codes = text[: 96 * 40].reshape(40, 96).T.astype(np.int64)
    assert np.allclose(net.positions(codes)[0], net.positions(codes, keep=True)[0], atol=1e-6)


def test_what_the_stage_keeps_is_written(spark):
    assert langid.kept(spark, odd.documents(spark), "").inputFiles()
