"""Language identification with a bidirectional gated recurrent network over bytes (operator 5).

The network reads a text's UTF-8 bytes in windows of ``WINDOW`` bytes, one hidden state in each
direction, and gives every byte position a distribution over the learned languages; a document's
probabilities are the mean over all its positions, whatever its length. It is trained in numpy by
backpropagation through time on a bounded sample of labelled texts: about ``PER_LANGUAGE`` texts
of each language, chosen by hash of id and text, from each of which windows are drawn at hashed places.
Every language that a training row names is learned, however many there are.

Texts that are null or have no letter are ``und`` with score 0. With no labelled text every text
is ``und``. Of equally probable languages the one that is first in the alphabet is predicted.
Repeated rows get the same prediction; an empty table gives an empty result; the language column is
read for training only, further columns not at all. Very long texts are read whole when they are
predicted; in training each text of the sample gives ``WINDOWS_OF_TEXT`` windows, which with
``PER_LANGUAGE`` is the sample's bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import crc_mod, small_batches, stored, table, trim, utf8

WINDOW = 96
HIDDEN = 12
#: Texts to learn from in each language (expected; they're chosen by hash), and windows of each.
PER_LANGUAGE, WINDOWS_OF_TEXT = 400, 4
#: Places of hashes.
PLACES = 1_000_000
#: A batch has BATCH windows, and at least LEAST_OF_EACH of each language.
STEPS, BATCH, LEAST_OF_EACH, RATE = 260, 128, 2, 0.02
#: Windows read together (fewer for more than USUAL languages), and a task's bytes at a time.
LANES, USUAL, BLOCK_BYTES = 2048, 64, 2_000_000
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Gru:
    """Weights of one direction: input rows by byte, recurrent matrices, both for gates z, r, n."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.x = (rng.standard_normal((257, 3 * hidden)) * 0.3).astype(np.float32)  # 256: padding
        self.zr = (rng.standard_normal((hidden, 2 * hidden)) / hidden**0.5).astype(np.float32)
        self.n = (rng.standard_normal((hidden, hidden)) / hidden**0.5).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.x, self.zr, self.n]

    @np.errstate(over="ignore")
    def forward(self, codes: np.ndarray, keep: bool = False):
        """States after each step, time first; ``codes`` are (time, lanes). Padding keeps the state."""
        steps, lanes = codes.shape
        hidden = self.n.shape[0]
        one, two = np.float32(1), np.float32(2)
        # A table and a matrix for each gate, so all arrays are whole, with the signs and factors that
        # exponentials want: a sigmoid is 1 / (1 + exp(-a)), a tanh 1 - 2 / (1 + exp(2a)).
        cut = lambda w, k: np.ascontiguousarray(w[:, k * hidden : (k + 1) * hidden])
        (xz, xr), xn = (-cut(self.x, k) for k in (0, 1)), cut(self.x, 2) * two
        (wz, wr), wn = (-cut(self.zr, k) for k in (0, 1)), self.n * two
        h = np.zeros((lanes, hidden), np.float32)
        x = np.empty((lanes, hidden), np.float32)
        states = np.empty((steps, lanes, hidden), np.float32)
        saved = []
        for t in range(steps):
            z, r = h @ wz, h @ wr
            for gate, inputs in ((z, xz), (r, xr)):
                gate += np.take(inputs, codes[t], axis=0, out=x, mode="clip")
                np.exp(gate, out=gate)
                gate += one
                np.divide(one, gate, out=gate)
            rh = r * h
            n = rh @ wn
            n += np.take(xn, codes[t], axis=0, out=x, mode="clip")
            np.exp(n, out=n)
            n += one
            np.divide(-two, n, out=n)
            n += one
            if keep:
                saved.append((h, z, r, rh, n))
            own = states[t]  # n + z * (h - n)
            np.subtract(h, n, out=own)
            own *= z
            own += n
            h = own
        return states, saved

    def backward(self, codes: np.ndarray, saved: list, grads: np.ndarray) -> list[np.ndarray]:
        """Gradients of the parameters by backpropagation through time, from those of the states."""
        dx, dzr, dn = (np.zeros_like(p) for p in self.parameters())
        hidden = self.n.shape[0]
        carry = np.zeros_like(grads[0])
        for t in range(len(codes) - 1, -1, -1):
            h, z, r, rh, n = saved[t]
            g = grads[t] + carry
            gn = g * (1 - z) * (1 - n * n)
            gz = g * (h - n) * z * (1 - z)
            grh = gn @ self.n.T
            gr = grh * h * r * (1 - r)
            gates = np.concatenate([gz, gr], axis=1)
            dn += rh.T @ gn
            dzr += h.T @ gates
            np.add.at(dx, codes[t], np.concatenate([gates, gn], axis=1))
            carry = g * z + grh * r + gates @ self.zr.T
        assert hidden == carry.shape[1]
        return [dx, dzr, dn]


class Network:
    """Two directions and a softmax layer over the learned languages."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forth, self.back = Gru(rng, hidden), Gru(rng, hidden)
        self.out = (rng.standard_normal((2 * hidden, len(languages))) * 0.3).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.forth.parameters(), *self.back.parameters(), self.out, self.bias]

    def positions(self, codes: np.ndarray, keep: bool = False):
        """Probabilities at every position, (time, lanes, languages); with ``keep`` what gradients need, too.

        Without it the states of one direction are gone before those of the other are there.
        """
        if keep:
            a, saved_a = self.forth.forward(codes, keep)
            b, saved_b = self.back.forward(codes[::-1], keep)
            both = np.concatenate([a, b[::-1]], axis=2)
            return self.softmax(both @ self.out), both, saved_a, saved_b
        hidden = self.forth.n.shape[0]
        logits = self.forth.forward(codes)[0] @ self.out[:hidden]
        logits += (self.back.forward(codes[::-1])[0] @ self.out[hidden:])[::-1]
        return self.softmax(logits), None, None, None

    def softmax(self, logits: np.ndarray) -> np.ndarray:
        """Probabilities in place of the logits, to which the bias is added."""
        logits += self.bias
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy of all positions that aren't padding, and its gradients."""
        p, both, saved_a, saved_b = self.positions(codes, keep=True)
        real = (codes < 256).astype(np.float32)
        share = real / max(1.0, float(real.sum()))
        lanes = np.arange(codes.shape[1])
        loss = -float((np.log(np.maximum(p[:, lanes, labels], 1e-9)) * share).sum())
        d = p * share[:, :, None]
        d[:, lanes, labels] -= share
        flat = d.reshape(-1, d.shape[2])
        d_out, d_bias = both.reshape(-1, both.shape[2]).T @ flat, flat.sum(0)
        d_both = d @ self.out.T
        hidden = both.shape[2] // 2
        return loss, [
            *self.forth.backward(codes, saved_a, d_both[:, :, :hidden]),
            *self.back.backward(codes[::-1], saved_b, d_both[::-1, :, hidden:]),
            d_out, d_bias,
        ]

    def learn(self, codes: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 11) -> None:
        """Adam over random batches of windows (codes: windows by time), languages equally often."""
        if not len(codes):
            return
        rng = np.random.default_rng(seed)
        each = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        each = [e for e in each if len(e)]
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        for step in range(1, steps + 1):
            picked = np.concatenate([rng.choice(e, max(LEAST_OF_EACH, batch // len(each))) for e in each])
            _, grads = self.gradients(np.ascontiguousarray(codes[picked].T, np.int64), labels[picked])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            scale = min(1.0, 1.0 / max(norm, 1e-9))
            now = rate * (1 - step / (steps + 1))
            for p, g, m, v in zip(self.parameters(), grads, first, second, strict=True):
                g = g * scale
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for empty texts."""
        sizes = np.diff(offsets)
        counts = -(-sizes // WINDOW)  # windows of each text
        text_of = np.repeat(np.arange(len(sizes)), counts)
        nth = np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = offsets[:-1][text_of] + nth * WINDOW
        lengths = np.minimum(WINDOW, offsets[1:][text_of] - starts)
        total = np.zeros((len(sizes), len(self.languages)))
        padded = np.r_[data, np.zeros(WINDOW, np.uint8)]
        together = max(1, LANES * USUAL // max(USUAL, len(self.languages)))
        for full in (True, False):  # windows of full length go together, so few lanes are padded
            mine = np.flatnonzero((lengths == WINDOW) == full)
            mine = mine[np.argsort(lengths[mine], kind="stable")]
            for a in range(0, len(mine), together):
                lanes = mine[a : a + together]
                steps = WINDOW  # shorter ones are padded as in training, whatever they are read with
                codes = padded[starts[lanes][None, :] + np.arange(steps)[:, None]].astype(np.int64)
                real = np.arange(steps)[:, None] < lengths[lanes][None, :]
                if not full:
                    codes[~real] = 256
                p, *_ = self.positions(codes)
                if not full:
                    p *= real[:, :, None]
                np.add.at(total, text_of[lanes], p.sum(0))
        return total / np.maximum(sizes, 1)[:, None]


def windows_of(texts: list[bytes], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """WINDOWS_OF_TEXT windows of each text, spread over the whole text at places by its key."""
    out, owner = [], []
    for i, (text, key) in enumerate(zip(texts, keys, strict=True)):
        rng = np.random.default_rng(key & 0xFFFFFFFF)
        data = np.frombuffer(text, np.uint8)
        for at in sorted({int(x) for x in rng.integers(0, max(1, len(data) - WINDOW + 1), WINDOWS_OF_TEXT)}):
            row = np.full(WINDOW, 256, np.int64)
            piece = data[at : at + WINDOW]
            row[: len(piece)] = piece
            out.append(row)
            owner.append(i)
    return np.array(out).reshape(-1, WINDOW), np.array(owner, np.int64)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    """Learn from rows whose language and text aren't null.

    Of each language about PER_LANGUAGE different rows (by id and text) count, those of the least
    hashes, and one at least: ids may be null or repeat, and repeated rows count once.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    rows = rows.withColumn("key", F.xxhash64("id", "lang", "text")).withColumn("place", F.pmod("key", F.lit(PLACES)))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("first")).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return Network([])
    # places below a language's share of the range: about PER_LANGUAGE of its texts, and one at least
    shares = labelled.sparkSession.createDataFrame([(r["lang"], max(math.ceil(min(1.0, PER_LANGUAGE / r["n"]) * PLACES), r["first"] + 1)) for r in counts], "lang string, below long")
    chosen = rows.join(F.broadcast(shares), "lang").where("place < below").select("id", "text", "lang", "key").dropDuplicates(["lang", "key"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, owner = windows_of([t.encode("utf-8") for t in batch["text"]], batch["key"].tolist())
            yield pd.DataFrame({"lang": batch["lang"].to_numpy()[owner], "key": batch["key"].to_numpy()[owner], "codes": [c.astype(np.int16).tobytes() for c in codes]})

    with small_batches(labelled.sparkSession):
        got = chosen.mapInPandas(cut, "lang string, key long, codes binary").toPandas().sort_values(["key", "codes"])
    number = {name: k for k, name in enumerate(languages)}
    network = Network(languages)
    codes = np.frombuffer(b"".join(got["codes"]), np.int16).reshape(-1, WINDOW)
    network.learn(codes, np.array([number[x] for x in got["lang"]], np.int64))
    return network


def predict(network: Network, text: Column, spark: SparkSession) -> Column:
    """A struct (lang_pred, score) for each text."""
    shared = spark.sparkContext.broadcast(network)  # some tens of kilobytes

    @F.pandas_udf("lang_pred string, score double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            known, p = np.zeros(len(batch), bool), np.zeros((len(batch), max(1, len(own.languages))))
            start, held, raw = 0, 0, []
            for i, text in enumerate(batch):
                known[i] = bool(own.languages) and isinstance(text, str) and LETTER.search(text) is not None
                data = text.encode("utf-8") if known[i] else b""
                if raw and held + len(data) > BLOCK_BYTES:
                    p[start:i] = pooled(own, raw)
                    start, held, raw = i, 0, []
                raw.append(data)
                held += len(data)
            if raw:
                p[start:] = pooled(own, raw)
            del raw
            best = p.argmax(1)
            names = np.array([*own.languages, UNDETERMINED], object)
            trim()
            yield pd.DataFrame({"lang_pred": names[np.where(known, best, len(own.languages))], "score": np.where(known, np.minimum(p.max(1), 1.0), 0.0)})

    return judged(text)


def pooled(network: Network, raw: list[bytes]) -> np.ndarray:
    if not network.languages:
        return np.zeros((len(raw), 1))
    data, offsets = utf8(pa.array(raw, pa.binary()))
    return network.pooled(data, offsets)


def identify(docs: DataFrame, network: Network, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with one more column, a struct (lang_pred, score)."""
    return docs.withColumn(name, predict(network, F.col(text_col), docs.sparkSession))


def learned(docs: DataFrame) -> Network:
    """Trained on the documents that aren't held out (crc32(doc_id) mod 4 other than 2)."""
    return train(docs.where(F.coalesce(crc_mod("doc_id", 4), F.lit(0)) != 2))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    found = identify(docs.select("doc_id", "text"), learned(docs), name="language")
    return found.select("doc_id", held, "language.lang_pred", "language.score")


#: In the pipeline, texts whose best language has less than this mean probability go.
LEAST_SCORE = 0.4


def kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is determined with enough certainty, with all their columns.

    They are written here, so that a worker gets few texts at a time whoever reads them.
    """
    name = "__language"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    found = identify(docs, learned(docs), name=name)
    certain = (F.col(f"{name}.lang_pred") != UNDETERMINED) & (F.col(f"{name}.score") >= LEAST_SCORE)
    return stored(found.where(certain).drop(name), "language-kept")
