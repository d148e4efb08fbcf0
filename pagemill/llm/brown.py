"""Language-model scoring with a Brown class-based bigram model (operator 7).

1. Each task cuts its texts into tokens and writes blocks: the texts as local token numbers, and the
   block's distinct words with their training counts. Later steps work on a block's distinct words
   and not on its tokens. A word is a 64-bit key within one of ``SHARDS`` shards, both hashes of
   it; so words need no strings, and two of them coincide with a probability of 2 ** -80 a pair.
2. Block counts are summed by word, in groups of shards.
3. Exchange clustering over the whole vocabulary, into as many classes as the cube root of its
   size. The ``SEEDS`` most frequent words are exchanged one by one, on a bounded matrix; these
   classes are where it starts. Then each word counts the classes of its neighbours over all
   training texts (one aggregate by word and class) and moves to the class where the likelihood
   gains most, all words in one round. Rounds go on until one adds less than ``GAIN`` to the
   likelihood of a token; the best assignment is kept. What reaches the driver is the table of
   class bigrams.
4. Counts and classes go back to the blocks; a text's probability is the product of class
   transitions and word emissions. A class keeps a share for words it hasn't seen (as many as it
   has different ones), and an unknown word is what all classes keep together, so the
   probabilities of all known words, the unknown word and the end add up to one.

Null texts count as empty: one end token. An empty table gives an empty result; with no training
text all classes are equally probable. Repeated rows are scored alike and all count in training.
A class that is as good as another one loses to it if its number is higher. A very long text is
cut into tokens at once, and a block of its own. Columns other than the named ones aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagemill.llm.common import blocks, bucketed, crc_mod, discard, gathered, mix, stored, table, trim, unbucketed, utf8
from pagemill.llm.dedup import BASE, power_table

#: Bytes of text in a block (at least, but for a task's last one; twice as many at most), and bytes that are hashed at a time.
BLOCK_BYTES, PIECE_BYTES = 12_000_000, 1_000_000
#: Tokens that a task scores at a time.
CHUNK = 500_000
SHARDS = 65_536
#: Distinct words of blocks that a task merges, in the mean.
PAIRS = 1_000_000
#: Words that are exchanged one by one before all are.
SEEDS = 512
#: Rounds and sweeps end when the log likelihood of a token grows by less.
GAIN = 0.005
#: Weight of the class unigram in a class transition.
BACKOFF = 5.0
#: Added to each class bigram count when words choose.
EPS = 0.5

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256)
LOWER[65:91] += 32
VALUES = [mix(LOWER, 71), mix(LOWER, 73)]
END = mix(np.zeros(1, np.uint64))[0]  # the key of no letters at all; its shard is 0


def pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(array.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and shards of all tokens of texts that lie one after another, and the texts' numbers of them."""
    n = len(data)
    space = np.ones(n + 2, bool)
    space[1:-1] = SPACE[data]
    first = np.zeros(n + 1, bool)  # of a text
    first[offsets] = True
    starts = np.flatnonzero(~space[1:-1] & (space[:-2] | first[:-1]))
    ends = np.flatnonzero(~space[1:-1] & (space[2:] | first[1:])) + 1
    forth, back = power_table(BASE, n + 1), power_table(pow(BASE, -1, 2**64), n + 1)
    sums = np.zeros(n + 1, np.uint64)
    hashes = []
    for values in VALUES:
        np.cumsum(values[data] * forth[:n], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * back[starts]))
    sizes = np.diff(np.searchsorted(starts, offsets)) + 1
    word = np.ones(len(starts) + len(sizes), bool)
    word[np.cumsum(sizes) - 1] = False
    keys, shards = np.full(len(word), END), np.zeros(len(word), np.uint16)
    keys[word], shards[word] = hashes[0], (hashes[1] >> np.uint64(48)).astype(np.uint16)
    return keys, shards, sizes


def to_blocks(rows: DataFrame) -> DataFrame:
    """Rows (id, text, held) as blocks.

    ``keys``, ``shards`` and ``counts`` are of the block's distinct words, in the order of shard and
    key; ``tokens`` are places in them; ``counts`` are those of the texts that aren't held out.
    """
    kind = rows.schema["id"].dataType
    ids_type = pa.list_(to_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, task = 0, TaskContext.get().partitionId()
        for batch in gathered(batches, 1, BLOCK_BYTES):
            data, offsets = utf8(batch.column(1))
            for start, end in blocks(np.diff(offsets), 2 * BLOCK_BYTES):
                yield one(f"{task}-{number}", batch.slice(start, end - start), data, offsets[start : end + 1])
                number += 1
                trim()

    def one(block: str, batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        found = []
        for a, b in blocks(np.diff(offsets), PIECE_BYTES):
            at = offsets[a : b + 1]
            found.append(tokens_of(data[at[0] : at[-1]], at - at[0]))
        keys, shards, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        codes, distinct = pd.factorize(keys)
        del keys
        of_distinct = np.empty(len(distinct), np.uint16)
        of_distinct[codes] = shards
        order = np.lexsort((distinct, of_distinct))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        tokens = place[codes]
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        counts = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(order)).astype(np.int32)
        packed = [pack(sizes.astype(np.int32)), pack(tokens), distinct[order].tobytes(), pack(of_distinct[order]), pack(counts)]
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([batch.column(0).to_pylist()], ids_type), pa.array([held.tolist()], pa.list_(pa.bool_())), *(pa.array([x], pa.binary()) for x in packed), pa.array([len(order)])],
            ["block", "ids", "held", "sizes", "tokens", "keys", "shards", "counts", "words"],
        )

    return rows.mapInArrow(run, f"block string, ids array<{kind.simpleString()}>, held array<boolean>, sizes binary, tokens binary, keys binary, shards binary, counts binary, words long")


@dataclass
class Deal:
    """How words are dealt: ``groups`` ranges of shards, and ``parts`` parts of the blocks."""

    groups: int
    parts: int

    def cuts(self, shards: np.ndarray) -> list[tuple[int, int, int]]:
        """Of ascending shards: (group, start, end) of each group that is there."""
        own = shards.astype(np.int64) * self.groups // SHARDS
        there, first = np.unique(own, return_index=True)
        return list(zip(there.tolist(), first.tolist(), np.r_[first[1:], len(own)].astype(int).tolist(), strict=True))


def asked(made: DataFrame, deal: Deal) -> DataFrame:
    """Rows (block, group, part, keys, counts) of all words of all blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                keys, counts = np.frombuffer(row.keys, np.uint64), unpack(row.counts, np.int32)
                cuts = deal.cuts(unpack(row.shards, np.uint16))
                yield pd.DataFrame({"block": row.block, "group": [g for g, *_ in cuts], "keys": [keys[a:b].tobytes() for _, a, b in cuts], "counts": [pack(counts[a:b].astype(np.int64)) for _, a, b in cuts]})

    rows = made.select("block", "keys", "shards", "counts").mapInPandas(run, "block string, group int, keys binary, counts binary")
    return rows.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(deal.parts)).cast("int"))


def word_counts(asks: DataFrame, deal: Deal) -> DataFrame:
    """Rows (group, keys, counts, top, top_counts): the training words of a group in the order of their
    keys, and the most frequent ones."""

    def merge(batch: pd.DataFrame) -> pd.DataFrame:
        trim()
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in batch["keys"]])
        counts = np.concatenate([unpack(c, np.int64) for c in batch["counts"]])
        codes, distinct = pd.factorize(keys[counts > 0])
        sums = np.bincount(codes, counts[counts > 0], len(distinct)).astype(np.int64)
        order = np.argsort(distinct)
        distinct, sums = distinct[order], sums[order]
        top = np.lexsort((distinct.view(np.int64), -sums))[: SEEDS + 1]
        return pd.DataFrame({"group": batch["group"].iloc[:1], "keys": [distinct.tobytes()], "counts": [pack(sums)], "top": [distinct[top].view(np.int64)], "top_counts": [sums[top]]})

    schema = "group int, keys binary, counts binary, top array<long>, top_counts array<long>"
    if deal.parts > 1:
        asks = stored(asks.groupBy("group", "part").applyInPandas(merge, schema), "brown-parts")
    return asks.groupBy("group").applyInPandas(merge, schema)


def unit_bigrams(made: DataFrame, seeds: np.ndarray) -> np.ndarray:
    """Counts of adjacent units in all training texts: the seeds (ascending keys), the end, all others."""
    units = len(seeds) + 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(units * units, np.int64)
        for batch in batches:
            for row in batch.itertuples():
                of_word = units_of(np.frombuffer(row.keys, np.uint64), seeds)
                for before, own in training_pairs(row):
                    before, own = np.where(before < 0, units - 2, of_word[before]), of_word[own]
                    total += np.bincount(before * units + own, minlength=units * units)
        pairs = np.flatnonzero(total)
        yield pd.DataFrame({"pair": pairs, "n": total[pairs]})

    found = made.select("sizes", "tokens", "keys", "held").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(units * units, np.int64)  # at most units squared rows, whatever the input
    got = found.toPandas()
    out[got["pair"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out.reshape(units, units)


def units_of(keys: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    if not len(seeds):
        return np.where(keys == END, 0, 1)
    at = np.minimum(np.searchsorted(seeds, keys), len(seeds) - 1)
    return np.where(keys == END, len(seeds), np.where(seeds[at] == keys, at, len(seeds) + 1))


def training_pairs(row) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (previous word, word) of each token of a block's training texts; -1 before a text."""
    sizes, tokens = unpack(row.sizes, np.int32).astype(np.int64), unpack(row.tokens, np.int32)
    held, ends = np.asarray(row.held, bool), np.r_[0, np.cumsum(sizes)]
    for a, b in blocks(sizes, CHUNK):
        own = tokens[ends[a] : ends[b]].astype(np.int64)
        before = np.r_[-1, own[:-1]]
        before[ends[a:b] - ends[a]] = -1
        keep = np.repeat(~held[a:b], sizes[a:b])
        yield before[keep], own[keep]


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(grams: np.ndarray) -> float:
    """Log likelihood of a token under the class bigrams, but for what doesn't depend on classes."""
    grams = grams.astype(np.float64)
    return float(xlogx(grams).sum() - xlogx(grams.sum(0)).sum() - xlogx(grams.sum(1)).sum()) / max(grams.sum(), 1)


def exchange(bigrams: np.ndarray, classes: int) -> np.ndarray:
    """Class of each unit, by exchange: each unit in turn goes where the likelihood is greatest.

    With the class bigram counts G, the likelihood is the sum of G log G less the sums of the
    class totals' x log x. Units start in round-robin order of frequency; the last two units (the
    end of a text, and all words that aren't units) keep classes of their own, the last two.
    """
    n = bigrams.shape[0]
    mass = bigrams.sum(0) + bigrams.sum(1)
    order = [u for u in np.argsort(-mass, kind="stable").tolist() if u < n - 2]
    own = np.zeros(n, np.int64)
    own[order] = np.arange(n - 2) % classes
    own[n - 2 :] = classes, classes + 1
    member = np.zeros((n, classes + 2))
    member[np.arange(n), own] = 1
    grams = bigrams.astype(np.float64)
    after, before = grams @ member, grams.T @ member  # of each unit: counts by the next and the previous class
    table = member.T @ after
    last = likelihood(table)
    while True:
        moved = 0
        for u in order:
            if not mass[u]:
                continue
            a, self_n = own[u], grams[u, u]
            out, into = after[u].copy(), before[u].copy()
            out[a] -= self_n
            into[a] -= self_n
            table[a, :] -= out
            table[:, a] -= into
            table[a, a] -= self_n
            left, right = table.sum(1) + into, table.sum(0) + out  # totals of the other classes' rows and columns hold u again
            # the gain of joining each class c: rows and columns c change, and the corner (c, c) once
            rows, columns, base = table + out[None, :], table + into[:, None], xlogx(table)
            gain = (xlogx(rows) - base).sum(1) + (xlogx(columns) - base).sum(0)
            corner = np.diagonal(table)
            gain += xlogx(corner + out + into + self_n) - xlogx(corner + out) - xlogx(corner + into) + xlogx(corner)
            gain -= xlogx(left + out.sum() + self_n) - xlogx(left) + xlogx(right + into.sum() + self_n) - xlogx(right)
            gain[classes:] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = int(a)
            table[best, :] += out
            table[:, best] += into
            table[best, best] += self_n
            if best != a:
                moved += 1
                own[u] = best
                after[:, a] -= grams[:, u]
                after[:, best] += grams[:, u]
                before[:, a] -= grams[u, :]
                before[:, best] += grams[u, :]
        now = likelihood(table)
        if not moved or now < last + GAIN:
            return own
        last = now


def classes_for(words: int) -> int:
    """How many classes a vocabulary gets."""
    return max(2, round(words ** (1 / 3)))


def profiles_of(row, classes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, n): how often a block's words stand before (code is the next word's class) and
    after (width more than the previous word's class) words of each class, in training texts."""
    found, counts = [], []
    end = np.flatnonzero(np.frombuffer(row.keys, np.uint64) == END)
    for before, own in training_pairs(row):
        before = np.where(before < 0, end, before)  # a text starts after an end
        for word, code in ((before, classes[own]), (own, width + classes[before])):
            pairs, n = np.unique(word * (2 * width) + code, return_counts=True)
            found.append(pairs)
            counts.append(n)
    return summed(found, counts, 2 * width)


def summed(found: list[np.ndarray], counts: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not found:
        return (np.zeros(0, np.int64),) * 3
    pairs, counts = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, int)
    pairs, counts = pairs[first], np.add.reduceat(counts, first) if len(first) else counts
    return pairs // width, pairs % width, counts


PROFILE = "group int, part int, keys binary, word binary, code binary, n binary"


def profile_rows(row, classes: np.ndarray, width: int, deal: Deal) -> pd.DataFrame:
    """A block's profiles, a row for each group of its words."""
    word, code, n = profiles_of(row, classes, width)
    keys = np.frombuffer(row.keys, np.uint64)
    out = []
    for g, a, b in deal.cuts(unpack(row.shards, np.uint16)):
        x, y = np.searchsorted(word, [a, b])
        if x < y:
            own, place = np.unique(word[x:y], return_inverse=True)
            out.append((g, 0, keys[own].tobytes(), pack(place.astype(np.int32)), pack(code[x:y].astype(np.int32)), pack(n[x:y].astype(np.int64))))
    trim()
    return pd.DataFrame(out, columns=["group", "part", "keys", "word", "code", "n"])


def seed_profiles(made: DataFrame, seeds: np.ndarray, own: np.ndarray, width: int, deal: Deal) -> DataFrame:
    """Profiles where only the seeds, the end and all others have a class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                yield profile_rows(row, own[units_of(np.frombuffer(row.keys, np.uint64), seeds)], width, deal)

    rows = made.select("block", "sizes", "tokens", "keys", "shards", "held").mapInPandas(run, PROFILE)
    return rows


def with_profiles(rows: DataFrame, model: DataFrame, width: int, deal: Deal) -> DataFrame:
    """Sums of profiles by word, beside the model: rows (group, keys, counts, classes, word, code, n,
    cells, cell_counts). Cells are the class bigrams, and after them the classes' numbers of words."""

    def add(batch: pd.DataFrame, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, counts = [], []
        for r in batch.itertuples():
            at = np.searchsorted(keys, np.frombuffer(r.keys, np.uint64))
            found.append(at[unpack(r.word, np.int32)] * np.int64(2 * width) + unpack(r.code, np.int32))
            counts.append(unpack(r.n, np.int64))
        return summed(found, counts, 2 * width)

    def part_of(batch: pd.DataFrame) -> pd.DataFrame:
        trim()
        keys = np.unique(np.concatenate([np.frombuffer(k, np.uint64) for k in batch["keys"]]))
        word, code, n = add(batch, keys)
        return pd.DataFrame({"group": batch["group"].iloc[:1], "part": 0, "keys": [keys.tobytes()], "word": [pack(word.astype(np.int32))], "code": [pack(code.astype(np.int32))], "n": [pack(n)]})

    def whole(batch: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        trim()
        own = held.iloc[0]
        keys, classes = np.frombuffer(own["keys"], np.uint64), unpack(own["classes"], np.int32)
        word, code, n = add(batch, keys)
        table = np.zeros(width * width + width, np.int64)
        after = code < width
        np.add.at(table, classes[word[after]].astype(np.int64) * width + code[after], n[after])
        table[width * width :] = np.bincount(classes, minlength=width)
        cells = np.flatnonzero(table)
        packed = [own["keys"], own["counts"], own["classes"], pack(word.astype(np.int32)), pack(code.astype(np.int32)), pack(n)]
        return pd.DataFrame([[own["of_group"], *packed, cells, table[cells]]], columns=["group", "keys", "counts", "classes", "word", "code", "n", "cells", "cell_counts"])

    if deal.parts > 1:
        part = F.pmod(F.xxhash64("keys"), F.lit(deal.parts)).cast("int")
        rows = rows.withColumn("part", part).groupBy("group", "part").applyInPandas(part_of, PROFILE)
    held = model.select(F.col("group").alias("of_group"), "keys", "counts", "classes")
    schema = "group int, keys binary, counts binary, classes binary, word binary, code binary, n binary, cells array<long>, cell_counts array<long>"
    return stored(rows.groupBy("group").cogroup(held.groupBy("of_group")).applyInPandas(whole, schema), "brown-profiles")


def class_table(profiled: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Class bigrams and numbers of words: at most width * (width + 1) sums."""
    got = profiled.select(F.explode(F.arrays_zip("cells", "cell_counts")).alias("x")).groupBy("x.cells").agg(F.sum("x.cell_counts").alias("n")).toPandas()
    out = np.zeros(width * width + width, np.int64)
    out[got["cells"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out[: width * width].reshape(width, width), out[width * width :]


def preferences(grams: np.ndarray, classes: int) -> np.ndarray:
    """What a word gains in each class by one more neighbour: a row for each code of a profile."""
    smooth = np.log(grams + EPS)
    rows, columns = np.log((grams + EPS).sum(1)), np.log((grams + EPS).sum(0))
    return np.concatenate([smooth[:classes].T - rows[:classes], smooth[:, :classes] - columns[:classes]]).astype(np.float32)


def choose(profiled: DataFrame, gains: np.ndarray) -> DataFrame:
    """The model (group, keys, counts, classes) where every word has the class it gains most in."""
    classes = gains.shape[1]
    shared = profiled.sparkSession.sparkContext.broadcast(gains)  # classes times twice as many codes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                keys, word, code, n = np.frombuffer(row.keys, np.uint64), unpack(row.word, np.int32), unpack(row.code, np.int32), unpack(row.n, np.int64).astype(np.float32)
                best = np.zeros(len(keys), np.int32)
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, int)
                sizes = np.diff(np.r_[first, len(word)])
                for a, b in blocks(sizes, max(1, 3_000_000 // classes)):
                    x, y = first[a], first[b - 1] + sizes[b - 1]
                    scores = np.add.reduceat(shared.value[code[x:y]] * n[x:y, None], first[a:b] - x, axis=0)
                    best[word[first[a:b]]] = scores.argmax(1)
                best[keys == END] = classes
                trim()
                yield pd.DataFrame({"group": [row.group], "keys": [row.keys], "counts": [row.counts], "classes": [pack(best)]})

    made = profiled.select("group", "keys", "counts", "word", "code", "n").mapInPandas(run, "group int, keys binary, counts binary, classes binary")
    return stored(made, "brown-classes")


def answers(asks: DataFrame, model: DataFrame, deal: Deal) -> DataFrame:
    """Rows (of_block, group, c, classes): training counts and classes (-1: none) of all words of blocks."""

    def answer(key: tuple, questions: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        keys = np.frombuffer(held["keys"].iloc[0], np.uint64) if len(held) else np.zeros(0, np.uint64)
        if len(keys):
            counts, classes = unpack(held["counts"].iloc[0], np.int64), unpack(held["classes"].iloc[0], np.int32)
        for r in questions.itertuples():
            wanted = np.frombuffer(r.keys, np.uint64)
            c, own = np.zeros(len(wanted), np.int64), np.full(len(wanted), -1, np.int32)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                known = keys[at] == wanted
                c[known], own[known] = counts[at[known]], classes[at[known]]
            out.append((r.block, r.group, pack(c), pack(own)))
        trim()
        return pd.DataFrame(out, columns=["of_block", "group", "c", "classes"])

    held = model.select(F.col("group").alias("of_group"), "keys", "counts", "classes", F.explode(F.sequence(F.lit(0), F.lit(deal.parts - 1))).alias("of_part"))
    questions = asks.select("block", "group", "part", "keys")
    found = questions.groupBy("group", "part").cogroup(held.groupBy("of_group", "of_part")).applyInPandas(answer, "of_block string, group int, c binary, classes binary")
    return stored(found, "brown-answers")


def in_order(right: pd.DataFrame, column: str, kind) -> np.ndarray:
    """An answer for each of a block's words."""
    return np.concatenate([unpack(x, kind) for x in right.sort_values("group")[column]])


def all_profiles(made: DataFrame, answered: DataFrame, width: int, deal: Deal) -> DataFrame:
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [profile_rows(row, in_order(right, "classes", np.int32), width, deal) for row in left.itertuples()]
        return pd.concat(out) if out else pd.DataFrame(columns=["group", "part", "keys", "word", "code", "n"])

    texts = made.select("block", "sizes", "tokens", "keys", "shards", "held")
    return texts.groupBy("block").cogroup(answered.select("of_block", "group", "classes").groupBy("of_block")).applyInPandas(run, PROFILE)


@dataclass
class Model:
    """What scoring needs: logs of transitions (a row for each class, the end and an unknown word;
    a column for each class and the end), of an unknown word after each, and of one word in each class."""

    moves: np.ndarray
    unknown: np.ndarray
    one_of: np.ndarray
    total: int
    distinct: int


def model_of(grams: np.ndarray, kinds: np.ndarray, total: int, distinct: int) -> Model:
    """``grams`` and ``kinds`` of all classes, the end last."""
    n = len(grams)
    alone = (grams.sum(0) + 1) / (grams.sum() + n)
    moves = np.vstack([(grams + BACKOFF * alone) / (grams.sum(1, keepdims=True) + BACKOFF), alone])
    mass, kinds = grams.sum(0).astype(np.float64), kinds.astype(np.float64)
    rest = np.where(mass > 0, kinds / np.maximum(mass + kinds, 1), 1.0)
    rest[-1] = 0.0  # the end is one token and none is like it
    one_of = -np.log10(np.maximum(mass + kinds, 1))
    one_of[-1] = -np.log10(max(mass[-1], 1))
    return Model(np.log10(moves), np.log10(np.maximum(moves @ rest, 1e-300)), one_of, total, distinct)


def fit(made: DataFrame, asks: DataFrame, deal: Deal) -> tuple[Model, DataFrame]:
    """The model, and each block's words with their training counts and classes."""
    words = stored(word_counts(asks, deal), "brown-counts")
    sums = words.select("keys", "counts").mapInPandas(lambda bs: (pd.DataFrame({"n": [int(unpack(r.counts, np.int64).sum())], "v": [len(r.keys) // 8]}) for b in bs for r in b.itertuples()), "n long, v long")
    total, distinct = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    classes = classes_for(distinct)
    width = classes + 2  # the end, and before all words have classes, the others
    top = words.select(F.explode(F.arrays_zip("top", "top_counts")).alias("x")).select("x.*").orderBy(F.desc("top_counts"), "top").limit(SEEDS + 1).collect()
    seeds = np.sort(np.array([r["top"] for r in top], np.int64).view(np.uint64))
    seeds = seeds[seeds != END]
    own = exchange(unit_bigrams(made, seeds), classes)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own_classes = [pack(own[units_of(np.frombuffer(k, np.uint64), seeds)].astype(np.int32)) for k in batch["keys"]]
            yield pd.DataFrame({"group": batch["group"], "keys": batch["keys"], "counts": batch["counts"], "classes": own_classes})

    start = words.select("group", "keys", "counts").mapInPandas(first, "group int, keys binary, counts binary, classes binary")
    profiled = with_profiles(seed_profiles(made, seeds, own, width, deal), start, width, deal)
    best, kept = None, None
    while True:
        model = choose(profiled, preferences(class_table(profiled, width)[0], classes))
        answered = answers(asks, model, deal)
        discard(profiled)
        profiled = with_profiles(all_profiles(made, answered, width, deal), model, width, deal)
        grams, kinds = class_table(profiled, width)
        now = likelihood(grams)
        discard(model)
        ended = best is not None and now < best + GAIN
        if best is None or now > best:
            if kept is not None:
                discard(kept[1])
            best, kept = now, (model_of(grams[:-1, :-1], kinds[:-1], total, distinct), answered)
        else:
            discard(answered)
        if ended:
            discard(profiled, words)
            return kept


def score(docs: DataFrame, held: str = "__held", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row; learns from those whose boolean column ``held`` is false.

    Columns: the id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(held), F.lit(False)).alias("held"))
    made, name = bucketed(to_blocks(rows), "block", "brown_blocks")
    pairs = made.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    groups = min(SHARDS, -(-pairs // PAIRS) or 1)
    deal = Deal(groups, -(-pairs // (groups * PAIRS)) or 1)
    model, answered = fit(made, asked(made, deal), deal)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    columns = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def judge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, own = [], shared.value
        end, unknown = len(own.one_of) - 1, len(own.one_of)
        for row in left.itertuples():
            lengths, tokens = unpack(row.sizes, np.int32).astype(np.int64), unpack(row.tokens, np.int32)
            c, classes = in_order(right, "c", np.int64), in_order(right, "classes", np.int32)
            base = np.log10((c + 1) / (own.total + own.distinct + 1))
            is_end = np.frombuffer(row.keys, np.uint64) == END
            state = np.where(is_end, end, np.where(c > 0, classes, unknown))
            emission = np.where(is_end | (c == 0), 0.0, np.log10(np.maximum(c, 1)) + np.r_[own.one_of, 0.0][state])
            ends, held = np.r_[0, np.cumsum(lengths)], np.asarray(row.held, bool)
            step = np.c_[own.moves, own.unknown]
            for a, b in blocks(lengths, CHUNK):
                mine = tokens[ends[a] : ends[b]]
                now = state[mine]
                before = np.r_[end, now[:-1]]  # a text starts after an end
                add = lambda x, at=ends[a:b] - ends[a]: np.add.reduceat(x, at)  # noqa: E731  every text has its end token
                out.append(pd.DataFrame({
                    "id": list(row.ids)[a:b], "held_out": held[a:b], "n_tokens": lengths[a:b], "n_known": add((c > 0)[mine].astype(np.int64)), "train_tokens": own.total,
                    "base_score": add(base[mine]), "score": add(emission[mine] + step[before, now]),
                }))
        trim()
        return pd.concat(out) if out else pd.DataFrame({k: [] for k in columns})

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts = made.select("block", "ids", "held", "sizes", "tokens", "keys")
    joined = stored(texts.groupBy("block").cogroup(answered.groupBy("of_block")).applyInPandas(judge, schema), "brown-scores")
    unbucketed(made, name)
    discard(answered)
    return joined.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: scores of all documents, learned from those with crc32(doc_id) mod 7 other than 2."""
    docs = table(spark, sf_dir, "documents").withColumn("__held", crc_mod("doc_id", 7) == 2)
    return score(docs)
