"""BPE encoding and decoding with a pair occurrence index (operator 10).

A task cuts its texts into words, keeps each distinct word once and lays the symbols of all of
them into one array. An index maps every mergeable pair (by its rank) to all its positions. The
lowest active rank is taken, all its positions are merged at once, and the lists of the pairs to
the left and right of each merge are extended; positions that a merge made stale are recognised
when their list comes up. A rank is processed once for the whole partition, not once per word.

Null texts count as empty and give no tokens; repeated rows give repeated results; an empty table
gives an empty result. Only the two named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from pagemill.llm.common import table

#: Characters of text that a task holds as words at a time.
BLOCK_CHARS = 16_000_000
#: Distinct words beyond which a worker forgets, before its next block, those it has met.
KEPT_WORDS = 500_000

# The vocabulary file's own word pattern and white space (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0  -     　"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, others from U+0100."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    odd = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(odd)) for b in range(256)]


def newer_letters() -> list[str]:
    """Letters and digits of the newest Unicode that the interpreter's tables don't have."""
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    return [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]


def word_pattern(newer: list[str]) -> str:
    """Endings, runs of letters, single digits and runs of anything else but white space.

    What is a letter or digit depends on the version of Unicode; of those that are newer than the
    interpreter's tables, the ones that the tokenizers library doesn't know count as anything else.
    """
    theirs = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True).pre_tokenize_str("".join(newer))
    known = {c for piece, _ in theirs for c in piece}
    newer = [ord(c) for c in newer if c not in known]
    runs = [[g[0][1], g[-1][1]] for _, k in itertools.groupby(enumerate(newer), lambda x: x[1] - x[0]) if (g := list(k))]
    odd = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) or "\\uFFFF"
    return rf"(?V1){ENDINGS}|[\p{{L}}--[{odd}]]+|[\p{{N}}--[{odd}]]|[[^{SPACE}\p{{L}}\p{{N}}]||[{odd}]]+"


class WordBpe:
    """A word-level BPE vocabulary with word ends, from the text of a tokenizer's JSON file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.end] for c in letters], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.left, self.right = left, right
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))))
        newer = newer_letters()
        self.words = regex.compile(word_pattern(newer))
        theirs = normalizers.Lowercase()
        self.lower = {ord(c): low for c in newer if (low := theirs.normalize_str(c)) != c}
        self.odd_case = re.compile(f"[{''.join(map(chr, self.lower)) or chr(0x10FFFF)}]")
        # The same pattern for texts below U+0250 only, where letters and digits can be listed.
        low = [chr(c) for c in range(0x250)]
        letters = "".join(re.escape(c) for c in low if unicodedata.category(c)[0] == "L")
        digits = "".join(c for c in low if unicodedata.category(c)[0] == "N")
        self.low_words = re.compile(rf"{ENDINGS}|[{letters}]+|[{digits}]|[^{SPACE}{letters}{digits}]+")
        self.high = re.compile("[^\0-\u024f]")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where they never merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def normal(self, text: str) -> str:
        """NFC, then lower case letter by letter (a final sigma isn't special)."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        if self.odd_case.search(text):
            text = text.translate(self.lower)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def cut(self, text: str) -> list[str | tuple[str]]:
        """The words of a text; a special token is a tuple of one string."""
        if "<|" not in text:
            return self.plain(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += self.plain(text[at : m.start()])
            out.append((m[0],))
            at = m.end()
        return out + self.plain(text[at:])

    def plain(self, text: str) -> list[str]:
        text = self.normal(text)
        return (self.words if self.high.search(text) else self.low_words).findall(text)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after another, and the n + 1 offsets between the words."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        full = np.flatnonzero(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = np.full(len(data) + len(raw) + 1, -1, np.int64)  # a wall before, between and after words
        word_of = np.repeat(np.arange(len(raw)), sizes)
        at = np.arange(len(data)) + word_of + 1
        symbols[at] = self.inner[data]
        symbols[ends[full] + full] = self.last[data[ends[full] - 1]]
        nxt = np.arange(1, len(symbols) + 1)
        prv = np.arange(-1, len(symbols) - 1)
        nxt[-1] = len(symbols) - 1
        prv[0] = 0
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            ranks = self.rank(symbols[positions], symbols[nxt[positions]])
            keep = ranks >= 0
            ranks, positions = ranks[keep], positions[keep]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, p in zip(ranks[np.r_[0, cuts]].tolist(), np.split(positions, cuts), strict=True):
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(active, r)

        note(at)  # each call gets positions in ascending order, none twice
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            p = lists[0]
            if len(lists) > 1:
                p = np.sort(np.concatenate(lists))
                p = p[np.r_[True, p[1:] != p[:-1]]]
            a, b = self.left[r], self.right[r]
            p = p[(symbols[p] == a) & (symbols[nxt[p]] == b)]
            if a == b and len(p) > 1:  # of a run of equal symbols, every other one from its start
                fresh = np.r_[True, nxt[p[:-1]] != p[1:]]
                run = np.arange(len(p)) - np.maximum.accumulate(np.where(fresh, np.arange(len(p)), 0))
                p = p[run % 2 == 0]
            if not len(p):
                continue
            gone = nxt[p]
            symbols[p] = self.made[r]
            symbols[gone] = -2
            after = nxt[gone]
            nxt[p] = after
            prv[after] = p
            before = prv[p]
            note(before[symbols[before] >= 0])
            note(p)
        left = symbols[at] >= 0
        counts = np.bincount(word_of[left], minlength=len(raw))
        return symbols[at][left], np.r_[0, np.cumsum(counts)]

    def decode(self, ids: np.ndarray) -> str:
        """The file names no decoder, so tokens are joined by single spaces."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


class Places(dict):
    """Numbers words in the order in which they are met; ``new`` gathers those without ids yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str | tuple[str]] = []

    def __missing__(self, word):
        self[word] = at = len(self)
        self.new.append(word)
        return at


class Encoder:
    """Encodes the texts of a worker's tasks; remembers the ids of words it has met."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.forget()

    def forget(self) -> None:
        self.places = Places()
        self.ids, self.ends, self.said = np.zeros(0, np.int64), np.zeros(1, np.int64), []

    def learn(self) -> None:
        """Encode the words that are new, all of them at once."""
        words, self.places.new = self.places.new, []
        ids, ends = self.bpe.encode_words([w if isinstance(w, str) else "" for w in words])
        for k in [k for k, w in enumerate(words) if isinstance(w, tuple)]:
            ids = np.insert(ids, ends[k], self.bpe.specials[words[k][0]])
            ends[k + 1 :] += 1
        names = [*map(self.bpe.names.__getitem__, ids.tolist())]
        cuts = ends.tolist()
        self.said += [" ".join(names[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
        self.ends = np.r_[self.ends, self.ends[-1] + ends[1:]]
        self.ids = np.r_[self.ids, ids]

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids (unsigned 32-bit, little-endian) and decoded text of each text."""
        if len(self.places) > KEPT_WORDS:
            self.forget()
        places = self.places
        at = [[places[w] for w in self.bpe.cut(t)] for t in texts]
        self.learn()
        said = self.said
        words = np.fromiter(itertools.chain.from_iterable(at), np.int64, sum(map(len, at)))
        sizes = np.diff(self.ends)[words]
        ends = np.r_[0, np.cumsum(sizes)]
        ids = self.ids[np.repeat(self.ends[words] - ends[:-1], sizes) + np.arange(ends[-1])].astype("<u4")
        first = 0
        for own in at:
            last = first + len(own)
            yield ids[ends[first] : ends[last]], " ".join([said[i] for i in own])
            first = last


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """Token ids (if ``ids``), their number, and digests of ids and decoded text, for each row.

    Columns: the id column, n_tokens, ids (array<int>), ids_sha256, decoded_sha256.
    """
    spark = docs.sparkSession
    with open(vocab_path, encoding="utf-8") as f:  # 2 MB, so executors need no such file
        shared = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(docs.select(id_col).dtypes)[id_col]
    schema = f"id {kind}, n_tokens long, {'ids array<int>, ' * ids}ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            start, held = 0, 0
            for i, t in enumerate([*texts, None]):
                if i > start and (i == len(texts) or held + len(t or "") > BLOCK_CHARS):
                    yield one(encoder, batch.column(0).slice(start, i - start), [t or "" for t in texts[start:i]])
                    start, held = i, 0
                held += len(t or "")

    def one(encoder: Encoder, keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
        n, all_ids, a, b = [], [], [], []
        for found, said in encoder.texts(texts):
            n.append(len(found))
            a.append(hashlib.sha256(found.tobytes()).hexdigest())
            b.append(hashlib.sha256(said.encode("utf-8")).hexdigest())
            if ids:
                all_ids.append(found.astype(np.int32))
        columns = [keys, pa.array(n, pa.int64()), *([pa.array(all_ids, pa.list_(pa.int32()))] * ids), pa.array(a, pa.string()), pa.array(b, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", *["ids"] * ids, "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


_made: dict[str, Encoder] = {}


def encoder_of(spec: str) -> Encoder:
    """The encoder of a vocabulary, built once in each Python worker."""
    key = hashlib.sha256(spec.encode("utf-8")).hexdigest()
    if key not in _made:
        _made.clear()
        _made[key] = Encoder(WordBpe(spec))
    return _made[key]


def query(spark: SparkSession, sf_dir: str, vocab_path: str | None = None) -> DataFrame:
    """op10: digests of the encoding and decoding of every whole text of documents."""
    if vocab_path is None:
        import public_tokenizers

        vocab_path = public_tokenizers.path("word_bpe_49k.json")
    return encode(table(spark, sf_dir, "documents"), vocab_path, ids=False)
