"""Alignment of two tokenizers by id-striped dense count matrices (operator 11).

Side A is a byte-level BPE vocabulary, side B one of pieces with byte fallback. Both cut the same
bytes, so the ends of their tokens mark a text's bytes; between two marks lies one token of each
side, and these two are a link. Where both end together, a group ends.

1. Tasks encode their texts in blocks, keep the ids in a table bucketed by block, and name for each
   stripe the pairs (A id, B id) that occur in the block, with the number of documents that hold
   each. Ids of A are dealt to the stripes in turn, so frequent ids lie in many of them.
2. A stripe is a dense matrix, its A ids by all B ids. ``np.add.at`` adds the blocks' numbers, for
   ``TOGETHER`` blocks at a time, then the sums of as many, until one matrix is left: no task's
   memory grows with the input. The maxima of its rows are the best counts of the A ids.
3. A stripe answers the blocks, as many together, with the count of each of their pairs and whether
   it is the best of its A id. Answers are brought to the blocks' tables, which don't move, and
   every document's links are scored there.

Texts that are null or empty, or that side B doesn't give back byte for byte (as side B's own
sign for a space isn't), have no tokens: all their figures are zero and the digest is the empty
string. Special tokens' strings are plain text. Ids may be null or repeat: every row has its
own result and counts as a document. A very long text is a block of its own. An empty table gives
an empty result. Only the two named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagemill.llm.bpe import byte_letters
from pagemill.llm.common import blocks, bucketed, discard, gathered, stored, table, trim, unbucketed

#: Bytes of text of a block (at least, but for a task's last one; twice as many at most).
BLOCK_BYTES = 2_000_000
#: Ids of A in a stripe.
IDS = 128
#: Blocks whose pairs are added up or answered together.
TOGETHER = 256

# Fixed value: how the byte-level vocabulary cuts texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"


class Sides:
    """Both vocabularies: how they encode, and the bytes of each id."""

    def __init__(self, byte_level: str, pieces: bytes):
        spec = json.loads(byte_level)
        letters = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = max(ranks.values()) + 1, len(self.bytes_b)
        self.lengths_a = np.zeros(self.size_a, np.int64)
        for t, i in ranks.items():
            self.lengths_a[i] = len(t)
        self.lengths_b = np.array([*map(len, self.bytes_b)], np.int64)
        self.stripes = -(-self.size_a // IDS)
        said = [f"{i}{end}" for size, ends in ((self.size_a, ",|"), (self.size_b, ",;")) for end in ends for i in range(size)]
        self.widths = np.array([*map(len, said)], np.int64)
        self.said = np.array(said, f"S{self.widths.max()}").view(np.uint8).reshape(len(said), -1)

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides; none where the text isn't given back."""
        if not text:
            return [], []
        spaced = " " + text
        b = self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != spaced.encode("utf-8"):
            return [], []
        return self.a.encode_ordinary(spaced), b  # side A always gives back the bytes

    def codes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of pairs, in the order of their stripes and of their places there."""
        return (a % self.stripes * IDS + a // self.stripes) * self.size_b + b


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode("utf-8")


class Block:
    """The tokens of a block's texts, one after another, and how they lie side by side."""

    def __init__(self, sides: Sides, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.sides, self.a, self.b, self.n_a, self.n_b = sides, a.astype(np.int64), b.astype(np.int64), n_a, n_b
        ends_a, ends_b = np.cumsum(sides.lengths_a[self.a]), np.cumsum(sides.lengths_b[self.b])
        mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] |= 2
        self.ends_a, self.ends_b = mark[ends_a] == 3, mark[ends_b] == 3  # tokens that end a group
        found = mark[mark > 0]
        self.at_a, self.at_b = (np.cumsum(x, dtype=np.int64) - x for x in (found & 1, found >> 1))  # tokens of each link
        text_of_a = np.repeat(np.arange(len(n_a)), n_a)
        self.text = text_of_a[self.at_a]
        self.n_links = np.bincount(self.text, minlength=len(n_a))
        self.n_groups = np.bincount(text_of_a[self.ends_a], minlength=len(n_a))

    def links(self) -> np.ndarray:
        return self.sides.codes(self.a[self.at_a], self.b[self.at_b])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The different pairs, in order, and how many of the texts have each."""
        keys = np.sort(self.text << 32 | self.links())
        keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
        return np.unique(keys & 0xFFFFFFFF, return_counts=True)

    def digests(self) -> list[str]:
        """For each text the digest of its groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        start_b = np.r_[0, np.flatnonzero(self.ends_b) + 1]  # of each group
        end_a = np.flatnonzero(self.ends_a) + 1
        group_a, group_b = (np.cumsum(x) - x for x in (self.ends_a, self.ends_b))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + start_b[group_a]] = self.a + self.ends_a * self.sides.size_a
        codes[np.arange(len(self.b)) + end_a[group_b]] = 2 * self.sides.size_a + self.b + self.ends_b * self.sides.size_b
        said = self.sides.said[codes].ravel()
        data = memoryview(said[said > 0].tobytes())
        ends = np.r_[0, np.cumsum(self.sides.widths[codes])]
        cuts = ends[np.r_[0, np.cumsum(self.n_a + self.n_b)]].tolist()
        return [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(cuts, cuts[1:], strict=False)]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sums over each text's links of a value for each link."""
        return np.diff(np.r_[0, np.cumsum(values)][np.r_[0, np.cumsum(self.n_links)]])


_made: dict[str, Sides] = {}


def sides_of(byte_level: str, pieces: bytes) -> Sides:
    """Both vocabularies, built once in each Python worker."""
    key = hashlib.sha256(byte_level.encode("utf-8") + pieces).hexdigest()
    if key not in _made:
        _made.clear()
        _made[key] = Sides(byte_level, pieces)
    return _made[key]


class Alignment:
    """The tables of an alignment: encoded blocks, their questions, and the count of every pair."""

    def __init__(self, docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text"):
        spark = docs.sparkSession
        with open(byte_level_path, encoding="utf-8") as f, open(pieces_path, "rb") as g:  # under 3 MB, so executors need no files
            self.shared = spark.sparkContext.broadcast((f.read(), g.read()))
        self.sides = sides_of(*self.shared.value)
        self.id_col, self.kind = id_col, docs.select(id_col).schema[0].dataType
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        self.made, self.name = bucketed(self.encoded(rows), "block", "alignment_blocks")
        n = self.made.where("ids is not null").count()
        self.parts = -(-n // TOGETHER) or 1
        self.asked = self.made.where("pairs is not null").select("block", "stripe", "pairs", "counts", F.pmod(F.xxhash64("block"), F.lit(self.parts)).alias("part"))
        self.counts = stored(self.added(), "alignment-counts")

    def encoded(self, rows: DataFrame) -> DataFrame:
        """A row with the ids of each block and one with the pairs of each of its stripes."""
        shared, kind = self.shared, to_arrow_type(self.kind)
        names = ["block", "ids", "n_a", "n_b", "a", "b", "stripe", "pairs", "counts"]
        types = [pa.int64(), pa.list_(kind), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

        def batch_of(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sides = sides_of(*shared.value)
            block = TaskContext.get().partitionId() << 32
            for batch in gathered(batches, 1, BLOCK_BYTES):
                sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
                for start, end in blocks(sizes, 2 * BLOCK_BYTES):
                    a, b, n = [], [], []
                    for text in batch.column(1).slice(start, end - start):
                        x, y = sides.encode(text.as_py())
                        a.append(np.array(x, np.uint32))
                        b.append(np.array(y, np.uint32))
                        n.append((len(x), len(y)))
                    a, b, n = np.concatenate(a), np.concatenate(b), np.array(n, np.int64)
                    one = Block(sides, a, b, n[:, 0], n[:, 1])
                    packed = {k: [narrow(v, size).tobytes()] for k, v, size in (("a", a, sides.size_a), ("b", b, sides.size_b))}
                    ids = pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), batch.column(0).slice(start, end - start).cast(kind))
                    yield batch_of(block=[block], ids=ids, n_a=[n[:, 0].tobytes()], n_b=[n[:, 1].tobytes()], **packed)
                    pairs, counts = one.pairs()
                    stripe, place = np.divmod(pairs, IDS * sides.size_b)
                    starts = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1]]) if len(pairs) else np.zeros(0, np.int64)
                    cuts = [*zip(starts.tolist(), [*starts[1:].tolist(), len(pairs)], strict=False)]
                    if cuts:
                        yield batch_of(block=[block] * len(cuts), stripe=stripe[starts], pairs=[place[s:e].astype(np.int32).tobytes() for s, e in cuts], counts=[counts[s:e].tobytes() for s, e in cuts])
                    block += 1
                    del one, a, b
                    trim()

        return rows.mapInArrow(run, f"block long, ids array<{self.kind.simpleString()}>, n_a binary, n_b binary, a binary, b binary, stripe long, pairs binary, counts binary")

    def added(self) -> DataFrame:
        """For each stripe its pairs, their counts and the highest count of each of its A ids."""
        size_b = self.sides.size_b

        def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            matrix = np.zeros(IDS * size_b, np.int64)
            for pairs, counts in zip(rows["pairs"], rows["counts"], strict=True):
                np.add.at(matrix, np.frombuffer(pairs, np.int32), np.frombuffer(counts, np.int64))
            at = np.flatnonzero(matrix)
            best = matrix.reshape(IDS, size_b).max(axis=1)
            trim()
            return pd.DataFrame({"stripe": [key[0]], "part": [key[1]], "pairs": [at.astype(np.int32).tobytes()], "counts": [matrix[at].tobytes()], "best": [best.tobytes()]})

        rows, parts = self.asked.select("stripe", "part", "pairs", "counts"), self.parts
        while True:
            rows = rows.groupBy("stripe", "part").applyInPandas(add, "stripe long, part long, pairs binary, counts binary, best binary")
            if parts == 1:
                return rows.select("stripe", "pairs", "counts", "best")
            parts = -(-parts // TOGETHER)
            rows = rows.select("stripe", F.pmod("part", F.lit(parts)).alias("part"), "pairs", "counts")

    def pairs(self) -> DataFrame:
        """Rows (a, b, n_docs, best) of every pair that is linked somewhere: side B's tokens for each token of side A."""
        size_b, stripes = self.sides.size_b, self.sides.stripes

        def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    place, b = np.divmod(np.frombuffer(row.pairs, np.int32).astype(np.int64), size_b)
                    n = np.frombuffer(row.counts, np.int64)
                    yield pd.DataFrame({"a": place * stripes + row.stripe, "b": b, "n_docs": n, "best": n == np.frombuffer(row.best, np.int64)[place]})

        return self.counts.mapInPandas(spread, "a long, b long, n_docs long, best boolean")

    def documents(self) -> DataFrame:
        """One row for each document: its tokens, groups and links, and how the corpus counts its links."""
        size_b, shared, kind = self.sides.size_b, self.shared, to_arrow_type(self.kind)

        def answer(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            pairs, counts, best = (np.frombuffer(held[c].iloc[0], k) for c, k in (("pairs", np.int32), ("counts", np.int64), ("best", np.int64)))
            scores = counts << 1 | (counts == best[pairs // size_b])
            found = [scores[np.searchsorted(pairs, np.frombuffer(p, np.int32))].tobytes() for p in asked["pairs"]]
            trim()
            return pd.DataFrame({"of_block": asked["block"], "stripe": asked["stripe"], "scores": found}, columns=["of_block", "stripe", "scores"])

        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.parts - 1).cast("long"))).alias("of_part")
        held = self.counts.select(F.col("stripe").alias("of_stripe"), "pairs", "counts", "best", every)
        asked = self.asked.select("block", "stripe", "pairs", "part")
        answers = asked.groupBy("stripe", "part").cogroup(held.groupBy("of_stripe", "of_part")).applyInPandas(answer, "of_block long, stripe long, scores binary")
        figures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

        def settle(left: pa.Table, right: pa.Table) -> pa.Table:
            right = right.sort_by("stripe")
            scores = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in right.column("scores").to_pylist())])
            sides, row = sides_of(*shared.value), {c: left.column(c)[0].as_py() for c in ("n_a", "n_b", "a", "b")}
            a, b = np.frombuffer(row["a"], narrow_type(sides.size_a)), np.frombuffer(row["b"], narrow_type(sides.size_b))
            block = Block(sides, a, b, np.frombuffer(row["n_a"], np.int64), np.frombuffer(row["n_b"], np.int64))
            links = block.links()
            distinct, place = np.unique(links, return_inverse=True)
            of_link = scores[place]
            ids = left.column("ids").combine_chunks().flatten().cast(kind)
            counted = [block.n_a, block.n_b, block.n_groups, block.n_links, block.sums(of_link & 1), block.sums(of_link >> 1)]
            out = pa.table([ids, *(pa.array(x, pa.int64()) for x in counted), pa.array(block.digests(), pa.string())], ["id", *figures, "groups_sha256"])
            trim()
            return out

        texts = self.made.where("ids is not null").select("block", "ids", "n_a", "n_b", "a", "b")
        schema = f"id {self.kind.simpleString()}, {', '.join(f'{c} long' for c in figures)}, groups_sha256 string"
        return texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(settle, schema).withColumnRenamed("id", self.id_col)

    def discard(self) -> None:
        """Remove the tables; nothing that is still to be read may depend on them."""
        unbucketed(self.made, self.name)
        discard(self.counts)


def narrow_type(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


def narrow(ids: np.ndarray, size: int) -> np.ndarray:
    return ids.astype(narrow_type(size))


def align(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment's figures of every document, written once; the tables behind them are removed."""
    found = Alignment(docs, byte_level_path, pieces_path, id_col, text_col)
    out = stored(found.documents(), "alignment-documents")
    found.discard()
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: both tokenizers' tokens of every whole text of documents, side by side."""
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
