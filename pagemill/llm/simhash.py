"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 13).

A text's words are lower-cased in A-Z; each bit of its fingerprint is 1 if it is set in over half
of the hashes of its three-word shingles, repeats included. Texts link if their fingerprints
differ in at most three bits; a class is a connected component of links.

Half of three bits isn't whole, so two fingerprints meet in the middle at one flip from the one
and two from the other. Every fingerprint emits all its variants within one flip. Fingerprints
that differ in one or three bits have different parities, so only even ones emit variants of two
flips as well; and as of three bits two lie in the same half of the 64, only pairs of flips within
a half are needed. So with at most three differing bits there is a variant that both emit, with at
most one flip from at least one of them:

* none or one: one of both itself; two: the first with one of them flipped;
* three: the even one with two that lie in the same half flipped, the odd one with the third.

Whatever meets a fingerprint that is one flip from a variant differs from it in three bits at
most. So each variant gives one link for each of its fingerprints, to the smallest that is within
one flip of it: no links beyond the number of variants, and none is missing between components.

Equal fingerprints are one before they emit. Variants go to as many shards as their number asks
for, by a hash of the variant: copies and near copies don't meet in one task.

Null and empty texts have no words and the fingerprint zero, linked like any other; one or two
words are one shingle. Rows of a null id are linked but name no class; a class of such rows only
has a null name. Rows that repeat an id have a fingerprint each, and each its own class (the same
where their texts are alike). Very long texts are hashed whole. An empty table gives an empty
result; only the two named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from pagemill.llm.common import discard, mix, stored, table, trim
from pagemill.llm.links import components

WORDS, SEED, RADIUS, BITS = 3, 42, 3, 64
#: Fingerprints that a task expands at a time, and variants of a shard in the mean.
FINGERPRINTS, VARIANTS = 4096, 2_000_000
#: Hashes whose bits are counted at a time.
HASHES = 1 << 16

ONE = np.uint64(1)
#: The flips within one bit, and those of two bits of a half of 32.
NEAR = np.array([0, *(1 << k for k in range(BITS))], np.uint64)
FAR = np.array([1 << i | 1 << j for half in (range(32), range(32, BITS)) for i, j in combinations(half, 2)], np.uint64)
FLIPS = np.r_[NEAR, FAR]
#: Variants of a fingerprint in the mean: only even ones emit the far ones.
MEAN = len(NEAR) + len(FAR) / 2


def hashes(text: str) -> np.ndarray:
    """XXH64 of a text's shingles of three words, or of all its words if they are fewer."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(len(words) - WORDS + 1, 1)
    at = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    return np.fromiter(map(xxh64_intdigest, (joined[a:b] for a, b in at), repeat(SEED)), np.uint64, n)


def fingerprint(found: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(found), HASHES):
        some = found[k : k + HASHES].astype(">u8").view(np.uint8).reshape(-1, BITS // 8)
        counts += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(found)).tobytes(), "big")


def fingerprints(rows: DataFrame) -> DataFrame:
    """Rows (id, text) as (id, fp): the fingerprint as a signed number."""
    kind = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(hashes(t or "")) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(to_arrow_type(kind)), pa.array(found.view(np.int64))], ["id", "fp"])
            trim()

    return rows.mapInArrow(run, f"id {kind.simpleString()}, fp long")


def balls(fps: DataFrame, shards: int) -> DataFrame:
    """The variants of distinct fingerprints, rows (shard, variants, flips): places in FLIPS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(every), FINGERPRINTS):
                some = every[k : k + FINGERPRINTS]
                even = some[np.bitwise_count(some) % 2 == 0]
                variants = np.r_[(some[:, None] ^ NEAR).ravel(), (even[:, None] ^ FAR).ravel()]
                flips = np.r_[np.tile(np.arange(len(NEAR), dtype=np.uint16), len(some)), np.tile(np.arange(len(NEAR), len(FLIPS), dtype=np.uint16), len(even))]
                shard = (mix(variants, 71) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)
                order = np.argsort(shard, kind="stable")
                variants, flips, shard = variants[order], flips[order], shard[order]
                starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
                cuts = zip(starts.tolist(), [*starts[1:].tolist(), len(shard)], strict=True)
                blobs = [(variants[a:b].tobytes(), flips[a:b].tobytes()) for a, b in cuts]
                columns = [pa.array(shard[starts].astype(np.int64)), *(pa.array(x, pa.binary()) for x in zip(*blobs, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "variants", "flips"])
            trim()

    return fps.mapInArrow(run, "shard long, variants binary, flips binary")


def meetings(variants: np.ndarray, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different fingerprints that a variant links, each once."""
    order = np.argsort(variants)
    variants, flips = variants[order], flips[order]
    same = variants[1:] == variants[:-1]
    shared = np.r_[same, False] | np.r_[False, same]
    variants, flips = variants[shared], flips[shared]
    if not len(variants):
        return variants, variants
    fps, near = variants ^ FLIPS[flips], flips < len(NEAR)
    starts = np.flatnonzero(np.r_[True, variants[1:] != variants[:-1]])
    size = np.diff(np.r_[starts, len(variants)])
    pivot = np.repeat(np.minimum.reduceat(np.where(near, fps, np.uint64(2**64 - 1)), starts), size)
    met = np.repeat(np.logical_or.reduceat(near, starts), size) & (fps != pivot)
    met &= np.bitwise_count(fps ^ pivot) <= RADIUS
    pairs = np.unique(np.c_[pivot[met], fps[met]], axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(fps: DataFrame, n: int) -> DataFrame:
    """Links (a, b) of ``n`` distinct fingerprints, rows (fp), whose components are those of all pairs within RADIUS bits."""
    shards = max(1, round(n * MEAN / VARIANTS))

    def meet(batch: pd.DataFrame) -> pd.DataFrame:
        variants, flips = (np.concatenate([np.frombuffer(x, kind) for x in batch[c]]) for c, kind in (("variants", np.uint64), ("flips", np.uint16)))
        a, b = meetings(variants, flips)
        trim()
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = balls(fps.repartition(max(1, -(-n // FINGERPRINTS))), shards)
    return dealt.groupBy("shard").applyInPandas(meet, "a long, b long").distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fingerprint, component_id), one for each row of ``docs``."""
    rows = stored(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))), "simhash-rows")
    firsts = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-firsts")
    found = stored(links(firsts.select("fp"), firsts.count()), "simhash-links")
    comps = components(found)
    named = firsts.join(comps.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "first", F.coalesce("class", "fp").alias("class"))
    least = named.groupBy("class").agg(F.min("first").alias("component_id"))
    classes = stored(named.join(least, "class").select("fp", "component_id"), "simhash-classes")
    discard(firsts, found)
    return rows.join(classes, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: fingerprint and class of every document."""
    return near_classes(table(spark, sf_dir, "documents"))
