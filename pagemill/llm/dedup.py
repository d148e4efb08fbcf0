"""Near-duplicate detection by order MinHash (operator 4).

A text is a sequence of five-word shingles (words lower-cased in A-Z, ASCII punctuation left out),
each labelled by how often it occurred before, so that all labelled shingles of a text differ.
Each of ``TABLES`` random orders picks the ``PICKED`` smallest labelled shingles of a text and
keeps them in text order; texts with equal picks share a bucket. So a bucket needs both the
shingles and their order, and follows edit similarity and not only set overlap.

1. Exact copies collapse to their smallest id.
2. In each bucket every member is verified against the smallest one.
3. Where a bucket still holds several components, all pairs across components are verified, but
   for those that can't be similar, by a bound on the shingles that both can have (see ``across``).

Verification aligns the labelled shingles of both texts within a band: M matched in order of n and
m give the similarity M / (n + m - M). From ``SIMILARITY`` on two texts are linked; a class is a
connected component, named by its smallest id.

Null texts count as empty, and texts without a word are copies of each other only if they are
equal. A text of fewer than five words is one shingle. Rows with a null id take no part and have a
null class. Repeated rows are in the same class; an empty table gives an empty result; only the
two named columns are read. A very long text is hashed whole, alone in its task's memory.

Picks are drawn without repeats, so of u shingles that two texts have, m of them both, all picks of
a table are shared with probability C(m, PICKED) / C(u, PICKED): for long texts at exactly the least
similarity 0.8 ** PICKED, and a pair is missed with (1 - 0.8 ** PICKED) ** TABLES = 3e-6; for 4
shingles of 5 only 1/5. So texts of at most ``SHORT`` shingles have TABLES further buckets of
``FEW`` picks each (4 of 5: 3/5, missed with 3e-10). Where only one text is that short, or none,
missing a pair at exactly the least similarity has a probability below 1e-5.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagemill.llm.common import anti_or_semi, blocks, gathered, mix, stored, table, trim, utf8
from pagemill.llm.links import components, stars, verified

WORDS, SIMILARITY = 5, 0.8
TABLES, PICKED = 24, 4
#: Texts of at most so many shingles are also looked up by fewer picks.
SHORT, FEW = 24, 2
#: A shingle that at most so many documents have is rare.
RARE = 8
#: Labelled shingles that a task counts, in the mean.
SHINGLES = 500_000
#: Bytes of text that a task hashes at a time, twice as many at most (a longer text is hashed alone).
BLOCK_BYTES = 1_000_000

#: Of each byte: 0 left out (ASCII punctuation), 1 between words, 2 part of a word.
KINDS = np.full(256, 2, np.uint8)
KINDS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 0
KINDS[[9, 10, 11, 12, 13, 32]] = 1
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15 | 1
MULTIPLIERS = mix(np.arange(TABLES, dtype=np.int64), 41) | np.uint64(1)
PLACES = mix(np.arange(PICKED, dtype=np.int64), 43) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_powers: dict[int, np.ndarray] = {}


def power_table(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        _powers[base] = powers(base, max(n, BLOCK_BYTES + 1))
    return _powers[base]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after another, and the offsets of texts in them."""
    kinds = KINDS[data]
    used = np.flatnonzero(kinds)
    offsets = np.searchsorted(used, offsets)
    letters = kinds[used] == 2
    data = LOWER[data[used]]
    first = np.zeros(len(data) + 1, bool)  # of a text
    first[offsets] = True
    before = np.r_[False, letters[:-1]] & ~first[:-1]
    starts = np.flatnonzero(letters & ~before)
    after = np.r_[letters[1:], False] & ~first[1:]
    ends = np.flatnonzero(letters & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * power_table(BASE, len(data))[: len(data)], out=sums[1:])
    inverse = power_table(pow(BASE, -1, 2**64), len(data) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts]), np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts, one after another, and the offsets of texts in them."""
    hashes, at = word_hashes(data, offsets)
    sizes = np.diff(at)
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    bounds = np.r_[0, np.cumsum(counts)]
    text = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(bounds[-1]) - bounds[text] + at[text]
    end = at[1:][text]
    padded = np.r_[hashes, np.zeros(words, np.uint64)]
    found = np.zeros(len(place), np.uint64)
    for k in range(words):
        found = found * np.uint64(BASE) + np.where(place + k < end, padded[place + k], np.uint64(0))
    found = mix(found)
    key = found + mix(text, 47)
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    if not fresh.all():
        n = np.arange(len(key))
        nth = n - np.maximum.accumulate(np.where(fresh, n, 0))
        again = nth > 0
        found[order[again]] = mix(found[order[again]] + mix(nth[again], 53))
    return found, bounds


def sketches(found: np.ndarray, bounds: np.ndarray, picked: int = PICKED, salt: int = 59) -> np.ndarray:
    """A row of TABLES bucket keys for each text that has shingles; zeros for the others."""
    counts = np.diff(bounds)
    out = np.zeros((len(counts), TABLES), np.uint64)
    text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    wanted = np.minimum(counts, picked)
    # about 4 * picked shingles of a text lie below this bound
    share = np.minimum(1.0, 4.0 * picked / np.maximum(counts, 1))
    bound = np.where(share >= 1, np.uint64(0xFFFFFFFFFFFFFFFF), (share * 2.0**63).astype(np.uint64) * np.uint64(2))[text]
    for t in range(TABLES):
        value = found * MULTIPLIERS[t]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        below = value <= bound
        few = np.bincount(text[below], minlength=len(counts)) < wanted
        if few.any():
            below |= few[text]
        at = np.flatnonzero(below)
        at = at[np.lexsort((value[at], text[at]))]
        own = text[at]
        first = np.r_[True, own[1:] != own[:-1]] if len(own) else np.zeros(0, bool)
        n = np.arange(len(at))
        at = np.sort(at[n - np.maximum.accumulate(np.where(first, n, 0)) < picked])  # text order again
        own = text[at]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
        nth = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        if len(at):
            out[own[starts], t] = mix(np.add.reduceat(found[at] * PLACES[nth], starts), salt + t)
    return out


def buckets(found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket keys of all texts, one after another, and the offsets of texts in them."""
    counts = np.diff(bounds)
    short = counts <= SHORT
    more = sketches(found[np.repeat(short, counts)], np.r_[0, np.cumsum(counts[short])], FEW, 59 + TABLES)
    keys = np.zeros((len(counts), 2 * TABLES), np.uint64)
    keys[:, :TABLES], keys[short, TABLES:] = sketches(found, bounds), more
    used = np.repeat(np.c_[np.ones(len(counts), bool), short], TABLES, axis=1)
    return keys[used], np.r_[0, np.cumsum(np.where(short, 2 * TABLES, TABLES))]


def aligned(first: bytes, second: bytes, least: float = SIMILARITY) -> float:
    """Similarity of two sequences of labelled shingles by alignment within a band.

    n and m shingles of which M match in order: M / (n + m - M). Paths that leave the band of
    (n + m) * (1 - least) / (1 + least) diagonals have too many gaps to reach ``least``; a value
    below ``least`` is a lower bound only.
    """
    a, b = np.frombuffer(first, np.uint64), np.frombuffer(second, np.uint64)
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return float(total == 0)
    share = Fraction(least).limit_denominator(1_000_000)
    p, q = share.numerator, share.denominator
    needed = -(-total * p // (p + q))  # the fewest matches that are enough, in integers
    if min(len(a), len(b)) < needed:
        return 0.0
    band = total - 2 * needed
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    j = order[at]
    i = np.flatnonzero(b[j] == a)
    j = j[i]
    near = np.abs(i - j) <= band
    j = j[near]
    if len(j) < needed:
        return 0.0
    if (np.diff(j) < 0).any():  # longest increasing chain of matches
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
            else:
                tails[k] = x
        matched = len(tails)
    else:
        matched = len(j)
    return matched / (total - matched)


def in_blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in gathered(batches, column, BLOCK_BYTES):
        data, offsets = utf8(batch.column(column))
        for start, end in blocks(np.diff(offsets), 2 * BLOCK_BYTES):
            at = offsets[start : end + 1]
            yield batch.slice(start, end - start), data[at[0] : at[-1]], at - at[0]
        trim()


def sketched(rows: DataFrame) -> DataFrame:
    """Rows (id, text) as (id, n, buckets): the number of shingles and the bucket keys."""
    kind = to_arrow_type(rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in in_blocks(batches, 1):
            found, bounds = shingles(data, offsets)
            keys, at = buckets(found, bounds)
            n = np.diff(bounds)
            lists = pa.ListArray.from_arrays(at.astype(np.int32), keys.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(kind), pa.array(n, pa.int64()), lists], ["id", "n", "buckets"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, buckets array<long>")


def contents(rows: DataFrame) -> DataFrame:
    """Rows (id, text) as (id, content): the labelled shingles, eight bytes each."""
    kind = to_arrow_type(rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in in_blocks(batches, 1):
            found, bounds = shingles(data, offsets)
            raw = [found[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(kind), pa.array(raw, pa.binary())], ["id", "content"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, content binary")


def rare_shingles(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (id, text) as rows (id, other, n): an id's rare shingles (other null), or those of a pair.

    Sums over all rows of an id or a pair (in either order) are what it has. Tasks send each shard
    of the shingles one row for each block of texts; of a shingle that more than RARE of the
    block's texts have, they say only that it is frequent, so no shard gathers a common shingle.
    """
    kind = rows.schema["id"].dataType
    arrow, name = to_arrow_type(kind), kind.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in in_blocks(batches, 1):
            found, bounds = shingles(data, offsets)
            text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            shard = (mix(found, 61) % np.uint64(shards)).astype(np.int64)
            order = np.lexsort((found, shard))
            found, text, shard = found[order], text[order], shard[order]
            first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, int)
            count = np.diff(np.r_[first, len(found)])
            often = np.repeat(count > RARE, count)
            common = found[first[count > RARE]], shard[first[count > RARE]]
            found, text, shard = found[~often], text[~often], shard[~often]
            there = np.union1d(shard, common[1])
            cuts, ends = np.searchsorted(shard, there), np.searchsorted(shard, there, "right")
            low, high = np.searchsorted(common[1], there), np.searchsorted(common[1], there, "right")
            ids, texts, each, frequent = [], [], [], []
            for c, e, x, y in zip(cuts.tolist(), ends.tolist(), low.tolist(), high.tolist(), strict=True):
                own, place = np.unique(text[c:e], return_inverse=True)
                ids.append(batch.column(0).take(pa.array(own)).cast(arrow))
                texts.append(place.astype(np.int32).tobytes())
                each.append(found[c:e].tobytes())
                frequent.append(common[0][x:y].tobytes())
            lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32), pa.concat_arrays(ids) if ids else pa.array([], arrow))
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), lists, *(pa.array(x, pa.binary()) for x in (texts, each, frequent))], ["shard", "ids", "texts", "shingles", "frequent"])

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        trim()
        ids = [np.asarray(x, object) for x in batch["ids"]]
        starts = np.cumsum([0, *map(len, ids)])
        ids = np.concatenate(ids)
        owner = np.concatenate([np.frombuffer(t, np.int32) + s for t, s in zip(batch["texts"], starts, strict=False)])
        found = np.concatenate([np.frombuffer(x, np.uint64) for x in batch["shingles"]])
        frequent = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in batch["frequent"]]))
        order = np.argsort(found)
        found, owner = found[order], owner[order]
        first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, int)
        number = np.diff(np.r_[first, len(found)])
        rare = np.repeat((number <= RARE) & ~np.isin(found[first], frequent), number)
        found, owner = found[rare], owner[rare]
        own = np.bincount(owner, minlength=len(ids))
        pairs = [np.zeros(0, np.int64)]
        for d in range(1, RARE):
            same = np.flatnonzero(found[d:] == found[:-d])
            a, b = np.minimum(owner[same], owner[same + d]), np.maximum(owner[same], owner[same + d])
            pairs.append(a * np.int64(len(ids)) + b)
        pairs, shared = np.unique(np.concatenate(pairs), return_counts=True)
        has = np.flatnonzero(own)
        none = np.full(len(has), None, object)
        return pd.DataFrame({"id": np.r_[ids[has], ids[pairs // len(ids)]], "other": np.r_[none, ids[pairs % len(ids)]], "n": np.r_[own[has], shared].astype(np.int64)})

    dealt = rows.mapInArrow(deal, f"shard long, ids array<{name}>, texts binary, shingles binary, frequent binary")
    return dealt.groupBy("shard").applyInPandas(count, f"id {name}, other {name}, n long")


def named(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (id, text) whose id is in ``ids``."""
    return anti_or_semi(rows, ids.select("id"), ["id"], "left_semi")


def still_open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows (bucket, id, n, class) of buckets that hold more than one component."""
    own = members.join(comps, "id", "left").select("bucket", "id", "n", F.coalesce("class", "id").alias("class"))
    split = own.groupBy(F.col("bucket").alias("of")).agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("of")
    return own.join(split, F.col("bucket") == F.col("of"), "left_semi")


def across(opened: DataFrame, texts: DataFrame, sketch: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that can reach SIMILARITY; ``texts`` are (id, text), ``sketch`` (id, n, buckets).

    A shingle that at most RARE of the open documents have is rare. Two documents match in at most
    as many shingles as the smaller number of frequent ones that either has, and the rare ones
    that both have. Where the frequent ones alone could be enough, documents of one bucket are
    paired if their numbers of shingles allow it; where rare ones are needed, the documents that
    share them are, at most RARE for each.
    The largest component of a bucket isn't paired with itself, so what is joined is each other
    member with all members. A pair comes out of the first bucket only that both are in.
    """
    total = opened.select("id", "n").distinct().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = stored(rare_shingles(texts, max(1, -(-total // SHINGLES))), "order-rare")
    rare = counts.where("other is null").groupBy("id").agg(F.sum("n").alias("r"))
    docs = opened.select("id", "n", "class").distinct().join(rare, "id", "left")
    docs = docs.join(sketch, ["id", "n"]).select("id", "n", "class", (F.col("n") - F.coalesce("r", F.lit(0))).alias("most"), "buckets")
    docs = stored(docs, "order-bounds")
    least = SIMILARITY / (1 + SIMILARITY)
    lacking = least * (F.col("n") + F.col("_n")) - F.least("most", "_most") - 1e-9  # matches that rare shingles must give
    renamed = [F.col(c).alias(f"_{c}") for c in ("id", "n", "class", "most", "buckets")]

    can = opened.select("bucket", "id", "n").join(docs.where(F.col("most") >= SIMILARITY * F.col("n") - 1e-9), ["id", "n"])
    sizes = can.groupBy("bucket", "class").agg(F.count("*").alias("k"))
    main = sizes.groupBy(F.col("bucket").alias("of")).agg(F.max_by("class", F.struct("k", "class")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("of", "main")
    strays = can.join(main, (F.col("bucket") == F.col("of")) & (F.col("class") != F.col("main"))).select("bucket", *renamed)
    # Similar texts have similar numbers of shingles, so a bucket's members meet within bands of them.
    first = F.col("bucket") == F.array_min(F.array_intersect("buckets", "_buckets"))
    band = lambda n: F.floor(F.log(F.col(n)) / (-np.log(SIMILARITY) * (1 + 1e-6)))
    near = strays.withColumn("band", F.explode(F.array(*[band("_n") + k for k in (-1, 0, 1)])))
    frequent = near.join(can.withColumn("band", band("n")), ["bucket", "band"]).where((F.col("class") != F.col("_class")) & (lacking <= 0) & first).select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"))

    both = counts.where("other is not null and id <> other").groupBy(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("_id")).agg(F.sum("n").alias("s"))
    docs, renamed = docs.drop("buckets"), renamed[:-1]
    both = both.join(docs, "id").join(docs.select(*renamed), "_id").where((F.col("class") != F.col("_class")) & (lacking <= F.col("s")))
    return frequent.unionByName(both.select(F.col("id").alias("a"), F.col("_id").alias("b"))).distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, class_id), one for each row of ``docs``."""
    return judged(docs, id_col, text_col).select(F.col("id").alias(id_col), "class_id")


def judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, digest, class_id, stays), one for each row of ``docs``.

    Of each class the rows of one text and id stay: those of the smallest id, and if it has several
    texts there, of the least digest. Rows with a null id stay. An id with different texts is as
    many documents; where there are such ids, documents are told apart by id and digest.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    digests = stored(rows.select("id", "digest"), "order-digests")
    several = digests.where("id is not null").groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b")
    if several.isEmpty():
        found = classes_of(rows, digests)
        return found.select("id", "digest", "class_id", (F.col("id").isNull() | (F.col("id") == F.col("class_id"))).alias("stays"))
    kind = rows.schema["id"].dataType.simpleString()
    named = rows.select(F.concat(F.col("id").cast("string"), F.lit(":"), F.hex("digest")).alias("id"), "text", "digest")
    found = stored(classes_of(named, named.select("id", "digest")), "order-named")
    own = F.expr(f"cast(left(id, length(id) - 65) as {kind})")
    first = found.where("id is not null").groupBy(F.col("class_id").alias("of")).agg(F.min(F.struct(own.alias("own"), F.col("id").alias("name"))).alias("first"))
    found = found.join(first, F.col("class_id") == F.col("of"), "left")
    return found.select(own.alias("id"), "digest", F.col("first.own").alias("class_id"), (F.col("id").isNull() | (F.col("id") == F.col("first.name"))).alias("stays"))


def classes_of(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """Rows (id, digest, class_id) from rows (id, text, digest) in which an id has one text."""
    firsts = digests.where("id is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("last"))
    firsts = stored(firsts, "order-firsts")
    copies = digests.join(firsts.where("rep <> last"), "digest").where("id <> rep").select("id", "digest").distinct()
    alone = anti_or_semi(rows.where("id is not null"), stored(copies, "order-copies"), ["id", "digest"], "left_anti").select("id", "text")
    sketch = stored(sketched(alone).where("n > 0"), "order-sketches")
    members = sketch.select("id", "n", F.explode("buckets").alias("bucket"))
    pairs = stored(stars(members), "order-stars")
    links = stored(verified(pairs, content_of(alone, pairs), aligned, SIMILARITY).select("a", "b"), "order-links")
    comps = stored(components(links), "order-classes")
    opened = stored(still_open(members, comps), "order-open")
    ids = opened.select("id").distinct()
    more = stored(across(opened, named(alone, ids), sketch.select("id", "n", "buckets")).join(pairs, ["a", "b"], "left_anti"), "order-across")
    more = stored(verified(more, content_of(alone, more), aligned, SIMILARITY).select("a", "b"), "order-links")
    if not more.isEmpty():
        comps = stored(components(links.unionByName(more)), "order-classes")
    whole = digests.join(firsts.select("digest", "rep"), "digest", "left")
    named_by = comps.select(F.col("id").alias("rep"), "class")
    return whole.join(named_by, "rep", "left").select("id", "digest", F.when(F.col("id").isNotNull(), F.coalesce("class", "rep")).alias("class_id"))


def content_of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    return stored(contents(named(rows, ids)), "order-contents")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the class of every document."""
    return near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns.

    Repeated rows of it are one document too; of two texts with one id each is a document of its
    own; documents with a null id stay.
    """
    found = stored(judged(docs, "doc_id", "text"), "order-result")
    column = "__digest"
    while column.lower() in map(str.lower, docs.columns):
        column += "_"
    on = ["doc_id", column]
    found = found.select(F.col("id").alias("doc_id"), F.col("digest").alias(column), "stays")
    rows = docs.withColumn(column, F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)))
    rest = anti_or_semi(rows, found.where("not stays").select(on).distinct(), on, "left_anti")
    again = found.where("stays and doc_id is not null").groupBy(on).count().where("count > 1").select(on)
    if again.isEmpty():
        return rest.drop(column)
    once = anti_or_semi(rest, again, on, "left_semi").dropDuplicates(on)
    return anti_or_semi(rest, again, on, "left_anti").unionByName(once).drop(column)
