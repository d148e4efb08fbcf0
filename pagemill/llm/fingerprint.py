"""Document fingerprints by a randomised edit embedding (operator 6).

Shared random walks map edit distance to Hamming distance: a walk reads a text's characters and at
each step emits the character it stands on, then moves on or stays as a random bit of the step
and the character says. After an edit two walks over otherwise equal text soon meet again, so the
emitted strings differ in few places. Walks start anew at content-defined anchors, about every
SPACING characters and with steps that the anchor gives, so a long text is many short walks, an
edit is felt up to the next anchor only, and different texts take different steps.

The emitted strings are never stored: step ``j`` adds the random sign of (j, character) to counter
``j mod BITS``, and the counters' signs are the fingerprint. Two fingerprints agree in a bit with a
probability that depends on the share of equal steps, which ``likeness`` inverts.

``near_pairs`` finds near copies: each of ``BANDS`` bands samples ``SAMPLED`` bits, texts with equal
bits share a bucket, members of a bucket are verified against its smallest one by the edit distance
of their texts, and those that aren't near it are verified against the smallest of the rest, and so
on. Where a bucket then still holds several components, members of different ones are verified too,
so texts of a bucket that are near each other are always in one component. Which near copies share
one depends on how many places were edited (measured on texts of 1,500 to 6,000 characters): with
0.5, 1, 2 and 5 % of the characters changed at random 99, 91, 55 and 10 % of the pairs do, with 1,
2, 5 and 10 % of the words 100, 98, 85 and 41 %; of unrelated texts none of 120.

Null texts count as empty; an empty text has the fingerprint of all zero bits and is like itself
only (likeness 1) and unlike others (0). Equal texts have equal fingerprints. Repeated rows are
distinct rows that follow each other in the order of the ids; rows with a null id come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type

from pagemill.llm.common import anti_or_semi, blocks, mix, stored, table, trim
from pagemill.llm.links import components, verified

BITS = 256
#: Steps after which the shared random functions repeat; a multiple of BITS.
PERIOD = 4096
#: A walk starts anew where the hash of ANCHOR characters is 0 modulo SPACING, and at the latest
#: after LONGEST characters.
ANCHOR, SPACING, LONGEST = 6, 32, 4096
#: Bands of near_pairs, the bits that each samples, and the least edit similarity.
BANDS, SAMPLED, LEAST = 96, 20, 0.8
#: Walks that are taken together.
LANES = 32768
#: Characters that a task embeds at a time.
BLOCK_CHARS = 500_000
#: Rows of a part of the table, in the mean at most.
ROWS_OF_PART = 10_000


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each step and character class: whether the walk moves on, and the sign it adds."""
    h = mix(np.arange(PERIOD * 256, dtype=np.int64), 17).reshape(PERIOD, 256)
    moves, signs = (h & np.uint64(1)).astype(np.int8), (h >> np.uint64(1) & np.uint64(1)).astype(np.int8) * 2 - 1
    return np.pad(moves, ((0, 0), (0, 1))), np.pad(signs, ((0, 0), (0, 1)))  # class 256, past the end: no move, no sign


MOVES, SIGNS = tables()


def contexts(points: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """A hash of each character and up to ``width - 1`` characters of its own text before it."""
    h = mix(points, 3)
    first = np.r_[0, ends[:-1]]
    place = np.arange(len(points)) - np.repeat(first, np.diff(np.r_[0, ends]))
    out = h.copy()
    for k in range(1, width):
        turned = h[:-k] << np.uint64(k) | h[:-k] >> np.uint64(64 - k)
        out[k:] ^= np.where(place[k:] >= k, turned, np.uint64(0))
    return mix(out.view(np.int64), 5)


def starts_of(rolling: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places at which walks start, over texts that lie one after another and end at ``ends``."""
    first = np.r_[0, ends[:-1]]
    cuts = np.flatnonzero(rolling % np.uint64(SPACING) == 0) + 1
    cuts = cuts[cuts < len(rolling)]
    text = np.searchsorted(ends, cuts, side="right")
    cuts = cuts[cuts - first[text] >= ANCHOR]
    starts = np.unique(np.r_[first[ends > first], cuts])
    sizes = np.diff(np.r_[starts, ends[-1]])
    far = sizes > LONGEST
    more = [np.arange(s + LONGEST, s + n, LONGEST) for s, n in zip(starts[far].tolist(), sizes[far].tolist(), strict=True)]
    return np.sort(np.concatenate([starts, *more]))


def embed(texts: list[str]) -> np.ndarray:
    """Fingerprints as rows of BITS // 8 bytes."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(lengths)
    sums = np.zeros((len(texts), BITS), np.int32)
    if len(points):
        rolling = contexts(points, ends, ANCHOR)
        starts = starts_of(rolling, ends)
        classes = np.append((mix(points, 3) >> np.uint64(40) & np.uint64(255)).astype(np.int16), np.int16(256))
        stops, owner = np.r_[starts[1:], len(points)], np.searchsorted(ends, starts, side="right")
        first = np.where(starts == np.r_[0, ends[:-1]][owner], np.uint64(0), rolling[np.maximum(starts - 1, 0)] >> np.uint64(20) & np.uint64(PERIOD - 1)).astype(np.int64)
        for a in range(0, len(starts), LANES):
            some = slice(a, a + LANES)
            counters, own = walked(classes, starts[some], stops[some], first[some]), owner[some]
            edges = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])  # walks lie in the order of their texts
            sums[own[edges]] += np.add.reduceat(counters, edges, axis=1, dtype=np.int32).T
    return np.packbits(sums > 0, axis=1)


def walked(classes: np.ndarray, at: np.ndarray, stop: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The counters, BITS by walks, of walks from ``at`` to ``stop`` that begin with the step ``step``."""
    n, past = len(at), len(classes) - 1
    counters = np.zeros(BITS * n, np.int16)
    place, moves, signs = np.arange(n), MOVES.ravel(), SIGNS.ravel()
    at, taken = at.copy(), 0
    width = MOVES.shape[1]
    row = step * width  # of the step in the tables
    while len(at):
        code = row + classes.take(at)
        counters[step % BITS * n + place] += signs.take(code)
        at += moves.take(code)
        step = step + 1 & PERIOD - 1
        row = step * width
        going = at < stop
        taken += 1
        if taken % 16 == 0 or len(at) < 64:
            at, stop, place, step, row = at[going], stop[going], place[going], step[going], row[going]
        else:
            at[~going] = past
    return counters.reshape(BITS, n)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal steps, estimated from the share of equal bits (rows of bytes), 0 to 1."""
    differ = np.bitwise_count(a ^ b).sum(1) / BITS
    return np.clip(np.cos(np.pi * np.minimum(differ, 0.5)), 0, 1)


def compare(a: np.ndarray, b: np.ndarray, a_empty: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), likeness(a, b))


def edited(text: str, following: str) -> str:
    """``text`` whose last half (rounded down) gives way to as many first characters of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(texts: list[str], following: list[str]) -> list:
    """For each text and the one that follows it: the columns of NAMES, as lists."""
    made = [edited(*r) for r in zip(texts, following, strict=True)]
    number = {t: k for k, t in enumerate(dict.fromkeys([*texts, *following, *made]))}
    prints = embed([*number])
    own, after, changed = (prints[[number[t] for t in x]] if x else prints[:0] for x in (texts, following, made))
    empty, empty_after, empty_made = (np.array([not t for t in x], bool) for x in (texts, following, made))
    hexed = lambda x: [r.tobytes().hex() for r in x]
    return [[*map(len, texts)], [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in made], hexed(own), hexed(changed), compare(own, changed, empty, empty_made).tolist(), compare(own, after, empty, empty_after).tolist()]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Rows are dealt by ranges of (id descending, hash of the text), about ROWS_OF_PART each, so null
    ids and a hot id are many parts too. A task pairs each row with the next one of its part, and
    gives out its first and its last row with their texts; the last row of each part is then paired
    with the first one of the part after it.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    name, id_type = kind.simpleString(), to_arrow_type(kind)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // ROWS_OF_PART))
    order = [F.col("id").desc_nulls_last(), F.col("h").asc()]
    dealt = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text", F.spark_partition_id().alias("part"))
    names = ["id", *NAMES, "part", "edge", "text"]

    def batch_of(ids: list, found: list, part: list, edge: list, texts: list) -> pa.RecordBatch:
        n = len(ids)
        found = found or [[None] * n] * len(NAMES)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = [pa.array(ids, id_type), *(pa.array(x, k) for x, k in zip(found, kinds, strict=True)), pa.array(part, pa.int32()), pa.array(edge, pa.string()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows whose last has no successor yet
        held, part = 0, None
        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part is None:
                    part = batch.column(2)[0].as_py()
                    yield batch_of([row[0]], [], [part], ["first"], [row[1]])
                waiting.append(row)
                held += len(row[1])
                if held > BLOCK_CHARS and len(waiting) > 1:
                    yield block(waiting)
                    waiting = waiting[-1:]
                    held = len(waiting[0][1])
        if len(waiting) > 1:
            yield block(waiting)
        if waiting:
            yield batch_of([waiting[-1][0]], [], [part], ["last"], [waiting[-1][1]])

    def block(rows: list[tuple]) -> pa.RecordBatch:
        n = len(rows) - 1
        out = batch_of([r[0] for r in rows[:-1]], compared([r[1] for r in rows[:-1]], [r[1] for r in rows[1:]]), [None] * n, [None] * n, [None] * n)
        trim()
        return out

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, after = (batch.column(k).to_pylist() for k in range(3))
            yield batch_of(ids, compared(texts, after), [None] * len(ids), [None] * len(ids), [None] * len(ids))

    made = stored(dealt.mapInArrow(run, f"id {name}, {FIELDS}, part int, edge string, text string"), "edit-prints")
    firsts, lasts = (made.where(F.col("edge") == e) for e in ("first", "last"))
    there = sorted(r["part"] for r in firsts.select("part").collect())  # a number for each part
    following = spark.createDataFrame([(p, there[(k + 1) % len(there)]) for k, p in enumerate(there)], "part int, next_part int")
    ends = lasts.select("part", "id", "text").join(F.broadcast(following), "part").join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("after")), "next_part")
    ended = ends.select("id", "text", "after").mapInArrow(pair, f"id {name}, {FIELDS}, part int, edge string, text string")
    return made.where("edge is null").unionByName(ended).select(F.col("id").alias(id_col), *NAMES)


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a column of the table in the bits of two integers."""
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = every, 0, len(a)
    for c in b:
        same = places.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right, left = down | ~(diagonal | up), up & diagonal
        distance += bool(right & last) - bool(left & last)
        right = right << 1 | 1
        up, down = (left << 1 | ~(diagonal | right)) & every, right & diagonal & every
    return distance


def edit_similarity(a: bytes, b: bytes) -> float:
    x, y = bytes(a).decode("utf-8"), bytes(b).decode("utf-8")
    return 1 - edit_distance(x, y) / max(len(x), len(y), 1)


def band_keys(prints: np.ndarray) -> np.ndarray:
    """BANDS keys of each fingerprint, from SAMPLED random bits each."""
    bits = np.unpackbits(prints, axis=1)
    rng = np.random.default_rng(31)
    keys = np.empty((len(prints), BANDS), np.int64)
    for k in range(BANDS):
        chosen = rng.choice(BITS, SAMPLED, replace=False)
        keys[:, k] = bits[:, chosen].astype(np.int64) @ (1 << np.arange(SAMPLED)) + (k << SAMPLED)
    return keys


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """Links (a, b, similarity), a < b, between near copies; their components are the classes.

    Null and empty texts and rows with a null id take no part.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text <> ''")
    kind, name = docs.schema[id_col].dataType.simpleString(), rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in blocks(np.array([*map(len, texts)]), BLOCK_CHARS):
                keys = band_keys(embed(texts[start:end]))
                lists = pa.ListArray.from_arrays(np.arange(0, end - start + 1, dtype=np.int32) * BANDS, keys.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start).cast(to_arrow_type(name)), lists], ["id", "bands"])

    bands = stored(rows.mapInArrow(run, f"id {kind}, bands array<long>"), "edit-bands")
    members = bands.select("id", F.explode("bands").alias("bucket")).distinct()
    texts_of = lambda pairs: anti_or_semi(
        rows, stored(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "edit-ids"), ["id"], "left_semi"
    ).select("id", F.encode("text", "UTF-8").alias("content"))
    rest, links, tried = members, None, None
    while True:
        pivots = rest.groupBy(F.col("bucket").alias("of")).agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("of", "a")
        held = stored(rest.join(pivots, F.col("bucket") == F.col("of")).where("id <> a").select("bucket", "a", "id"), "edit-members")
        if held.isEmpty():
            break
        pairs = held.select("a", F.col("id").alias("b")).distinct()
        if links is not None:
            pairs = pairs.join(links.select("a", "b"), ["a", "b"], "left_anti")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = verified(pairs, texts_of(pairs), edit_similarity, least)
        links = stored(found if links is None else links.unionByName(found), "edit-links")
        rest = stored(held.join(links.select("a", F.col("b").alias("id")), ["a", "id"], "left_anti").select("bucket", "id"), "edit-rest")
    if links is None:
        return docs.sparkSession.createDataFrame([], f"a {kind}, b {kind}, similarity double")
    more = stored(across(members, components(links.select("a", "b"))).join(tried.distinct(), ["a", "b"], "left_anti"), "edit-across")
    return links.unionByName(stored(verified(more, texts_of(more), edit_similarity, least), "edit-links"))


def across(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket and different components.

    The largest component of a bucket isn't paired with itself, so what is joined is each other
    member with all members.
    """
    own = stored(members.join(comps, "id", "left").select("bucket", "id", F.coalesce("class", "id").alias("class")), "edit-open")
    sizes = own.groupBy("bucket", "class").agg(F.count("*").alias("k"))
    main = sizes.groupBy(F.col("bucket").alias("of")).agg(F.max_by("class", F.struct("k", "class")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("of", "main")
    strays = own.join(main, (F.col("bucket") == F.col("of")) & (F.col("class") != F.col("main"))).select("bucket", F.col("id").alias("_id"), F.col("class").alias("_class"))
    return strays.join(own, "bucket").where("class <> _class").select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
