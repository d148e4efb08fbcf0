"""Quality classifier: a byte n-gram model with interpolated modified Kneser-Ney smoothing (operator 1).

Trained on trusted text: all documents labelled of good quality and not toxic, however many. Four
fifths train the model; the rest, which it hasn't seen, give each language's perplexity threshold
as an exact quantile. Documents above their language's threshold are rejected.

Counts are sharded by the last two bytes of an n-gram's context. All orders from 3 up that an
n-gram backs off to share those bytes, so a shard holds every count that its probabilities need;
orders 1 and 2 are a table of at most 65,536 rows. Tasks cut documents into blocks, send each
shard the block's distinct n-grams, and get their log probabilities back; so what is shuffled is
a block's distinct n-grams and not its text's positions. The blocks themselves lie in a bucketed
table and don't move again: their ids alone are joined with the trusted ones, and which texts of a
block are trusted is sent to it.

Null texts and empty texts have no bytes: their perplexity is null and they are rejected. A null
language counts as a language of its own; one with under ``LEAST`` calibration texts gets the
threshold over all languages; without any calibration text nothing but empty texts is rejected.
Repeated rows are judged alike; an empty table gives an empty result; further columns aren't read.
A very long text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagemill.llm.common import anti_or_semi, blocks, bucketed, crc_mod, discard, gathered, mix, stored, table, trim, unbucketed, utf8

ORDER = 5
#: Of five parts of the trusted documents, the one that sets the thresholds.
PARTS, CALIBRATION = 5, 0
QUANTILE = 0.995
#: Calibration texts that a language needs for a threshold of its own.
LEAST = 50
#: Of the approximate percentiles that enclose a quantile: how many values an error of one is, and how far off they are.
ACCURACY, WIDTH = 100_000, 1e-4
SHARDS = 64
#: Blocks whose questions to a shard one task answers.
TOGETHER = 32
#: Bytes of text in a block: at least so many (but for a task's last one), twice as many at most.
BLOCK_BYTES = 4_000_000
#: Bytes of a block whose n-grams a task holds at a time (or one longer text's).
PIECE_BYTES = 500_000
ROLES = {"other": 0, "train": 1, "calibrate": 2}


def windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Packed n-grams ending at each byte and at the end mark of each text, text after text.

    Every text has ORDER - 1 zero bytes before it; the one after it is its end mark.
    """
    pad = ORDER - 1
    sizes = np.diff(offsets)
    n = len(data) + pad * (len(sizes) + 1)
    padded = np.zeros(n, np.uint8)
    starts = offsets[:-1] + pad * np.arange(len(sizes))  # of each text's first n-gram, and of the zeros before it
    real = np.ones(n, bool)
    for k in range(pad):
        real[starts + k] = False
    real[n - pad :] = False
    padded[real] = data
    grams = np.zeros(n - pad, np.int64)
    for k in range(ORDER):
        np.left_shift(grams, 8, out=grams)
        np.bitwise_or(grams, padded[k : n - pad + k], out=grams)
    wanted = np.ones(n - pad, bool)
    ends = np.append(starts[1:], n - pad)[: len(sizes)]
    for k in range(1, pad):  # n-grams that reach into the next text
        wanted[ends - k] = False
    return grams[wanted]


def pieces_of(sizes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Runs of texts of about PIECE_BYTES: first and end of the texts, and of their places (bytes and end marks)."""
    ends = np.r_[0, np.cumsum(sizes + 1)]
    return [(start, end, ends[start], ends[end]) for start, end in blocks(sizes, PIECE_BYTES)]


def coded(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At each place of the texts the number of its n-gram, and the distinct n-grams by number.

    Piece after piece, so that little more than the numbers is held of a whole block.
    """
    codes = np.empty(len(data) + len(sizes), np.int32)
    offsets = np.r_[0, np.cumsum(sizes)]
    distinct = np.zeros(0, np.int64)
    for start, end, a, b in pieces_of(sizes):
        own, grams = pd.factorize(windows(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]))
        known = len(distinct)
        numbers, distinct = pd.factorize(np.concatenate([distinct, grams]))  # the known ones keep their numbers
        codes[a:b] = numbers[known:][own]
    return codes, distinct


def shard_of(grams: np.ndarray) -> np.ndarray:
    return (mix(grams >> 8 & 0xFFFF) % np.uint64(SHARDS)).astype(np.int64)


def pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(array.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def to_blocks(rows: DataFrame) -> DataFrame:
    """Rows (key, id, lang, text) as blocks: one row each, with its keys, ids, languages, sizes and texts."""
    types = [to_arrow_type(rows.schema[c].dataType) for c in ("key", "id")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, task = 0, TaskContext.get().partitionId()
        for batch in gathered(batches, 3, BLOCK_BYTES):
            data, offsets = utf8(batch.column(3))
            for start, end in blocks(np.diff(offsets), 2 * BLOCK_BYTES):
                at = offsets[start : end + 1]
                yield one(f"{task}-{number}", batch.slice(start, end - start), data[at[0] : at[-1]], np.diff(at))
                number += 1
                trim()

    def one(block: str, batch: pa.RecordBatch, data: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        listed = [pa.array([batch.column(k).to_pylist()], pa.list_(t)) for k, t in enumerate([*types, pa.string()])]
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), *listed, pa.array([sizes.tobytes()], pa.binary()), pa.array([pack(data)], pa.binary())],
            ["block", "keys", "ids", "langs", "sizes", "texts"],
        )

    key, own = (rows.schema[c].dataType.simpleString() for c in ("key", "id"))
    return rows.mapInArrow(run, f"block string, keys array<{key}>, ids array<{own}>, langs array<string>, sizes binary, texts binary")


def to_pieces(texts: DataFrame, roles: DataFrame) -> DataFrame:
    """The n-grams of blocks (block, sizes, texts), given the texts (of_block, place, role) that have a role.

    For each block and shard a row with the block's distinct n-grams (``grams``, ascending, as
    differences) and their counts in its training texts, if any; for each block a row without a
    shard that has the roles of all its texts.
    """

    def cut(held: pd.DataFrame, named: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in held.itertuples():
            sizes = np.frombuffer(row.sizes, np.int64)
            role = np.zeros(len(sizes), np.int8)
            role[named["place"].to_numpy()] = named["role"].to_numpy()
            codes, distinct = coded(unpack(row.texts, np.uint8), sizes)
            counts = np.zeros(len(distinct), np.int64)
            for start, end, a, b in pieces_of(sizes):
                counts += np.bincount(codes[a:b][np.repeat(role[start:end] == ROLES["train"], sizes[start:end] + 1)], minlength=len(distinct))
            del codes
            shards = shard_of(distinct)
            order = np.lexsort((distinct, shards))
            cuts = np.searchsorted(shards[order], np.arange(SHARDS + 1))
            rows.append((row.block, None, None, None, role.tobytes()))
            for s in range(SHARDS):
                if cuts[s] < cuts[s + 1]:
                    mine = order[cuts[s] : cuts[s + 1]]
                    n = counts[mine].astype(np.int32).tobytes() if counts[mine].any() else None
                    rows.append((row.block, s, np.diff(distinct[mine], prepend=0).tobytes(), n, None))
        trim()
        return pd.DataFrame(rows, columns=["block", "shard", "grams", "counts", "roles"]).astype({"shard": "Int32"})

    return texts.groupBy("block").cogroup(roles.groupBy("of_block")).applyInPandas(cut, "block string, shard int, grams binary, counts binary, roles binary")


def grams_of(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.int64))


def suffix(grams: np.ndarray, order: int) -> np.ndarray:
    return grams & ((1 << 8 * order) - 1)


def tallies(counts: np.ndarray) -> np.ndarray:
    """How many n-grams have the counts 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5]


def lower(grams: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of an order and by how many distinct bytes each is preceded."""
    return np.unique(suffix(grams, order), return_counts=True)


def merge_counts(pieces: DataFrame) -> DataFrame:
    """Counts of each shard: one row with its n-grams of the highest order, counts and tallies.

    Rows (shard, grams, counts) of many blocks are first summed by groups of blocks, so that no
    task gathers more than a group's pieces of a shard at once.
    """

    def merge(batch: pd.DataFrame) -> pd.DataFrame:
        trim()
        grams = np.concatenate([grams_of(g) for g in batch["grams"]])
        counts = np.concatenate([np.frombuffer(c, np.int32) for c in batch["counts"]]).astype(np.int64)
        keep = counts > 0
        keys, inverse = np.unique(grams[keep], return_inverse=True)
        sums = np.bincount(inverse, counts[keep], len(keys)).astype(np.int32)
        return pd.DataFrame({"shard": batch["shard"].iloc[:1], "grams": [np.diff(keys, prepend=0).tobytes()], "counts": [sums.tobytes()]})

    def whole(batch: pd.DataFrame) -> pd.DataFrame:
        out = merge(batch)
        grams = grams_of(out["grams"].iloc[0])
        tally = [tallies(np.frombuffer(out["counts"].iloc[0], np.int32))]
        for order in range(ORDER - 1, 2, -1):
            grams, counts = lower(grams, order)
            tally.append(tallies(counts))
        pairs, before = lower(grams, 2)
        out["tally"] = [np.concatenate(tally).tolist()]
        out["pairs"], out["before"] = [pairs.tolist()], [before.tolist()]
        return out

    part = "shard int, grams binary, counts binary"
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(64)))
    summed = pieces.select("shard", "part", "grams", "counts").groupBy("shard", "part").applyInPandas(merge, part)
    return summed.groupBy("shard").applyInPandas(whole, part + ", tally array<long>, pairs array<long>, before array<long>")


def discounts(tally: np.ndarray) -> np.ndarray:
    """D1, D2 and D3+ of modified Kneser-Ney from the tallies of counts 1 to 4.

    Where a tally is zero the usual estimate is undefined or out of range; then 0.5, 1, 1.5.
    """
    n1, n2, n3, n4 = (float(x) for x in tally)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.where((found > 0) & (found < np.array([1, 2, 3])), found, [0.5, 1.0, 1.5])


def interpolate(query: np.ndarray, grams: np.ndarray, counts: np.ndarray, cut: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities of one order: discounted counts, plus what the discounts free times ``below``.

    ``grams`` ascending with their counts; ``query`` may hold any n-grams of the same order.
    """
    if not len(grams):
        return below
    contexts = grams >> 8
    first = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]])
    names, totals = contexts[first], np.add.reduceat(counts, first).astype(np.float64)
    level = np.minimum(counts, 3)
    freed = np.add.reduceat(cut[level - 1], first)
    at = np.minimum(np.searchsorted(grams, query), len(grams) - 1)
    c = np.where(grams[at] == query, counts[at], 0)
    own = np.where(c > 0, c - cut[np.maximum(np.minimum(c, 3), 1) - 1], 0.0)
    where = np.minimum(np.searchsorted(names, query >> 8), len(names) - 1)
    seen = names[where] == query >> 8
    return np.where(seen, (own + freed[where] * below) / totals[where], below)


def low_orders(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """P(byte | byte) as a table of 256 x 256, and the discounts of order 2; order 1 gives way to the uniform."""
    before = np.zeros(65536, np.int64)
    for p, n in pairs.items():
        before[p] = n
    grams = np.flatnonzero(before)
    preceded = np.bincount(grams & 255, minlength=256)  # of each byte: by how many different ones
    seen = np.flatnonzero(preceded)
    alone = interpolate(np.arange(256), seen, preceded[seen], discounts(tallies(preceded[seen])), np.full(256, 1 / 256))
    cut = discounts(tallies(before[grams]))
    every = np.arange(65536)
    return interpolate(every, grams, before[grams], cut, alone[every & 255]), cut


def log_probabilities(query: np.ndarray, grams: np.ndarray, counts: np.ndarray, cuts: np.ndarray, low: np.ndarray) -> np.ndarray:
    """log10 P of n-grams of the highest order, given their shard's counts.

    ``cuts`` are the discounts of orders ORDER, ORDER - 1, ... 3; ``low`` the table of order 2.
    """
    levels = [(grams, counts.astype(np.int64))]
    for order in range(ORDER - 1, 2, -1):
        levels.append(lower(levels[-1][0], order))
    p = low[query & 0xFFFF]
    for k in range(len(levels) - 1, -1, -1):
        p = interpolate(suffix(query, ORDER - k), *levels[k], cuts[k], p)
    return np.log10(p)


def perplexities(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, lang_col: str, named: Column | None = None) -> DataFrame:
    """Rows (id, lang, role, n_bytes, log10_prob, perplexity), one for each row of ``docs``.

    ``trusted`` has the column id; all its ids count. With ``named``, an expression of ``docs``'
    columns, rows come out under that name in place of their id.
    """
    trusted = trusted.where("id is not null").distinct()
    trusted = trusted.select("id", F.when(crc_mod("id", PARTS) == CALIBRATION, ROLES["calibrate"]).otherwise(ROLES["train"]).cast("int").alias("role"))
    own = F.col(id_col) if named is None else named
    rows = docs.select(F.col(id_col).alias("key"), own.alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    made, name = bucketed(to_blocks(rows), "block", "quality_blocks")
    roles = made.select(F.col("block").alias("of_block"), F.posexplode("keys").alias("place", "id")).join(trusted, "id").select("of_block", "place", "role")
    pieces = stored(to_pieces(made.select("block", "sizes", "texts"), roles), "quality-pieces")
    model = stored(merge_counts(pieces.where("counts is not null").select("block", "shard", "grams", "counts")), "quality-model")
    tally = np.zeros(4 * (ORDER - 2), np.int64)
    for r in model.select(F.posexplode("tally").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        tally[r["k"]] = r["n"]
    cuts = np.array([discounts(t) for t in tally.reshape(-1, 4)])
    pairs = model.select(F.explode(F.arrays_zip("pairs", "before")).alias("x")).groupBy("x.pairs").agg(F.sum("x.before").alias("n")).collect()
    low, _ = low_orders({r["pairs"]: r["n"] for r in pairs})  # at most 65,536 rows

    def answer(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        grams = grams_of(held["grams"].iloc[0]) if len(held) else np.zeros(0, np.int64)
        counts = np.frombuffer(held["counts"].iloc[0], np.int32) if len(held) else np.zeros(0, np.int32)
        logs = [log_probabilities(grams_of(g), grams, counts, cuts, low).astype(np.float32).tobytes() for g in asked["grams"]]
        trim()
        return pd.DataFrame({"of_block": asked["block"], "shard": asked["shard"], "logs": logs}, columns=["of_block", "shard", "logs"])

    # A shard's model is joined with each group of blocks, so a shard's questions are many tasks.
    parts = -(-made.count() // TOGETHER) or 1
    few = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
    asked = pieces.where("grams is not null").select("block", "shard", "grams", few.alias("part"))
    held = model.select(F.col("shard").alias("model_shard"), "grams", "counts", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("model_part"))
    answers = asked.groupBy("shard", "part").cogroup(held.groupBy("model_shard", "model_part")).applyInPandas(answer, "of_block string, shard int, logs binary")
    answers = answers.unionByName(pieces.where("roles is not null").select(F.col("block").alias("of_block"), F.lit(-1).alias("shard"), F.col("roles").alias("logs")))

    def settle(texts: pd.DataFrame, logs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in texts.itertuples():
            sizes = np.frombuffer(row.sizes, np.int64)
            codes, distinct = coded(unpack(row.texts, np.uint8), sizes)
            begin = np.r_[0, np.cumsum(sizes + 1)[:-1]]
            shards = shard_of(distinct)
            order = np.lexsort((distinct, shards))
            role, *by_shard = logs.sort_values("shard")["logs"]  # the roles stand at shard -1
            found = np.empty(len(distinct), np.float64)
            found[order] = np.concatenate([np.frombuffer(x, np.float32) for x in by_shard])
            out.append(pd.DataFrame({
                "id": list(row.ids), "lang": list(row.langs), "role": np.frombuffer(role, np.int8).astype(np.int32),
                "n_bytes": sizes, "log10_prob": np.concatenate([np.add.reduceat(found[codes[a:b]], begin[start:end] - a) for start, end, a, b in pieces_of(sizes)]),
            }))
        trim()
        return pd.concat(out) if out else pd.DataFrame({k: [] for k in ("id", "lang", "role", "n_bytes", "log10_prob")})

    kind = rows.schema["id"].dataType.simpleString()
    texts = made.select("block", "ids", "langs", "sizes", "texts")
    found = texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInPandas(settle, f"id {kind}, lang string, role int, n_bytes long, log10_prob double")
    per_byte = -F.col("log10_prob") / (F.col("n_bytes") + 1)
    out = stored(found.withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), per_byte))), "quality-perplexities")
    unbucketed(made, name)
    discard(pieces, model)
    return out


def quantiles(rows: DataFrame, by: list[str], value: str, quantile: float) -> DataFrame:
    """Rows (by, threshold, n): of each group's n values the one of rank ceil(quantile * n), exactly.

    Approximate percentiles to both sides enclose it, ten times as far off as their own error can
    be; only the values between them, a five-thousandth, are ranked.
    """
    counts = rows.groupBy(*by, F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    at = [max(0.0, quantile - WIDTH), min(1.0, quantile + WIDTH)]
    ends = rows.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.percentile_approx(value, at, ACCURACY).alias("__ends"), F.count("*").alias("n"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    near = (counts.join(ends, same) if by else counts.crossJoin(ends)).where(F.col("__v") <= F.col("__ends")[1])
    # what lies below counts as one value
    near = near.groupBy(*by, "n", F.greatest("__v", F.col("__ends")[0]).alias("__v")).agg(F.sum("__n").alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(*by).orderBy("__v"))
    ranked = near.withColumn("__upto", upto).where(F.col("__upto") >= F.ceil(F.lit(quantile) * F.col("n")))
    return ranked.groupBy(*by, "n").agg(F.min("__v").alias("threshold")).select(*by, "threshold", "n")


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, named: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: id (or ``named``), lang, n_bytes, log10_prob, perplexity, threshold, keep."""
    rows = perplexities(docs, trusted, id_col, text_col, lang_col, named)
    calibration = rows.where((F.col("role") == ROLES["calibrate"]) & F.col("perplexity").isNotNull())
    over_all = next((r["threshold"] for r in quantiles(calibration, [], "perplexity", quantile).collect()), None)
    by_lang = quantiles(calibration, ["lang"], "perplexity", quantile).where(F.col("n") >= LEAST).select(F.col("lang").alias("of_lang"), "threshold")
    rows = rows.join(by_lang, rows["lang"].eqNullSafe(by_lang["of_lang"]), "left")
    threshold = F.coalesce("threshold", F.lit(over_all).cast("double"))
    keep = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return rows.select(F.col("id").alias(id_col), "lang", "n_bytes", "log10_prob", "perplexity", threshold.alias("threshold"), keep.alias("keep"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that some label calls good and no label calls bad or toxic."""
    judged = labels.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return judged.where("quality = 1 and coalesce(toxic, 0) = 0").select("id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: perplexity and verdict of every document."""
    return classify(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")))


def kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with all their columns.

    Each row is judged for itself, whatever its id: rows of the same id, language and text are
    judged alike, others that share an id (or have none) don't matter to it.
    """
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("doc_id", "lang", "text")]
    name = F.sha2(F.concat_ws("\x01", *plain), 256)
    judged = classify(docs, trusted_ids(table(spark, sf_dir, "labels")), named=name)
    column = "__judged"
    while column.lower() in map(str.lower, docs.columns):
        column += "_"
    rejected = judged.where("not keep").select(F.col("doc_id").alias(column)).distinct()
    return anti_or_semi(docs.withColumn(column, name), rejected, [column], "left_anti").drop(column)
