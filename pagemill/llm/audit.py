"""How a set of filters interact: a Walsh-Hadamard audit (operator 12).

Every document gets a mask of the filters that it fails. For each part and label the 32 sums of
the masks' parities, one for each set of filters with a sign for each document, are aggregated;
the transform is its own inverse but for a factor of 32, so the sums give the number of documents
of every mask exactly, in integers. From these 32 cells follow, for each order in which the
filters may run, what each step keeps and removes. A document that fails k filters is removed by
each of them in 120 / k of the 120 orders, which is each filter's Shapley sum.

Null texts count as empty, null parts as the empty string. A null id has no smaller one and is
smaller than none, so its row is no copy; of rows that repeat an id none is a copy of the other. A
document is good (toxic) if any row of the labels says so; labels of a null id count for nobody. Very
long texts are read whole, as an array of their words. An empty table gives an empty result.
Only named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import stored, table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
CELLS = 2 ** len(FILTERS)
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
SIGNS = "[#$%&*|]"


def failures(text: Column) -> Column:
    """The mask of filters A to D (bits 0 to 3) that a text fails."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    distinct = F.size(F.array_distinct(words)).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [
        F.size(words) < LEAST_WORDS,
        distinct * 100 < F.size(words).cast("long") * LEAST_DISTINCT,
        capitals * 100 > F.length(text).cast("long") * MOST_CAPITALS,
        text.rlike(SIGNS),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def masked(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Rows (part, mask, good, toxic), one for each row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    facts = docs.select(F.col(id_col).alias("id"), part, failures(text).alias("fails"), F.unhex(F.sha2(text, 256)).alias("digest"))
    facts = stored(facts, "audit-facts")
    # The first of equal texts is found by digest and id together, so copies of one text don't meet.
    firsts = facts.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))])
    known = facts.where("id is not null").join(firsts, ["digest", "id"], "left").join(marks.where("good or toxic"), "id", "left")
    copy = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    known = known.select("part", (F.col("fails") + copy).alias("mask"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    unknown = facts.where("id is null").select("part", F.col("fails").alias("mask"), F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return known.unionByName(unknown)


def cells(rows: DataFrame) -> DataFrame:
    """Rows (part, label columns, cells): how many rows have each mask, by the transform of parity sums."""
    others = [c for c in rows.columns if c != "mask"]
    sums = [F.expr(f"sum(1L - 2 * (bit_count(mask & {s}) & 1))") for s in range(CELLS)]
    signed = rows.groupBy(*others).agg(F.array(*sums).alias("sums"))
    inverse = f"transform(sequence(0, {CELLS - 1}), m -> aggregate(sequence(0, {CELLS - 1}), 0L, (t, s) -> t + (1 - 2 * (bit_count(m & s) & 1)) * sums[s]) div {CELLS})"
    return signed.select(*others, F.expr(inverse).alias("cells"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step, with what the step does to the part."""
    found = cells(masked(docs, labels, id_col, text_col, part_col))
    sums = {"n": "true", "g": "good", "x": "toxic"}
    parts = found.groupBy("part").agg(*[F.array(*[F.expr(f"sum(if({of}, cells[{m}], 0L))") for m in range(CELLS)]).alias(name) for name, of in sums.items()])
    steps = parts.withColumn("filter_order", F.explode(F.lit(ORDERS))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = lambda k: f"shiftleft(1, ascii(substring(filter_order, {k}, 1)) - ascii('{FILTERS[0]}'))"
    before = f"aggregate(filter(sequence(1, {len(FILTERS)}), k -> k < step), 0, (t, k) -> t | {bit('k')})"
    steps = steps.withColumn("own", F.expr(bit("step"))).withColumn("before", F.expr(before))

    def over(counts: str, condition: str, each: str = "1") -> Column:
        """The sum over masks m that fulfil the condition."""
        return F.expr(f"aggregate(sequence(0, {CELLS - 1}), 0L, (t, m) -> t + if({condition}, {counts}[m] * {each}, 0L))")

    removed = "(m & own) > 0 and (m & before) = 0"
    return steps.select(
        "part", "filter_order", "step",
        over("n", "(m & (before | own)) = 0").alias("kept"),
        over("n", removed).alias("removed"),
        over("n", "(m & own) > 0 and (m & before) > 0").alias("redundant"),
        over("n", "m = own").alias("unique_fails"),
        over("g", removed).alias("good_lost"),
        over("x", removed).alias("toxic_lost"),
        over("n", "(m & own) > 0", f"({len(ORDERS)} div bit_count(m))").alias("shapley"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every order and step of the five filters, for each source of documents."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The same by brute force: every document is taken through every order.
SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
facts AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN worded.doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM worded LEFT JOIN marks ON worded.doc_id = marks.doc_id),
grouped AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM facts GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
applied AS (
  SELECT part, o, step, n, g, x, fails, contains(fails, o[step]) AS failing,
    step > 1 AND regexp_matches(fails, '[' || left(o, greatest(step - 1, 1)) || ']') AS gone
  FROM grouped CROSS JOIN steps),
counted AS (
  SELECT part, o, step,
    sum(n) FILTER (NOT gone AND NOT failing) AS kept, sum(n) FILTER (failing AND NOT gone) AS removed, sum(n) FILTER (failing AND gone) AS redundant,
    sum(n) FILTER (failing AND len(fails) = 1) AS unique_fails, sum(g) FILTER (failing AND NOT gone) AS good_lost, sum(x) FILTER (failing AND NOT gone) AS toxic_lost
  FROM applied GROUP BY part, o, step),
shapley AS (SELECT part, o[step] AS f, sum(coalesce(removed, 0)) AS shapley FROM counted GROUP BY part, o[step])
SELECT c.part, o AS filter_order, step,
  coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, shapley::BIGINT AS shapley
FROM counted c JOIN shapley s ON c.part = s.part AND o[step] = f
"""
