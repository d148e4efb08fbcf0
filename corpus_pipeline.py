"""The corpus pipeline: quality, language, near duplicates, packing.

``STAGES`` names the stages; each function takes (spark, docs, sf_dir) and works on all that the
stage before it kept. All but the last return the columns of documents, further ones too, whatever
their names; the last returns pieces and bins.

Null and empty texts go in the first stage, texts without a letter in the second; each row is judged
by its own text, whatever its id. Repeated rows and copies are one document after the third, the one
of the smallest id; different texts with one id are different documents there, and rows with a null
id are never taken for copies. Of two equally good languages
the first in the alphabet counts, and pieces of the same length are packed in the order of a digest
of their row. Very long texts are judged whole and packed in several pieces. An empty table stays
empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import dedup, langid, packing, quality
from pagemill.llm.common import stored, table

STAGES = [
    ("quality", quality.kept),
    ("language", langid.kept),
    ("near_duplicates", dedup.kept),
    ("packing", packing.packed),
]

#: SQL can't express a trained network or sketches; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of the documents that pass all stages; each stage's rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
