"""A training corpus from raw documents: five stages, each over all rows that
the stage before kept, written to the shared scratch folder in between.

Near duplicates are linked from a similarity of 0.8 on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm.common import stored, table
from tickwise.llm.decontam import without_leaks
from tickwise.llm.langid import with_language
from tickwise.llm.neardup import without_near_duplicates
from tickwise.llm.packing import pack
from tickwise.llm.pii import redacted

#: Near duplicates: percent of shared shingles, and signature bands under which
#: a pair at that similarity stays unseen with probability 3e-6.
NEAR = {"percent": 80, "bands": 42, "rows": 6}
#: Words that a packing worker remembers: fewer than alone, beside what the stages
#: before have left in the executors' memory.
PACK_WORDS = 100_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs, **NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, keep_words=PACK_WORDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data),
          ("packing", packing)]

# fitted models and packing have no SQL form; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
