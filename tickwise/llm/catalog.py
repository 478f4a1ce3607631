"""Registered queries of this package: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm.ann import search
from tickwise.llm.common import table
from tickwise.llm.decontam import leaky_documents
from tickwise.llm.fim import ORACLE_SQL as FIM_SQL
from tickwise.llm.fim import digests
from tickwise.llm.html import extract
from tickwise.llm.huffman import read_tokens, write_tokens
from tickwise.llm.langid import identified
from tickwise.llm.licenses import find_licenses
from tickwise.llm.neardup import NEAR_SQL, near_duplicates
from tickwise.llm.packing import pack
from tickwise.llm.pii import personal_data
from tickwise.llm.sampling import compared
from tickwise.llm.sharding import SHARD_SQL, shard_rows
from tickwise.llm.spelling import spelling_variants
from tickwise.session import new_scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"), by_place=True)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_posting_list_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaky_documents(table(spark, sf_dir, "documents"),
                           table(spark, sf_dir, "benchmark"))


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), shards=24)


def op9_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op10_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, ids=False)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_html_main_text, op2_language_id, op3_license_scan, op4_best_fit_packing,
        op5_posting_list_search, op6_personal_data,
        op7_benchmark_decontamination, op8_jump_sharding, op9_minhash_near_duplicates,
        op10_huffman_token_files, op11_fill_in_middle, op12_spelling_variants,
        op13_document_fingerprints, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op8_jump_sharding": SHARD_SQL, "op9_minhash_near_duplicates": NEAR_SQL,
            "op11_fill_in_middle": FIM_SQL}
