"""Training-data pipeline over ``documents``: identify, deduplicate, decontaminate, mix, write token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read as the next
stage's ``docs``. All but the last return the columns of ``documents`` (extra columns pass through).
A null text has no language and goes in the first stage; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripcraft.llm import decontaminate, langid, mixing, simhash, tokens
from tripcraft.llm.common import stored
from tripcraft.session import ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of which no learned language holds half of the letters, go."""
    ship_package(spark)
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group of near-duplicates stays (the smallest doc_id)."""
    ship_package(spark)
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts (``n_chars`` follows); texts without a word left go."""
    ship_package(spark)
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"),
                                length="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's budgeted share of the tokens, by seeded epochs; a document taken twice is two rows."""
    ship_package(spark)
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder; returns doc_id, start, n_tokens, ids_crc32 read from them."""
    ship_package(spark)
    return tokens.write_and_read(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

ORACLE_SQL = None  # Viterbi labels, XXH64 fingerprints and BPE ids have no SQL; tests/llm uses brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
