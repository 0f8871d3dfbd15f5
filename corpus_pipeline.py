"""From raw documents to packed training windows: five stages, each written and read again by the next.

All but the last stage return the columns of ``documents``. The last returns the pieces of the documents with their
windows: ``doc_id``, ``source``, ``cluster``, ``piece``, ``start_token``, ``n_tokens``, ``bin_id``, ``bin_offset``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm import mixing, near_dedup, packing, quality, suffix_dedup
from paperloom.session import land


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or come from a host that mostly does, go."""
    return quality.keep_documents(docs)


def near_dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, similarity 0.8)."""
    return near_dedup.keep_one(docs, shingle=5, percent=80)


def suffix_dedup_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur again are cut out of the texts; ``n_chars`` follows."""
    return suffix_dedup.remove_repeats(docs, length=200, size="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled such that sources, languages and topics meet their target weights."""
    return mixing.keep_sampled(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2,048 words; neither two copies of a text nor two documents of a source share one."""
    return packing.pack(docs, packing.word_tokens(), source=F.col("source"), cluster=F.md5("text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup_documents),
    ("suffix_dedup", suffix_dedup_texts),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_documents),
]

#: Suffix removal and packing are not expressible; the tests hold run() against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
