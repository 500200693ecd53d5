"""From raw documents to packed training sequences: five stages, each written and read again.

Each stage takes the documents that its predecessor kept. All but the last return whole
documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.llm import catalog, decontam, exact, packing, quality, simhash
from eventrill.llm.common import prepared, shared_table, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at least ``catalog.KEEP_SCORE``."""
    prepared(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), catalog.learned_quality())
    return quality.keep_good(docs, model, catalog.KEEP_SCORE)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.keep_one(docs, exact.exact_dedup(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    prepared(spark)
    found = simhash.near_duplicates(docs)
    return exact.keep_one(docs, found.select("doc_id", "text_hash", F.col("first").alias("kept")))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"), max_coverage=0.0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    prepared(spark)
    return packing.packed(docs, catalog.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]

# No stage but the second could be told in SQL; tests hold the chain against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
