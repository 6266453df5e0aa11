"""The training corpus pipeline: stages over `documents`, each written as Parquet and read back by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nightglass.llm import bagminhash, decontam, mixing, quality, sharding
from nightglass.llm.common import table, write_out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the current policy keeps; a null or empty text has too few words."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least doc_id."""
    return bagminhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with less than a twentieth of their words in benchmark windows."""
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order of the Pfair mix of their sources."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard, and their slot in it: a shard's slots follow the Pfair mix of the sources."""
    return sharding.sharded(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]
# Near duplicates, mixing and sharding have no SQL form; tests/llm compares the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_out(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
