"""A corpus pipeline: five of the operators of ``tabloom.llm``, each stage written as Parquet and read again.

Every stage is a function (spark, docs, sf_dir) -> DataFrame and works on all that the stage before it kept.
All but the last return the columns of ``documents``; the last adds each record's place among the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import decontamination, mixing, quality, sharding, simhash
from tabloom.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    return simhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: repeated passes as copies, the last pass in part; documents cut at a block's end have a row for each part."""
    return mixing.mix(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records with size, shard and slot; where a column has such a name already, the result has an underscore behind it."""
    return sharding.sharded(docs, columns=docs.columns)


STAGES = [
    ("quality", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Trained scores, fingerprints and permutations have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
