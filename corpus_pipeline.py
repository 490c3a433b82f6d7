"""Corpus pipeline: five stages from raw documents to shards.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as parquet
and read again as the next one's ``docs``.  A stage works on everything its
predecessor kept, and all stages but the last return the columns of
``documents``:

1. quality classifier: documents that score below the cutoff go;
2. near-duplicates: one document of each group (five-word shingles, 0.8) stays;
3. benchmark decontamination: documents that hold a test item go;
4. mixing: rates thin toxic documents to their target share of the clean ones;
5. sharding: every document gets a shard and a slot.

The result of ``run`` rests on trained models and hashes that SQL cannot
express, so ``ORACLE_SQL`` is None; tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import decontaminate, mixing, near_dedup, quality, sharding
from inkwell.llm._scratch import materialize

# Toxic text is thinned to at most this share of the words; all clean text stays, once.
MIX_TARGETS = {"clean": 0.975, "toxic": 0.025}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, mixing.label_domain(_table(spark, sf_dir, "labels")), MIX_TARGETS,
                                keep="clean")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("near duplicates", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing to targets", mix),
    ("sharding", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
