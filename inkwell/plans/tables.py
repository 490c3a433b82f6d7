"""Loading the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Tables whose rows carry CPU-heavy row-local work (regex over whole texts,
# JSON parsing, session building).
SPREAD = {"documents", "pages", "conversations", "events"}


# Session setting: deal the rows of those tables to so many partitions after the
# pruned scan (for files of few row groups).  Unset: as the scan splits them.
SCAN_PARTITIONS = "spark.inkwell.scanPartitions"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(parts)) if parts and name in SPREAD else df
