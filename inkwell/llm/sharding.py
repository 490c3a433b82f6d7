"""Sharding by sampled splitters.

Records are ordered by (hash of the text, doc_id), so equal texts are
neighbours, and the order is cut into shards of nearly equal bytes:

1. ``draw``: a size-weighted sample of keys.  Each record gets the priority
   ``-ln(u) / size`` with u from a hash of its key; the least priorities are a
   sample without replacement in which large records are likelier.  The sample
   holds ``SAMPLES_PER_RANGE`` keys per range (a fixed number of ranges, so a
   bounded collect).
2. The sample's quantiles are the splitters of fine ranges.
3. Ranges with more than ``OVERFULL`` times their share of bytes are
   subdivided by a further draw inside them, until none is left (a range of one
   record cannot be cut).
4. Each range is a window of its own: running bytes and row numbers, plus the
   totals of the ranges before it (one row per range), place every record
   exactly.  The shard is the one that holds the record's middle byte, so shard
   sizes differ from the mean by less than one record.

A group of equal texts that holds a third of all bytes is cut across ranges by
doc_id like any other stretch of the order.

Edge cases: a NULL or empty text has size 1; NULL doc_ids come first; repeated
rows are separate records in neighbouring slots; an empty table gives an empty
result; extra columns are kept by ``shard_documents`` unless they bear the name
of a result column, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm._columns import set_aside
from inkwell.llm._scratch import materialize, ship

SHARDS = 8
RANGES = 128
SAMPLES_PER_RANGE = 32
OVERFULL = 2.0


def records(docs: DataFrame) -> DataFrame:
    """Narrow table of the records: size, checksum and the order's key."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key"))


def draw(rows: DataFrame, n: int, round_no: int) -> list[tuple[int, int]]:
    """Size-weighted sample of (key, doc_id) without replacement, sorted; at most ``n``."""
    # 53 bits of the hash make a number in (0, 1)
    u = (F.shiftrightunsigned(F.xxhash64("key", "doc_id", F.lit(round_no)), 11) + 1) / F.lit(float(2 ** 53 + 1))
    sample = (rows.select("key", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("doc_id"), (-F.log(u) / F.col("size")).alias("p"))
              .orderBy("p", "key", "doc_id").limit(n).select("key", "doc_id").toPandas())
    return sorted(zip(sample["key"].tolist(), sample["doc_id"].tolist(), strict=True))


def quantiles(sample: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """n - 1 splitters at equal steps of a sorted sample."""
    return [sample[i * len(sample) // n] for i in range(1, n)] if sample else []


def ranged(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with ``part``: how many splitters are at or below the record's (key, doc_id)."""
    keys = np.array([k for k, _ in splitters], np.int64)
    ids = np.array([d for _, d in splitters], np.int64)
    schema = rows.schema.simpleString()[len("struct<"):-1] + ",part:int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            doc = np.array([-2 ** 63 if d is None else d for d in batch.column("doc_id").to_pylist()], np.int64)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            part = low.copy()
            for i in np.flatnonzero(high > low):        # the key itself is split: by doc_id
                part[i] = low[i] + np.searchsorted(ids[low[i]:high[i]], doc[i], "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))],
                                             names=[*batch.schema.names, "part"])
    return rows.mapInArrow(run, schema)


def place(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, key, shard, slot."""
    if shards < 1 or ranges < 1:
        raise ValueError("shards and ranges must be positive")
    ship(docs.sparkSession)
    rows = materialize(records(docs), "records")
    splitters = sorted(set(quantiles(draw(rows, ranges * SAMPLES_PER_RANGE, 0), ranges)))
    totals: list = []
    for number in count(1):                 # every turn adds a splitter or ends
        parts = ranged(rows, splitters)
        totals = sorted(parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"),
                                                  F.countDistinct("key", F.coalesce("doc_id", F.lit(-2 ** 63))).alias("keys"))
                        .collect())
        share = sum(t["bytes"] for t in totals) / ranges
        full = [t for t in totals if t["bytes"] > OVERFULL * share and t["keys"] > 1]
        if not full:
            break
        more = set(splitters)
        for t in full:
            pieces = int(t["bytes"] / share) + 1
            more |= set(quantiles(draw(parts.filter(F.col("part") == t["part"]), pieces * SAMPLES_PER_RANGE, number), pieces))
        if len(more) == len(splitters):
            break
        splitters = sorted(more)

    # totals of the ranges before each range: one entry per range
    bytes_before, rows_before, a, b = {}, {}, 0, 0
    for t in totals:
        bytes_before[t["part"]], rows_before[t["part"]] = a, b
        a, b = a + t["bytes"], b + t["n"]
    if not totals:
        return rows.select("doc_id", "size", "text_crc32", "key", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    at = lambda d: F.element_at(F.create_map(*[F.lit(int(x)).cast("long") for kv in d.items() for x in kv]), F.col("part").cast("long"))
    inside = Window.partitionBy("part").orderBy("key", F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    ahead = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = materialize(
        ranged(rows, splitters)
        .withColumn("end", at(bytes_before) + F.sum("size").over(ahead))
        .withColumn("row", at(rows_before) + F.row_number().over(inside) - 1)
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor((F.col("end") - F.col("size") / 2) * shards / F.lit(float(a))))
                    .cast("int")).select("doc_id", "size", "text_crc32", "key", "shard", "row"), "ordered")
    first = {r["shard"]: r["first"] for r in ordered.groupBy("shard").agg(F.min("row").alias("first")).collect()}
    start = F.element_at(F.create_map(*[F.lit(int(x)).cast("long") for kv in first.items() for x in kv]), F.col("shard").cast("long"))
    return ordered.select("doc_id", "size", "text_crc32", "key", "shard", (F.col("row") - start).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``.  Repeated rows keep their number of slots.

    Rows of one id and text take their slots in the order of their other columns,
    so that a recomputed task deals them alike; rows that are equal throughout are
    interchangeable.
    """
    rows, own = set_aside(docs.drop("shard", "slot"), "doc_id", "text")
    placed = place(rows, shards)
    same = Window.partitionBy("doc_id", "key").orderBy("slot")
    slots = (placed.withColumn("copy", F.row_number().over(same))
             .select(F.col("doc_id").alias("id"), F.col("key").alias("its_key"), F.col("copy").alias("its_copy"), "shard", "slot"))
    others = [c for c in rows.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit(0)
    rows = rows.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "key").orderBy(order)))
    joined = rows.join(slots, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("its_key")) & (F.col("copy") == F.col("its_copy")))
    return joined.select(*own, "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, records in slot order within each file."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
