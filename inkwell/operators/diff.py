"""Draft / final comparison: which sentences the editor kept, removed and
added, and how length changed.  Row-local on each pair — no shuffle beyond
the pairing join itself.  ``draft_final_diff`` compares the versions as sets,
``draft_final_alignment`` in order and with repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import split_sentences


def _mean_len(arr: Column) -> Column:
    total = F.aggregate(arr, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x))
    return F.when(F.size(arr) > 0, total / F.size(arr))


def draft_final_diff(pairs: DataFrame, key: str = "dir", v1: str = "v1", v2: str = "v2") -> DataFrame:
    """Per pair: distinct sentence counts of both versions, kept / removed /
    added (set algebra, so kept + removed = n_v1), the length ratio
    v2 / v1 in characters and the change of the mean sentence length."""
    s1 = split_sentences(v1)
    s2 = split_sentences(v2)
    d1 = F.array_distinct(s1)
    d2 = F.array_distinct(s2)
    return pairs.select(
        F.col(key),
        F.size(d1).cast("long").alias("n_v1"),
        F.size(d2).cast("long").alias("n_v2"),
        F.size(F.array_intersect(d1, d2)).cast("long").alias("kept"),
        F.size(F.array_except(d1, d2)).cast("long").alias("removed"),
        F.size(F.array_except(d2, d1)).cast("long").alias("added"),
        F.when(F.length(v1) > 0, F.length(v2) / F.length(v1)).alias("length_ratio"),
        (_mean_len(s2) - _mean_len(s1)).alias("mean_sentence_len_change"),
    )


def _common_length():
    """Two arrays of sentence hashes -> the length of their longest common subsequence.

    A row of the dynamic programme is one big integer whose zero bits mark where
    the length grows, so a sentence costs a few integer operations and not one
    step per sentence of the other version.
    """
    def common(left, right):
        import pandas as pd

        def of(a, b):
            if a is None or b is None:
                return None
            where: dict = {}
            for i, x in enumerate(a):
                where[x] = where.get(x, 0) | 1 << i
            full = (1 << len(a)) - 1
            row = full
            for x in b:
                met = row & where.get(x, 0)
                row = (row + met | row - met) & full
            return len(a) - row.bit_count()

        return pd.Series([of(a, b) for a, b in zip(left, right, strict=True)], dtype="Int64")

    common.__annotations__ = {}
    return F.pandas_udf(common, "long", F.PandasUDFType.SCALAR)


def draft_final_alignment(pairs: DataFrame, key: str = "dir", v1: str = "v1", v2: str = "v2") -> DataFrame:
    """Per pair: sentences of both versions, those kept in their order (longest
    common subsequence; a repeated sentence counts as often as it is kept),
    removed, added, and moved: kept as a multiset but not in order.

    kept + removed = n_v1 and kept + added = n_v2.  A NULL version gives NULL
    counts of what needs it; an empty one has no sentence.
    """
    arrays = pairs.select(F.col(key), split_sentences(v1).alias("_s1"), split_sentences(v2).alias("_s2"))
    hashed = arrays.select(key, *[F.transform(c, lambda x: F.xxhash64(x)).alias(c) for c in ("_s1", "_s2")])
    aligned = hashed.withColumn("kept", _common_length()("_s1", "_s2"))
    n1, n2 = F.array_size("_s1").cast("long"), F.array_size("_s2").cast("long")
    # sentences in common as a multiset: both versions sorted have it as their common subsequence
    shared = _common_length()(F.array_sort("_s1"), F.array_sort("_s2"))
    return (aligned.withColumn("_shared", shared)
            .select(key, n1.alias("n_v1"), n2.alias("n_v2"), "kept", (n1 - F.col("kept")).alias("removed"),
                    (n2 - F.col("kept")).alias("added"), (F.col("_shared") - F.col("kept")).alias("moved")))
