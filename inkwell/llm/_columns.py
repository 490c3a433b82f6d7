"""Callers' columns, kept apart from the names that operators use inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column but the ``used`` ones under a number, and the
    columns that give them back under their own names, in their order."""
    inner = [c if c in used else f"caller{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*inner), [F.col(a).alias(b) for a, b in zip(inner, docs.columns, strict=True)]
