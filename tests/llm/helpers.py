"""Fixtures for the training-data operators: rows with every awkward case."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, node string, key string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def awkward_texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, exact copies, near copies, shared passages, self repeats, one very long text."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    base = prose(rng, 120)
    near = base.split()
    near[50] = "changed"
    rows: list[tuple[int | None, str | None]] = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "One"), (9, "one two"),
        (10, prose(rng, 40) + " " + shared + "\n" + prose(rng, 30)), (11, shared + " " + prose(rng, 80)),
        (12, prose(rng, 20) + "\t" + shared), (13, prose(rng, 35) + " x " + prose(rng, 1)), (14, (prose(rng, 36) + " ") * 2),
        (15, "a " * 300), (16, "naïve   café " * 30), (17, prose(rng, 5000)), (None, prose(rng, 50)), (None, base),
        (18, prose(rng, 34)), (19, prose(rng, 35)), (20, base), (20, base)]
    rows += [(20, " ".join(w if i % 9 else "other" for i, w in enumerate(base.split())))]
    rows += [(100 + i, " ".join(w if rng.random() > 0.02 else "edit" for w in base.split())) for i in range(25)]
    rows += [(200 + i, prose(rng, rng.randrange(1, 90))) for i in range(30)]
    return rows


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (doc_id, text) with the other columns of documents and some whose names the operators use inside."""
    return spark.createDataFrame([(d, t, None, None, len(t or ""), 1, "n", "k") for d, t in rows], SCHEMA).repartition(3)
