"""Quality classifier: hashed word n-grams, logistic regression, FTRL.

A text's features are its word n-grams (n = 1, 2), hashed into ``SLOTS`` slots,
once as written and once as shapes (runs of lower case, upper case, digits;
other signs as they are), so that unseen words count too; a pair of shapes also
says whether it repeats one word.  Each occurrence counts ``1 / n`` of ``SCALE``
(n = occurrences), so a score depends on shares, not on length.  The model is trained by
follow-the-regularised-leader updates (per-coordinate step sizes, L1 and L2):
the labelled sample is dealt to ``LEARNERS`` learners by a hash of the id,
each runs over its documents in hash order, and the weights are averaged.  A
score is one sparse dot product and a logistic link.

Bounds: at most ``TRAIN_ROWS`` labelled rows are learned from (those with the
least hash of their id); the model has ``SLOTS`` numbers.  Scoring covers every
whole text and reads nothing but the text.

Edge cases: a NULL or blank text has no features and scores by the intercept;
labels other than 0 and 1, NULL labels and labels of unknown ids are ignored;
an id labelled both ways is learned from both rows; without labelled rows every score is
0.5; repeated rows score alike; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import _tokens as T
from inkwell.llm._scratch import ship

SLOTS = 1 << 18
SCALE = 64.0
TRAIN_ROWS = 16_384
LEARNERS = 8
PASSES = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 0.01
CUTOFF = 0.3


_SHAPE = [(re.compile(r"[^\W\d_]*[a-z\u00df-\uffff][^\W\d_]*"), "a"), (re.compile(r"[A-Z\u00c0-\u00de]+"), "A"), (re.compile(r"\d+"), "0")]


class Shapes(T.WordHashes):
    """word -> hash of its shape; a leading capital is kept apart from a word in capitals."""

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        shape = "^" if text[:1].isupper() else ""
        for pattern, sign in _SHAPE:
            text = pattern.sub(sign, text)
        value = self[word] = T.xxhash.xxh3_64_intdigest((shape + text).encode())
        return value


class Features:
    """Slots of the n-grams of one word sequence (several texts may follow one another)."""

    def __init__(self):
        self.words, self.shapes = T.WordHashes(), Shapes()

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots by word (2 x n) and by pair with the next word (2 x n-1)."""
        h, s = self.words.of(words), self.shapes.of(words)
        repeat = (h[:-1] == h[1:]).astype(T.U64)
        single = np.stack([T.mix(h), T.mix(s + T.U64(1))])
        pair = np.stack([T.mix(h[:-1] * T.U64(T.M1) + h[1:] * T.U64(T.M2)),
                         T.mix(s[:-1] * T.U64(T.M2) + s[1:] * T.U64(T.M1) + repeat)])
        return (single % T.U64(SLOTS)).astype(np.int64), (pair % T.U64(SLOTS)).astype(np.int64)


def sparse(features: Features, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and values of one text, with the intercept."""
    words = T.split_words(text)
    slots = np.concatenate([x.ravel() for x in features.of(words)])
    at, count = np.unique(slots, return_counts=True)
    return np.r_[at, SLOTS], np.r_[count * (SCALE / max(1, len(slots))), 1.0]


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """Follow-the-regularised-leader for one logistic model; the last slot is the intercept."""

    def __init__(self, slots: int = SLOTS):
        self.z = np.zeros(slots + 1)
        self.n = np.zeros(slots + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == len(self.z) - 1, 0.0, L1)
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - label) * x
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def _train(group: pd.DataFrame) -> pd.DataFrame:
    features, model = Features(), Ftrl()
    group = group.sort_values(["turn", "doc_id", "label"])
    rows = [(*sparse(features, t), y) for t, y in zip(group["text"], group["label"], strict=True)]
    for _ in range(PASSES):
        for at, x, y in rows:
            model.learn(at, x, y)
    w = model.weights(np.arange(SLOTS + 1))
    at = np.flatnonzero(w)
    return pd.DataFrame({"slot": at, "weight": w[at]})


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS) -> np.ndarray:
    """Average weights of the learners (``SLOTS + 1`` numbers, the last the intercept)."""
    ship(docs.sparkSession)
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .filter("doc_id is not null and label in (0, 1)").distinct()
              .withColumn("turn", F.xxhash64("doc_id", F.lit(7)))
              .orderBy("turn", "doc_id", "label").limit(rows))
    # at most `rows` rows of three numbers: bounded, so the texts stay where they are
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    learned = (texts.join(F.broadcast(sample), "doc_id")
               .withColumn("learner", F.pmod("turn", F.lit(LEARNERS)))
               .groupBy("learner").applyInPandas(_train, "slot long, weight double"))
    out = np.zeros(SLOTS + 1)
    # every learner sends at most SLOTS + 1 numbers; a learner without rows counts as zeros
    model = learned.groupBy("slot").agg((F.sum("weight") / LEARNERS).alias("weight")).toPandas()
    out[model["slot"].to_numpy(np.int64)] = model["weight"].to_numpy(float)
    return out


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights = Features(), model.value
        for batch in batches:
            texts, out = batch.column("text").to_pylist(), []
            for a, b in T.slices(texts):
                words = [T.split_words(t) for t in texts[a:b]]
                n = np.array([len(w) for w in words])
                single, pair = features.of([w for ws in words for w in ws])
                own = weights[single].sum(axis=0)
                if len(own):
                    end = np.cumsum(n)
                    both = np.r_[weights[pair].sum(axis=0), 0.0]
                    both[end[n > 0] - 1] = 0.0       # a pair may not span two texts
                    sums = np.r_[0.0, np.cumsum(own + both)]
                    dot = sums[end] - sums[end - n]
                else:
                    dot = np.zeros(len(n))
                out.append(sigmoid(dot * SCALE / np.maximum(1, 4 * n - 2) + weights[SLOTS]))
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, score double")


def held_out(doc_id) -> F.Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= cutoff)."""
    weights = train(docs, labels.filter(~held_out("doc_id")))
    return score(docs, weights).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= cutoff, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that score at least ``cutoff``; all columns.  The scores ride along in the same pass."""
    weights = train(docs, labels.filter(~held_out("doc_id")))
    model = docs.sparkSession.sparkContext.broadcast(weights)
    scorer = _score(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for scored in scorer(iter([batch])):
                keep = scored.column("score").to_numpy() >= cutoff
                yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)
