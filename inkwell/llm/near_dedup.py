"""Near-duplicate documents: MinHash, banding, verification, components.

Each text becomes the set of its distinct word shingles.  ``BANDS * ROWS``
universal hash functions ``a*x + b mod 2**64`` (a odd) give minima; four
minima form a band, and texts that share a band are candidates.  Candidates
are rated on the first 16 bits of all minima (a pair at the threshold falls
more than ``SLACK`` below it, five deviations, with probability about 1e-6), and the ones left are confirmed on
the full shingle sets of the texts themselves.  A pair at similarity 0.8 shares no
band with probability (1 - 0.8**4)**25 = 2e-6.  Components come from
alternating large-star and small-star (``components.py``), labelled by the
least doc_id.

Texts with equal sets are one node, so a group of exact copies of any size
costs one node; a group of near copies is joined through the stars of its
buckets (see ``components.link``) and never expanded into pairs.  Pairs across
components are only made where they can still link.  The sets left there are
ordered from the rarest shingle to the commonest; similar sets share one of
their first shingles, and if the first shared one stands at places i and j, the
sets share at most ``min(n - i, m - j)``.  The join tests that bound, which is exact.

Edge cases: letters A-Z are lower-cased, nothing else is changed.  A NULL,
empty or blank text has no shingle and links with nothing; a text with fewer
words than a shingle has one shingle, the whole sequence.  Repeated rows (same
id, same text) get equal result rows; rows that share an id but not their text
are judged by their own texts (sets named by the same least id are one node).
A NULL doc_id cannot stand for a
component: such a row takes the component of its equals, or NULL and
``kept = true`` where it has none.  Ties go to the least doc_id.  An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm import _tokens as T
from inkwell.llm._columns import set_aside
from inkwell.llm._scratch import materialize, ship
from inkwell.llm.components import link, shared_buckets

BANDS, ROWS = 25, 4
SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
SLACK = 0.2
SEED = 20_240_501
# Shingles per block of the (functions x shingles) matrix.
BLOCK = 2048

_SIGNATURE = "doc_id long, text_key long, n long, hi long, lo long, bands array<long>, minima binary"
_ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(cache: T.WordHashes, text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = T.encode(text).translate(_ASCII_LOWER).split()
    if not words:
        return np.zeros(0, T.U64)
    h = cache.of(words)
    if len(words) < width:       # the whole sequence, apart from any real shingle
        return T.mix(T.Rolling(h, T.M2).windows(len(words)) + T.U64(len(words)))
    return np.unique(T.Rolling(h).windows(width))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(SEED))
    a = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * T.U64(2) + T.U64(1)
    return a[:, None], rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)[:, None]


def minima(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = functions
    least = np.full(len(a), T.MASK, T.U64)
    for i in range(0, len(shingles), BLOCK):
        np.minimum(least, (a * shingles[None, i:i + BLOCK] + b).min(axis=1), out=least)
    return least


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, functions = T.WordHashes(), _functions()
        salt = T.mix(np.arange(1, BANDS + 1, dtype=T.U64))
        for batch in batches:
            n, hi, lo, bands, mins = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_hashes(cache, text, width)
                least = minima(s, functions)
                n.append(len(s))
                hi.append(int(T.mix(s).sum(dtype=T.U64).view(np.int64)))
                lo.append(int(T.mix(s ^ T.U64(T.M1)).sum(dtype=T.U64).view(np.int64)))
                key = salt.copy()
                for column in least.reshape(BANDS, ROWS).T:
                    key = T.mix(key * T.U64(T.M1) + column)
                bands.append(key.view(np.int64) if len(s) else None)
                mins.append((least >> T.U64(48)).astype(np.uint16).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(mins, pa.binary())],
                names=["doc_id", "text_key", "n", "hi", "lo", "bands", "minima"])
    return run


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lanes(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BANDS * ROWS)
    for batch in batches:
        same = (lanes(batch.column("ma")) == lanes(batch.column("mb"))).mean(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same)], names=["a", "b", "score"])


def _exact(width: int, percent: int):
    """Pairs whose full sets are similar enough; shingles are compared as words, not as hashes."""
    def shingles(text: str) -> set:
        words = T.encode(text).translate(_ASCII_LOWER).split()
        if len(words) < width:
            return {tuple(words)}
        return set(zip(*(words[i:] for i in range(width)), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                p, q = shingles(x), shingles(y)
                both = len(p & q)
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _shingle_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = T.WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in T.slices(texts):
                sets = [shingle_hashes(cache, t, width) for t in texts[a:b]]
                node = np.repeat(np.arange(b - a), [len(s) for s in sets])
                # texts under one id are told apart
                text = np.array([T.xxhash.xxh3_64_intdigest(T.encode(t)) for t in texts[a:b]], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a).take(pa.array(node)), pa.array(text[node]),
                     pa.array(np.concatenate(sets).view(np.int64))], names=["node", "text", "shingle"])
    return run


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every input row."""
    return (_judged(docs, width, percent, id_col, text_col)
            .select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", "kept"))


def _judged(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    if width < 1 or not 0 < percent <= 100:
        raise ValueError("width must be positive and percent in 1..100")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    signed = materialize(rows.mapInArrow(_signatures(width), _SIGNATURE), "signatures")

    # one node per distinct shingle set, named by its least doc_id
    nodes = materialize(
        signed.filter("n > 0").groupBy("hi", "lo", "n")
        .agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("at"), F.any_value("bands").alias("bands"), F.any_value("minima").alias("minima"))
        .filter("at is not null").select("hi", "lo", "n", F.col("at.doc_id").alias("node"), "at.text_key", "bands", "minima"), "nodes")
    shared = shared_buckets(nodes.select("node", F.explode("bands").alias("key")), "near")
    side = nodes.select("node", "n", "minima")
    # texts that can be asked for: those of nodes that share a bucket
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("doc_id"), "text_key")
    texts = materialize(rows.join(wanted, ["doc_id", "text_key"], "left_semi").select("doc_id", "text")
                        .dropDuplicates(["doc_id", "text"]), "texts")

    def score(pairs: DataFrame) -> DataFrame:
        a = side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("minima").alias("ma"))
        b = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("minima").alias("mb"))
        sized = (pairs.join(a, "a").join(b, "b")
                 .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
        rated = sized.select("a", "b", "ma", "mb").mapInArrow(_agreement, "a long, b long, score double")
        return rated.filter(F.col("score") >= percent / 100 - SLACK)

    def confirm(pairs: DataFrame) -> DataFrame:
        return (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
                .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
                .select("a", "b", "ta", "tb").mapInArrow(_exact(width, percent), "a long, b long").distinct())

    def prefixes(left: DataFrame) -> DataFrame:
        shingles = materialize(texts.join(left.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
                               .mapInArrow(_shingle_rows(width), "node long, text long, shingle long"), "shingles")
        times = shingles.groupBy("shingle").agg(F.count("*").alias("times"))
        order = Window.partitionBy("node", "text").orderBy("times", "shingle")
        ranked = (shingles.join(times, "shingle").withColumn("i", F.row_number().over(order) - 1)
                  .withColumn("n", F.count("*").over(Window.partitionBy("node", "text"))))
        # a similar set holds percent of this one's shingles, so one of the first places is shared
        return (ranked.filter((F.col("times") > 1) & (100 * (F.col("n") - F.col("i")) >= percent * F.col("n")))
                .select(F.col("shingle").alias("key"), "node", F.struct("n", "i").alias("f")))

    def possible(x, y):
        return ((100 + percent) * F.least(x["n"] - x["i"], y["n"] - y["i"]) >= percent * (x["n"] + y["n"])) & (
            100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))

    groups = link(shared, score, confirm, "near", possible, prefixes)
    classes = (nodes.join(groups, "node", "left")
               .select("hi", "lo", "n", F.coalesce("component", "node").alias("component_id")))
    return (signed.select("doc_id", "text_key", "n", "hi", "lo").join(classes, ["hi", "lo", "n"], "left")
            .select("doc_id", "text_key", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``docs`` with one document of each group (the least doc_id); all columns, whatever their names.

    A repeated row of the document that stays is dropped too; a document
    without words stays, and so do rows with a NULL doc_id, which nothing can
    name.
    """
    docs, own = set_aside(docs, "doc_id", "text")
    kept = (_judged(docs, width, percent, "doc_id", "text").filter("kept and doc_id is not null")
            .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct())
    named = docs.join(kept, (docs.doc_id == F.col("_id")) & (F.xxhash64(docs.text) == F.col("_key")), "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null")).select(*own)
