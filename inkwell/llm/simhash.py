"""SimHash fingerprints and permuted block tables.

Terms are a text's words and word pairs.  A term's weight is
``(1 + ln tf) * idf``; the document frequencies come from one pass over all
documents into ``DF_SLOTS`` hashed counters (a fixed size: 2**18 numbers,
whatever the corpus).  Every term hash votes with its weight on the 64 signed
bits; the fingerprint is the sign vector.  Under random signs two texts whose
weighted term vectors have cosine c agree on a share ``1 - acos(c)/pi`` of the
bits, so ``likeness = max(0, cos(pi * distance / 64))`` estimates c.

``near_fingerprints`` finds all fingerprints within a Hamming radius r by
permuted block tables: the 64 bits fall into r + 3 blocks, two fingerprints
within r agree on at least three of them, and there is one table per choice
of three blocks, keyed by their bits.  Equal fingerprints are one node and the
members of a bucket are linked through stars first (``components.link``), so
no bucket is expanded into all pairs.  ``link_counts`` counts every neighbour
within r: the pairs of a bucket are compared inside its task, as numbers, and
only sums per fingerprint leave it.  A bucket of more than ``CELL`` fingerprints
is cut into square cells of that side, so no task holds more of it.

Edge cases: a NULL or blank text has no terms and the fingerprint 0; NULL is
fingerprinted as the empty text.  Equal texts have equal fingerprints.
Documents are neighbours in ascending (doc_id, text) order, NULL ids first;
after the last comes the first, and a lone document is its own neighbour.
Repeated rows are separate documents with equal fingerprints, each a link of
the others; so are all texts without terms.  An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm import _tokens as T
from inkwell.llm._scratch import materialize, ship
from inkwell.llm.components import link, shared_buckets

BITS = 64
DF_SLOTS = 1 << 18
# Neighbouring slots that travel in one row.
SLOT_RUN = 256
RADIUS = 3
# Side of the cells that a bucket's comparisons are cut into.
CELL = 4096
# Low bits of a block key that hold the number of its table.
TABLE_BITS = 10
# Sampled ids per range when the documents are put into id order.
SAMPLES_PER_RANGE = 64


def term_counts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term hashes (words and word pairs) of one text and their counts."""
    pairs = T.mix(hashes[:-1] * T.U64(T.M1) + hashes[1:] * T.U64(T.M2))
    return np.unique(np.concatenate([hashes, pairs]), return_counts=True)


def _df_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = T.WordHashes()
    slots = np.zeros(DF_SLOTS, np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            terms, _ = term_counts(cache.of(T.split_words(text)))
            np.add.at(slots, np.unique(terms % T.U64(DF_SLOTS)).astype(np.int64), 1)
    runs = slots.astype(np.int32).reshape(-1, SLOT_RUN)
    some = np.flatnonzero(runs.any(axis=1)).astype(np.int32)
    counts = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * SLOT_RUN), pa.array(runs[some].ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(some), counts], names=["run", "counts"])


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Hashed document frequencies of all documents: ``DF_SLOTS`` numbers."""
    ship(docs.sparkSession)
    rows = (docs.select("text").mapInArrow(_df_pass, "run int, counts array<int>")
            .repartition("run").select("run", F.posexplode("counts"))
            .groupBy("run", "pos").agg(F.sum("col").alias("df")).toPandas())
    out = np.zeros(DF_SLOTS, np.int64)
    out[rows["run"].to_numpy(np.int64) * SLOT_RUN + rows["pos"].to_numpy(np.int64)] = rows["df"].to_numpy(np.int64)
    return out


def idf_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log((1.0 + n_docs) / (1.0 + df)).astype(np.float32) + np.float32(1e-3)


def fingerprint(cache: T.WordHashes, text: str | None, idf: np.ndarray) -> int:
    words = T.split_words(text)
    if not words:
        return 0
    terms, tf = term_counts(cache.of(words))
    weight = (1 + np.log(tf)).astype(np.float32) * idf[(terms % T.U64(len(idf))).astype(np.int64)]
    votes = np.zeros(BITS, np.float64)
    for i in range(0, len(terms), 16_384):
        bits = np.unpackbits(T.mix(terms[i:i + 16_384]).view(np.uint8).reshape(-1, 8), axis=1)
        votes += 2.0 * (weight[i:i + 16_384] @ bits) - weight[i:i + 16_384].sum(dtype=np.float64)
    return int(np.packbits(votes > 0).view(np.uint64)[0])


def likeness(a: int, b: int) -> float:
    return max(0.0, math.cos(math.pi * (a ^ b).bit_count() / BITS))


def fingerprints(docs: DataFrame, idf, cuts: list[int] | None = None) -> DataFrame:
    """``doc_id, tie, packed, fp, part``: the text compressed (all of them travel to their neighbours), its
    fingerprint and the number of ``cuts`` below the id (-1: no id).  ``docs``: doc_id, text, tie.
    """
    ship(docs.sparkSession)
    edges = np.array(cuts or [], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, pack = T.WordHashes(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            fps = [fingerprint(cache, t, idf.value) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array([pack.compress(T.encode(t)) for t in texts], pa.binary()),
                 pa.array(np.array(fps, np.uint64).view(np.int64)), range_numbers(batch.column("doc_id"), edges)],
                names=["doc_id", "tie", "packed", "fp", "part"])
    return docs.select("doc_id", "text", "tie").mapInArrow(run, "doc_id long, tie string, packed binary, fp long, part int")


def range_numbers(ids: pa.Array, edges: np.ndarray) -> pa.Array:
    """The number of edges below each id; -1 without one."""
    numbers = np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int32)
    return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), np.int32(-1), numbers))


def block_tables(radius: int) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """The blocks as (first bit, width) and the choices of three blocks, one per table."""
    n = radius + 3
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)], list(combinations(range(n), 3))


def block_keys(fp, radius: int = RADIUS):
    """One key per table of the permuted blocks: a hash of three blocks' bits above the table's number."""
    blocks, tables = block_tables(radius)
    bits = [F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)) for at, width in blocks]
    return F.array(*[F.shiftleft(F.xxhash64(*[bits[j] for j in chosen]), TABLE_BITS).bitwiseOR(F.lit(i).cast("long"))
                     for i, chosen in enumerate(tables)])


def _cell_links(radius: int):
    """Sorted cells -> per fingerprint and batch the documents within ``radius``.

    A pair shares up to all tables; it counts in the first one in which it agrees.
    """
    blocks, tables = block_tables(radius)
    masks = [np.uint64(((1 << width) - 1) << at) for at, width in blocks]
    chosen_masks = [masks[i] | masks[j] | masks[k] for i, j, k in tables]

    def count(rows: pa.Table) -> pa.RecordBatch:
        key, node, weight, row, column, side = (rows.column(c).to_numpy() for c in ("key", "node", "weight", "row", "column", "side"))
        fp, table, n = node.view(np.uint64), key & ((1 << TABLE_BITS) - 1), len(node)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (column[1:] != column[:-1])])
        end = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
        links, left, step = np.zeros(n, np.int64), np.arange(n), 1
        while len(left := left[left + step < end[left]]):
            other = left + step
            x = fp[left] ^ fp[other]
            near = (np.bitwise_count(x) <= radius) & ((row[left] == column[left]) | (side[left] != side[other]))
            a, b, x = left[near], other[near], x[near]
            first = np.full(len(x), -1)
            for i in range(len(tables) - 1, -1, -1):
                first[(x & chosen_masks[i]) == 0] = i
            a, b = a[first == table[a]], b[first == table[a]]
            links[a] += weight[b]
            links[b] += weight[a]
            step += 1
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some])], names=["fp", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # the last cell of a batch may go on in the next one
            cells = [batch.column(c).to_numpy() for c in ("key", "row", "column")]
            inner = np.flatnonzero(np.any([c != c[-1] for c in cells], axis=0))
            cut = int(inner[-1]) + 1 if len(inner) else 0
            if held and any(c[0] != held[-1].column(i)[-1].as_py() for i, c in zip(("key", "row", "column"), cells, strict=True)):
                yield count(pa.Table.from_batches(held))
                held = []
            if cut:
                yield count(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield count(pa.Table.from_batches(held))
    return run


def link_counts(shared: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """``fp, links``: the documents of other fingerprints within ``radius``; fingerprints without any are not listed.

    ``shared``: ``shared_buckets`` of (key, node, weight), where ``weight`` is the number of documents of a node.
    """
    ship(shared.sparkSession)
    wide = (shared.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > cell)
            .select("key", F.ceil(F.col("size") / cell).cast("int").alias("sides")))
    dealt = (shared.join(wide, "key", "left").withColumn("sides", F.coalesce("sides", F.lit(1)))
             .withColumn("side", F.pmod(F.xxhash64("node"), "sides").cast("int"))
             .withColumn("across", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
             .select("key", "node", "weight", F.least("side", "across").alias("row"), F.greatest("side", "across").alias("column"), "side"))
    cells = dealt.repartition("key", "row", "column").sortWithinPartitions("key", "row", "column")
    return cells.mapInArrow(_cell_links(radius), "fp long, links long").groupBy("fp").agg(F.sum("links").alias("links"))


def near_fingerprints(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per distinct ``fp`` of the documents' fingerprints ``fps``.

    ``near_class``: the least fingerprint reachable in steps of at most ``radius`` bits; ``n_links``: the
    other documents within ``radius`` bits, those of equal fingerprint included.  Keys only propose a pair;
    the distance is checked on the whole fingerprint.
    """
    nodes = fps.filter("fp is not null").groupBy("fp").agg(F.count("*").alias("weight"))

    def score(pairs: DataFrame) -> DataFrame:
        return (pairs.withColumn("score", BITS - F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
                .filter(F.col("score") >= BITS - radius))

    shared = shared_buckets(nodes.select(F.col("fp").alias("node"), "weight", F.explode(block_keys(F.col("fp"), radius)).alias("key")),
                            "simhash")
    within = lambda x, y: F.bit_count(x["node"].bitwiseXOR(y["node"])) <= radius
    groups = link(shared, score, lambda pairs: pairs, "simhash", within).withColumnRenamed("node", "fp")
    return (nodes.join(groups.hint("merge"), "fp", "left").join(link_counts(shared, radius), "fp", "left")
            .select("fp", F.coalesce("component", "fp").alias("near_class"),
                    (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))


def next_documents(docs: DataFrame, idf) -> DataFrame:
    """``doc_id, packed, fp`` of every document with ``next_packed`` and ``next_fp`` of the one that follows.

    The ids are cut into ranges at sampled quantiles and each range is a
    window of its own.  The last row of a range meets the first document of
    the next one through a join of one row per range.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares or [0.5], SAMPLES_PER_RANGE * parts).alias("c")).first()["c"]
    # only rows that share their id need their text for the order
    repeated = materialize(docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("again")), "repeated-ids")
    docs = (docs.join(repeated.withColumn("repeated", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("again")), "left")
            .select("doc_id", "text", F.when(F.col("repeated"), F.col("text")).alias("tie")))
    rows = fingerprints(docs, idf, sorted(set(cuts or [])))

    # the first id of each range, in the order of the ranges (one number per range)
    starts = [r["doc_id"] for r in _first_ids(docs, sorted(set(cuts or [])))]
    if not starts:
        return rows.select("doc_id", "packed", "fp", F.col("packed").alias("next_packed"), F.col("fp").alias("next_fp"))
    named = [x for x in starts if x is not None]
    chosen = F.col("doc_id").isin(named) if None not in starts else F.col("doc_id").isNull() | F.col("doc_id").isin(named)
    first = (fingerprints(docs.filter(chosen), idf, sorted(set(cuts or [])))
             .groupBy("part").agg(F.min(F.struct("doc_id", "tie", "packed", "fp")).alias("head")))
    numbers = sorted(-1 if x is None else int(np.searchsorted(np.array(sorted(set(cuts or [])), np.int64), x)) for x in starts)
    before = F.create_map(*[F.lit(x) for pair in zip(numbers, [numbers[-1], *numbers[:-1]], strict=True) for x in pair])
    heads = first.select(before[F.col("part")].alias("part"), "head.packed", "head.fp").toDF("part", "head_packed", "head_fp")

    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), F.col("tie"))
    ahead = (rows.withColumn("next_packed", F.lead("packed").over(order)).withColumn("next_fp", F.lead("fp").over(order))
             .join(heads, "part", "left"))
    return ahead.select("doc_id", "packed", "fp", F.coalesce("next_packed", "head_packed").alias("next_packed"),
                        F.coalesce("next_fp", "head_fp").alias("next_fp"))


def _first_ids(docs: DataFrame, cuts: list[int]) -> list:
    """The least id of each range (``None`` for the range of rows without an id)."""
    edges = np.array(cuts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays([ids, range_numbers(ids, edges)], names=["doc_id", "part"])
    return (docs.select("doc_id").mapInArrow(run, "doc_id long, part int")
            .groupBy("part").agg(F.min("doc_id").alias("doc_id")).collect())


def _compare(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, unpack = T.WordHashes(), zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, digests, edited_fps = [], [], []
            for packed, next_packed in zip(batch.column("packed").to_pylist(), batch.column("next_packed").to_pylist(), strict=True):
                text, after = (unpack.decompress(p).decode("utf-8", "surrogatepass") for p in (packed, next_packed))
                half = len(text) // 2
                edited = text[:len(text) - half] + after[:half]
                sizes.append(len(text))
                digests.append(hashlib.sha256(T.encode(edited)).hexdigest())
                edited_fps.append(fingerprint(cache, edited, idf.value))
            own = batch.column("fp").to_numpy().view(np.uint64).tolist()
            following = batch.column("next_fp").to_numpy().view(np.uint64).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("fp"), pa.array(sizes, pa.int64()), pa.array(digests),
                 pa.array([f"{x:016x}" for x in own]), pa.array([f"{x:016x}" for x in edited_fps]),
                 pa.array([likeness(a, b) for a, b in zip(own, edited_fps, strict=True)], pa.float64()),
                 pa.array([likeness(a, b) for a, b in zip(own, following, strict=True)], pa.float64())],
                names=["doc_id", "fp", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next"])
    return run


def fingerprint_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per document: fingerprint, likeness to its half-edited text and to the next document, near class,
    number of documents within ``radius`` bits."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    idf = spark.sparkContext.broadcast(idf_weights(document_frequencies(rows), rows.count()))
    ordered = next_documents(rows, idf)
    compared = materialize(ordered.mapInArrow(
        _compare(idf), "doc_id long, fp long, n_chars long, edited_sha256 string, fingerprint string, "
                       "edited_fingerprint string, near_edited double, near_next double"), "compared")
    classes = near_fingerprints(compared, radius)
    return compared.join(classes, "fp", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.lower(F.lpad(F.hex("near_class"), 16, "0")).alias("near_class"), "n_links")
