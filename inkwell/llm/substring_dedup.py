"""Removal of long word sequences that occur more than once in a corpus.

De Bruijn compaction
--------------------
Every window of ``length`` consecutive words is an edge of a De Bruijn graph;
a text is a walk through it.  A walk is cut into *paths* at content-defined
nodes, each path is compacted to one row (its label is a 96-bit hash of all
its words), and equal paths meet in one Spark aggregation:

1. ``paths``: the node of an edge is the leftmost least k-mer (k = 8 words)
   among those inside its window, so equal edges have equal nodes.  Consecutive
   edges with one node form a run; a path begins at a run whose node hash is
   divisible by ``RUNS_PER_PATH``, and at the first window of a text.
2. Paths with equal labels are compacted to one.  A path that occurs twice is
   nonbranching and repeated as a whole: all of its words go, without a row
   per window.
3. The remaining edges can only repeat where their node occurs in two of the
   *distinct* paths.  Nodes are counted over distinct paths and joined back;
   only the windows of such nodes are expanded from the source coordinates
   (text, first window), hashed to 96 bits, and counted.  A path that
   repeats stands in with weight two, once, however often it occurs.
4. Spans that repeat go back to their source coordinates, are united, and are
   cut from the text.

Windows are judged on the input; a run of any number of copies costs one
aggregated row per path.  Nothing is capped: a passage that a third of all
texts share is counted with map-side aggregation and joined by hash.

Edge cases: a NULL text has no words; a text with fewer than ``length`` words
has no window and stays whole; repeated rows (same id, same text) are two
occurrences and repeat each other; an empty table gives an empty result; other
columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import _tokens as T
from inkwell.llm._scratch import materialize, ship

WINDOW_WORDS = 35
NODE_WORDS = 8
RUNS_PER_PATH = 6

_PATHS = "key binary, start int, n int, hi long, lo int, nodes array<long>"
_EDGES = "key binary, start int, fresh boolean, hi long, lo int"


def _walk(hashes: np.ndarray, offsets: np.ndarray, length: int):
    """Valid window starts, the position of each window's node, and k-mer hashes."""
    k = min(NODE_WORDS, length)
    grams = T.Rolling(hashes).windows(k)
    n = len(hashes) - length + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, grams
    span = length - k + 1          # k-mers inside a window
    at, size = np.arange(len(grams)), 1
    while size < span:             # least of `size` k-mers, doubled; ties: leftmost
        step = min(size, span - size)
        left, right = at[:-step], at[step:]
        at = np.where(grams[right] < grams[left], right, left)
        size += step
    starts = np.arange(n)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    starts = starts[starts + length <= ends]
    return starts, at[starts], grams


def _labels(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (T.Rolling(hashes, T.M1).ranges(start, end).view(np.int64),
            (T.Rolling(hashes, T.M2).ranges(start, end) >> T.U64(32)).astype(np.uint32).view(np.int32))


def _paths(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = T.WordHashes()
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("key")
            for a, b in T.slices(texts):
                _, h, offsets = T.hash_slice(cache, texts[a:b])
                starts, node, grams = _walk(h, offsets, length)
                if not len(starts):
                    continue
                doc = np.searchsorted(offsets, starts, side="right") - 1
                fresh = np.r_[True, (node[1:] != node[:-1])]
                first = np.r_[True, doc[1:] != doc[:-1]]
                runs = np.flatnonzero(fresh | first)
                cut = first[runs] | (T.mix(grams[node[runs]] + T.U64(1)) % T.U64(RUNS_PER_PATH) == 0)
                heads = np.flatnonzero(cut)                      # runs that begin a path
                begin = runs[heads]
                count = np.diff(np.r_[begin, len(starts)])
                s = starts[begin]
                hi, lo = _labels(h, s, s + count + length - 1)
                nodes = pa.ListArray.from_arrays(pa.array(np.r_[heads, len(runs)], pa.int32()),
                                                 pa.array(grams[node[runs]].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a).take(pa.array(doc[begin])),
                     pa.array((s - offsets[doc[begin]]).astype(np.int32)),
                     pa.array(count.astype(np.int32)), pa.array(hi), pa.array(lo), nodes],
                    names=["key", "start", "n", "hi", "lo", "nodes"])
    return run


def _edges(length: int):
    """Expand the windows whose node is listed, from (text, listed paths)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = T.WordHashes()
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("key")
            listed = batch.column("listed").to_pylist()
            for i, text in enumerate(texts):
                _, h, offsets = T.hash_slice(cache, [text])
                starts, node, grams = _walk(h, offsets, length)
                picked, fresh = [], []
                for p in listed[i]:
                    w = np.arange(p["start"], p["start"] + p["n"])
                    known = np.array(p["nodes"], np.int64).view(T.U64)
                    w = w[np.isin(grams[node[w]], known)]
                    picked.append(w)
                    fresh.append(np.full(len(w), p["fresh"]))
                s = np.concatenate(picked)
                hi, lo = _labels(h, s, s + length)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(i, 1).take(pa.array(np.zeros(len(s), np.int32))),
                     pa.array(s.astype(np.int32)), pa.array(np.concatenate(fresh)), pa.array(hi), pa.array(lo)],
                    names=["key", "start", "fresh", "hi", "lo"])
    return run


def _cut(length: int, keep_text: bool, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept_texts, n_words, n_removed, digest, spans_out = [], [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = T.split_words(text)
                edge = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    edge[s["start"]] += 1
                    edge[s["start"] + s["n"] + length - 1] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                flips = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(kept).hexdigest())
                spans_out.append([{"start": int(x), "end": int(y)} for x, y in zip(flips[::2], flips[1::2], strict=True)])
                kept_texts.append(kept.decode("utf-8", "surrogatepass") if keep_text else None)
            out = [batch.column(c) for c in columns]
            out += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest),
                    pa.array(spans_out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            names = [*columns, "n_words", "n_removed", "kept_sha256", "removed_spans"]
            if keep_text:
                out.append(pa.array(kept_texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def remove_repeats(docs: DataFrame, length: int = WINDOW_WORDS, id_col: str = "doc_id",
                   text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Cut every word that lies in a ``length``-word window occurring elsewhere.

    Returns one row per input row: the id, ``n_words``, ``n_removed``,
    ``kept_sha256`` (of the kept words joined by one space),
    ``removed_spans`` (array of word ranges, end exclusive) and, with
    ``keep_text``, ``kept_text``.
    """
    if length < 1:
        raise ValueError("length must be positive")
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("text"), F.unhex(F.md5(text)).alias("key"))

    paths = materialize(rows.select("key", "text").mapInArrow(_paths(length), _PATHS), "paths")
    distinct = materialize(
        paths.groupBy("hi", "lo", "n").agg(F.count("*").alias("copies"),
                                           F.min(F.struct("key", "start")).alias("at"),
                                           F.any_value("nodes").alias("nodes"))
             .select("hi", "lo", "n", "copies", "at.key", "at.start", "nodes"), "distinct-paths")
    # copies of a text bear the same spans: one row for each
    whole = (paths.select("key", "start", "n", "hi", "lo")
             .join(distinct.filter("copies > 1").select("hi", "lo", "n"), ["hi", "lo", "n"])
             .groupBy("key", "start").agg(F.max("n").alias("n")))

    nodes = distinct.select("key", "start", "n", (F.col("copies") == 1).alias("fresh"), F.explode("nodes").alias("node"))
    common = nodes.groupBy("node").agg(F.count("*").alias("times")).filter("times > 1").select("node")
    listed = (nodes.join(common, "node")
              .groupBy("key", "start", "n", "fresh").agg(F.collect_set("node").alias("nodes"))
              .groupBy("key").agg(F.collect_list(F.struct("start", "n", "fresh", "nodes")).alias("listed")))
    # one row per distinct text is expanded
    texts = rows.join(listed, "key").select("key", "text", "listed").dropDuplicates(["key"])
    edges = materialize(texts.mapInArrow(_edges(length), _EDGES), "edges")
    repeated = (edges.groupBy("hi", "lo").agg(F.sum(F.when(F.col("fresh"), 1).otherwise(2)).alias("times"))
                .filter("times > 1").select("hi", "lo"))
    single = edges.filter("fresh").join(repeated, ["hi", "lo"]).select("key", "start", F.lit(1).alias("n"))

    # dealt by text before the lists are made: a text's spans come in few rows from many places
    spans = (whole.unionByName(single).repartition("key")
             .groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    out = rows.join(spans, "key", "left").select("_id", "text", "spans")
    schema = (f"_id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string, "
              "removed_spans array<struct<start:long,end:long>>" + (", kept_text string" if keep_text else ""))
    return out.mapInArrow(_cut(length, keep_text, ["_id"]), schema).withColumnRenamed("_id", id_col)
