"""Benchmark decontamination: BM25 over test items with block-max WAND.

1. Index.  A test item's question, its answer, and pieces of at most
   ``PIECE_WORDS`` words that overlap and cover all of it are the documents of
   a small BM25 index.  A posting weighs ``idf * tf part`` over the piece's own
   total, so a piece's score against itself is 1.  Terms and lengths are counted
   over the whole benchmark, so a score does not depend on the shards.  Items
   are dealt to index shards of about ``SHARD_PIECES`` pieces (a fixed size), which
   are built in tasks and searched ``PASS_SHARDS`` per pass over the documents, so
   the index may grow with the benchmark.  Inside a shard, pieces are ordered by their words and grouped into
   blocks of ``BLOCK_PIECES``; per term there is a list of the pieces that hold it, and
   one of the blocks with the greatest weight in each.
2. Retrieval.  A text's words, each term once, are scored against questions and
   answers.  A side is retrieved at its own least score: the least weight that
   ``OVERLAP`` of its n-grams can have, so no pair that passes step 3 is missed.
   A text is refused as soon as bounds allow: by the sum of its terms' greatest
   weights (the WAND test), then block by block by the sum of block maxima;
   pieces of the blocks that remain are scored exactly.  Nothing is ranked or
   capped.
3. Verification.  A retrieved item is confirmed on the text: the share of its
   question's word n-grams and of its answer's that occur in the text must
   both reach ``OVERLAP``.  The answer is the last sentence of the item, the
   question the rest (an item of one sentence is all question).
4. Score.  A confirmed pair's score is the best of the item's pieces over the
   text's passages of ``2 * STEP_WORDS`` words, which overlap by half.

Retrieval only chooses candidates; a link rests on the words.  Words are compared
in lower case without surrounding punctuation.

Edge cases: NULL or empty texts are no passage and no item; items without
words match nothing; an item shorter than an n-gram must occur as a whole; equal items all
match; repeated document rows give repeated result rows; an empty table on
either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import _tokens as T
from inkwell.llm._scratch import materialize, ship

PIECE_WORDS = 32
STEP_WORDS = 32
# Pieces of a shard, some 4 MB, and the shards that one pass over the documents searches.
SHARD_PIECES = 8192
PASS_SHARDS = 8
BLOCK_PIECES = 8
QUESTION_NGRAM, ANSWER_NGRAM = 5, 3
OVERLAP = 0.5
# Taken off the least scores, for sums in single precision.
SLACK = 1e-3
# Words of one text whose passages are bounded in one go.
BOUND_WORDS = 32_768
K1, B = 1.2, 0.75

_EDGE = re.compile(rb"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$")
_HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def words_of(text: str | None) -> list[bytes]:
    return [w for w in (_EDGE.sub(b"", x) for x in (text or "").lower().encode("utf-8", "surrogatepass").split()) if w]


class WordForms(T.WordHashes):
    """Raw word -> hash of its compared form; 0 for a word of punctuation alone."""

    def __missing__(self, word: bytes) -> int:
        form = _EDGE.sub(b"", word.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass"))
        value = self[word] = T.xxhash.xxh3_64_intdigest(form) if form else 0
        return value

    def words(self, text: str | None) -> np.ndarray:
        h = self.of(T.split_words(text))
        return h[h != 0]


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; one sentence is all question."""
    parts = re.findall(r"[^.!?\n]+[.!?]*\s*", text.strip())
    parts = [p for p in parts if p.strip()]
    return ("".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def grams(words: np.ndarray, n: int) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(T.Rolling(words).windows(min(n, len(words))))


def pieces_of(words: np.ndarray) -> list[np.ndarray]:
    """Pieces of at most ``PIECE_WORDS`` words that overlap by half at least and cover every word."""
    if not len(words):
        return []
    last = max(0, len(words) - PIECE_WORDS)
    return [words[i:i + PIECE_WORDS] for i in [*range(0, last, PIECE_WORDS // 2), last]]


def item_pieces(cache: WordForms, text: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(question and answer, pieces that cover the item): the documents of the index."""
    return [cache.words(s) for s in question_and_answer(text)], pieces_of(cache.words(text))


def least_share(grams_of: np.ndarray, terms: np.ndarray, weights: np.ndarray, overlap: float) -> float:
    """The least weight of the words of any ``overlap`` of a side's n-grams (rows of words).

    A word's weight is spread over the n-grams that hold it; a set of n-grams weighs no
    more than the words in it, so the cheapest ones bound every such set from below.
    """
    at = np.sort(np.searchsorted(terms, grams_of), axis=1)
    first = np.c_[np.ones(len(at), bool), at[:, 1:] != at[:, :-1]]       # a word counts once in an n-gram
    held = np.bincount(at[first], minlength=len(terms))
    price = np.sort(((weights / np.maximum(held, 1))[at] * first).sum(axis=1))
    return float(price[:int(np.ceil(overlap * len(price) - 1e-9))].sum())


def share_in(side: np.ndarray, windows: np.ndarray) -> float:
    """The share of the n-grams of a side (ascending) among those of a text."""
    at = np.searchsorted(side, windows)
    seen = np.zeros(len(side) + 1, bool)
    seen[at[side[np.minimum(at, len(side) - 1)] == windows]] = True
    return float(seen[:-1].mean())


class Postings:
    """Inverted lists: per term the places that hold it and their weights, one list after the other."""

    def __init__(self, n_terms: int, rows: list[tuple[np.ndarray, np.ndarray]]):
        """``rows``: per place its (terms, weights)."""
        term = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, np.int64)
        order = np.argsort(term, kind="stable")
        self.place = np.repeat(np.arange(len(rows)), [len(t) for t, _ in rows])[order].astype(np.int32)
        self.weight = (np.concatenate([w for _, w in rows]) if rows else np.zeros(0, np.float32))[order]
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))

    def maxima(self, group: np.ndarray) -> Postings:
        """The lists of groups of places, with each list's greatest weight in the group; groups ascend with places."""
        out = object.__new__(Postings)
        of_term = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        groups = group[self.place]
        cuts = np.flatnonzero((np.diff(of_term, prepend=-1) != 0) | (np.diff(groups, prepend=-1) != 0))
        out.place = groups[cuts].astype(np.int32)
        out.weight = np.maximum.reduceat(self.weight, cuts) if len(cuts) else self.weight
        out.starts = np.searchsorted(of_term[cuts], np.arange(len(self.starts)))
        return out

    def sums(self, terms: np.ndarray, n: int | None, by_term: bool = False) -> np.ndarray:
        """Per place (or per term) the sum of its weights over the terms' lists."""
        sizes = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        if by_term:
            return np.bincount(np.repeat(np.arange(len(terms)), sizes), self.weight[at], len(terms))
        return np.bincount(self.place[at], self.weight[at], n)


class Index:
    """One shard of the inverted index, as arrays."""

    def __init__(self, items: list[tuple[int, str]], df_of: dict[int, int], n_pieces: int, mean: float, overlap: float = OVERLAP):
        """``df_of`` (term -> pieces that hold it), ``n_pieces`` and their mean length are those of the whole benchmark."""
        cache = WordForms()
        self.items: list[tuple[int, list[np.ndarray], list[int]]] = []
        # (sorted words, item, words, rows of n-grams; None for a piece that is only scored)
        pieces: list[tuple[tuple, int, np.ndarray, np.ndarray | None]] = []
        for number, (item, text) in enumerate(items):
            sides, parts = item_pieces(cache, text)
            widths = [min(n, len(s)) for s, n in zip(sides, (QUESTION_NGRAM, ANSWER_NGRAM), strict=True)]
            self.items.append((item, [grams(s, w) for s, w in zip(sides, widths, strict=True)], widths))
            for side, width in zip(sides, widths, strict=True):
                if width:
                    rows = np.unique(np.lib.stride_tricks.sliding_window_view(side, width), axis=0)
                    pieces.append((tuple(sorted(side.tolist())), number, side, rows))
            pieces += [(tuple(sorted(p.tolist())), number, p, None) for p in parts]
        pieces.sort(key=lambda p: p[:2])             # similar pieces share blocks
        self.piece_item = np.array([p[1] for p in pieces], np.int64)
        self.terms = np.unique(np.concatenate([p[2] for p in pieces])) if pieces else np.zeros(0, np.uint64)
        counted = [(np.searchsorted(self.terms, t), n) for t, n in (np.unique(p[2], return_counts=True) for p in pieces)]
        df = np.array([df_of[t] for t in self.terms.tolist()], np.float64)
        idf = np.log(1 + (n_pieces - df + 0.5) / (df + 0.5))
        # (term, weight) of each piece
        self.weighted: list[tuple[np.ndarray, np.ndarray]] = []
        for term, tf in counted:
            w = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * tf.sum() / mean))
            self.weighted.append((term, (w / w.sum()).astype(np.float32)))
        # only questions and answers are retrieved, each at the least score that a passing text can have
        sides = [j for j, p in enumerate(pieces) if p[3] is not None]
        self.side_item = self.piece_item[sides]
        self.sides = np.bincount(self.side_item, minlength=len(self.items))      # an item needs all of its sides
        dense = np.zeros(len(self.terms))
        self.least = np.zeros(len(sides))
        for i, j in enumerate(sides):
            term, w = self.weighted[j]
            dense[term] = w
            self.least[i] = least_share(pieces[j][3], self.terms, dense, overlap) - SLACK
        self.postings = Postings(len(self.terms), [self.weighted[j] for j in sides])
        block = np.arange(len(sides)) // BLOCK_PIECES
        self.block_postings = self.postings.maxima(block)
        self.block_least = np.minimum.reduceat(self.least, np.arange(0, len(sides), BLOCK_PIECES)) if sides else np.zeros(0)
        self.term_max = self.postings.maxima(np.zeros(len(sides), np.int64)).sums(np.arange(len(self.terms)), None, True)

    def places(self, words: np.ndarray) -> np.ndarray:
        """The term number of each word; the number after the last for a word outside the index."""
        at = np.searchsorted(self.terms, words)
        at[(at == len(self.terms)) | (self.terms[np.minimum(at, len(self.terms) - 1)] != words)] = len(self.terms)
        return at

    def candidates(self, words: np.ndarray) -> list[int]:
        """The items of whose sides a text holds weight enough to pass: no passing item is missed."""
        if not len(words) or not len(self.terms):
            return []
        there = np.zeros(len(self.terms) + 1, bool)
        there[self.places(words)] = True
        term = np.flatnonzero(there[:-1])
        # the WAND test, then the sums of block maxima; pieces of the blocks that remain exactly
        if not len(term) or not len(self.least) or self.term_max[term].sum() < self.least.min():
            return []
        live = self.block_postings.sums(term, len(self.block_least)) >= self.block_least
        if not live.any():
            return []
        near = np.repeat(live, BLOCK_PIECES)[:len(self.least)]
        kept = near & (self.postings.sums(term, len(self.least)) >= self.least)
        return np.flatnonzero((np.bincount(self.side_item[kept], minlength=len(self.items)) >= self.sides) & (self.sides > 0)).tolist()

    def score(self, words: np.ndarray, number: int) -> float:
        """The best score of an item's pieces over all passages of one text."""
        own = np.flatnonzero(self.piece_item == number)
        weights = np.zeros((len(self.terms) + 1, len(own)), np.float32)      # last row: a word outside the index
        for i, j in enumerate(own.tolist()):
            weights[self.weighted[j][0], i] = self.weighted[j][1]
        at, best = self.places(words), 0.0
        # blocks of words overlap by one passage, so each passage is whole in one
        for start in range(0, len(at), BOUND_WORDS):
            part = at[start:start + BOUND_WORDS + STEP_WORDS]
            width, step = len(self.terms) + 1, np.arange(len(part)) // STEP_WORDS
            # each word stands in the passage of its step and in the one before; a passage counts a term once
            keys = (step * width + part)[part < len(self.terms)]
            keys = np.unique(np.concatenate([keys, keys[keys >= width] - width]))
            passage, term = np.divmod(keys, width)
            if len(keys):
                cuts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
                best = max(best, float(np.add.reduceat(weights[term], cuts, axis=0).max()))
        return min(1.0, best)


def _hits(index, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordForms()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = cache.words(text)
                have: dict[int, np.ndarray] = {}
                for shard, number in ((x, n) for x in index.value for n in x.candidates(words)):
                    item, sides, widths = shard.items[number]
                    shares = []
                    for side, width in zip(sides, widths, strict=True):
                        if width and width not in have:
                            have[width] = T.Rolling(words).windows(width)
                        shares.append(share_in(side, have[width]) if width else 1.0)
                        if shares[-1] < overlap:
                            break
                    else:
                        out.append((doc, item, shard.score(words, number), *shares))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                                                                             pa.float64()), strict=True)],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
    return run


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term the number of pieces that hold it; in the row without a term the pieces and their words."""
    cache = WordForms()
    for batch in batches:
        pieces = [p for text in batch.column("text").to_pylist() for part in item_pieces(cache, text) for p in part if len(p)]
        if not pieces:
            continue
        terms, n = np.unique(np.concatenate([np.unique(p) for p in pieces]), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *terms.view(np.int64).tolist()], pa.int64()), pa.array([len(pieces), *n.tolist()], pa.int64()),
             pa.array([sum(map(len, pieces)), *[0] * len(n)], pa.int64())], names=["term", "n", "words"])


def _terms_by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordForms()
    for batch in batches:
        for shard, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist(), strict=True):
            terms = np.unique(np.concatenate([p for part in item_pieces(cache, text) for p in part]))
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(terms), pa.int32()), pa.array(terms.view(np.int64))],
                                             names=["shard", "term"])


def _built(n_pieces: int, mean: float, overlap: float):
    def run(items, df):
        df_of = dict(zip(df["term"].to_numpy(np.int64).view(np.uint64).tolist(), df["n"].tolist(), strict=True))
        # ids travel as strings, because pandas makes floats of numbers beside a NULL
        numbered = [(None if i is None else int(i), t) for i, t in zip(items["item_id"], items["text"], strict=True)]
        index = Index(sorted(numbered, key=str), df_of, n_pieces, mean, overlap)
        return pd.DataFrame({"shard": items["shard"].iloc[:1], "index": [pickle.dumps(index)]})
    return run


def build_shards(items: DataFrame, shard_pieces: int = SHARD_PIECES, overlap: float = OVERLAP) -> Iterator[list[Index]]:
    """Index shards of a bounded number of pieces, ``PASS_SHARDS`` at a time.

    Terms are counted over all items, and the shards are built in tasks and written;
    only those of one pass are in the driver, which hands them on.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    counts = materialize(rows.select("text").mapInArrow(_statistics, "term long, n long, words long")
                         .groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "piece-terms")
    size = counts.filter("term is null").first()
    if size is None:
        return
    n_shards = -(-size["n"] // shard_pieces)
    # equal items are dealt apart, too; written, so that the numbers stay
    dealt = materialize(rows.withColumn("shard", F.pmod(F.xxhash64("item_id", "text", F.monotonically_increasing_id()), F.lit(n_shards))
                                        .cast("int")), "items")
    known = (dealt.select("shard", "text").mapInArrow(_terms_by_shard, "shard int, term long").distinct()
             .join(counts.filter("term is not null").select("term", "n"), "term"))
    shards = materialize(dealt.withColumn("item_id", F.col("item_id").cast("string")).groupBy("shard").cogroup(known.groupBy("shard"))
                         .applyInPandas(_built(size["n"], size["words"] / size["n"], overlap), "shard int, index binary"), "shards")
    for start in range(0, n_shards, PASS_SHARDS):
        found = shards.filter(F.col("shard").between(start, start + PASS_SHARDS - 1)).orderBy("shard").select("index").collect()
        if found:
            yield [pickle.loads(r["index"]) for r in found]


def contaminated(docs: DataFrame, items: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every confirmed pair."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], _HITS)
    for shards in build_shards(items, overlap=overlap):
        out = out.unionByName(rows.mapInArrow(_hits(spark.sparkContext.broadcast(shards), overlap), _HITS))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """``docs`` without the rows that hold a test item; all columns.  Decided row by row, without a join."""
    spark, out = docs.sparkSession, docs
    ship(spark)
    for shards in build_shards(items, overlap=overlap):
        shared = spark.sparkContext.broadcast(shards)
        find = _hits(shared, overlap)

        def run(batches, find=find):
            for batch in batches:
                numbered = pa.RecordBatch.from_arrays(
                    [pa.array(range(batch.num_rows), pa.int64()), batch.column("text")], names=["doc_id", "text"])
                bad = {d for hit in find(iter([numbered])) for d in hit.column("doc_id").to_pylist()}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))
        out = out.mapInArrow(run, docs.schema)
    return out
