"""Phrase collocations per language, counted by multikey quicksort of routed suffixes.

A text is lower-cased (A-Z), cut into pieces at punctuation and line ends, and a
piece into words.  A suffix is a position in a piece with the words from there on,
five at most.  Counting goes by levels:

1. Words are counted per language (map-side, then one aggregate): the count n of
   all words, and which words reach ``MIN_COUNT``.
2. Pairs of frequent words are counted by hash (44 bits, a few bytes a pair and map
   task).  Suffixes of up to five words are cut where two neighbours are no frequent
   pair: no frequent phrase crosses such a place.  Frequent words and pairs travel as
   bit tables of hashed slots, of a fixed size.  A hash shared with something rare
   only lets a suffix through that the exact count of step 4 then refuses.
3. Routing is global: equal leading words meet in one task.  Before, each map task
   sends one row per distinct suffix with its number, so a passage that a third of
   the documents share travels once per task.  A pair is a route, and so are three leading words
   of longer suffixes: the words behind them are bounded by the frequent
   pairs and by the maximum depth, so no route grows with the text.
4. In a task, suffix pointers are sorted by multikey three-way quicksort: partition
   by the word at the current depth into less, equal and greater, go one word deeper
   in the equal part, down to the maximum depth.  The size of an equal part is the
   count of its phrase.  A part below ``MIN_COUNT`` is abandoned at once.  Buckets are
   taken in runs of about ``RUN_ROWS`` suffixes; where one bucket is longer, its equal
   suffixes are merged first.

The score of a phrase is that of its weakest cut, in decimals (38 digits); phrases
inside a longer one of equal count go.  f(longer) >= f(shorter) can hold only through
phrases one word longer, so those are looked at.

Edge cases: a NULL text is empty, a NULL lang 'und'.  Documents without ids, with
equal ids or repeated rows count each time they stand there.  Texts of any length
are read whole, in slices of one or more documents.  An empty table, or no phrase
that is frequent, gives an empty result.  Ties of score and count go by phrase.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm import _tokens as T
from inkwell.llm._scratch import materialize, ship

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
# The bit tables of frequent words and pairs have 2 ** WORD_BITS and 2 ** PAIR_BITS slots: 2 and 16 MB.
WORD_BITS, PAIR_BITS = 24, 27
# Bytes of a bit table that one row of its aggregation holds.
CHUNK = 8192
# Pairs are first counted by 44 bits of their hash, dealt into 2 ** BUCKET_BITS buckets.
BUCKET_BITS, REST_BITS = 14, 30
HELD_PAIRS = 4_000_000
# Buckets of routes: the unit that one sort must see whole.
ROUTES = 4096
RUN_ROWS = 1 << 20
# Rows that a map task holds before it sends them.
HELD_ROWS = 400_000

# The characters that end a piece; a full stop stands for all of them.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TO_STOP = bytes.maketrans(ENDS, b"." * len(ENDS))
STOP = b"."

_PACKED = "route int, lang string, phrase array<string>, n array<long>"
_COUNTED = "lang string, phrase string, n long"


class Words(dict):
    """word -> number in order of first sight, per language and Python worker; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({STOP: 0})
        self.names = [STOP]

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        self.names.append(word)
        return value


def word_numbers(words: Words, texts: list[str | None]) -> np.ndarray:
    """Word numbers of the texts' pieces, each piece closed by 0."""
    data = b" . ".join(T.encode(t).lower().translate(_TO_STOP).replace(STOP, b" . ") for t in texts).split()
    data.append(STOP)
    return np.fromiter(map(words.__getitem__, data), np.int64, len(data))


def by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str | None]]]:
    """Slices of a batch's texts, by language."""
    texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
    for a, b in T.slices(texts):
        groups: dict[str, list[str | None]] = {}
        for lang, text in zip(langs[a:b], texts[a:b], strict=True):
            groups.setdefault(lang, []).append(text)
        yield from groups.items()


def _rows(lang: str, phrases: list[bytes], counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(phrases), pa.string()), pa.array([p.decode("utf-8", "replace") for p in phrases], pa.string()),
         pa.array(counts, pa.int64())], names=["lang", "phrase", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[Words, np.ndarray]] = {}

    def flush(lang: str) -> pa.RecordBatch:
        words, counts = held.pop(lang)
        return _rows(lang, words.names[1:], counts[1:len(words.names)].tolist())

    for batch in batches:
        for lang, texts in by_lang(batch):
            words, counts = held.get(lang) or (Words(), np.zeros(1, np.int64))
            numbers = word_numbers(words, texts)
            found = np.bincount(numbers, minlength=len(words.names))
            found[:len(counts)] += counts
            held[lang] = words, found
            if sum(len(w) for w, _ in held.values()) > HELD_ROWS:
                yield from [flush(x) for x in list(held)]
    yield from [flush(x) for x in list(held)]


def _seed(lang: str) -> int:
    return xxhash.xxh32_intdigest(T.encode(lang))


def word_hash(word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(word, seed)


def bit_table(bits: DataFrame, slots: int) -> bytes:
    """Rows ``slot`` -> one bit per slot that is listed: slots / 8 bytes, whatever the number of rows."""
    def pack(table: pa.Table) -> pa.Table:
        flags = np.zeros(8 * CHUNK, np.uint8)
        flags[table.column("bit").to_numpy()] = 1
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    chunks = (bits.select(F.floor(F.col("slot") / (8 * CHUNK)).alias("chunk"), F.pmod("slot", F.lit(8 * CHUNK)).cast("int").alias("bit"))
              .distinct().groupBy("chunk").applyInArrow(pack, "chunk long, bits binary").collect())      # at most slots / 8 bytes
    table = bytearray(slots // 8)
    for row in chunks:
        table[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = row["bits"]
    return bytes(table)


def _word_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, words = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([word_hash(T.encode(w), _seed(lang)) >> (64 - WORD_BITS)
                                                    for lang, w in zip(langs, words, strict=True)], pa.int64())], names=["slot"])


def _set(table: bytes, slots: np.ndarray) -> np.ndarray:
    """The bits of the slots."""
    return (np.frombuffer(table, np.uint8)[slots >> T.U64(3)] >> (T.U64(7) - (slots & T.U64(7))).astype(np.uint8)) & 1 == 1


class _Language:
    """A language's words in a worker, their hashes, and which are frequent."""

    def __init__(self, lang: str, word_table: bytes):
        self.words, self.seed, self.table = Words(), _seed(lang), word_table
        self.hashes, self.frequent = np.zeros(1, np.uint64), np.zeros(1, bool)

    def numbers(self, texts: list[str | None]) -> np.ndarray:
        numbers = word_numbers(self.words, texts)
        new = self.words.names[len(self.hashes):]
        if new:
            hashes = np.array([word_hash(w, self.seed) for w in new], np.uint64)
            self.hashes = np.concatenate([self.hashes, hashes])
            self.frequent = np.concatenate([self.frequent, _set(self.table, hashes >> T.U64(64 - WORD_BITS))])
        return numbers

    def pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places with a frequent word before a frequent word, hashes of those pairs)"""
        ok = self.frequent[numbers]
        starts = np.nonzero(ok[:-1] & ok[1:])[0]
        return starts, T.mix(self.hashes[numbers[starts]] * T.U64(T.M1) + self.hashes[numbers[starts + 1]])


class _Languages(dict):
    def __init__(self, word_table: bytes):
        super().__init__()
        self.table = word_table

    def of(self, lang: str) -> _Language:
        if sum(len(x.words) for x in self.values()) > T.CACHE_WORDS:
            self.clear()
        if lang not in self:
            self[lang] = _Language(lang, self.table)
        return self[lang]


def _count_hashes(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    return found, np.bincount(inverse, np.concatenate(counts), len(found)).astype(np.int64)


def _pair_hashes(word_table):
    """Texts -> the hashes of their pairs of frequent words, dealt into buckets, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = _Languages(word_table.value)
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            found, n = _count_hashes(hashes, counts)
            bucket = (found >> T.U64(REST_BITS)).astype(np.int64)
            first = np.nonzero(np.diff(bucket, prepend=-1))[0]
            ends = np.append(first, len(found))[1:]
            rest = (found & T.U64((1 << REST_BITS) - 1)).astype(np.uint32)
            # from there on the number no longer matters
            n = np.minimum(n, np.iinfo(np.uint16).max).astype(np.uint16)
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[first]), pa.array([rest[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                 pa.array([n[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())], names=["bucket", "rest", "n"])

        for batch in batches:
            for lang, texts in by_lang(batch):
                language = languages.of(lang)
                found, n = np.unique(language.pairs(language.numbers(texts))[1] >> T.U64(64 - BUCKET_BITS - REST_BITS),
                                     return_counts=True)
                hashes.append(found)
                counts.append(n)
                if sum(map(len, hashes)) > HELD_PAIRS:
                    merged = _count_hashes(hashes, counts)
                    hashes, counts = [merged[0]], [merged[1]]
                    if len(merged[0]) > HELD_PAIRS // 2:
                        yield flush()
                        hashes, counts = [], []
        if hashes:
            yield flush()
    return run


def _frequent_hashes(min_count: int):
    """Rows sorted by bucket -> slots of the pair hashes that reach the count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slots(bucket: int, rest: list[bytes], n: list[bytes]) -> pa.RecordBatch:
            found, total = _count_hashes([np.frombuffer(r, np.uint32) for r in rest], [np.frombuffer(c, np.uint16) for c in n])
            key = (T.U64(bucket) << T.U64(REST_BITS)) | found[total >= min_count].astype(np.uint64)
            return pa.RecordBatch.from_arrays([pa.array((key >> T.U64(BUCKET_BITS + REST_BITS - PAIR_BITS)).astype(np.int64))], names=["slot"])

        now, rest, n = None, [], []
        for batch in batches:
            for bucket, r, c in zip(*(batch.column(x).to_pylist() for x in ("bucket", "rest", "n")), strict=True):
                if bucket != now and rest:
                    yield slots(now, rest, n)
                    rest, n = [], []
                now = bucket
                rest.append(r)
                n.append(c)
        if rest:
            yield slots(now, rest, n)
    return run


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, class of each, size of each class)"""
    _, first, inverse, counts = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
    return first, inverse, counts


def local_suffixes(language: _Language, texts: list[str | None], pair_table: bytes, depth: int) -> tuple[list[bytes], list[int]]:
    """The distinct pairs, and the distinct suffixes of 3 to ``depth`` words, with how often each stands there."""
    numbers = language.numbers(texts)
    names, size = language.words.names, len(language.words.names)
    starts, hashes = language.pairs(numbers)
    starts = starts[_set(pair_table, hashes >> T.U64(64 - PAIR_BITS))]
    if not len(starts):
        return [], []
    good = np.zeros(len(numbers) + depth, np.int64)        # place i and i + 1 may be inside a phrase
    good[starts] = 1
    length = np.ones(len(starts), np.int64)                # words of the suffix at each start
    chain = np.ones(len(starts), np.int64)
    for step in range(depth - 1):
        chain = chain * good[starts + step]
        length += chain
    phrases: list[bytes] = []
    sizes: list[int] = []
    # class by class of one word more: exact, without a hash
    first, code, counts = _distinct(numbers[starts] * size + numbers[starts + 1])
    pair_first, longest = starts[first], length > 2
    phrases += [names[a] + b" " + names[b] for a, b in zip(numbers[pair_first].tolist(), numbers[pair_first + 1].tolist(), strict=True)]
    sizes += counts.tolist()
    at, code, length = starts[longest], code[longest], length[longest]
    if depth > 2 and len(at):
        for step in range(2, depth):
            word = np.where(length > step, numbers[np.minimum(at + step, len(numbers) - 1)], 0)
            first, code, counts = _distinct(code * size + word)
        phrases += [b" ".join([names[n] for n in numbers[p:p + k].tolist()])
                    for p, k in zip(at[first].tolist(), length[first].tolist(), strict=True)]
        sizes += counts.tolist()
    return phrases, sizes


def route(lang_seed: int, phrase: bytes) -> int:
    """The bucket of a phrase's leading words, three at most."""
    return xxhash.xxh3_64_intdigest(b" ".join(phrase.split(b" ", 3)[:3]), lang_seed) & (ROUTES - 1)


def _packed(lang: str, counts: dict[bytes, int]) -> pa.RecordBatch:
    """One row per bucket of routes, with its suffixes and their numbers."""
    seed = _seed(lang)
    buckets = np.fromiter((route(seed, p) for p in counts), np.int32, len(counts))
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order], prepend=-1))
    offsets = pa.array(np.append(cuts, len(order)).astype(np.int32))
    phrases = pa.array([p.decode("utf-8", "replace") for p in counts], pa.string()).take(pa.array(order))
    sizes = pa.array(np.fromiter(counts.values(), np.int64, len(counts))[order])
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets[order][cuts]), pa.array([lang] * len(cuts), pa.string()), pa.ListArray.from_arrays(offsets, phrases),
         pa.ListArray.from_arrays(offsets, sizes)], names=["route", "lang", "phrase", "n"])


def _suffixes(word_table, pair_table, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = _Languages(word_table.value)
        held: dict[str, dict[bytes, int]] = {}

        for batch in batches:
            for lang, texts in by_lang(batch):
                phrases, counts = local_suffixes(languages.of(lang), texts, pair_table.value, depth)
                mine = held.setdefault(lang, {})
                for p, n in zip(phrases, counts, strict=True):
                    mine[p] = mine.get(p, 0) + n
                if sum(len(h) for h in held.values()) > HELD_ROWS:
                    yield from [_packed(x, h) for x, h in held.items() if h]
                    held.clear()
        yield from [_packed(x, h) for x, h in held.items() if h]
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.column("n")
        rows = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(n.offsets.to_numpy())))
        yield pa.RecordBatch.from_arrays([batch.column("lang").take(rows), batch.column("phrase").flatten(), n.flatten(),
                                          batch.column("route").take(rows)], names=["lang", "phrase", "n", "route"])


def multikey_quicksort(keys: np.ndarray, sizes: np.ndarray, min_count: int) -> Iterator[tuple[int, int, int]]:
    """``(pointer, depth, count)`` of every prefix of the rows of ``keys`` that counts ``min_count`` or more.

    ``keys``: one row of numbers per suffix, 0 behind its end; ``sizes``: how often each
    stands in the text; the pointer is that of some row with the prefix.
    """
    depth_limit = keys.shape[1]
    todo = [(np.arange(len(keys)), 0)]
    while todo:
        rows, depth = todo.pop()
        while True:
            weights = sizes[rows]
            if not len(rows) or weights.sum() < min_count:          # too small for any phrase: abandoned
                break
            column = keys[rows, depth]
            pivot = column[len(column) // 2]
            less, greater = column < pivot, column > pivot
            equal = ~(less | greater)
            for part in (less, greater):
                if part.any():
                    todo.append((rows[part], depth))
            rows = rows[equal]
            count = int(weights[equal].sum())
            if pivot == 0 or count < min_count:
                break
            yield int(rows[0]), depth + 1, count
            depth += 1
            if depth == depth_limit:
                break


def _count_routes(depth: int, min_count: int):
    """Rows (lang, phrase, n, route) sorted by route -> phrases with their counts.

    Pairs stand apart from longer suffixes: each counts all places of the pair.
    """
    def count(runs: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(runs).combine_chunks()
        words = pc.split_pattern(table.column("phrase"), " ").combine_chunks()
        lengths = np.diff(words.offsets.to_numpy())
        flat = words.flatten().dictionary_encode()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        keys = np.zeros((len(table), depth + 1), np.int32)
        keys[:, 0] = 2 * langs.indices.to_numpy() + 2 + (lengths > 2)
        at = np.repeat(np.arange(len(table)), lengths)
        keys[at, 1 + np.arange(len(at)) - np.repeat(words.offsets.to_numpy()[:-1] - words.offsets.to_numpy()[0], lengths)] = \
            flat.indices.to_numpy() + 1
        found = [f for f in multikey_quicksort(keys, table.column("n").to_numpy(), min_count)
                 if f[1] > 3 or (f[1] == 3 and lengths[f[0]] == 2)]
        if not found:
            return None
        names, phrases = flat.dictionary.to_pylist(), []
        for p, d, _ in found:
            phrases.append(" ".join(names[k - 1] for k in keys[p, 1:d].tolist()))
        return pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array([keys[p, 0] // 2 - 1 for p, _, _ in found])), pa.array(phrases, pa.string()),
             pa.array([n for _, _, n in found], pa.int64())], names=["lang", "phrase", "n"])

    def merged(runs: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        sums = pa.Table.from_batches(runs).group_by(["lang", "phrase", "route"]).aggregate([("n", "sum")])
        return sums.rename_columns({"n_sum": "n"}).select(["lang", "phrase", "n", "route"]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if size + batch.num_rows > RUN_ROWS and held:
                # cut where a route ends; a route that goes on is kept for the next run
                routes = batch.column("route").to_numpy()
                last = held[-1].column("route")[-1].as_py()
                cut = int(np.searchsorted(routes != last, True)) if routes[0] == last else 0
                if cut < batch.num_rows:
                    found = count(held + ([batch.slice(0, cut)] if cut else []))
                    if found is not None:
                        yield found
                    held, batch = [], batch.slice(cut)
                else:
                    held = merged(held)            # one long route: equal suffixes become one row
                size = sum(b.num_rows for b in held)
            held.append(batch)
            size += batch.num_rows
        if held:
            found = count(held)
            if found is not None:
                yield found
    return run


def routed_counts(suffixes: DataFrame, depth: int, min_count: int) -> DataFrame:
    """``lang, phrase, n`` of the frequent phrases of 2 to ``depth`` words from packed suffixes."""
    count = _count_routes(depth, min_count)
    routed = suffixes.repartition("route").sortWithinPartitions("route")
    return routed.mapInArrow(lambda batches: count(_unpacked(batches)), _COUNTED)


def phrase_counts(documents: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(``lang, phrase, n`` of all frequent phrases of 1 to ``max_words`` words, ``lang, n`` of all words)."""
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = materialize(docs.mapInArrow(_count_words, _COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    frequent = words.filter(F.col("n") >= min_count)
    words_seen = frequent.select("lang", "phrase").mapInArrow(_word_slots, "slot long")
    word_table = spark.sparkContext.broadcast(bit_table(words_seen, 1 << WORD_BITS))
    hashed = docs.mapInArrow(_pair_hashes(word_table), "bucket long, rest binary, n binary")
    pairs_seen = hashed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_frequent_hashes(min_count), "slot long")
    pair_table = spark.sparkContext.broadcast(bit_table(pairs_seen, 1 << PAIR_BITS))
    suffixes = docs.mapInArrow(_suffixes(word_table, pair_table, max_words), _PACKED)
    found = frequent.unionByName(routed_counts(suffixes, max_words, min_count))
    return materialize(found, "phrases"), words.groupBy("lang").agg(F.sum("n").alias("n"))


def cut_scores(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of two words and more, by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    phrases = counts.select("lang", "phrase", F.col("n").alias("a"), words.alias("words")).filter(F.size("words") > 1)
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("tail"))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
            .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
            .join(F.broadcast(totals), "lang"))            # one row per language
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)))"
                   " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    least = F.min_by(F.struct("l", "r", "n", "score"), F.struct("score", "k"))
    return (cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(least.alias("c"))
            .select("lang", "phrase", "a", "c.l", "c.r", "c.n", "c.score"))


def collocations(documents: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases."""
    counts, totals = phrase_counts(documents, min_count, max_words)
    words = F.split("phrase", " ")
    longer = counts.select("lang", "n", words.alias("words")).filter(F.size("words") > 2)
    inside = longer.select("lang", "n", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " "),
        F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " "))).alias("phrase"))
    covers = inside.groupBy("lang", "phrase").agg(F.max("n").alias("cover"))
    kept = cut_scores(counts, totals).join(covers, ["lang", "phrase"], "left").filter(
        F.col("cover").isNull() | (F.col("cover") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
