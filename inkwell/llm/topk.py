"""Exact top-k inner products by norm-bucketed retrieval.

1. Candidates are range-partitioned by falling length and packed, in that order,
   into buckets of at most ``BUCKET_ROWS`` vectors (one written row each: a matrix
   and its ids).  Equal lengths are parted by id, so a vector that makes up a third
   of the table fills many buckets and no single one.
2. The bucket of the longest vectors gives every query a first threshold: the k-th
   best product in it, which the final k-th best cannot fall below.
3. Queries are packed into blocks in the order of threshold / length.  A block and
   a bucket meet only if some query of the block can reach its threshold with the
   bucket's longest vector; the pairs come from the two small tables of bounds and
   then fetch their payloads by equi-joins.
4. In a pair every query has a local cosine threshold: its threshold over its own
   length and the bucket's greatest.  Length pruning takes the vectors at the head
   of the bucket that are long enough.  Coordinate pruning takes those whose
   direction lies within the feasible range of the query's ``FOCUS`` largest
   coordinates: cosine c with a unit vector q bounds coordinate f by
   ``q_f c -+ sqrt((1 - c^2)(1 - q_f^2))``.  A few queries of the block, spread over
   the thresholds, try both; from the cosine on at which coordinates leave less to
   verify, the bucket prunes by coordinates, below it by length.
5. What is left is verified by exact products; a window keeps each query's k best.

Components are whole numbers held in doubles.  Products are exact in doubles while
the lengths' product is below 2**53, and are taken with Python's integers beyond;
bounds carry a relative slack, so rounding drops nothing.

Edge cases: a vector that is NULL or holds a NULL or non-finite component takes no
part; a shorter vector counts as padded with zeros, an empty one as zero.  Rows
whose id is NULL take no part.  A query's own rows are those of its id; a repeated
query row is one query, other rows count each.  Ties go to the smaller id.  Fewer
than k candidates give fewer rows.  A product beyond 64 bits is ranked by its value
and returned as the nearest long.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm._scratch import materialize, ship

BUCKET_ROWS = 4096
BLOCK_ROWS = 2048
FOCUS = 4
# Ways in which the buckets that meet a block are dealt, so that no task holds all of them.
DEALS = 16
PROBES = 8
# Verifying a gathered vector costs about as much as this many in a row of a matrix product.
GATHER_COST = 8.0
SLACK = 1e-9
EXACT = 2.0 ** 53
LONG = 2 ** 63 - 1

_NINES = str.maketrans("0123456789", "9876543210")
_PACKED = "pack long, n int, dim int, longest double, ids binary, vectors binary"
_BLOCK = "pack long, n int, dim int, least double, ids binary, vectors binary, floors binary"
_FOUND = "query_id long, query long, vec_id long, exact string, score long"


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """``vec_id, v array<double>, norm2 double``: components floor(scale * x) of the vectors that take part."""
    def whole(c: Column) -> Column:
        y = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)    # greater doubles are whole

    x = F.transform("embedding", whole)
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    v = v.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))
    return v.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
    return out


def _pack(rows_per_pack: int, floors: bool):
    """Rows in the partition's order -> packs of a bounded number of rows."""
    def emit(ids, matrix, key, floor, number):
        norms = np.linalg.norm(matrix, axis=1)
        bound = float(key.min()) if floors else float(norms.max())
        columns = [pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([matrix.shape[1]], pa.int32()),
                   pa.array([bound]), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                   pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary())]
        if floors:
            columns.append(pa.array([floor.tobytes()], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=["pack", "n", "dim", "least" if floors else "longest", "ids", "vectors"]
                                          + (["floors"] if floors else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            dim = int(batch.column("dim")[0].as_py())
            held.append((batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), dim),
                         batch.column("key").to_numpy(), batch.column("floor").to_numpy()))
            size += batch.num_rows
            while size >= rows_per_pack:
                whole = [np.concatenate(c) for c in zip(*held, strict=True)]
                yield emit(*(c[:rows_per_pack] for c in whole), number)
                number += 1
                held = [tuple(c[rows_per_pack:] for c in whole)]
                size -= rows_per_pack
        if size:
            yield emit(*(np.concatenate(c) for c in zip(*held, strict=True)), number)
    return run


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products, as doubles where they hold them and as Python integers otherwise."""
    longest = [float(np.linalg.norm(m, axis=1).max(initial=0.0)) for m in (queries, vectors)]
    if longest[0] * longest[1] < EXACT:
        return queries @ vectors.T
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (queries, vectors)]
    return whole[0] @ whole[1].T if queries.shape[1] else np.zeros((len(queries), len(vectors)), object)


def sortable(x: int) -> str:
    """A string that sorts as the whole number does, whatever its size."""
    digits = str(abs(x))
    key = f"{len(digits):04d}{digits}"
    return "1" + key if x >= 0 else "0" + key.translate(_NINES)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id."""
    places = np.arange(len(ids))
    if len(ids) > k:
        if scores.dtype == object:
            floor = sorted(scores, reverse=True)[k - 1]
        else:
            floor = np.partition(scores, len(ids) - k)[len(ids) - k]
        places = np.nonzero(scores >= floor)[0]
    return places[sorted(range(len(places)), key=lambda i: (-scores[places[i]], ids[places[i]]))[:k]] if len(places) else places


class _Bucket:
    """Vectors of one bucket, longest first, and their directions sorted by coordinate."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        norms = np.linalg.norm(vectors, axis=1)
        order = np.lexsort((ids, -norms))
        self.ids, self.vectors, self.norms = ids[order], vectors[order], norms[order]
        self.directions = self.vectors / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def by_length(self, least: float) -> int:
        """How many vectors at the head are at least so long."""
        return int(np.searchsorted(-self.norms, -least * (1 - SLACK), side="right"))

    def _list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            order = np.argsort(self.directions[:, f], kind="stable")
            self.sorted[f] = self.directions[order, f], order
        return self.sorted[f]

    def by_coordinates(self, direction: np.ndarray, cosine: float) -> np.ndarray:
        """Places of the vectors whose direction may have the cosine."""
        c = max(-1.0, cosine - SLACK)
        if c > 1.0:
            return np.zeros(0, np.int64)
        focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        q = direction[focus]
        wide = np.sqrt(np.maximum(0.0, (1 - c * c) * (1 - q * q))) + SLACK
        low, high = q * c - wide, q * c + wide
        # a direction beyond the cone's edge may be any further along
        low, high = np.where(q <= -c, -2.0, low), np.where(q >= c, 2.0, high)
        if c <= 0:
            return np.arange(len(self.ids))
        ranges = []
        for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist(), strict=True):
            values = self._list(f)[0]
            ranges.append((int(np.searchsorted(values, a, "left")), int(np.searchsorted(values, b, "right"))))
        first = min(range(len(ranges)), key=lambda i: ranges[i][1] - ranges[i][0])
        places = self._list(int(focus[first]))[1][ranges[first][0]:ranges[first][1]]
        for i, f in enumerate(focus.tolist()):
            if i != first and len(places):
                d = self.directions[places, f]
                places = places[(d >= low[i]) & (d <= high[i])]
        return places


def _switch(bucket: _Bucket, queries: np.ndarray, norms: np.ndarray, floors: np.ndarray, local: np.ndarray) -> float:
    """The local cosine from which on this bucket prunes by coordinates."""
    order = np.argsort(-local, kind="stable")
    switch = 2.0
    for i in order[np.linspace(0, len(order) - 1, min(PROBES, len(order))).astype(int)]:
        by_length = bucket.by_length(floors[i] / norms[i]) if floors[i] > 0 else len(bucket.ids)
        by_coordinates = len(bucket.by_coordinates(queries[i] / norms[i], local[i]))
        if by_coordinates * GATHER_COST >= by_length:
            break
        switch = float(local[i])
    return switch


def search_bucket(bucket: _Bucket, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int
                  ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query place, vector places, products) of each query's k best in the bucket, or of those that may be."""
    norms = np.linalg.norm(queries, axis=1)
    longest = float(bucket.norms[0])
    bound = norms * longest
    alive = np.nonzero(bound * (1 + SLACK) >= floors)[0]
    if not len(alive):
        return
    # without a positive threshold nothing can be pruned: cosine -1
    local = np.full(len(ids), -1.0)
    some = (floors > 0) & (bound > 0)
    local[some] = floors[some] / bound[some]
    switch = _switch(bucket, queries[alive], np.where(norms > 0, norms, 1.0)[alive], floors[alive], local[alive])
    lengthwise = []
    for i in alive.tolist():
        if local[i] < switch or local[i] <= 0:
            lengthwise.append(i)
            continue
        places = bucket.by_coordinates(queries[i] / norms[i], local[i])
        places = places[bucket.ids[places] != ids[i]]
        if len(places):
            products = _products(queries[i:i + 1], bucket.vectors[places])[0]
            best = _best(products, bucket.ids[places], k)
            yield i, places[best], products[best]
    for start in range(0, len(lengthwise), 256):
        part = np.array(lengthwise[start:start + 256])
        heads = [bucket.by_length(floors[i] / norms[i]) if floors[i] > 0 else len(bucket.ids) for i in part]
        products = _products(queries[part], bucket.vectors[:max(heads)])
        for j, (i, head) in enumerate(zip(part.tolist(), heads, strict=True)):
            places = np.nonzero(bucket.ids[:head] != ids[i])[0]
            row = products[j][places]
            best = _best(row, bucket.ids[places], k)
            yield i, places[best], row[best]


def _unpack(row_ids: bytes, vectors: bytes, n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row_ids, "<i8"), np.frombuffer(vectors, np.float64).reshape(n, dim)


def _first_floors(k: int, first: list[tuple]):
    """Queries -> their k-th best product in the first bucket and its share of the query's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _Bucket(*_unpack(*first[0]))
        dim = bucket.vectors.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, queries = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), dim)
            floors = np.full(len(ids), -np.inf)
            for i, _, products in search_bucket(bucket, ids, queries, floors, k):
                if len(products) == k:
                    floors[i] = float(products[-1]) * (1 - SLACK if products[-1] > 0 else 1 + SLACK)
            norms = np.linalg.norm(queries, axis=1)
            least = np.where(floors > 0, floors / np.where(norms > 0, norms, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(np.full(len(ids), dim, np.int32)), pa.array(least),
                 pa.array(floors)], names=["vec_id", "v", "dim", "key", "floor"])
    return run


def _search_pairs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                pair = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
                bucket = _Bucket(*_unpack(pair["ids"], pair["vectors"], pair["n"], pair["dim"]))
                ids, queries = _unpack(pair["q_ids"], pair["q_vectors"], pair["q_n"], pair["dim"])
                found: list[tuple[int, int, int, int]] = []
                for i, places, products in search_bucket(bucket, ids, queries, np.frombuffer(pair["floors"], np.float64), k):
                    query = xxhash.xxh3_64_intdigest(queries[i].tobytes()) >> 1
                    found += [(int(ids[i]), query, int(bucket.ids[p]), int(s)) for p, s in zip(places, products, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[c] for f in found], pa.int64()) for c in range(3)]
                    + [pa.array([sortable(f[3]) for f in found], pa.string()),
                       pa.array([max(-LONG - 1, min(LONG, f[3])) for f in found], pa.int64())],
                    names=["query_id", "query", "vec_id", "exact", "score"])
    return run


def top_products(vectors: DataFrame, is_query: Column, k: int, scale: int = 256, bucket_rows: int = BUCKET_ROWS,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k greatest products of every query row with all rows but its own.

    ``vectors``: vec_id, embedding; ``is_query``: condition on vec_id.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = materialize(whole_vectors(vectors.select("vec_id", "embedding"), scale), "vectors")
    dim = v.agg(F.max(F.size("v"))).first()[0]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if dim is None:
        return empty
    rows = v.select("vec_id", "v", "norm2", F.lit(dim).alias("dim"), F.lit(0.0).alias("floor"))
    sized = rows.repartitionByRange(F.desc("norm2"), F.asc("vec_id")).sortWithinPartitions(F.desc("norm2"), F.asc("vec_id"))
    buckets = materialize(sized.select("vec_id", "v", "dim", F.col("norm2").alias("key"), "floor")
                          .mapInArrow(_pack(bucket_rows, False), _PACKED), "buckets")
    # one bucket: bounded by bucket_rows vectors
    first = [tuple(r) for r in buckets.orderBy(F.desc("longest"), "pack").limit(1).select("ids", "vectors", "n", "dim").collect()]
    asked = v.filter(is_query).select("vec_id", "v").distinct()
    floored = materialize(asked.mapInArrow(_first_floors(k, first), "vec_id long, v array<double>, dim int, key double, floor double"),
                          "floors")
    ordered = floored.repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id")
    blocks = materialize(ordered.mapInArrow(_pack(block_rows, True), _BLOCK), "blocks")
    pairs = _pairs(buckets.select("pack", "longest"), blocks.select(F.col("pack").alias("block"), "least"))
    found = (pairs.join(every_deal(blocks.select(F.col("pack").alias("block"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"),
                                                 F.col("vectors").alias("q_vectors"), "floors")), ["block", "deal"])
             .drop("block", "deal").join(buckets.drop("longest"), "pack").drop("pack").mapInArrow(_search_pairs(k), _FOUND))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("exact"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def every_deal(rows: DataFrame) -> DataFrame:
    return rows.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))


def _band(x: Column) -> Column:
    return F.when(x < 1, 0).otherwise(1 + F.floor(F.log2(x))).cast("int")


def _pairs(buckets: DataFrame, blocks: DataFrame) -> DataFrame:
    """``pack, block, deal`` of the buckets whose longest vector reaches a block's least demand.

    A range join by equal keys: lengths fall into bands of powers of two, a bucket is
    listed in its band and all below, and the buckets are dealt ``DEALS`` ways.
    """
    length = F.col("longest") * (1 + SLACK)
    have = (buckets.withColumn("length", length).withColumn("deal", F.pmod(F.xxhash64("pack"), F.lit(DEALS)).cast("int"))
            .withColumn("band", F.explode(F.sequence(F.lit(0), _band(F.col("length"))))))
    need = every_deal(blocks.withColumn("band", _band(F.col("least"))))
    return have.join(need, ["band", "deal"]).filter("length >= least").select("pack", "block", "deal")
