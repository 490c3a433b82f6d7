import math
import random

import pytest
from pyspark.sql import functions as F

from inkwell.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, pack long, score long, rank int"


def whole(v):
    return [math.floor(256 * x) for x in v]


def brute(rows, every, k):
    import numpy as np
    fine = [(i, whole([float(np.float32(x)) for x in v])) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, queries = [], {(i, tuple(v)) for i, v in fine if i % every == 0}
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in fine if i != q)[:k]
        out += [(q, r + 1, i, max(-2 ** 63, min(2 ** 63 - 1, -s))) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, every, k, **sizes):
    df = spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, topk.top_products(df, F.col("vec_id") % every == 0, k, **sizes).collect()))


def vectors(rng, n, dim, spread):
    out = []
    for i in range(n):
        length = math.exp(rng.gauss(0, spread))
        v = [rng.gauss(0, 1) for _ in range(dim)]
        norm = math.sqrt(sum(x * x for x in v))
        out.append((i, [length * x / norm for x in v]))
    return out


@pytest.mark.parametrize("dim,spread", [(4, 0.0), (16, 0.05), (16, 1.0)])
def test_equals_brute_force(spark, dim, spread):
    rows = vectors(random.Random(dim), 400, dim, spread)
    rows += [(1000 + i, rows[7][1]) for i in range(150)]             # one vector in a third of the rows
    for sizes in ({}, {"bucket_rows": 32, "block_rows": 8}):
        assert run(spark, rows, 10, 5, **sizes) == brute(rows, 10, 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []), (6, [0.0, 0.0]),
            (7, [-1.0, -0.5]), (8, [1.0]), (9, [1.0, 0.5, 0.25]), (10, [0.0, 0.0]), (None, [9.0, 9.0]), (11, [1.0, 0.5]),
            (11, [1.0, 0.5]), (20, [-3.0, 2.0]), (20, [-3.0, 2.0]), (30, [3e38, 1.0]), (31, [3e38, -1.0]), (12, [1e12, 1e9]), (40, [1e17, 3.0]),
            (41, [1e16, -4.0]), (42, [1e16, 5.0])]
    assert run(spark, rows, 10, 5) == brute(rows, 10, 5)
    assert run(spark, rows, 10, 100, bucket_rows=4, block_rows=2) == brute(rows, 10, 100)


def test_empty_and_lone(spark):
    assert run(spark, [], 10, 5) == []
    assert run(spark, [(0, [1.0])], 10, 5) == []
    assert run(spark, [(1, [1.0]), (2, [2.0])], 10, 5) == []
    assert run(spark, [(0, None), (50, [nan := float("nan")])], 10, 5) == [] and nan != nan


def test_coordinates_prune_and_keep_the_rest():
    import numpy as np
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(500, 8)) * rng.uniform(0.5, 2, (500, 1))
    bucket = topk._Bucket(np.arange(500), np.floor(256 * vectors))
    shrunk = 0
    for q in np.floor(256 * rng.normal(size=(40, 8))):
        direction = q / np.linalg.norm(q)
        cosines = bucket.directions @ direction
        for c in (0.3, 0.6, 0.9, 1.0):
            places = bucket.by_coordinates(direction, c)
            assert set(np.nonzero(cosines >= c)[0]) <= set(places.tolist())
            shrunk += len(places) < 250
    assert shrunk > 80
