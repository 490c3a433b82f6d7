import random

from pyspark.sql import functions as F

from inkwell.llm import components, simhash
from inkwell.llm.components import connected_components, link, shared_buckets


def labels(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    return {x: find(x) for x in parent}


def test_components_of_chains_stars_and_random_edges(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    edges = [(u, v) for u, v in edges if u != v]
    df = spark.createDataFrame([*edges, (7, 7), (None, 3)], "u long, v long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == labels(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_link_finds_what_the_stars_miss(spark):
    # one bucket; only neighbours on a line link, so stars join few of them
    nodes = list(range(40))
    buckets = spark.createDataFrame([(1, n) for n in nodes], "key long, node long")
    score = lambda p: p.withColumn("score", -F.abs(F.col("a") - F.col("b")).cast("double"))
    confirm = lambda p: p.filter(F.abs(F.col("a") - F.col("b")) <= 1).select("a", "b")
    possible = lambda x, y: F.abs(x["node"] - y["node"]) <= 3
    got = {r.node: r.component for r in link(shared_buckets(buckets, "t"), score, confirm, "t", possible).collect()}
    assert got == {n: 0 for n in nodes}


def test_fingerprints_within_the_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(6)]
    fps = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for bit in rng.sample(range(63), rng.randrange(1, 8)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    want = labels([(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 3])
    copies = {f: 1 + (i % 7 == 0) * 3 for i, f in enumerate(fps)}
    docs = spark.createDataFrame([(f,) for f in fps for _ in range(copies[f])] + [(None,)], "fp long")
    rows = simhash.near_fingerprints(docs, 3).collect()
    assert {r.fp: r.near_class for r in rows} == want | {f: f for f in fps if f not in want}
    assert {r.fp: r.n_links for r in rows} == links_of(copies, 3)


def links_of(copies, radius):
    """Brute force: the other documents within the radius of each fingerprint."""
    return {a: sum(n for b, n in copies.items() if (a ^ b).bit_count() <= radius) - 1 for a in copies}


def test_links_of_a_bucket_cut_into_cells(spark):
    """Many close fingerprints under the same keys; cells of five, and negative fingerprints."""
    rng = random.Random(8)
    base, copies = rng.getrandbits(64), {}
    while len(copies) < 90:
        x = base
        for bit in rng.sample(range(64), rng.randrange(0, 5)):
            x ^= 1 << bit
        copies[x - (1 << 64) if x >> 63 else x] = rng.randrange(1, 4)
    nodes = spark.createDataFrame(list(copies.items()), "fp long, weight long")
    for radius in (1, 3):
        keys = F.explode(simhash.block_keys(F.col("fp"), radius)).alias("key")
        shared = shared_buckets(nodes.select(F.col("fp").alias("node"), "weight", keys), "t")
        want = {a: sum(n for b, n in copies.items() if b != a and bin((a ^ b) & simhash.T.MASK).count("1") <= radius) for a in copies}
        for cell in (5, simhash.CELL):
            got = {r.fp: r.links for r in simhash.link_counts(shared, radius, cell).collect()}
            assert got == {a: n for a, n in want.items() if n}


def test_report_counts_links_of_every_document(spark):
    """All documents of the small table, their edited copies and blank ones, against all pairs."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t[:-3] + "x") for i, t in rows[:40]] + [(20_000 + i, t) for i, t in enumerate(["", None, " \n", rows[0][1]])]
    got = simhash.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = [int(r.fingerprint, 16) for r in got]
    assert len(got) == len(rows) and max(r.n_links for r in got) > 0
    for r, fp in zip(got, prints, strict=True):
        assert r.n_links == sum((fp ^ other).bit_count() <= simhash.RADIUS for other in prints) - 1


def test_fingerprints_equal_a_plain_computation(spark):
    """Signed votes of every weighted term, term by term, against the vectorised ones."""
    import numpy as np

    from inkwell.llm import _tokens as T

    rows = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()][:60]
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    df = simhash.document_frequencies(docs)
    idf, cache = simhash.idf_weights(df, len(rows)), T.WordHashes()
    assert df.max() <= len(rows)
    for r in rows:
        words = [int(h) for h in cache.of(T.split_words(r.text))]
        pairs = [(a * T.M1 + b * T.M2) & T.MASK for a, b in zip(words, words[1:], strict=False)]
        terms = {}
        for t in words + [int(x) for x in T.mix(np.array(pairs, np.uint64))]:
            terms[t] = terms.get(t, 0) + 1
        votes = [0.0] * simhash.BITS
        for t, n in terms.items():
            weight = np.float32(1 + np.log(n)) * idf[t % len(idf)]
            h = int(T.mix(np.array([t], np.uint64))[0])
            for bit in range(simhash.BITS):
                votes[bit] += float(weight) if h >> bit & 1 else -float(weight)
        got = simhash.fingerprint(cache, r.text, idf)
        plain = sum((votes[8 * (b // 8) + b % 8] > 0) << (8 * (b // 8) + 7 - (7 - b % 8)) for b in range(simhash.BITS))
        near_zero = {b for b in range(simhash.BITS) if abs(votes[b]) < 1e-2}
        assert all((got ^ plain) >> b & 1 == 0 for b in range(simhash.BITS) if b not in near_zero)


def test_exploded_buckets_are_not_broadcast(spark, monkeypatch):
    """Twenty keys a node pass as a table of the nodes' size: joined by broadcast they fill the driver."""
    written = {}
    monkeypatch.setattr(components, "materialize", lambda df, name: written.setdefault(name, df))
    nodes = spark.range(1, 10, 4).withColumnRenamed("id", "node")
    shared = shared_buckets(nodes.select("node", F.explode(F.array(F.lit(7), F.col("node") % 8)).alias("key")), "x")
    assert "BroadcastHashJoin" not in written["x-buckets"]._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.key, r.node, r["first"]) for r in shared.collect()) == [(1, 1, 1), (1, 9, 1), (7, 1, 1), (7, 5, 1), (7, 9, 1)]
